"""Quality classifier (2): random-indexing word vectors, pooled, two-layer network.

1. *Word vectors.* Every token falls into one of ``BUCKETS`` hash buckets; each
   bucket has a fixed sparse index vector (a few +1/-1 entries, from the
   hash). A bucket's context vector is the sum of the index vectors of the
   tokens within ``WINDOW`` places, over **all** texts. The sums are integers:
   each task adds up its texts and sends one table of ``BUCKETS`` rows, which
   are added in slices, so the result does not depend on the partitioning.
   Hash buckets bound the table at any vocabulary; rare words share buckets.
2. *Pooling.* A document is the mean and the spread of its tokens' scaled
   context vectors and the mean product of neighbours, over its whole text.
3. *Network.* Two layers in numpy (tanh, then a logit), trained on at most
   ``SAMPLE`` labelled documents, those with the smallest md5 of the id.
   A share of them is kept aside, and one temperature, chosen there by log
   loss, scales the logits into calibrated probabilities.

Defined cases: null and empty texts pool to the zero vector and get the score
of that; with no labelled rows, or one class only, every score is the share of
label 1 (0.5 without rows); rows that share a doc_id are scored one by one;
null doc_ids are never labelled; extra columns are kept by ``keep_good`` and
ignored by ``quality_scores``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.spark_util import read_table, stored
from corvid.llm.textbatch import (BASE, RollingHash, chunks, mix, rows_of,
                                  text_buffer, tokens)

BUCKET_BITS, DIM, WINDOW, NONZERO = 13, 32, 2, 2
BUCKETS = 1 << BUCKET_BITS
PARTS = 3
SLICES = 32
#: Bytes of text pooled at once.
POOL_CHUNK = 1 << 16
SAMPLE = 20_000
THRESHOLD = 0.3
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 0.01, 1e-4


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries: two ``(BUCKETS, NONZERO)`` arrays."""
    h = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(BASE)).reshape(BUCKETS, NONZERO)
    return (h % np.uint64(DIM)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def token_buckets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every token of the chunk."""
    start, end = tokens(data, off)
    h = RollingHash(data).ranges(start, end)
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), rows_of(off, start)


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, sign = index_vectors()
    total = np.zeros(BUCKETS * DIM)
    for batch in batches:
        data, off = text_buffer(batch.column(0))
        for _, _, d, o in chunks(data, off, 2 << 20):
            b, row = token_buckets(d, o)
            for gap in range(1, WINDOW + 1):
                same = np.flatnonzero(row[gap:] == row[:-gap]) if len(row) > gap else np.empty(0, np.int64)
                left, right = b[same], b[same + gap]
                for i in range(NONZERO):
                    for here, there in ((left, right), (right, left)):
                        total += np.bincount(here * DIM + place[there, i], sign[there, i],
                                             minlength=BUCKETS * DIM)
    sums = total.astype(np.int64).reshape(SLICES, -1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([s.tobytes() for s in sums], pa.binary())],
        names=["slice", "sums"])


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            got = np.frombuffer(raw.as_buffer(), dtype=np.int64)
            held[s] = held[s] + got if s in held else got.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())],
        names=["slice", "sums"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """``(BUCKETS, DIM)`` scaled context vectors of all texts of ``docs``."""
    schema = "slice int, sums binary"
    part = docs.select("text").mapInArrow(_context_sums, schema)
    rows = part.repartition(SLICES, "slice").mapInArrow(_add_slices, schema).collect()  # BUCKETS * DIM numbers
    sums = np.zeros((SLICES, BUCKETS * DIM // SLICES), dtype=np.int64)
    for r in rows:
        sums[r["slice"]] += np.frombuffer(r["sums"], dtype=np.int64)
    v = sums.reshape(BUCKETS, DIM).astype(np.float64)
    v -= v.sum(0) / max(1.0, np.abs(v).sum()) * np.abs(v).sum(1, keepdims=True)   # the common direction
    return (v / np.maximum(1e-9, np.linalg.norm(v, axis=1, keepdims=True))).astype(np.float32)


def pool(data: np.ndarray, off: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """``(texts, PARTS * DIM)``: the mean and the spread of the tokens' vectors, and
    the mean product of each token's vector with the next one's."""
    out = np.zeros((len(off) - 1, PARTS * DIM))
    for lo, hi, d, o in chunks(data, off, POOL_CHUNK):
        b, row = token_buckets(d, o)
        if not len(b):
            continue
        has, first = np.unique(row, return_index=True)
        n = np.diff(np.append(first, len(row)))[:, None]
        v = vectors[b]
        mean = np.add.reduceat(v, first, axis=0) / n
        square = np.add.reduceat(v * v, first, axis=0) / n
        pair = np.zeros_like(v)
        np.multiply(v[:-1], v[1:], out=pair[:-1])
        pair[(first - 1)[1:]] = 0                   # the last token of a text has no next
        pair[-1] = 0
        follow = np.add.reduceat(pair, first, axis=0) / n
        out[lo + has] = np.hstack([mean, np.sqrt(np.maximum(0, square - mean ** 2)), follow])
    return out


class Network:
    """Standardised input, tanh layer, logit; scores are calibrated."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11):
        self.base = float(y.mean()) if len(y) else 0.5
        self.flat = len(y) < 10 or self.base in (0.0, 1.0)
        self.t = 1.0
        if self.flat:
            return
        rng = np.random.default_rng(seed)
        self.mu, self.sd = x.mean(0), x.std(0) + 1e-6
        held = rng.permutation(len(y)) < max(1, len(y) // 5)
        self._fit((x[~held] - self.mu) / self.sd, y[~held], rng)
        z, target = self._logit((x[held] - self.mu) / self.sd), y[held]
        grid = np.exp(np.linspace(-2, 3, 101))
        self.t = float(min(grid, key=lambda t: np.logaddexp(0, np.where(target == 1, -z, z) / t).mean()))

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        d = x.shape[1]
        p = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for at in np.array_split(order, max(1, len(y) // BATCH)):
                xb, yb = x[at], y[at]
                h = np.tanh(xb @ p[0] + p[1])
                err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - yb) / len(at)
                back = np.outer(err, p[2]) * (1 - h * h)
                grads = [xb.T @ back + DECAY * p[0], back.sum(0), h.T @ err + DECAY * p[2], err.sum(keepdims=True)]
                step += 1
                for a, g, mi, vi in zip(p, grads, m, v):
                    mi += 0.1 * (g - mi)
                    vi += 0.001 * (g * g - vi)
                    a -= RATE * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.999 ** step)) + 1e-8)
        self.w1, self.b1, self.w2, self.b2 = p

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1."""
        if self.flat:
            return np.full(len(x), self.base)
        z = self._logit((x - self.mu) / self.sd) / self.t
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def held_out(doc_id) -> F.Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample: int = SAMPLE) -> Network:
    """Fit on at most ``sample`` labelled ids outside the held-out fifth."""
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").cast("double").alias("_y"))
             .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")   # at most ``sample`` ids

    def features(batches):
        for batch in batches:
            x = pool(*text_buffer(batch.column(1)), vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["doc_id", "y", "x"])
    # one row for each id, so that copies of an id add nothing to the bound
    got = (rows.mapInArrow(features, "doc_id long, y double, x binary")
           .groupBy("doc_id").agg(F.max("y").alias("y"), F.min("x").alias("x")).orderBy("doc_id").collect())
    x = np.array([np.frombuffer(r["x"]) for r in got]).reshape(-1, PARTS * DIM)
    return Network(x, np.array([r["y"] for r in got]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    vectors = word_vectors(docs)
    return vectors, train(docs, labels, vectors, sample)


def quality_scores(docs: DataFrame, vectors: np.ndarray, net: Network) -> DataFrame:
    """``(doc_id, score)`` of every row of ``docs``."""
    def run(batches):
        for batch in batches:
            s = net.score(pool(*text_buffer(batch.column(1)), vectors))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])
    return docs.select("doc_id", "text").mapInArrow(
        run, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    vectors, net = fit(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            s = net.score(pool(*text_buffer(batch.column(at)), vectors))
            yield batch.filter(pa.array(s >= threshold))
    return docs.mapInArrow(run, docs.schema)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    vectors, net = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_scores(docs, vectors, net)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
