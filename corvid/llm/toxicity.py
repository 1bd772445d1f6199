"""Toxicity classifier (13): a factorization machine over hashed terms.

1. *Terms.* Every word (a run of letters and digits, lower case) gives its
   beginnings of 3 to 8 bytes and itself, hashed into ``BUCKETS`` buckets: a stem
   is known from words never seen before. A document is the set of its buckets,
   over its whole text.
2. *Choice.* The ``FEATURES`` buckets whose documents differ most between the
   labels (likelihood ratio) are columns; a column's value is the strength of
   its shrunk log odds, so that what says little by itself counts little, but
   still counts (``FLOOR``), as it may say more together with another term.
3. *Factorization machine.* ``logit = b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i
   x_j``: the factors learn what pairs of terms mean (an insult beside the
   mention of a group), which no sum of single weights can. Fitted in numpy by
   mini-batches on at most ``SAMPLE`` labelled documents, those with the
   smallest md5 of the id; the decisive epoch is the best one on a share of
   them that is kept aside.

Learning moves feature sets of the sample only; scoring is one pass over the
texts, without a shuffle.

Defined cases: null and empty texts have no terms and score the bias alone;
with no labelled rows, or one class only, every score is the share of label 1
(0.5 without rows); rows that share a doc_id are scored one by one, and one of
them is learned from; an id labelled twice is toxic if any label says so; null
doc_ids are never labelled; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.quality import held_out
from corvid.llm.spark_util import read_table, stored
from corvid.llm.textbatch import LETTER, RollingHash, _bounds, chunks, rows_of, text_buffer

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
STEMS = (3, 4, 5, 6, 7, 8)
#: Salt of whole words, so that a word differs from a beginning of another.
WORD_SALT = np.uint64(0x5851F42D4C957F2D)
#: Bytes of text hashed at once.
TEXT_CHUNK = 1 << 18
SAMPLE, FEATURES = 20_000, 4_096
SHRINK, FLOOR = 20.0, 0.1
RANK, EPOCHS, BATCH, RATE, DECAY = 8, 30, 128, 0.02, 1e-5
THRESHOLD = 0.5


def lower(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with ASCII and Latin-1 capitals in lower case."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    latin = latin[(data[latin] >= 0x80) & (data[latin] <= 0x9E) & (data[latin] != 0x97)]
    out[latin] += 32
    return out


def term_pairs(data: np.ndarray, off: np.ndarray, place: np.ndarray | None = None) -> Iterator[tuple]:
    """``(first text, past last text, rows, buckets)`` chunk by chunk: each pair of
    a text and one of its buckets once, in order. With ``place`` buckets become
    columns, and those without one are left out."""
    for lo, hi, d, o in chunks(data, off, TEXT_CHUNK):
        start, end = _bounds(LETTER[d], o)
        if not len(start):
            yield lo, hi, np.empty(0, np.int64), np.empty(0, np.int64)
            continue
        h, row = RollingHash(lower(d)), rows_of(o, start)
        keys, at = [h.ranges(start, end) ^ WORD_SALT], [row]
        for n in STEMS:
            long = end - start >= n
            keys.append(h.ranges(start[long], start[long] + n))
            at.append(row[long])
        bucket, row = (np.concatenate(keys) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.concatenate(at)
        if place is not None:
            bucket = place[bucket].astype(np.int64)
            row, bucket = row[bucket >= 0], bucket[bucket >= 0]
        pair = np.unique((row << BUCKET_BITS) | bucket)
        yield lo, hi, pair >> BUCKET_BITS, pair & (BUCKETS - 1)


class Columns:
    """The chosen buckets and their values."""

    def __init__(self, bucket: np.ndarray, c: np.ndarray, c1: np.ndarray, n: int, n1: int, size: int = FEATURES):
        base = n1 / n
        p = (c1 + SHRINK * base) / (c + SHRINK)
        logit = np.log(p / (1 - p)) - np.log(base / (1 - base))
        strength = _ratio(c, c1, n, n1)
        best = np.sort(np.lexsort((bucket, -strength))[:size])
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[bucket[best]] = np.arange(len(best))
        self.value = np.maximum(FLOOR, np.abs(logit[best])).astype(np.float64)


def _ratio(c: np.ndarray, c1: np.ndarray, n: int, n1: int) -> np.ndarray:
    """Likelihood ratio of each 2 x 2 table (term or not, toxic or not)."""
    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300)), 0.0)
    c, c1 = c.astype(float), c1.astype(float)
    total = 0.0
    for seen, rows, cols in ((c1, c, n1), (c - c1, c, n - n1), (n1 - c1, n - c, n1), (n - n1 - c + c1, n - c, n - n1)):
        total = total + part(seen, rows * cols / n)
    return total


class FactorizationMachine:
    """Bias, weights and factors; rows are ``(row, column)`` pairs sorted by row."""

    def __init__(self, value: np.ndarray, base: float, seed: int = 13):
        rng = np.random.default_rng(seed)
        self.value, self.base, self.flat = value, base, base in (0.0, 1.0) or not len(value)
        if not self.flat:
            self.bias = np.array([np.log(base / (1 - base))])
            self.w = np.zeros(len(value))
            self.v = rng.normal(0, 0.05, (len(value), RANK))
            self.rng = rng

    def sums(self, row: np.ndarray, col: np.ndarray, n: int):
        """Logits and the factor sums of ``n`` rows."""
        x = self.value[col]
        xv = self.v[col] * x[:, None]
        linear = np.bincount(row, self.w[col] * x, minlength=n)
        total = np.stack([np.bincount(row, xv[:, f], minlength=n) for f in range(RANK)], axis=1)
        square = np.bincount(row, (xv * xv).sum(axis=1), minlength=n)
        return self.bias[0] + linear + 0.5 * ((total ** 2).sum(axis=1) - square), total, x, xv

    def fit(self, row: np.ndarray, col: np.ndarray, y: np.ndarray) -> None:
        if self.flat:
            return
        aside = self.rng.permutation(len(y)) < len(y) // 10
        first = np.searchsorted(row, np.arange(len(y) + 1))
        params = [self.bias, self.w, self.v]
        m, s, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        best = (np.inf, [p.copy() for p in params])
        learn = np.flatnonzero(~aside)
        for _ in range(EPOCHS):
            for at in np.array_split(self.rng.permutation(learn), max(1, len(learn) // BATCH)):
                r, c = _take(first, col, at)
                z, total, x, xv = self.sums(r, c, len(at))
                err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[at]) / len(at)
                g_w = np.bincount(c, err[r] * x, minlength=len(self.w)) + DECAY * self.w
                g_v = DECAY * self.v
                each = err[r][:, None] * x[:, None] * (total[r] - xv)
                for f in range(RANK):
                    g_v[:, f] += np.bincount(c, each[:, f], minlength=len(self.w))
                step += 1
                for p, g, mi, si in zip(params, [err.sum(keepdims=True), g_w, g_v], m, s):
                    mi += 0.1 * (g - mi)
                    si += 0.001 * (g * g - si)
                    p -= RATE * (mi / (1 - 0.9 ** step)) / (np.sqrt(si / (1 - 0.999 ** step)) + 1e-8)
            if aside.any():
                held = np.flatnonzero(aside)
                z = self.sums(*_take(first, col, held), len(held))[0]
                loss = float(np.logaddexp(0, np.where(y[held] == 1, -z, z)).mean())
                if loss < best[0]:
                    best = (loss, [p.copy() for p in params])
        if best[0] < np.inf:
            self.bias, self.w, self.v = best[1]

    def score(self, row: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
        """Probability of label 1 of ``n`` rows."""
        if self.flat:
            return np.full(n, self.base)
        return 1 / (1 + np.exp(-np.clip(self.sums(row, col, n)[0], -60, 60)))


def _take(first: np.ndarray, col: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of the rows ``at``, renumbered 0, 1, ..."""
    size = first[at + 1] - first[at]
    row = np.repeat(np.arange(len(at)), size)
    start = np.repeat(first[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    return row, col[start + np.arange(len(row))]


class Model:
    """Columns and machine; ``score`` takes a string column."""

    def __init__(self, columns: Columns | None, machine: FactorizationMachine):
        self.columns, self.machine = columns, machine

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.machine.base)
        if self.columns is not None:
            for lo, hi, row, col in term_pairs(*text_buffer(texts), self.columns.place):
                out[lo:hi] = self.machine.score(row, col, hi - lo)
        return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """Fit on at most ``sample`` labelled ids outside the held-out fifth."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("_y"))
             .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")   # at most ``sample`` ids

    def terms(batches):
        for batch in batches:
            for lo, hi, row, bucket in term_pairs(*text_buffer(batch.column(1))):
                cut = np.split(bucket.astype(np.uint32), np.searchsorted(row, np.arange(1, hi - lo)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(2)[lo:hi], pa.array([c.tobytes() for c in cut], pa.binary())],
                    names=["doc_id", "y", "terms"])

    # one row for each id, so that copies of an id add nothing to the bound
    sets = stored(rows.mapInArrow(terms, "doc_id long, y double, terms binary")
                  .groupBy("doc_id").agg(F.max("y").alias("y"), F.min("terms").alias("terms")), "tox-terms")

    def count(batches):
        c, c1 = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = np.frombuffer(t, np.uint32)
                c[at] += 1
                c1[at] += int(y == 1)
        hit = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(c[hit]), pa.array(c1[hit])], names=["b", "c", "c1"])

    size = sets.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0)).alias("n1")).first()
    n, n1 = size["n"], size["n1"]
    base = n1 / n if n else 0.5
    if not n or not 0 < n1 < n:
        return Model(None, FactorizationMachine(np.empty(0), base))
    counts = (sets.select("y", "terms").mapInArrow(count, "b long, c long, c1 long")
              .groupBy("b").agg(F.sum("c").alias("c"), F.sum("c1").alias("c1"))).toPandas()   # BUCKETS rows at most
    columns = Columns(counts["b"].to_numpy(), counts["c"].to_numpy(), counts["c1"].to_numpy(), n, n1, features)

    def choose(batches):
        for batch in batches:
            kept = []
            for t in batch.column(2).to_pylist():
                col = columns.place[np.frombuffer(t, np.uint32)]
                kept.append(np.sort(col[col >= 0]).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.binary())],
                                             names=["doc_id", "y", "cols"])
    got = sets.mapInArrow(choose, "doc_id long, y double, cols binary").orderBy("doc_id").collect()  # ``sample`` rows
    cols = [np.frombuffer(r["cols"], np.uint16) for r in got]
    machine = FactorizationMachine(columns.value, base)
    machine.fit(np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate(cols).astype(np.int64),
                np.array([r["y"] for r in got]))
    return Model(columns, machine)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row of ``docs``."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1)))],
                                             names=["doc_id", "score"])
    return docs.select("doc_id", "text").mapInArrow(
        run, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())]))


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity_scores(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
