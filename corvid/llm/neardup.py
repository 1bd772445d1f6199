"""MinHash near-dedup (9): DartMinHash signatures, banded joining, exact check.

A text is a weighted set: its shingles of five words, weighted by how often
they occur. Similarity is weighted Jaccard, 0.8 or more.

*Darts.* For every shingle a fixed Poisson process throws darts on the plane
of weight x rank. It is generated region by region from hashes of the shingle
(weight strips 0-1, 1-2, 2-4, ..., rank strips in fixed steps), so equal
shingles get equal darts in every text. A dart counts if its weight is below
the shingle's weight; each dart names one of ``T`` coordinates, and a
coordinate keeps its earliest dart. Rank strips are opened only until every
coordinate has one, so the number of darts is about ``T log T`` whatever the
length of the text. Two texts agree in a coordinate with the probability of
their weighted Jaccard similarity.

*Banding.* ``BANDS`` bands of ``ROWS`` coordinates: a pair at 0.8 shares no band
with probability 3e-6. Copies of one text are one node. In a bucket every
member meets the bucket's head (a star, not all pairs): the member that shares
most buckets with others, which is the text nearest the middle of its group.
Texts of the pairs whose signatures agree in ``AGREE`` coordinates are compared
exactly. Buckets that still hold several components are then searched for
links between them in bounded blocks of signatures, so that a link that does
not involve the head is found too. Only these texts get a longer signature of
``FINE`` coordinates, which tells pairs near the threshold apart; the
candidates that are left are checked exactly.

*Classes.* Connected components by alternating large-star and small-star steps
on the links, in DataFrames.

Defined cases: null texts are empty; texts without words are grouped only with
their exact copies; 1 to 4 words make one shingle; null doc_ids take part, and
the class id is the smallest doc_id of the class (null if it has none); equal
rows are copies of each other; an empty table gives no rows; extra columns are
kept by ``keep_one`` and ignored by ``near_dup_classes``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from corvid.llm.spark_util import read_table, stored
from corvid.llm.textbatch import (BASE, RollingHash, chunks, mix, rows_of,
                                  text_buffer, words)

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 24, 4
T = BANDS * ROWS
#: A pair at 0.8 agrees in fewer coordinates with probability 1e-5.
AGREE = 60
#: Coordinates of the longer signature, and the agreement that a pair at 0.8
#: misses with probability 1e-5 while most pairs at 0.7 do.
FINE, FINE_AGREE = 1024, 764
BLOCK = 256
#: Bytes of text signed at once, and pairs compared at once, in a task.
SIGN_CHUNK, FINE_CHUNK, PAIR_CHUNK = 1 << 18, 1 << 16, 128
#: Upper ends of the rank strips: 2^-12, 2^-10, ..., 2^-4, 2^-3, 2^-2, ...
RANK_ENDS = [2.0 ** e for e in (-12, -10, -8, -6, -4)] + [2.0 ** e for e in range(-3, 60)]
U = np.uint64


def shingles(data: np.ndarray, off: np.ndarray, k: int = SHINGLE):
    """``(text, hash, count)`` of the distinct shingles, sorted by text and hash."""
    s, e = words(data, off)
    if not len(s):
        return np.empty(0, np.int64), np.empty(0, U), np.empty(0, np.int64)
    h, row = RollingHash(data).ranges(s, e), rows_of(off, s)
    power = [U(pow(BASE, i, 1 << 64)) for i in range(k)]
    out_row, out_h = [], []
    if len(row) >= k:
        full = np.flatnonzero(row[k - 1:] == row[:len(row) - k + 1])
        out_row.append(row[full])
        out_h.append(mix(sum(h[full + i] * power[i] for i in range(k))))
    has, first, n = np.unique(row, return_index=True, return_counts=True)
    short = n < k
    if short.any():
        at, length = first[short], n[short]
        total = length.astype(U) * U(0x9FB21C651E98DF25)
        for i in range(k - 1):
            inside = length > i
            total[inside] += h[at[inside] + i] * power[i]
        out_row.append(has[short])
        out_h.append(mix(total))
    row, h = np.concatenate(out_row), np.concatenate(out_h)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])))
    return row[new], h[new], np.diff(np.append(new, len(h)))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U(11)).astype(np.float64) * 2.0 ** -53


def _poisson_cdf(area: float) -> np.ndarray:
    n = np.arange(1, int(area + 12 * area ** 0.5 + 30))
    steps = np.concatenate([[0.0], np.cumsum(np.log(area / n))]) - area
    return np.cumsum(np.exp(steps))


def dart_minhash(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n_rows: int, t: int = T) -> np.ndarray:
    """``(n_rows, t)`` dart ids; rows without elements stay 0."""
    best, ids = np.full(n_rows * t, np.inf), np.zeros(n_rows * t, dtype=U)
    total = np.bincount(row, weight, minlength=n_rows)
    need = t * (np.log(t) + 2)
    # (element, weight strip): strip 0 is [0, 1), strip s is [2^(s-1), 2^s)
    strips = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    el = np.repeat(np.arange(len(row)), strips)
    strip = np.arange(len(el)) - np.repeat(np.cumsum(strips) - strips, strips)
    base = mix(h[el] + strip.astype(U) * U(0xC2B2AE3D27D4EB4F))
    open_ = total > 0
    low = 0.0
    for r, high in enumerate(RANK_ENDS):
        if not open_.any():
            break
        live = open_[row[el]]
        if not live.all():
            el, strip, base = el[live], strip[live], base[live]
        u = mix(base + U((r + 1) * 0x165667B19E3779F9 % (1 << 64)))
        count = np.zeros(len(el), dtype=np.int64)
        for s in np.unique(strip):
            of = strip == s if strip.any() else slice(None)
            count[of] = np.searchsorted(_poisson_cdf((high - low) * (1.0 if s == 0 else 2.0 ** (s - 1))), _unit(u[of]), "right")
        hit = np.flatnonzero(count)
        n = count[hit]
        at = np.repeat(hit, n)
        j = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        dart = mix(u[at] + (j + 1).astype(U) * U(0x27D4EB2F165667C5))
        wide = np.where(strip[at] == 0, 1.0, 2.0 ** (strip[at] - 1))
        at_weight = np.where(strip[at] == 0, 0.0, wide) + wide * _unit(mix(dart + U(1)))
        ok = at_weight < weight[el[at]]
        at, dart = at[ok], dart[ok]
        rank = low + (high - low) * _unit(mix(dart + U(2)))
        slot = row[el[at]] * t + (mix(dart + U(3)) % U(t)).astype(np.int64)
        np.minimum.at(best, slot, rank)
        first = best[slot] == rank
        ids[slot[first]] = dart[first]
        open_ &= (total * high < need) | np.isinf(best).reshape(n_rows, t).any(1)
        low = high
    return ids.reshape(n_rows, t)


def band_keys(ids: np.ndarray) -> np.ndarray:
    """``(rows, BANDS)`` bucket keys, different for different bands."""
    part = ids.reshape(len(ids), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U) * U(BASE), part.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key + part[:, :, i])
    return key.view(np.int64)


def _text_key(col) -> F.Column:
    return F.unhex(F.md5(F.coalesce(col, F.lit(""))))


def _sign(batches):
    """(doc_id, text) -> (doc_id, node, sig, bands)."""
    for batch in batches:
        data, off = text_buffer(batch.column(1))
        for lo, hi, d, o in chunks(data, off, SIGN_CHUNK):
            ids = dart_minhash(*shingles(d, o), hi - lo)
            has = (ids != 0).any(1)
            keys, sig = band_keys(ids), ids.astype(np.uint16)
            raw = d.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo),
                pa.array([hashlib.md5(raw[o[i]:o[i + 1]]).digest() for i in range(hi - lo)], pa.binary()),
                pa.array([sig[i].tobytes() if has[i] else b"" for i in range(hi - lo)], pa.binary()),
                pa.array([keys[i] if has[i] else [] for i in range(hi - lo)], pa.list_(pa.int64()))],
                names=["doc_id", "node", "sig", "bands"])


def similarity(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of two columns of texts, row by row."""
    sides = []
    for col in (left, right):
        data, off = text_buffer(col)
        got = [(lo + r, h, c) for lo, _, d, o in chunks(data, off) for r, h, c in [shingles(d, o)]]
        sides.append([np.concatenate(x) for x in zip(*got)])
    row, h, c = (np.concatenate([a, b]) for a, b in zip(*sides))
    order = np.lexsort((h, row))
    row, h, c = row[order], h[order], c[order].astype(np.float64)
    total = np.bincount(row, c, minlength=len(left))
    same = np.flatnonzero((row[1:] == row[:-1]) & (h[1:] == h[:-1]))
    both = np.bincount(row[same], np.minimum(c[same], c[same + 1]), minlength=len(left))
    return both / np.maximum(total - both, 1e-9)


def _checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that reach the similarity on their whole texts."""
    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), PAIR_CHUNK):
                part = batch.slice(at, PAIR_CHUNK)
                ok = similarity(part.column(2), part.column(3)) >= SIMILAR
                yield part.select([0, 1]).filter(pa.array(ok))
    return pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in ``AGREE`` coordinates or more."""
    sa = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sa"))
    sb = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sb"))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, T) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).sum(1) >= AGREE))
    return pairs.join(sb, "b").join(sa, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def _fine(batches):
    """(node, text) -> (node, fine): a longer signature, one byte a coordinate."""
    for batch in batches:
        data, off = text_buffer(batch.column(1))
        for lo, hi, d, o in chunks(data, off, FINE_CHUNK):
            ids = dart_minhash(*shingles(d, o), hi - lo, FINE).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo),
                                              pa.array([s.tobytes() for s in ids], pa.binary())], names=["node", "fine"])


def _cross_block(batches):
    """Block pairs -> pairs of different components whose signatures agree.

    A pair is looked at in the first band that it shares, and nowhere else."""
    for batch in batches:
        for p in batch.to_pylist():
            a, b, band = p["left"], p["right"], p["band"]
            x, y = (np.frombuffer(b"".join(r["sig"] for r in s), np.uint16).reshape(-1, T) for s in (a, b))
            fx, fy = (np.frombuffer(b"".join(r["fine"] for r in s), np.uint8).reshape(-1, FINE) for s in (a, b))
            la, lb = (np.array([r["root"] for r in s], dtype="S16") for s in (a, b))
            out = set()
            for i in range(len(a)):
                same = y == x[i]
                near = np.flatnonzero((same.sum(1) >= AGREE) & (lb != la[i]))
                if not len(near):
                    continue
                first = same[near].reshape(-1, BANDS, ROWS).all(2).argmax(1)
                near = near[first == band]
                near = near[(fy[near] == fx[i]).sum(1) >= FINE_AGREE]
                out |= {tuple(sorted((a[i]["node"], b[j]["node"]))) for j in near}
            yield pa.RecordBatch.from_arrays([pa.array([q[0] for q in out], pa.binary()),
                                              pa.array([q[1] for q in out], pa.binary())], names=["a", "b"])


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members, with their component, of buckets that hold several."""
    members = stored(members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    mixed = stored(members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                   .filter("lo <> hi").select("key"), "mixed-buckets")
    return stored(members.join(mixed, "key"), "mixed-members")


def _cross_pairs(mixed: DataFrame, nodes: DataFrame, fine: DataFrame) -> DataFrame:
    """Candidate links between components that meet in a bucket."""
    blocks = (mixed.join(nodes.select("node", "sig"), "node").join(fine, "node")
              .withColumn("nb", F.ceil(F.col("n") / BLOCK))
              .withColumn("blk", F.pmod(F.xxhash64("node"), F.col("nb")))
              .groupBy("key", "band", "nb", "blk")          # about BLOCK members by the hash
              .agg(F.collect_list(F.struct("node", "root", "sig", "fine")).alias("rows")))
    blocks = stored(blocks, "near-blocks")
    left = (blocks.select("key", "band", F.col("blk").alias("i"), F.col("rows").alias("left"),
                          F.explode(F.sequence("blk", F.col("nb") - 1)).alias("j")))
    right = blocks.select("key", F.col("blk").alias("j"), F.col("rows").alias("right"))
    return left.join(right, ["key", "j"]).select("left", "right", "band").mapInArrow(
        _cross_block, "a binary, b binary").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest node."""
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .filter("a <> b").distinct(), "links")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the least neighbours are stored, so that a hot node's side of the join can be split
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = (both.join(least, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        # a node has few smaller neighbours here, so this join has no hot side
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        e = stored(joined.select("a", F.col("m").alias("b")).unionByName(
            joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), "small-star")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def near_dup_classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, node, class_id, class_size, keeper, kept_doc)`` of every row.

    ``node`` is the md5 of the text; the class is represented by the row with
    text ``keeper`` and id ``kept_doc``.
    """
    schema = T_.StructType([T_.StructField("doc_id", docs.schema["doc_id"].dataType),
                            T_.StructField("node", T_.BinaryType()), T_.StructField("sig", T_.BinaryType()),
                            T_.StructField("bands", T_.ArrayType(T_.LongType()))])
    signed = stored(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_sign, schema), "signed")
    nodes = stored(signed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
                                              F.first("sig").alias("sig"), F.first("bands").alias("bands")), "nodes")
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = stored(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    members = stored(buckets.join(sizes, "key"), "members")
    # the more company a text has over all its buckets, the nearer it is to the middle of its group
    rank = stored(members.groupBy("node").agg(F.sum("n").alias("company")), "company")
    heads = stored(members.join(rank, "node").groupBy("key").agg(F.max_by(
        "node", F.struct("company", "node")).alias("head")), "heads")
    star = (members.join(heads, "key").filter(F.col("node") != F.col("head"))
            .select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct())
    star = stored(_agreeing(star, nodes), "star-pairs")

    # the texts that share a bucket with another, moved once; joined by sorting at
    # any size, so that the plan does not change with the number of such texts
    texts = stored(docs.select(_text_key(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text"))
                   .join(rank.select("node").hint("merge"), "node", "left_semi")
                   .groupBy("node").agg(F.first("text").alias("text")), "near-texts")
    links = stored(_checked(star, texts), "star-links")
    roots = components(links)
    mixed = _mixed(members, roots)
    fine = stored(texts.mapInArrow(_fine, "node binary, fine binary"), "fine")
    more = stored(_cross_pairs(mixed, nodes, fine).join(star, ["a", "b"], "left_anti"), "cross-pairs")
    links = links.unionByName(stored(_checked(more, texts), "cross-links"))
    roots = components(links)
    classed = (nodes.select("node", "first_id", "copies").join(roots, "node", "left")
               .withColumn("root", F.coalesce("root", "node")))
    keeper = F.min(F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id"), F.col("node")))
    classes = (classed.groupBy("root").agg(keeper.alias("k"), F.sum("copies").alias("class_size"))
               .select("root", F.col("k.first_id").alias("class_id"), "class_size", F.col("k.node").alias("keeper")))
    named = stored(classed.select("node", "root").join(classes, "root").drop("root"), "classes")
    return signed.select("doc_id", "node").join(named, "node").select(
        "doc_id", "node", "class_id", "class_size", "keeper")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, all columns: the smallest doc_id's."""
    classes = near_dup_classes(docs)
    keepers = stored(classes.filter(F.col("node") == F.col("keeper")).groupBy("keeper", "class_id")
                     .agg(F.count(F.when(F.col("doc_id").eqNullSafe(F.col("class_id")), 1)).alias("rows")), "keepers")
    named = keepers.select(F.col("keeper").alias("_node"), F.col("class_id").alias("_id"), F.col("rows").alias("_rows"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    kept = (docs.select(row, _text_key(F.col("text")).alias("_key"), F.col("doc_id").alias("_doc"))
            .join(named, (F.col("_key") == F.col("_node")) & F.col("_doc").eqNullSafe(F.col("_id"))))
    single = kept.filter("_rows = 1").select("_row.*")
    # rows that repeat both id and text: any one of them
    again = kept.filter("_rows > 1").groupBy("_key").agg(F.first("_row").alias("_row")).select("_row.*")
    return single.unionByName(again)


def op9_near_dups(spark, sf_dir: str) -> DataFrame:
    return near_dup_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")
