"""Hard-negative mining (12): score bounds along a spanning tree of anchors.

Anchors meet all candidates in blocks. The anchors of a block are joined by a
minimum spanning tree (Euclidean distance). For an anchor ``a`` with parent
``p`` and a candidate ``c``, ``|<a, c> - <p, c>| <= |a - p| * |c|``: the
interval known for a candidate's score at the parent, widened by edge distance
times candidate norm, holds its score at the child. At the root all scores are
computed; below it, only of candidates whose interval overlaps the window that
matters there, and those get their exact score (an interval of one point):

* *positives*: same-label candidates that can reach the k-th largest lower bound;
* *negatives*: other-label candidates that can lie in the window of one of the
  anchor's positives, ``low/100 * positive <= negative <= high/100 * positive``.

Work on Spark: candidate blocks are formed once, in place, and stay in one task
each, while the anchors (few) are sent to every block in smaller blocks and
pass by one at a time. A task holds one block of either, and returns at most
``k`` rows per anchor (and positive), which a ranking per anchor reduces.

Defined cases: rows with a null label, a null vector or null or non-finite
components take no part; vectors are only compared with those of their own
length; repeated rows are rows of their own (each is an anchor, each is a
candidate, only the anchor's own row is left out); ties go to the smaller
vec_id; a null vec_id is never an anchor and comes last among ties; an anchor
without positives, or whose windows are empty (a negative positive score),
gives no rows; an empty table gives no rows; extra columns are ignored.
Scores are exact integers; large components are computed with Python's.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.codes import matrices, usable_vectors
from corvid.llm.spark_util import read_table, stored

ANCHOR_BLOCK, CANDIDATE_BLOCK = 256, 8192
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100
SCALE, ANCHOR_EVERY = 256, 100
#: Largest component whose inner products are exact in float64.
SAFE = 1 << 20
#: Stands for a null vec_id: last among ties, null again in the result.
NO_ID = (1 << 63) - 1


def numbers(arr: np.ndarray) -> np.ndarray:
    """float64 when inner products of it are exact there, else Python integers."""
    big = max((abs(int(x)) for x in (arr.min(initial=0), arr.max(initial=0))), default=0)
    dim = max(1, arr.shape[1])
    return arr.astype(np.float64) if big <= SAFE and big * big * dim < 1 << 52 else arr.astype(object)


def spanning_tree(mat: np.ndarray) -> list[tuple[int, int, float]]:
    """``(anchor, parent, edge distance)`` in an order that puts parents first;
    the root has parent -1. Distances are rounded up."""
    n = len(mat)
    x = mat.astype(np.float64)
    best, parent = np.full(n, np.inf), np.full(n, -1)
    left = np.ones(n, bool)
    out, at = [], 0
    for _ in range(n):
        left[at] = False
        edge = 0.0 if parent[at] < 0 else float(best[at])
        out.append((at, int(parent[at]), edge))
        gap = np.sqrt(((x - x[at]) ** 2).sum(axis=1)) * (1 + 1e-9)
        closer = left & (gap < best)
        best[closer], parent[closer] = gap[closer], at
        at = int(np.argmin(np.where(left, best, np.inf)))
    return out


class Bounds:
    """Score intervals of one anchor over all candidates of a block."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high

    @staticmethod
    def around(scores: np.ndarray) -> Bounds:
        """Points; float64 holds the scores, but for Python integers."""
        x = scores.astype(np.float64)
        slack = np.abs(x) * (1e-12 if scores.dtype == object else 0)
        return Bounds(x - slack, x + slack)

    def widened(self, edge: float, norms: np.ndarray) -> Bounds:
        slack = np.ceil(edge * norms)
        return Bounds(self.low - slack, self.high + slack)


def walk(anchors: np.ndarray, cands: np.ndarray, want) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchor by anchor down the tree: ``(anchor, rescored rows, their scores)``.

    ``want(anchor, bounds)`` names the candidate rows whose interval overlaps
    the anchor's window."""
    norms = np.sqrt((cands.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
    tree = spanning_tree(anchors)
    waiting = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(tree))
    known: dict[int, Bounds] = {}
    for a, p, edge in tree:
        if p < 0:
            b = Bounds.around(cands @ anchors[a])
        else:
            b = known[p].widened(edge, norms)
            waiting[p] -= 1
            if not waiting[p]:
                del known[p]
        rows = want(a, b)
        scores = (cands if len(rows) == len(cands) else cands[rows]) @ anchors[a]
        if waiting[a]:
            point = Bounds.around(scores)
            b.low[rows], b.high[rows] = point.low, point.high
            known[a] = b
        yield a, rows, scores


def positives_of(block, cand, k: int) -> Iterator[tuple]:
    """``(anchor row, positive row, positive id, score)``: at most ``k`` an anchor."""
    label_rows = {v: np.flatnonzero(cand["label"] == v) for v in np.unique(block["label"])}

    def want(a, b):
        same = label_rows[block["label"][a]]
        same = same[cand["row"][same] != block["row"][a]]
        if len(same) <= k:
            return same
        floor = np.partition(b.low[same], len(same) - k)[len(same) - k]
        return same[b.high[same] >= floor]

    for a, rows, scores in walk(block["mat"], cand["mat"], want):
        best = np.lexsort((cand["row"][rows], cand["id"][rows], -scores))[:k]
        for i in best:
            r = rows[i]
            yield (int(block["row"][a]), int(cand["row"][r]), int(cand["id"][r]), int(scores[i]))


def negatives_of(block, cand, k: int, low: int, high: int) -> Iterator[tuple]:
    """``(anchor row, positive row, negative id, score)``: at most ``k`` a positive."""
    windows = [[(int(r), int(s)) for r, s in p if low * int(s) <= high * int(s)] for p in block["positives"]]

    def want(a, b):
        if not windows[a]:
            return np.empty(0, np.int64)
        hit = np.zeros(len(b.low), bool)
        for _, s in windows[a]:
            hit |= (100 * b.high >= low * s) & (100 * b.low <= high * s)
        return np.flatnonzero(hit & (cand["label"] != block["label"][a]))

    for a, rows, scores in walk(block["mat"], cand["mat"], want):
        order = np.lexsort((cand["id"][rows], -scores))
        ids, got = cand["id"][rows][order], 100 * scores[order]
        for pos, s in windows[a]:
            for i in np.flatnonzero((got >= low * s) & (got <= high * s))[:k]:
                yield (int(block["row"][a]), pos, int(ids[i]), int(got[i]) // 100)


PACKED = "dim int, n int, body binary"


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, dict]]:
    """The batch's vectors by length, as arrays."""
    col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    row, ids, label = (col[n].to_numpy(zero_copy_only=False) for n in ("row", "vec_id", "label"))
    known = col["positives"].to_pylist() if "positives" in col else None
    for dim, at, mat in matrices(batch):
        pos = np.empty(len(at), dtype=object)
        for i, r in enumerate(at if known else ()):
            pos[i] = [(p["row"], p["score"]) for p in known[r]]
        yield dim, {"row": row[at], "id": ids[at], "label": label[at], "mat": mat, "positives": pos}


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length, formed where they are read."""
    def block(dim, body):
        small = body["mat"].dtype != object and abs(body["mat"]).max(initial=0) < 1 << 15
        body["mat"] = body["mat"].astype(np.int16) if small else body["mat"]
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([len(body["row"])], pa.int32()),
             pa.array([pickle.dumps(body)], pa.binary())], names=["dim", "n", "body"])

    def run(batches):
        held: dict[int, dict] = {}
        for batch in batches:
            for dim, new in _rows(batch):
                old = held.get(dim)
                got = {k: np.concatenate([old[k], v]) for k, v in new.items()} if old else new
                n = len(got["row"])
                for lo in range(0, n - size + 1, size):
                    yield block(dim, {k: v[lo:lo + size] for k, v in got.items()})
                held[dim] = {k: v[n - n % size:] for k, v in got.items()}
        for dim, got in held.items():
            if len(got["row"]):
                yield block(dim, got)
    return vectors.mapInArrow(run, PACKED)


def _open(body: bytes) -> dict:
    block = pickle.loads(body)
    mat = block["mat"]
    block["mat"] = numbers(mat if mat.dtype == object else mat.astype(np.int64))
    return block


def meet(candidates: DataFrame, anchors: DataFrame, search, schema: str) -> DataFrame:
    """``search(anchor block, candidate block)`` of every pair of blocks of one
    length. Each candidate block is in one task; the anchor blocks come to it."""
    n = candidates.count()
    names = [f.split()[0] for f in schema.split(", ")]
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    sent = anchors.select(everywhere.alias("block"), F.lit(1).alias("kind"), F.col("block").alias("other"), "dim", "body")
    held = candidates.select("block", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("other"), "dim", "body")

    def run(batches):
        at, dim, cand = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    at, dim, cand = r["block"], r["dim"], _open(r["body"])
                elif r["block"] == at and r["dim"] == dim:
                    out = np.array(search(_open(r["body"]), cand), dtype=np.int64).reshape(-1, len(names))
                    yield pa.RecordBatch.from_arrays([pa.array(out[:, i]) for i in range(len(names))], names=names)

    if not n:
        return candidates.sparkSession.createDataFrame([], schema)
    return (held.unionAll(sent).repartition(n, "block").sortWithinPartitions("block", "kind", "other")
            .mapInArrow(run, schema))


def numbered_blocks(df: DataFrame, name: str) -> DataFrame:
    """Stored blocks numbered 0, 1, ...: place in the file plus the blocks of
    the files before it (one row for each writing task)."""
    blocks = stored(df.withColumn("_id", F.monotonically_increasing_id()), name)
    task = F.shiftright("_id", 33)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = (blocks.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_c"))
             .select("_task", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first")))
    return (blocks.withColumn("_task", task).join(first, "_task")
            .select((F.col("_first") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias("block"), "dim", "n", "body"))


def hard_negatives(vectors: DataFrame, is_anchor, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, anchor_block: int = ANCHOR_BLOCK,
                   candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``
    of integer vectors ``(vec_id, label, v array<long>)``; ``is_anchor`` is a
    condition on ``vec_id``."""
    rows = stored(vectors.select(F.monotonically_increasing_id().alias("row"), is_anchor.alias("anchor"),
                                 F.coalesce("vec_id", F.lit(NO_ID)).alias("vec_id"),
                                 F.col("label").cast("long").alias("label"), "v"), "hn-rows")
    cands = numbered_blocks(packed(rows.drop("anchor"), candidate_block), "hn-cands")
    # neighbours in this order tend to be near, which shortens the trees' edges
    anchors = (rows.filter(F.coalesce("anchor", F.lit(False))).drop("anchor")
               .orderBy(F.size("v"), "label", "vec_id", "row"))
    ab = numbered_blocks(packed(anchors, anchor_block), "hn-anchors")
    found = meet(cands, ab, lambda a, c: list(positives_of(a, c, n_positives)),
                 "anchor_row long, row long, id long, score long")
    first = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "id", "row")
    positives = stored(found.withColumn("i", F.row_number().over(first)).filter(F.col("i") <= n_positives),
                       "hn-positives")
    per = positives.groupBy("anchor_row").agg(F.collect_list(F.struct("row", "score")).alias("positives"))
    with_pos = (anchors.join(per, F.col("row") == F.col("anchor_row")).drop("anchor_row")
                .orderBy(F.size("v"), "label", "vec_id", "row"))
    ab = numbered_blocks(packed(with_pos, anchor_block), "hn-windows")
    near = meet(cands, ab, lambda a, c: list(negatives_of(a, c, n_negatives, low, high)),
                "anchor_row long, positive_row long, negative long, negative_score long")
    best = Window.partitionBy("anchor_row", "positive_row").orderBy(F.desc("negative_score"), "negative")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n_negatives)
    names = positives.select("anchor_row", F.col("row").alias("positive_row"), F.col("id").alias("positive"),
                             F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    none = F.lit(NO_ID)
    return (ranked.join(names, ["anchor_row", "positive_row"]).join(ids, "anchor_row")
            .select("anchor_id", F.nullif("positive", none).alias("positive_id"), "rank",
                    F.nullif("negative", none).alias("negative_id"), "positive_score", "negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    raw = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").filter(F.col("label").isNotNull())
    label = F.col("label").cast("long")
    vectors = (usable_vectors(raw, SCALE)
               .withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)))
    return hard_negatives(vectors, F.col("vec_id") % ANCHOR_EVERY == 0)


SQL = f"""WITH good AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {SCALE}) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
sc AS MATERIALIZED (
  SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id AS id, a.label = c.label AS same,
    CAST(coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM good a JOIN good c ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.r <> c.r AND len(a.v) = len(c.v)),
pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, id NULLS LAST, cr) AS i
                       FROM sc WHERE same) WHERE i <= {POSITIVES}),
neg AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY n.score DESC, n.id NULLS LAST) AS rank
  FROM pos p JOIN sc n ON n.ar = p.ar AND NOT n.same
   AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= {NEGATIVES}"""
