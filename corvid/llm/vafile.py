"""Exact top-k search (3): vector-approximation files.

Candidate vectors are quantised per dimension into ``2**bits`` cells between
the dimension's least and largest value over the whole table. The cell codes
form the approximation file. A scan of the codes bounds every query-candidate
inner product from both sides; candidates whose upper bound is below the k-th
largest lower bound are out. The rest have their exact vectors read in order
of falling upper bound, until the k-th exact score is at least the next upper
bound: nothing unread can enter the result, so it is exact.

The stated query set meets all candidates in blocks: a candidate block is formed
where its vectors are read and stays in one task with its part of the
approximation file; the queries, a small share of the rows, are sent to every
block and pass by in blocks of their own. What is shuffled grows with queries
times candidate blocks, never with candidates times query blocks. Each meeting
returns at most ``k`` rows per query, and their union holds the global winners.

Defined cases: vectors that are null or hold null or non-finite components
take no part, nor do empty ones; vectors of another dimension than the query
are not compared; ties go to the smaller id; repeated rows are separate
candidates and repeated queries, and a query leaves out its own row alone, not
others of its id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.hardneg import meet, numbered_blocks, packed
from corvid.llm.spark_util import read_table, stored

Q_BLOCK, C_BLOCK = 256, 4096
BITS = 6
#: Candidates read exactly before the stopping test is repeated.
READ_STEP = 32


def encode_cells(mat: np.ndarray, lo: np.ndarray, hi: np.ndarray, bits: int) -> np.ndarray:
    """Cell codes; cell ``c`` of a dimension covers ``cell_edges`` ``[c, c+1]``."""
    step = np.maximum(1, -(-(hi - lo + 1) // (1 << bits)))
    return ((mat - lo) // step).astype(np.uint8)


def cell_bounds(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray, bits: int):
    """Least and largest integer component value each code allows."""
    step = np.maximum(1, -(-(hi - lo + 1) // (1 << bits)))
    low = lo + codes.astype(np.int64) * step
    return low, np.minimum(hi, low + step - 1)


def _exact_dtype(q: np.ndarray, c_lo: np.ndarray, c_hi: np.ndarray):
    """float64 when every partial sum is an exact integer there, else Python ints."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * q.shape[1] * \
        float(max(np.abs(c_lo.astype(np.float64)).max(initial=0), np.abs(c_hi.astype(np.float64)).max(initial=0)))
    return np.float64 if most < 2 ** 52 else object


def search_block(q_keys, q, c_ids, codes, lo, hi, bits, read, k, c_keys=None):
    """Top-k of every query within one candidate block, the candidate with the
    query's key (``c_keys``, else its id) left out.

    ``read(rows)`` returns exact candidate vectors; it is called only for
    candidates the bounds cannot exclude. Yields ``(query row, ids, scores)``.
    """
    kind = _exact_dtype(q, lo, hi)
    low, high = (x.astype(kind) for x in cell_bounds(codes, lo, hi, bits))
    qq = q.astype(kind)
    pos, neg = np.where(qq > 0, qq, 0), np.where(qq < 0, qq, 0)
    upper = pos @ high.T + neg @ low.T
    lower = pos @ low.T + neg @ high.T
    c_keys = c_ids if c_keys is None else c_keys
    for r in range(len(q_keys)):
        ok = c_keys != q_keys[r]
        up, dn = upper[r][ok], lower[r][ok]
        at = np.flatnonzero(ok)
        if not len(at):
            continue
        if len(at) > k:
            floor = np.partition(dn, len(dn) - k)[len(dn) - k]
            keep = up >= floor
            up, at = up[keep], at[keep]
        order = np.argsort(-up, kind="stable")
        up, at = up[order], at[order]
        scores = np.empty(0, dtype=kind)
        seen = 0
        while seen < len(at):
            step = at[seen:seen + max(READ_STEP, k)]
            scores = np.concatenate([scores, read(step).astype(kind) @ qq[r]])
            seen += len(step)
            if seen < len(at) and len(scores) >= k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                if kth > up[seen]:      # equal bounds may still hold a tie
                    break
        ids = c_ids[at[:seen]]
        best = np.lexsort((ids, -scores))[:k]
        yield r, ids[best], scores[best]


def va_topk(vectors: DataFrame, queries: DataFrame, k: int, bits: int = BITS,
            q_block: int = Q_BLOCK, c_block: int = C_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for integer vectors ``(vec_id, v array<long>)``.

    Where both tables have a column ``row`` (a number no two rows share), a query
    leaves out the candidate of its own ``row``, else those of its ``vec_id``."""
    own = "row" if "row" in vectors.columns and "row" in queries.columns else "vec_id"
    # blocks carry three numbers a vector: here its place, its id and its own key
    place = F.monotonically_increasing_id().alias("row")
    rows, asked = (stored(df.select(place, "vec_id", F.col(own).alias("label"), "v").filter("vec_id is not null"), name)
                   for df, name in ((vectors, "va-rows"), (queries, "va-asked")))
    # per-dimension range: one row per vector length
    ranges = (rows.select(F.size("v").alias("dim"), F.posexplode("v"))
              .groupBy("dim", "pos").agg(F.min("col").alias("lo"), F.max("col").alias("hi"))
              .groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("pos", "lo", "hi"))).alias("r")).collect())
    cells = {r["dim"]: (np.array([x["lo"] for x in r["r"]], np.int64), np.array([x["hi"] for x in r["r"]], np.int64))
             for r in ranges}
    cands = numbered_blocks(packed(rows, c_block), "va-file")
    sent = numbered_blocks(packed(asked, q_block), "va-queries")

    def search(q, c):
        lo, hi = cells[q["mat"].shape[1]]
        if "codes" not in c:            # the block's part of the approximation file
            c["mat"] = c["mat"].astype(np.int64)
            c["codes"] = encode_cells(c["mat"], lo, hi, bits)
        exact = c["mat"]
        return [(int(q["row"][r]), int(q["id"][r]), int(i), int(s)) for r, ids, scores in search_block(
            q["label"], q["mat"].astype(np.int64), c["id"], c["codes"], lo, hi, bits, lambda at: exact[at], k, c["label"])
            for i, s in zip(ids, scores)]

    best = meet(cands, sent, search, "query_row long, query_id long, vec_id long, score long")
    w = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


K, EVERY = 10, 100


def op3_vafile(spark, sf_dir: str) -> DataFrame:
    raw = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    good = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = stored(raw.filter(good & F.col("vec_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024)).alias("v")),
        "va-vectors")
    return va_topk(vectors, vectors.filter(F.col("vec_id") % EVERY == 0), K)


SQL = f"""WITH good AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 1024) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
sc AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1),
      lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % {EVERY} = 0 AND c.r <> q.r AND len(q.v) = len(c.v)),
rk AS (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM sc)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM rk WHERE rank <= {K}"""
