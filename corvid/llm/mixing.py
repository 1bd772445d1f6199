"""Mixing sources to target weights (10): weighted fair queueing.

Each source's documents stand in a shuffled queue (order of a digest of their
key), repeated for up to ``max_epochs`` rounds. A document copy's virtual
finish time is the cumulative size of its source's queue up to and including
it, divided by the source's weight. All copies are ordered by virtual finish
time in ranges, and the mix is the front of that order up to the total budget.

A source that reaches its repeat limit simply ends, and the queues of the
others go on, so the shares that result are the weights with each source's
excess over ``max_epochs`` times its size given to the rest. ``source_targets``
computes those shares in closed form for the report column ``target``.

Everything is DataFrame operations. Running sums use digest buckets inside a
source and time ranges across sources, so neither a source with a third of all
rows nor the global order is ever one task: see ``running_total``.

Defined cases: null text counts as size 0; null sources are one source, last;
equal rows are counted first and taken copy by copy; a size-0 document is
never taken (it adds nothing); an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.spark_util import WORD_GAP, digest_buckets, read_table, stored, text_digest

PER_BUCKET = 20_000
#: Time ranges up to the level: at least this many, and one for so many rows.
LEAST_RANGES, ROWS_PER_RANGE = 64, 2_000


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null counts 0."""
    body = F.coalesce(text, F.lit(""))
    gaps = F.regexp_count(body, F.lit(WORD_GAP))
    lead = F.when(body.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    tail = F.when(body.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    blank = body.rlike(r"^[\x20\x09-\x0D]*\z")
    return F.when(blank, F.lit(0)).otherwise(gaps - lead - tail + 1).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, source_size)``.

    Weights cycle over the sources in code-point order, null last. The target
    is ``min(max_epochs * size, weight * level)`` with the one level at which
    the targets add up to the total size. The table has one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    s = (sizes.withColumn("_rank", F.row_number().over(order) - 1)
         .withColumn("weight", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")))
         .withColumn("_cap", F.col("source_size") * max_epochs)
         .withColumn("_at", F.col("_cap") / F.col("weight")))
    rising = Window.orderBy("_at", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = (s.withColumn("_total", F.sum("source_size").over(every))
         .withColumn("_w", F.sum("weight").over(every))
         .withColumn("_used", F.coalesce(F.sum("_cap").over(rising), F.lit(0)))
         .withColumn("_gone", F.coalesce(F.sum("weight").over(rising), F.lit(0)))
         # the level if this source and all later ones stay below their caps
         .withColumn("_level", (F.col("_total") - F.col("_used")) / (F.col("_w") - F.col("_gone")))
         .withColumn("_open", F.col("_level") <= F.col("_at")))
    s = s.withColumn("_final", F.min(F.when(F.col("_open"), F.struct("_at", "_rank", "_level"))).over(every)["_level"])
    return s.select("source", "source_size", "weight", F.least(
        F.col("_cap").cast("double"), F.col("weight") * F.col("_final")).alias("target"))


def running_total(df: DataFrame, part: Sequence[str], bucket: str, order: Sequence[str],
                  value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over earlier rows of ``part``.

    ``bucket`` must not fall as ``order`` rises. Totals per bucket give each
    bucket's start, a window inside the bucket the rest: no window holds more
    than a bucket's rows.
    """
    part = list(part)
    per = df.groupBy(*part, bucket).agg(F.sum(value).alias("_t"))
    before = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    start = per.select(*[F.col(p).alias(f"_k{i}") for i, p in enumerate(part)],
                       F.col(bucket).alias("_kb"),
                       F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = (Window.partitionBy(*part, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    on = F.col(bucket) == F.col("_kb")
    for i, p in enumerate(part):
        on = on & F.col(p).eqNullSafe(F.col(f"_k{i}"))
    return (df.withColumn("_i", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(start, on)
            .withColumn(name, F.col("_o") + F.col("_i"))
            .drop("_i", "_o", "_kb", *[f"_k{i}" for i in range(len(part))]))


def fair_mix(docs: DataFrame, weights: Sequence[int], max_epochs: int = 3) -> DataFrame:
    """Mix ``docs(key, source, size)``; the budget is the sum of all sizes.

    Returns one row per input row: ``key, source, size, source_size, target,
    copies`` (how often the mix takes it, 0 to ``max_epochs``).
    """
    rows = stored(docs.select("key", "source", "size").groupBy("key", "source", "size")
                  .agg(F.count(F.lit(1)).alias("m"))
                  .withColumn("h", text_digest(F.col("key"), F.col("source"), F.col("size"))), "mix-rows")
    n = rows.count()
    digits = digest_buckets(n, PER_BUCKET)
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    targets = stored(source_targets(sizes, weights, max_epochs), "mix-targets")
    named = targets.select(F.col("source").alias("_s"), "source_size", "weight", "target")
    queue = running_total(rows.withColumn("_b", F.substring("h", 1, digits))
                          .withColumn("_v", F.col("size") * F.col("m")),
                          ["source"], "_b", ["h"], "_v", "start")
    queue = (queue.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "_b", "_v"))
    queue = stored(queue, "mix-queue")
    # one row per copy: equal rows follow each other, epochs follow each other
    copies = (queue.filter("size > 0")
              .withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
              .withColumn("e", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max_epochs - 1).cast("long"))))
              .withColumn("vf", (F.col("e") * F.col("source_size") + F.col("start")
                                 + (F.col("c") + 1) * F.col("size")) / F.col("weight")))
    # range sort: the clock in equal steps, sized by the level where the budget ends
    level = targets.agg(F.max(F.col("target") / F.col("weight")).alias("level"),
                        F.sum("source_size").alias("budget"))
    steps = LEAST_RANGES + n // ROWS_PER_RANGE
    level = level.select("budget", F.greatest(F.col("level") / steps, F.lit(1e-9)).alias("step"))
    timed = (copies.crossJoin(F.broadcast(level))       # one row
             .withColumn("_r", F.floor(F.col("vf") / F.col("step"))))
    taken = (running_total(timed.select("key", "source", "size", "h", "c", "e", "vf", "_r", "budget"),
                           [], "_r", ["vf", F.col("source").asc_nulls_last(), "h", "c"], "size", "before")
             .filter(F.col("before") + F.col("size") <= F.col("budget"))
             .groupBy("h", "c", "key", "source").agg(F.count(F.lit(1)).alias("copies")))
    # the digest writes a null like a "~": the columns themselves tell them apart
    taken = taken.select(*[F.col(c).alias(f"_{c}") for c in ("h", "c", "key", "source")], "copies")
    each = queue.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    same = ((F.col("h") == F.col("_h")) & (F.col("c") == F.col("_c")) & F.col("key").eqNullSafe(F.col("_key"))
            & F.col("source").eqNullSafe(F.col("_source")))
    return (each.join(taken, same, "left")
            .select("key", "source", "size", "source_size", "target",
                    F.coalesce("copies", F.lit(0)).alias("copies")))


def mix_documents(docs: DataFrame, weights: Sequence[int], max_epochs: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    names = docs.columns
    key = text_digest(F.col("doc_id"), F.md5(F.coalesce("text", F.lit(""))), F.xxhash64(*[docs[c] for c in names]))
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("_row"), key.alias("_key"))
    mix = (fair_mix(docs.select(key.alias("key"), "source", word_count(F.col("text")).alias("size")), weights, max_epochs)
           .groupBy("key").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_equal"))
           .filter("_copies > 0"))
    taken = rows.join(mix, F.col("_key") == F.col("key"))
    single = taken.filter("_equal = 1").select("_row", "_copies")
    # equal rows: one of them stands for all
    equal = (taken.filter("_equal > 1").groupBy("_key")
             .agg(F.first("_row").alias("_row"), F.first("_copies").alias("_copies")).drop("_key"))
    return (single.unionByName(equal)
            .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
            .select("_row.*"))


WEIGHTS = (5, 2, 1)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"), "source", word_count(F.col("text")).alias("size"))
    return fair_mix(docs, WEIGHTS).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


SQL = r"""WITH rows_ AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
num AS (
  SELECT *, md5(concat_ws('|', coalesce(doc_id::VARCHAR, '~'), coalesce(source, '~'), size::VARCHAR)) AS h,
         row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS c FROM rows_),
src AS (SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rk FROM rows_ GROUP BY source),
wt AS (SELECT *, [5, 2, 1][(rk % 3) + 1] AS weight, source_size * 3 AS cap FROM src),
lv AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level,
              cap::DOUBLE / weight AS at_
       FROM wt WINDOW w AS (ORDER BY cap::DOUBLE / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fin AS (SELECT arg_min(level, at_) AS level FROM (SELECT * FROM lv WHERE level <= at_ ORDER BY at_, rk LIMIT 1)),
tg AS (SELECT source, source_size, weight, least(cap::DOUBLE, weight * fin.level) AS target FROM lv, fin),
q AS (SELECT num.*, source_size, weight, target,
             sum(size) OVER (PARTITION BY num.source ORDER BY h, c ROWS UNBOUNDED PRECEDING)::BIGINT AS cum
      FROM num JOIN tg ON num.source IS NOT DISTINCT FROM tg.source),
ep AS (SELECT q.*, e, (e * source_size + cum)::DOUBLE / weight AS vf FROM q, range(3) t(e) WHERE size > 0),
run AS (SELECT *, sum(size) OVER (ORDER BY vf, source ASC NULLS LAST, h, c ROWS UNBOUNDED PRECEDING) AS upto FROM ep),
tk AS (SELECT h, c, doc_id, source, sum(size)::BIGINT AS taken FROM run
       WHERE upto <= (SELECT sum(size) FROM rows_) GROUP BY h, c, doc_id, source)
SELECT q.doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM q LEFT JOIN tk ON q.h = tk.h AND q.c = tk.c AND q.doc_id IS NOT DISTINCT FROM tk.doc_id
  AND q.source IS NOT DISTINCT FROM tk.source"""
