"""Spark helpers shared by the operators of this package."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.session import fresh_dir, ship_package

#: Text characters between words, for the ``[^\x20\x09-\x0D]+`` word rule.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = "\t\n\x0b\x0c\r "


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (any file system Spark can reach)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage and lets several consumers share one computation; the
    files live where ``spark.checkpoint.dir`` points, so a lost executor loses
    nothing.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_digest(*cols: Column) -> Column:
    """md5 (hex) of the columns, nulls marked: a uniform, engine-independent
    sort key that does not depend on partitioning."""
    parts = [F.coalesce(c.cast("string"), F.lit("~")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def digest_buckets(n_rows: int, per_bucket: int = 100_000) -> int:
    """Hex digits whose buckets hold about ``per_bucket`` digests or fewer."""
    return max(1, math.ceil(math.log(max(1, n_rows / per_bucket), 16)))


def number_rows(df: DataFrame, keys: Sequence[str], name: str = "row_no",
                part: Sequence[str] = (), per_bucket: int = 100_000) -> DataFrame:
    """0-based row numbers, over all rows or within ``part`` (some of ``keys``,
    never null), without a sort of a whole part in one task.

    Rows are numbered in the order of ``(md5(keys), keys)``. Equal rows are
    counted before any shuffle by key, so a row repeated for a third of the
    table is one row here and is expanded again at the end. A digest prefix
    forms the bucket: digests are uniform, so buckets have near equal sizes at
    any scale; per-bucket totals give each bucket's first number. The order
    depends on the values alone, so a recomputed task gives the same numbers.
    Returns ``keys`` and ``name`` (long), one row per input row.
    """
    keys, part = list(keys), list(part)
    counted = stored(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
          .withColumn("_md5", text_digest(*[F.col(k) for k in keys])), "numbered")
    digits = digest_buckets(counted.count(), per_bucket)
    counted = counted.withColumn("_b", F.substring("_md5", 1, digits))
    per = counted.groupBy(*part, "_b").agg(F.sum("_n").alias("_t"))
    before = Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = per.select(*part, "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = (Window.partitionBy(*part, "_b").orderBy("_md5", *keys)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (counted
              .withColumn("_i", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
              .join(first, [*part, "_b"]))
    return placed.select(
        *keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_c"),
        (F.col("_o") + F.col("_i")).alias("_s")
    ).select(*keys, (F.col("_s") + F.col("_c")).alias(name))
