"""Parquet table access and the labelled-text source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


TEXT_TABLES = ("documents", "pages")


def load_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """One table. ``partitions`` redistributes the scan, for long texts in a file
    that cannot be split; it is the caller's choice, or for text tables that of
    the session (``corvid.scan.partitions``). Without either nothing moves."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if partitions is None and name in TEXT_TABLES:
        partitions = int(spark.conf.get("corvid.scan.partitions", "0"))
    return df.repartition(partitions) if partitions else df


def split_rule(doc_id: Column, holdout_every: int = 10) -> Column:
    """Fixed, reproducible split: every ``holdout_every``-th id is validation."""
    return F.when(F.pmod(doc_id, F.lit(holdout_every)) == 0, F.lit("validation")) \
        .otherwise(F.lit("train"))


def load_labelled(spark: SparkSession, sf_dir: str, label_col: str = "quality",
                  holdout_every: int = 10) -> DataFrame:
    """documents ⋈ labels as ``(doc_id, text, label, split)``.

    ``labels`` covers a subset of documents; the join is an equi-join on the
    unique ``doc_id`` (no skew possible), left to Catalyst/AQE to plan.
    """
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load_table(spark, sf_dir, "labels").select(
        "doc_id", F.col(label_col).cast("int").alias("label"))
    return docs.join(labels, "doc_id").select(
        "doc_id", "text", "label", split_rule(F.col("doc_id"), holdout_every).alias("split"))


def split_filter(df: DataFrame, name: str) -> DataFrame:
    """one split of a labelled frame."""
    return df.filter(F.col("split") == name)


def split_counts(labelled: DataFrame) -> DataFrame:
    """Rows per split (partial + final aggregation)."""
    return labelled.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
