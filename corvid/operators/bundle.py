"""One artifact for a scorer (S5, S6): weights, rules of the tokenizer, fingerprint.

A bundle folder holds numbered versions. A version's weights are written first,
its manifest last; a version without a manifest does not exist for a reader, so
a swap is seen whole or not at all, and an old version stays readable for those
who have begun with it. The fingerprint (rows and a sum of row hashes) is
checked on loading.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.text import MODEL_TOKEN
from corvid.operators.score import VOCAB_SIZE, score_texts

MANIFEST = "version bigint, tokens string, rows bigint, fingerprint string"


def _fingerprint(weights: DataFrame) -> DataFrame:
    """One row: ``rows, fingerprint``."""
    h = F.xxhash64("token", "w0", "w1").cast("decimal(38,0)")
    return weights.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("fingerprint"))


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The manifests there are; none in a new folder."""
    try:
        return spark.read.schema(MANIFEST).json(f"{root}/manifests/*")
    except AnalysisException:       # no manifest yet
        return spark.createDataFrame([], MANIFEST)


def latest(spark: SparkSession, root: str) -> int:
    """The newest complete version, 0 without one."""
    return versions(spark, root).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def save_bundle(weights: DataFrame, root: str) -> int:
    """Write ``weights(token, w0, w1)`` as the next version; returns its number."""
    spark = weights.sparkSession
    version = latest(spark, root) + 1
    path = f"{root}/weights/{version}"
    weights.write.mode("overwrite").parquet(path)
    manifest = _fingerprint(spark.read.schema(weights.schema).parquet(path)).select(
        F.lit(version).cast("bigint").alias("version"), F.lit(MODEL_TOKEN).alias("tokens"), "rows", "fingerprint")
    manifest.coalesce(1).write.mode("errorifexists").json(f"{root}/manifests/{version}")
    return version


def load_bundle(spark: SparkSession, root: str, version: int | None = None) -> tuple[DataFrame, int]:
    """``(weights, version)``, the newest by default. Raises if there is none,
    if the tokenizer rules differ, or if the files are not those of the manifest."""
    version = latest(spark, root) if version is None else version
    said = versions(spark, root).filter(F.col("version") == version).first()
    if said is None:
        raise FileNotFoundError(f"no complete version {version} under {root}")
    weights = spark.read.parquet(f"{root}/weights/{version}")
    found = _fingerprint(weights).first()
    if (found["rows"], found["fingerprint"]) != (said["rows"], said["fingerprint"]):
        raise ValueError(f"version {version} under {root} is not what its manifest says")
    if said["tokens"] != MODEL_TOKEN or said["rows"] > VOCAB_SIZE + 2:
        raise ValueError(f"version {version} under {root} was made by other rules")
    return weights, version


def score_bundle(df: DataFrame, root: str, id_cols: str | list[str] = "doc_id") -> DataFrame:
    """M4 with the newest version, whose number stands in each row (``model``)."""
    weights, version = load_bundle(df.sparkSession, root)
    return score_texts(df, weights, id_cols).withColumn("model", F.lit(version).cast("bigint"))
