"""A training corpus from ``documents``, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last keep the columns of ``documents``:

1. ``quality``: the classifier, trained on the labelled rows, sends away
   documents scored below 0.3;
2. ``near_dups``: of each class of near copies the row with the smallest doc_id stays;
3. ``pii``: personal data and the terms that disclose it leave the texts;
4. ``mixing``: documents are taken by source weight, up to three times each;
5. ``packing``: token sequences of 2048, one row for each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvid.llm import mixing, neardup, packing, pii, quality
from corvid.llm.spark_util import read_table, stored
from corvid.session import ship_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return neardup.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, mixing.WEIGHTS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.op4_packing(spark, sf_dir, docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dups", near_dup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Not expressible in SQL (learned scores, signatures, token ids); see
#: tests/llm/test_pipeline.py for the plain version it is held against.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
