"""Vocabulary building and id encoding (A6, J3, X8 helpers, X7 in wordpiece)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.functions.text import RESERVED, UNK_ID


def token_counts(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """``(token, cnt)``; partial aggregation absorbs hot tokens before the shuffle."""
    return tokens.groupBy(token_col).agg(F.count(F.lit(1)).alias("cnt"))


def build_vocab(spark: SparkSession, tokens: DataFrame, k: int,
                token_col: str = "token") -> DataFrame:
    """Reserved ids first, then the ``k`` most frequent tokens.

    Ranked by count desc, token asc. ``orderBy().limit(k)`` plans as a
    per-partition top-k plus one merge of ``k x partitions`` rows, so the
    ranking window below only ever sees ``k`` rows: the result is bounded by
    ``k + 4`` rows and is safe to broadcast.
    """
    top = token_counts(tokens, token_col).orderBy(F.desc("cnt"), F.asc(token_col)).limit(k)
    ranked = top.select(
        F.col(token_col).alias("token"),
        (F.row_number().over(Window.orderBy(F.desc("cnt"), F.asc(token_col)))
         + F.lit(len(RESERVED) - 1)).cast("int").alias("token_id"),
        F.col("cnt").cast("bigint").alias("cnt"))
    reserved = spark.createDataFrame(
        [(t, i, 0) for t, i in RESERVED], "token string, token_id int, cnt bigint")
    return reserved.unionByName(ranked)


def encode_ids(tokens: DataFrame, vocab: DataFrame, token_col: str = "token") -> DataFrame:
    """Add ``token_id``; tokens outside the vocabulary get ``[UNK]``.

    ``vocab`` must be bounded (``build_vocab`` output): it is broadcast, so the
    token table is never shuffled for the lookup.
    """
    v = F.broadcast(vocab.select(F.col("token").alias(token_col), "token_id"))
    return tokens.join(v, token_col, "left").withColumn(
        "token_id", F.coalesce(F.col("token_id"), F.lit(UNK_ID)).cast("int"))
