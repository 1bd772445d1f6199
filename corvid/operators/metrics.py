"""Evaluation aggregates.

Each is one aggregation (partial + final) over whatever grouping is asked;
windows only ever run over already-aggregated, tiny tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 6


def _i(c: Column) -> Column:
    return c.cast("int")


def binary_counts(label: Column, pred: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(_i((label == 1) & (pred == 1))).alias("tp"),
        F.sum(_i((label == 0) & (pred == 1))).alias("fp"),
        F.sum(_i((label == 1) & (pred == 0))).alias("fn"),
        F.sum(_i((label == 0) & (pred == 0))).alias("tn"),
    ]


def f1_from_counts(tp: Column, fp: Column, fn: Column) -> Column:
    """A2: 2tp / (2tp + fp + fn); 0 when nothing is predicted or true."""
    den = F.lit(2) * tp + fp + fn
    return F.when(den == 0, F.lit(0.0)).otherwise((F.lit(2.0) * tp) / den)


def binary_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "pred",
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """A1 + A2 (+ F1 of class 0): ``n, accuracy, f1, f1_neg`` per group."""
    agg = df.groupBy(*group_cols).agg(*binary_counts(F.col(label_col), F.col(pred_col)))
    return agg.select(
        *group_cols,
        F.col("n").cast("bigint").alias("n"),
        F.round((F.col("tp") + F.col("tn")) / F.col("n"), DIGITS).alias("accuracy"),
        F.round(f1_from_counts(F.col("tp"), F.col("fp"), F.col("fn")), DIGITS).alias("f1"),
        F.round(f1_from_counts(F.col("tn"), F.col("fn"), F.col("fp")), DIGITS).alias("f1_neg"))


def confusion_long(df: DataFrame, gold_col: str, pred_col: str,
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """A3 long form: one row per (gold, predicted) pair that occurs."""
    return df.groupBy(*group_cols, F.col(gold_col).alias("gold"),
                      F.col(pred_col).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_wide(df: DataFrame, gold_col: str, pred_col: str,
                   classes: Sequence[str]) -> DataFrame:
    """A3 wide form: gold per row, one count column per predicted class.

    The class list is given, so the pivot needs no extra pass over the data.
    """
    wide = (df.groupBy(F.col(gold_col).alias("gold"))
            .pivot(pred_col, list(classes)).agg(F.count(F.lit(1))))
    return wide.select("gold", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                                 for c in classes])


def class_balance(df: DataFrame, label_col: str = "label",
                  group_cols: Sequence[str] = ()) -> DataFrame:
    """Count and share per class (share inside each group)."""
    counts = df.groupBy(*group_cols, label_col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*group_cols)  # over the aggregated rows only
    return counts.select(*group_cols, label_col, "n",
                         F.round(F.col("n") / F.sum("n").over(w), DIGITS).alias("share"))


def mean_cross_entropy(df: DataFrame, probs_col: str, label_col: str,
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """A5: mean of -log p(correct class), per group."""
    from corvid.functions.probs import neg_log_prob
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(neg_log_prob(F.col(probs_col), F.col(label_col))), DIGITS).alias("loss"))


def best_by(df: DataFrame, key_col: str, metric_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """The key with the best metric; the earliest key wins ties."""
    return df.groupBy(*group_cols).agg(
        F.max_by(F.col(key_col), F.struct(F.col(metric_col), -F.col(key_col))).alias(key_col),
        F.max(metric_col).alias(metric_col))


def batches_per_epoch(df: DataFrame, batch_size: int, epochs: int,
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """ceil(n / batch) batches per epoch and the total step count."""
    agg = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"))
    per = F.ceil(F.col("n") / F.lit(batch_size)).cast("bigint")
    return agg.select(*group_cols, F.col("n").cast("bigint").alias("n"),
                      per.alias("batches_per_epoch"),
                      (per * F.lit(epochs)).cast("bigint").alias("total_steps"))


def sequence_stats(df: DataFrame, n_tokens_col: str, max_len: int,
                   group_cols: Sequence[str] = ()) -> DataFrame:
    """Real tokens, padded share and truncated share at ``max_len``.

    ``n_tokens_col`` counts words; CLS and SEP take two more slots.
    """
    seq = F.col(n_tokens_col) + F.lit(2)
    kept = F.least(seq, F.lit(max_len))
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col(n_tokens_col)), DIGITS).alias("avg_tokens"),
        F.round(F.avg(kept), DIGITS).alias("avg_kept"),
        F.round(F.avg((F.lit(max_len) - kept) / F.lit(max_len)), DIGITS).alias("pad_share"),
        F.round(F.avg((seq > F.lit(max_len)).cast("int")), DIGITS).alias("truncated_share"))
