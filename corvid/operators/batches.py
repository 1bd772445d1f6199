"""Gap-free batch ids over an ordered table, without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.prefix import row_number


def assign_batches(df: DataFrame, part_cols: Sequence[str], order_col: str, size: int,
                   accumulate: int = 1) -> DataFrame:
    """Add ``batch_id`` (0-based), ``pos_in_batch`` and, when ``accumulate > 1``,
    ``step_id`` = the optimizer step that the micro-batch feeds (size x accumulate).

    Row numbers come from the block-decomposed prefix sum, so a hot partition
    key (the train split is 90% of rows) is still spread over many tasks.
    """
    out = row_number(df, part_cols, order_col, "_rn")
    idx = F.col("_rn") - F.lit(1)
    out = out.withColumn("batch_id", F.floor(idx / F.lit(size)).cast("bigint")) \
             .withColumn("pos_in_batch", F.pmod(idx, F.lit(size)).cast("bigint"))
    if accumulate > 1:
        out = out.withColumn("step_id", F.floor(idx / F.lit(size * accumulate)).cast("bigint"))
    return out.drop("_rn")
