"""Skew-proof running sums and ranks (W1, W4 and everything built on them).

A plain ``Window.partitionBy(key).orderBy(pos)`` puts every row of a key in one
task: a key holding a third of the data becomes a third of the job in one
thread. Here the order column is cut into fixed-size blocks:

1. per ``(key, block)`` totals (partial aggregation, one row per block);
2. a running sum over those block totals;
3. a running sum inside each ``(key, block)`` window (at most ``block_size``
   rows when the order column is unique within the key);
4. an equi-join of the two on ``(key, block)``.

Sparse or hashed order values fill few rows of each block, so there may be as
many blocks as rows. The running sum over block totals therefore cuts the block
numbers into blocks again (``levels`` times): with the defaults no window holds
more than 2^22 rows for any 64-bit order column.

The result is exact and deterministic (no partition ids, so a lost executor
just recomputes the same numbers).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_SIZE = 1 << 22
LEVELS = 2


def running_sum(df: DataFrame, part_cols: Sequence[str], order_col: str,
                values: Mapping[str, Column], inclusive: bool = True,
                block_size: int = BLOCK_SIZE, levels: int = LEVELS) -> DataFrame:
    """Add ``name = sum(value)`` over earlier rows of the same ``part_cols``.

    ``inclusive`` counts the current row too. ``order_col`` must be an
    integer column, unique within ``part_cols``.
    """
    part_cols = list(part_cols)
    names = list(values)
    rows = df
    for i, name in enumerate(names):
        rows = rows.withColumn(f"_v{i}", values[name])
    sums = [f"_v{i}" for i in range(len(names))]
    out = _running(rows, part_cols, order_col, sums, block_size, levels)
    for i, name in enumerate(names):
        before = F.col(f"_r_v{i}")
        out = out.withColumn(name, before + F.coalesce(F.col(f"_v{i}"), F.lit(0)) if inclusive else before)
    return out.drop(*sums, *[f"_r{s}" for s in sums])


def _running(rows: DataFrame, part: list[str], order: str, sums: list[str],
             block_size: int, levels: int) -> DataFrame:
    """Add ``_r<sum>``: the sum over earlier rows, by blocks of ``order``."""
    def window(keys):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def before(s, keys):
        return F.coalesce(F.sum(s).over(window(keys)), F.lit(0))

    if not levels:
        return rows.select("*", *[before(s, part).alias(f"_r{s}") for s in sums])
    blk = f"_blk{levels}"
    rows = rows.withColumn(blk, F.floor(F.col(order) / F.lit(block_size)).cast("bigint"))
    totals = rows.groupBy(*part, blk).agg(*[F.sum(s).alias(s) for s in sums])
    start = _running(totals, part, blk, sums, block_size, levels - 1)
    start = start.select(*part, blk, *[F.col(f"_r{s}").alias(f"_o{s}") for s in sums])
    inner = rows.select("*", *[before(s, [*part, blk]).alias(f"_r{s}") for s in sums])
    return (inner.join(start, [*part, blk])
            .withColumns({f"_r{s}": F.col(f"_r{s}") + F.col(f"_o{s}") for s in sums})
            .drop(blk, *[f"_o{s}" for s in sums]))


def row_number(df: DataFrame, part_cols: Sequence[str], order_col: str, name: str = "rn",
               block_size: int = BLOCK_SIZE) -> DataFrame:
    """1-based gap-free row number inside ``part_cols`` ordered by a unique key."""
    return running_sum(df, part_cols, order_col, {name: F.lit(1).cast("bigint")},
                       inclusive=True, block_size=block_size)
