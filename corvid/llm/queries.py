"""One registered query per operator, and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvid.llm import (codes, hardneg, mixing, neardup, packing, pii, quality, repeats, rules,
                        secrets, sharding, toxicity, vafile)
from corvid.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": repeats.op1_repeats,
    "op2_quality": quality.op2_quality,
    "op3_vafile": vafile.op3_vafile,
    "op4_packing": packing.op4_packing,
    "op5_rules": rules.op5_rules,
    "op6_secrets": secrets.op6_secrets,
    "op7_shards": sharding.op7_shards,
    "op8_pii": pii.op8_pii,
    "op9_near_dups": neardup.op9_near_dups,
    "op10_mixing": mixing.op10_mixing,
    "op11_codes": codes.op11_codes,
    "op12_hard_negatives": hardneg.op12_hard_negatives,
    "op13_toxicity": toxicity.op13_toxicity,
}
ORACLE: dict[str, str] = {
    "op3_vafile": vafile.SQL,
    "op7_shards": sharding.SQL,
    "op10_mixing": mixing.SQL,
    "op11_codes": codes.SQL,
    "op12_hard_negatives": hardneg.SQL,
}


def _shipped(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(fn) for name, fn in QUERIES.items()}


def llm_oracles() -> dict[str, str]:
    return dict(ORACLE)
