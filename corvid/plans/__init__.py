"""Registered queries: each is a Spark plan over the given tables plus, where
the semantics are expressible in SQL, an independent DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    from corvid.plans import (bank_plans, bundle_plans, chat_plans, class_plans,  # noqa: F401
                              generate_plans,
                              epoch_plans, infer_plans, ml_plans, piece_plans,
                              score_plans, stream_plans, text_plans, udf_plans)


def _shipped(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from corvid.session import ship_package
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, QueryFn]:
    """Registered queries; each first makes sure executors can import corvid."""
    _load_all()
    return {name: _shipped(fn) for name, fn in QUERIES.items()}


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
