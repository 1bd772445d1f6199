"""Every registered query against its DuckDB oracle (sf0.001), streams
against batch, completeness of the bank pipeline, model quality."""

import duckdb
import pytest

import __spark_entry__ as E
from corvid.sources.tables import TABLES
from tests.conftest import SF_MID, SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _core(names):
    """The training-data queries have tests of their own."""
    return sorted(n for n in names if not n.startswith("op") and n != "pipeline")


@pytest.mark.parametrize("name", _core(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_every_query_has_an_oracle():
    assert _core(set(QUERIES) - set(ORACLES)) == []


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["split", "n", "accuracy", "f1", "f1_neg"] and df.count() == 2


def test_bank_completeness(spark):
    r = QUERIES["bank_completeness"](spark, SF_SMALL).first()
    assert r.n_missing == 0 and r.n_valid + r.n_rejected == r.n_input


@pytest.mark.parametrize("stream,batch", [("stream_chat", "chat_stop"),
                                          ("stream_score", "score_texts")])
def test_stream_equals_batch(spark, stream, batch):
    a = QUERIES[stream](spark, SF_SMALL)
    b = QUERIES[batch](spark, SF_SMALL).select(*a.columns)
    assert sorted(a.collect()) == sorted(b.collect())


SF_BIG = "/root/testdata/sf0.1"


def _validation(spark, name, sf=SF_MID):
    return next(r for r in QUERIES[name](spark, sf).collect() if r.split == "validation")


def _majority_share(spark, sf=SF_MID):
    rows = [r for r in QUERIES["class_balance"](spark, sf).collect() if r.split == "validation"]
    return max(r.share for r in rows)


@pytest.mark.parametrize("name,sf", [("eval_binary", SF_MID)])
def test_sentiment_models_beat_majority(spark, name, sf):
    r = _validation(spark, name, sf)
    assert r.accuracy > _majority_share(spark, sf) and r.f1_neg > 0


@pytest.mark.parametrize("name,sf", [("train_sentiment", SF_MID), ("train_sentiment", SF_BIG), ("select_model", SF_MID)])
def test_logistic_regression_beats_majority(spark, name, sf):
    assert _validation(spark, name, sf).beats_majority


def test_category_model_carries_over_to_unseen_descriptions(spark):
    test = next(r for r in QUERIES["train_category"](spark, SF_SMALL).collect() if r.split == "test")
    assert test.beats_majority


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]])
def test_chat_stream_under_any_arrival(spark, order):
    from corvid.plans.stream_plans import chat_arrivals
    got = chat_arrivals(spark, SF_SMALL, order).collect()
    want = QUERIES["chat_stop"](spark, SF_SMALL).select("conv_id", "turn", "role", "text").collect()
    assert sorted(got) == sorted(want)


def test_cross_entropy_scores_once(spark):
    df = QUERIES["cross_entropy"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(concat([[CLS]]") == 1


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_sink_roundtrip_formats(spark, fmt):
    from corvid.operators import bank as B
    from corvid.plans.bank_plans import normalized
    from corvid.session import fresh_dir
    from corvid.sources.bank_csv import read_normalized, write_normalized
    valid, _ = B.split_valid(normalized(spark, SF_SMALL))
    cols = ["row_id", "date", "merchant", "description", "amount", "category"]
    want = valid.select(*cols)
    path = write_normalized(want, fresh_dir(spark, f"sink-{fmt}"), fmt)
    got = read_normalized(spark, path, fmt).select(*cols)
    assert sorted(got.collect()) == sorted(want.collect())
