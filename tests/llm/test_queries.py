"""Registered queries of the training-data operators against their SQL."""

import duckdb
import pytest

from corvid.llm.queries import llm_oracles, llm_queries
from corvid.sources.tables import TABLES
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df, rel = llm_queries()[name](spark, SF_SMALL), con.sql(llm_oracles()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got = sorted(repr([r[c] for c in sorted(df.columns)]) for r in df.collect())
    want = sorted(repr([r[rel.columns.index(c)] for c in sorted(rel.columns)]) for r in rel.fetchall())
    assert got == want


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))
