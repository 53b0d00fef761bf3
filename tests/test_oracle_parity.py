"""(a) every named query equals its independent DuckDB oracle on the given tables."""

import pytest

import __spark_entry__ as E
from helpers import duck_rows, spark_rows
from rtmart.plans import queries as rtmart_queries

# the optional training-data queries are tested in tests/llm
QUERIES = {k: E.queries()[k] for k in rtmart_queries()}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, name):
    s_cols, s_rows = spark_rows(QUERIES[name](spark, sf_small))
    d_cols, d_rows = duck_rows(ORACLES[name], sf_small)
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["dt", "hr", "cnt"]
    assert df.count() > 0


@pytest.mark.parametrize("name,expected", [
    ("dau_first_touch", 4006), ("order_wide", 60000), ("order_wide_interval", 17173),
    ("sliding_window_counts", 29179), ("first_order_flag", 12714), ("match_top20", 20),
])
def test_known_counts_sf001(spark, sf_mid, name, expected):
    assert QUERIES[name](spark, sf_mid).count() == expected
