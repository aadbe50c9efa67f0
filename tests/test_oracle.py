"""The driver's correctness gate at sf0.001: every query with oracle SQL
matches DuckDB on row count, columns and values."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tools.oracle_check import compare


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "efficiency" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF0001, [name], verbose=False)[name]
    assert res["rows_match"] and res["cols_match"] and res["hash_match"], res


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())
