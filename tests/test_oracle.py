"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck

from conftest import SF_SMALL

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    r = compare(df, con, ORACLE[name])
    assert r["columns_match"], r
    assert r["types_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 526
    assert "vwap" in df.columns
