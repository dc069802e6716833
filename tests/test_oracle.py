"""Every catalogue query vs its DuckDB oracle at sf 0.001 (exact values)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from airq.plans.catalog import CATALOG
from airq.plans.checker import compare, duck
from airq.plans.oracle import ORACLE

from .conftest import SF_SMALL

SQL = {k: v for k, v in oracle_sql().items() if k in ORACLE}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    r = compare(df, con, SQL[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_every_query_has_oracle_or_is_listed():
    rows_only = set(CATALOG) - set(SQL)
    assert rows_only <= {"forecast_24h"}


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "aqi_final" in df.columns
