import duckdb
import pytest

from airq.llm.queries import share_code
from airq.plans.checker import duck


@pytest.fixture(autouse=True)
def shared_code(spark):
    share_code(spark)


@pytest.fixture(scope="session")
def oracle():
    """rows(sf_dir, sql): the DuckDB result as (column names, rows)."""

    def rows(sf_dir, sql):
        con = duck(sf_dir)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        return names, cur.fetchall()

    return rows


def same_rows(df, names, rows):
    cols = sorted(names)
    assert sorted(df.columns) == cols
    at = [names.index(c) for c in cols]
    left = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    right = sorted((tuple(r[i] for i in at) for r in rows), key=repr)
    assert left == right
