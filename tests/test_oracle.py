"""Every registered query equals its DuckDB oracle on the smallest scale factor."""

import os

import duckdb
import pytest

from tests.conftest import SMALL
from tools.compare import TABLES, canon
from touchline.registry import REGISTRY

NAMES = sorted(n for n, (_, sql) in REGISTRY.items() if sql is not None)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    df = fn(spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    drows = rel.fetchall()
    assert len(rows) == len(drows)
    assert canon(df.columns, rows) == canon(rel.columns, drows)


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert "match_week_number" in df.columns
