"""Every registered query against its DuckDB SQL on the smallest tables; those without SQL must run."""

import os

import duckdb
import pandas as pd
import pytest

from siltstone.plans import registry

registry.load()

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def plain(v):
    if hasattr(v, "tolist") and getattr(v, "ndim", 0):
        v = v.tolist()
    if isinstance(v, (list, tuple, dict)):
        return str(v)
    if v is None or pd.isna(v):
        return None
    v = v.item() if hasattr(v, "item") else v
    return v if isinstance(v, bool) else float(v) if isinstance(v, (int, float)) else str(v)


def rows(df, columns):
    return sorted(([plain(v) for v in r] for r in df[columns].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    got = registry.QUERIES[name](spark, SF)
    if name not in registry.ORACLE:
        assert got.count() >= 0
        return
    want = con.sql(registry.ORACLE[name]).df()
    got = got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
