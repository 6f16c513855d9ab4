"""Every query with SQL against DuckDB, at the smallest scale."""

import glob
import os

import duckdb
import pytest

from skyweft.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def rows(frame, columns):
    def plain(x):
        if x is None or x != x:
            return None
        return x + 0.0 if isinstance(x, float) else x

    return sorted((tuple(plain(x) for x in r) for r in frame[columns].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    found, wanted = QUERIES[name](spark, sf_dir).toPandas(), duck.execute(ORACLES[name]).df()
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    a, b = rows(found, columns), rows(wanted, columns)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == tuple(pytest.approx(v, abs=1e-6) if isinstance(v, float) else v for v in y)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 200
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
