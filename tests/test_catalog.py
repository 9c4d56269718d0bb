"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from airlens.plans import catalog
from conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(ORACLE) and set(catalog.QUERIES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["city", "country", "hour", "dominant_pollutant", "aqi", "reading_count", "dangerous"]


def test_oracle_sql_needs_no_spark():
    import subprocess
    import sys

    code = ("import sys; sys.path.insert(0, '.'); import __spark_entry__ as e; "
            "from pyspark import SparkContext; assert SparkContext._active_spark_context is None; "
            "print(len(e.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=__import__("os").path.dirname(__import__("os").path.dirname(__file__)))
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.strip()) == len(ORACLE)
