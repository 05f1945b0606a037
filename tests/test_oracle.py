"""Every registered query against its DuckDB twin on the smallest tables
(row count, column names and an order-insensitive hash of values rounded
to 6 decimals), plus a row check for the queries without SQL twin."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from ratelens.plans import catalog
from tests.conftest import SMALL_DIR

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SQL, QUERIES = catalog.oracle_sql(), catalog.queries()
SKIP_ROWS_ONLY = {"t21_run_models", "t19_compare_models", "t16_random_forest", "t16_importances", "t20_study_examples"}


def _canon(v):
    if v is None:
        return "-"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_canon(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_DIR}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL_DIR)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, df.columns) == _digest(drows, dcols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SKIP_ROWS_ONLY))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SMALL_DIR).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "wilson_lb" in df.columns
