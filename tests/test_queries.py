"""Every registered query: its SQL twin must agree, and without one it must return rows."""

import duckdb
import pytest
from check_oracle import TABLES, compare

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["dropoff_nhood", "pickup_nhood", "ave_tip", "ave_dist"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cur = db.execute(SQL[name])
    assert compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description]) == ""


# The fits of these need more stations than the smallest tables have.
LARGE = {"pollution_forecast", "lm_interactions", "score_chain", "model_store"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_returns_rows(spark, sf, name):
    assert not QUERIES[name](spark, "/root/testdata/sf0.01" if name in LARGE else sf).isEmpty()
