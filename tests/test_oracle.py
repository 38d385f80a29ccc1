"""Every registered query against its independent DuckDB SQL on the same parquet tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("lineitem", "orders", "documents", "benchmark")


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_every_query_is_registered_with_callable():
    assert QUERIES and all(callable(f) for f in QUERIES.values())
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(exp)
    assert _rows(df.columns, got) == _rows(ocols, exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "control_score" in df.columns and "metrics_json" not in df.columns


@pytest.mark.parametrize("name", ["documents_controled_detailed", "control_monthly_trends",
                                  "documents_detailed_incremental", "freshness_report"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    """Timestamp bounds are wall-clock literals: a session zone other than the process zone changes nothing."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert _rows(df.columns, got) == _rows(ocols, res.fetchall())
