"""Every registered query against its DuckDB twin (sf0.001)."""
import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

SF_SMALL = "/root/testdata/sf0.001"

SQLS = E.oracle_sql()
QS = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QS))
def test_query_matches_oracle(spark, con, name):
    r = compare(name, spark, con, SF_SMALL, QS[name], SQLS.get(name))
    assert r["status"] in ("exact", "approx", "rows-only"), r
    if name not in SQLS:
        assert r["spark_rows"] > 0


def test_every_sql_has_a_query():
    assert set(SQLS) <= set(QS)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "CustomerID" and len(df.columns) == 12
    assert df.count() > 0


@pytest.mark.parametrize("name", ["clean_lines", "epoch_roundtrip", "cust_features",
                                  "window_features", "stream_window_features", "rank_change"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(name, spark, con, SF_SMALL, QS[name], SQLS.get(name))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["status"] in ("exact", "approx"), r
