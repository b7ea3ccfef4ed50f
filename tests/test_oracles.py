"""Every registered query against its SQL oracle (DuckDB) on the smallest
driver tables; the driver repeats this at sf0.01."""
import os

import pytest

import __spark_entry__ as E
from compare import compare, duck
from tidewatch import queries as Q

SF = os.environ.get("TW_ORACLE_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = Q.QUERIES, Q.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, ORACLES[name]) == []


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["asset_symbol", "window_start", "window_end"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["gold_anomalies", "silver_trades_typed", "lag_breaches"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = QUERIES[name](spark, SF)
        assert compare(df, con, ORACLES[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
