"""Every registered query equals its DuckDB oracle (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from fareflow.plans import catalog
from fareflow.plans.verify import compare, duckdb_connection

# The core library's queries; those of the optional subpackage have their own tests.
QUERIES = {name: e.fn for name, e in catalog.load().items()}
ORACLES = {name: e.oracle for name, e in catalog.load().items() if e.oracle is not None}


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_small, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES[name], sf_small, con)
    assert r["ok"], r


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLES)) == []
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_monthly_fare" in df.columns


def test_every_query_has_survey_ids():
    from fareflow.plans.catalog import REGISTRY
    assert all(e.ids for e in REGISTRY.values())


TZ_SENSITIVE = ["job01_monthly_revenue_zone_id", "agg19_by_hour", "agg28_weekly_retention",
                "win06_moving_average", "str01_tumbling_counts", "str14_recent_categories"]


@pytest.mark.parametrize("name", TZ_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, sf_small, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, name, QUERIES[name], ORACLES[name], sf_small, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r["ok"], r
