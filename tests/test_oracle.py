"""Every registered query of the library's plans against its DuckDB oracle on the smallest tables
(row count, column names and the multiset of rows must be equal)."""

import os

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck
from shelfwise.plans import load_all
from shelfwise.plans.registry import ORACLE as SQL
from shelfwise.plans.registry import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_the_driver_sees_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    st = compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert st["status"] == "ok", st


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "ty_sales" in df.columns


TIME_QUERIES = ["derived_order_counts", "typed_ingest", "review_backlog", "question_backlog",
                "latest_dated_file", "first_per_key", "upsert_conditions", "weekly_totals"]


@pytest.mark.parametrize("name", TIME_QUERIES)
def test_session_time_zone_does_not_change_results(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        st = compare(spark, con, name, QUERIES[name], SQL.get(name), SF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert st["status"] == "ok", st
