"""Every registered query against its DuckDB oracle, on the smallest tables."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from linecraft.plans import registered
from linecraft.testing import compare, duckdb_connection

# Queries of optional parts have their tests beside them.
QUERIES = registered.QUERIES
ORACLES = registered.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert r["spark_rows"] == r["oracle_rows"] and r["spark_rows"] > 0, r
    assert r["columns_match"] and r["values_match"], r


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["word", "cnt"] and df.count() > 0


@pytest.mark.parametrize("name", ["log_tagged", "log_parsed", "log_counts", "app_events", "word_count", "scan_lines"])
def test_query_independent_of_session_settings(spark, con, name):
    """Zone, ANSI mode and string-escape rules of the session do not change
    any result (the SQL text uses raw literals and chr() for control
    characters)."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.parser.escapedStringLiterals", "true")
    try:
        r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.ansi.enabled", "true")
        spark.conf.set("spark.sql.parser.escapedStringLiterals", "false")
    assert r["columns_match"] and r["values_match"], r
