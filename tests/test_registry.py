"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402
from waybill import fixtures  # noqa: E402
from waybill.operators import movement, silver  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return connection


@pytest.mark.parametrize("name", entry.own_queries())
def test_query_matches_sql(spark, db, name):
    verdict = compare.compare(spark, db, name, entry.own_queries()[name], entry.own_sql().get(name), SF)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert entry.own_queries().keys() == entry.own_sql().keys()


def test_fixture_counts(spark):
    rows = fixtures.positions(spark, SF)
    clean = silver.historical_silver(rows)
    moved = movement.vehicle_movement(clean)
    assert (rows.count(), silver.exact_dedupe(rows).count(), clean.count()) == (1035, 1015, 963)
    assert (moved.count(), moved.filter("time_difference_minutes is null").count()) == (163, 14)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "route_id" and result.count() <= 10
