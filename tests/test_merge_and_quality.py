from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from waybill.operators import merge, quality
from waybill.plans import monitoring, refresh as rf, serving
from waybill.schemas import ROUTE_SUMMARY
from waybill.sources import sinks, tables

S = "k string, t int, u int, n bigint"


def merged(spark, old, new, *args, **kwargs):
    state, updates = (spark.createDataFrame(rows, S) for rows in (old, new))
    return sorted(map(tuple, merge.keyed_merge(state, updates, ["k"], *args, **kwargs).collect()), key=repr)


OLD = [("a", 5, 5, 1), ("b", 5, 5, 1), ("c", None, 5, 1), ("keep", 1, 1, 1)]
NEW = [("a", 5, 7, 2), ("b", 4, 4, 2), ("c", 9, 9, 2), ("new", 3, 3, 2)]


def test_overwrite(spark):
    assert merged(spark, OLD, NEW) == sorted([*NEW, OLD[3]], key=repr)


def test_not_older(spark):
    got = merged(spark, OLD, NEW, merge.NOT_OLDER, time="t")
    # equal time: the update wins; older: stays; unknown stored time: stays, as in SQL
    assert got == sorted([NEW[0], OLD[1], OLD[2], NEW[3], OLD[3]], key=repr)


def test_widen_times(spark):
    got = merged(spark, OLD, NEW, merge.WIDEN_TIMES, first="t", last="u")
    assert got == sorted([("a", 5, 7, 2), ("b", 4, 5, 2), ("c", 9, 9, 2), ("new", 3, 3, 2), OLD[3]], key=repr)


def test_merging_twice_changes_nothing(spark):
    for policy, options in ((merge.OVERWRITE, {}), (merge.NOT_OLDER, {"time": "t"}),
                            (merge.WIDEN_TIMES, {"first": "t", "last": "u"})):
        once = merged(spark, OLD, NEW, policy, **options)
        assert merged(spark, once, NEW, policy, **options) == once


def test_not_older_does_not_depend_on_the_order_of_arrival(spark):
    one, two = [("a", 5, 1, 1), ("b", 2, 1, 1)], [("a", 3, 2, 2), ("b", 8, 2, 2)]
    forth = merged(spark, one, two, merge.NOT_OLDER, time="t")
    assert forth == merged(spark, two, one, merge.NOT_OLDER, time="t")


def test_wrong_policy(spark):
    with pytest.raises(ValueError):
        merged(spark, OLD, NEW, "newest")
    with pytest.raises(ValueError):
        merged(spark, OLD, NEW, merge.NOT_OLDER)


def test_not_yet_stored(spark):
    stored = spark.createDataFrame([(0, 1), (0, 1), (1, 5)], "p int, o int")
    updates = spark.createDataFrame([(0, 1), (0, 5), (1, 5)], "p int, o int")
    assert [tuple(r) for r in merge.not_yet_stored(updates, stored, ["p", "o"]).collect()] == [(0, 5)]


# -- versions -------------------------------------------------------------------------

def test_versions_commit_and_expire_on_request(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = spark.createDataFrame([], S).schema
    assert sinks.read_merged(spark, path, schema).isEmpty()
    first = None
    for n in range(5):
        state = sinks.read_merged(spark, path, schema)
        update = spark.createDataFrame([("a", n, n, n), (f"k{n}", n, n, n)], S)
        assert sinks.write_merged(merge.keyed_merge(state, update, ["k"]), path, source=f"q.{n}") == n
        first = first or sinks.read_merged(spark, path, schema)
    assert first.count() == 2  # a reader of an old version survives later commits
    assert sinks.versions(spark, path) == [0, 1, 2, 3, 4]
    assert sinks.read_merged(spark, path, schema).count() == 6
    assert sinks.read_merged(spark, path, schema, before=4).count() == 5
    # an unfinished version is invisible, and its number isn't used again
    (tmp_path / "table" / "version=9").mkdir()
    assert sinks.read_merged(spark, path, schema).count() == 6
    update = spark.createDataFrame([("z", 1, 1, 1)], S)
    assert sinks.write_merged(update, path, source="q.3") == 3  # a replay writes nothing
    assert sinks.read_merged(spark, path, schema).count() == 6
    assert sinks.write_merged(update, path, source="other.3") == 10  # the same batch of another query is new
    assert [r.k for r in sinks.read_merged(spark, path, schema).collect()] == ["z"]
    assert sinks.expire_versions(spark, path, keep=2) == [0, 1, 2, 3]
    assert sinks.versions(spark, path) == [4, 10]


def test_batches_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "batches")
    one = lambda n: spark.createDataFrame([(n,)], "n int")
    for n, source in ((1, "p.0"), (2, "q.0"), (3, "p.1"), (4, "p.0")):
        sinks.write_batch(one(n), path, source)
    (tmp_path / "batches" / "write=0000000007.x.0").mkdir()
    got = sorted((r.write, r.n) for r in sinks.read_batches(spark, path).collect())
    assert got == [("0000000000.p.0", 4), ("0000000001.q.0", 2), ("0000000002.p.1", 3)]


def test_table_scan_refuses_bad_input(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(OLD, S)
    sinks.write_table(df, path, sort_by=("k",))
    assert tables.table_scan(spark, path, required=("k", "t")).count() == 4
    with pytest.raises(ValueError, match="Missing columns"):
        tables.table_scan(spark, path, required=("k", "missing"))
    sinks.write_table(df.filter("false"), path)
    with pytest.raises(ValueError, match="empty"):
        tables.table_scan(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.table_scan(spark, path + "x")


def test_partition_values_keep_their_text(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("0012", 1), ("7", 2)], "route string, n int")
    sinks.write_table(df, path, partition_by=("route",))
    schema = df.select("n", "route").schema
    assert sorted(r.route for r in tables.table_scan(spark, path, schema).collect()) == ["0012", "7"]


# -- quality --------------------------------------------------------------------------

D = "route_id string, vehicle_count int, latitude double, note string"


def results(spark, rows, rules):
    return {r.check_name: r for r in quality.run_checks(spark.createDataFrame(rows, D), rules).collect()}


def test_passing_checks(spark):
    rules = [quality.not_empty("route_id"), quality.non_negative("vehicle_count"),
             quality.in_range("latitude", -90, 90), quality.required_columns(["route_id", "vehicle_count"])]
    df = spark.createDataFrame([("123", 10, 28.6139, None)], D)
    found = quality.run_checks(df, rules)
    assert quality.all_checks_passed(found)
    assert all(r.passed and r.failed_count == 0 and r.message == "" for r in found.collect())


@pytest.mark.parametrize("rule, values, failed, message", [
    (quality.not_empty("route_id"), (None, 1, 1.0, ""), 1, "route_id is null"),
    (quality.not_empty("route_id"), ("", 1, 1.0, ""), 1, "route_id is empty"),
    (quality.not_empty("route_id"), (" \t ", 1, 1.0, ""), 1, "route_id is empty"),
    (quality.non_negative("vehicle_count"), ("r", None, 1.0, ""), 1, "vehicle_count is null"),
    (quality.non_negative("vehicle_count"), ("r", -1, 1.0, ""), 1, "vehicle_count must be non-negative"),
    (quality.in_range("latitude", -90, 90), ("r", 1, None, ""), 1, "latitude is null"),
    (quality.in_range("latitude", -90, 90), ("r", 1, 91.0, ""), 1, "latitude must be between -90 and 90"),
    (quality.in_range("latitude", -90, 90), ("r", 1, float("nan"), ""), 1, "latitude must be between -90 and 90"),
    (quality.required_columns(["route_id", "speed", "x"]), ("r", 1, 1.0, ""), 0, "Missing columns: speed, x"),
])
def test_failing_checks(spark, rule, values, failed, message):
    found = quality.run_checks(spark.createDataFrame([values, ("ok", 1, 1.0, "")], D), [rule])
    row = found.first()
    assert (row.passed, row.failed_count, row.message) == (False, failed, message)
    assert not quality.all_checks_passed(found)


def test_a_rule_that_cannot_run_fails_alone(spark):
    def explode(df):
        raise RuntimeError("boom")

    rules = [quality.Rule("broken", explode), quality.non_negative("note"), quality.not_empty("absent"),
             quality.not_empty("route_id")]
    got = results(spark, [("r", 1, 1.0, "n")], rules)
    assert got["broken"].message == "Check execution failed: boom"
    assert got["note_non_negative"].message == "Check execution failed: note is not numeric"
    assert not got["absent_not_empty"].passed and got["route_id_not_empty"].passed


def test_no_rules_pass(spark):
    assert quality.all_checks_passed(results_df := quality.run_checks(spark.createDataFrame([], D), []))
    assert results_df.columns == ["check_name", "passed", "failed_count", "message"]


# -- monitoring -----------------------------------------------------------------------

NOW = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def arrivals(spark, *rows):
    return spark.createDataFrame(rows, "vehicle_id string, vehicle_timestamp timestamp, ingestion_timestamp timestamp")


@pytest.mark.parametrize("minutes, status", [(9, "fresh"), (10, "fresh"), (10.5, "stale"), (None, "no_data")])
def test_freshness(spark, minutes, status):
    rows = [] if minutes is None else [("a", NOW, NOW - timedelta(minutes=minutes)), ("a", NOW, NOW - timedelta(days=9))]
    row = monitoring.freshness(arrivals(spark, *rows), NOW).first()
    assert (row.status, row.age_minutes) == (status, minutes)


def test_observability(spark):
    rows = [("a", NOW, NOW), ("a", NOW, NOW), ("a", None, NOW), ("a", None, NOW), (None, NOW, NOW), ("b", NOW, None)]
    assert tuple(monitoring.table_observability(arrivals(spark, *rows), "t").first()) == ("t", 6, 2, 2)
    assert tuple(monitoring.table_observability(arrivals(spark), "t").first()) == ("t", 0, 0, 0)
    assert monitoring.duplicate_keys(arrivals(spark, *rows), ["vehicle_id", "vehicle_timestamp"]).count() == 2
    assert tuple(monitoring.not_empty_check(arrivals(spark), "t").first()) == ("t", 0, False)


def test_run_record_follows_the_checks(spark):
    summary = spark.createDataFrame([("r",), ("",)], "route_id string")
    passed = quality.all_checks_passed(monitoring.validate_route_ids(summary))
    record = monitoring.run_record("x", NOW, NOW + timedelta(seconds=2.5), summary, passed).first()
    assert (record.status, record.data_quality_status, record.records_processed, record.duration_seconds) == (
        "FAILED", "FAILED", 2, 2.5)


def events(spark, *rows):
    full = [(v, r, "t", 1.0, 2.0, NOW + timedelta(minutes=m), NOW, 0, n) for n, (v, r, m) in enumerate(rows)]
    return spark.createDataFrame(full, (
        "vehicle_id string, route_id string, trip_id string, latitude double, longitude double, "
        "vehicle_timestamp timestamp, ingestion_timestamp timestamp, kafka_partition int, kafka_offset bigint"))


def test_refresh_merges_and_records(spark, tmp_path):
    root = str(tmp_path)
    first = events(spark, ("a", "r1", 0), ("b", "r2", 0))
    rf.refresh(first, root, NOW, latest=serving.latest_positions(first))
    later = NOW + timedelta(hours=1)
    got = {r.route_id: r for r in rf.refresh(events(spark, ("a", "r1", 5), ("b", "r1", 6)), root, later).collect()}
    assert got["r1"].active_vehicle_count == 2 and got["r1"].updated_at.hour == 13
    assert got["r2"].active_vehicle_count == 1 and got["r2"].updated_at.hour == 12  # not seen again, stays
    assert [r.status for r in spark.read.parquet(f"{root}/freshness").collect()].count("stale") == 1
    assert spark.read.parquet(f"{root}/runs").filter("status = 'SUCCESS'").count() == 2
    assert spark.read.parquet(f"{root}/data_quality_metrics").count() == 2


def test_refresh_stops_on_a_blank_route(spark, tmp_path):
    with pytest.raises(RuntimeError):
        rf.refresh(events(spark, ("a", " ", 0)), str(tmp_path), NOW)
    with pytest.raises(RuntimeError):
        rf.refresh(events(spark), str(tmp_path / "empty"), NOW)
    assert spark.read.parquet(f"{tmp_path}/runs").first().status == "FAILED"
    assert sinks.read_merged(spark, f"{tmp_path}/route_activity_summary", ROUTE_SUMMARY).count() == 1


def test_table_health_equals_its_parts(spark):
    table = events(spark, ("a", "r1", 0), ("a", "r1", 0), ("b", None, 4))
    observed, fresh = monitoring.table_health(table, "t", NOW)
    assert observed.collect() == monitoring.table_observability(table, "t").collect()
    assert fresh.collect() == monitoring.freshness(table, NOW).collect()
