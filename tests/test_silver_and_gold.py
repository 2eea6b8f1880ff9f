from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from waybill.functions.geo import grid
from waybill.functions.text import decimal_text, is_blank, status_label
from waybill.functions.times import filename_timestamp, iso_text, parse_iso
from waybill.operators import silver as sv
from waybill.operators.latest import latest_by
from waybill.plans import gold, serving

RAW = "vehicle_id string, route_id string, trip_id string, latitude string, longitude string, vehicle_timestamp string, ingestion_timestamp string, source_file string"
T = "2024-01-01 10:00:00"


def raw(spark, *rows):
    return spark.createDataFrame([(*r, T, "f1")[:8] for r in rows], RAW)


def test_silver_rules(spark):
    df = raw(
        spark,
        ("a", "r", "t", "28.6", "77.2", T), ("a", "r", "t", "28.6", "77.2", T),   # exact copy
        ("", "r", "t", "28.6", "77.2", T),                                        # empty id stays
        (None, "r", "t", "28.6", "77.2", T), ("b", "r", "t", "x", "77.2", T),
        ("c", "r", "t", "28.6", None, T), ("d", "r", "t", "90.1", "77.2", T),
        ("e", "r", "t", "28.6", "77.2", "never"), ("f", None, None, "-90", "-180", T),
    )
    clean = sv.historical_silver(df)
    assert sorted(r.vehicle_id for r in clean.collect()) == ["", "a", "f"]
    assert dict(clean.dtypes)["latitude"] == "double" and dict(clean.dtypes)["vehicle_timestamp"] == "timestamp"


def test_copy_from_another_file_stays_in_history_only(spark):
    row = ("a", "r", "t", "28.6", "77.2", T, T)
    df = spark.createDataFrame([(*row, "f1"), (*row, "f2")], RAW)
    assert sv.historical_silver(df).count() == 2
    assert sv.snapshot_silver(df).count() == 1
    assert "source_file" not in sv.snapshot_silver(df).columns


def test_grid_rounds_ties_to_even(spark):
    values = [28.6125, 28.6135, 28.6, 0.0005, -0.0015]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(grid(F.col("x"))).collect()]
    assert got == [28.612, 28.614, 28.6, 0.0, -0.002]
    texts = spark.createDataFrame([(28.6,), (77.0,), (0.002,), (-5.25,)], "x double")
    assert [r[0] for r in texts.select(decimal_text(F.col("x"), 3)).collect()] == ["28.6", "77.0", "0.002", "-5.25"]


def test_text_and_time_helpers(spark):
    blanks = spark.createDataFrame([("",), (" \t\n",), (" ",), ("x ",)], "s string")
    assert [r[0] for r in blanks.select(is_blank(F.col("s"))).collect()] == [True, True, True, False]
    labels = spark.createDataFrame([("HIGH_ACTIVITY",), (None,), ("",)], "s string")
    assert [r[0] for r in labels.select(status_label(F.col("s"))).collect()] == ["High Activity", "UNKNOWN", "UNKNOWN"]
    assert labels.select(status_label(F.col("s"), "Alert")).collect()[1][0] == "Alert"
    times = spark.createDataFrame([("2024-01-01T00:00:00+00:00",), ("2024-01-01T05:30:00.5+05:30",), ("no",)], "s string")
    assert [r[0] for r in times.select(iso_text(parse_iso(F.col("s")))).collect()] == [
        "2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00.500000+00:00", None]


def test_filename_timestamp(spark):
    df = spark.createDataFrame([("/x/vehicle_positions_20260912_105335.bin",)], "p string")
    got = df.select(F.unix_seconds(filename_timestamp(F.col("p")))).first()[0]
    assert got == int(datetime(2026, 9, 12, 10, 53, 35, tzinfo=timezone.utc).timestamp())
    bad = spark.createDataFrame([("/x/positions.bin",)], "p string")
    with pytest.raises(Exception, match="Invalid snapshot file name"):
        bad.select(filename_timestamp(F.col("p"))).collect()


def positions(spark, at, *rows):
    return spark.createDataFrame(
        [(v, r, t, 28.6, 77.2, at(s), at(s + 5), 0, off) for v, r, t, s, off in rows],
        "vehicle_id string, route_id string, trip_id string, latitude double, longitude double, "
        "vehicle_timestamp timestamp, ingestion_timestamp timestamp, kafka_partition int, kafka_offset bigint")


def test_latest_positions_order_and_tie(spark, at):
    df = positions(spark, at, ("a", "r1", "t", 10, 1), ("a", "r2", "t", 10, 2), ("a", "r3", "t", 5, 9),
                   ("b", None, None, 1, 1), (None, "r", "t", 99, 9))
    got = {r.vehicle_id: r for r in serving.latest_positions(df).collect()}
    assert set(got) == {"a", "b"} and got["a"].route_id == "r2" and got["a"].updated_at is not None


def test_latest_by_reduces_below_the_shuffle(spark, at):
    df = positions(spark, at, *[("hot", "r", "t", n, n) for n in range(50)])
    plan = latest_by(df, ["vehicle_id"], ["vehicle_timestamp", "kafka_offset"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_route_vehicle_summary_counts_last_route_only(spark, at):
    df = positions(spark, at, ("a", "r1", "t1", 0, 1), ("a", "r2", "t2", 9, 2), ("b", "r2", None, 3, 3),
                   ("c", None, "t", 99, 4))
    got = {r.route_id: (r.active_vehicles, r.unique_trips) for r in gold.route_vehicle_summary(df).collect()}
    assert got == {"r2": (2, 1)}
    assert tuple(gold.summary_totals(gold.route_vehicle_summary(df)).first()) == (2, 1)


def test_hourly_ignores_missing_routes_but_counts_rows(spark, at):
    df = positions(spark, at, ("a", "r", "t", 0, 1), ("a", None, "t", 1, 2), ("b", "r", "t", 2, 3), (None, "r", "t", 3, 4))
    row = gold.hourly_vehicle_activity(df).first()
    assert (row.active_vehicles, row.active_routes, row.total_records) == (2, 1, 3)


def test_inferred_stops_count_ids_and_need_enough(spark, at):
    rows = [("a", "r", "t", n, n) for n in range(10)] + [(None, "r", "t", 50, 50)]
    stop = gold.inferred_stops(positions(spark, at, *rows)).first()
    assert stop.observation_count == 10 and stop.stop_id == "INF_28.6_77.2"
    assert stop.stop_name == "Inferred Mobility Point INF_28.6_77.2"
    assert stop.last_seen_at.timestamp() == at(50).timestamp()
    assert gold.inferred_stops(positions(spark, at, *rows[:9])).isEmpty()


def test_snapshot_metrics_skip_empty_ids_and_keep_empty_files(spark, at):
    df = positions(spark, at, ("", "", "t", 1, 1), ("a", "r", "t", 5, 2)).withColumn(
        "source_file", F.lit("vehicle_positions_20240101_100000.bin"))
    files = spark.createDataFrame([("/x/vehicle_positions_20240101_100000.bin",), ("/x/vehicle_positions_20240101_110000.bin",)], "path string")
    got = {r.source_file[-10:-4]: r for r in gold.snapshot_metrics(df, files).collect()}
    assert (got["100000"].active_vehicles, got["100000"].active_routes, got["100000"].total_records) == (1, 1, 2)
    assert got["110000"].total_records == 0 and got["110000"].snapshot_time is None
    assert got["110000"].ingestion_timestamp is not None


def test_empty_overview_and_limits(spark, at):
    none = serving.latest_positions(positions(spark, at))
    assert tuple(serving.metrics_overview(none).first()) == (0, 0, 0, None)
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            serving.vehicles_latest(none, bad)
        with pytest.raises(ValueError):
            serving.routes_activity(none, bad)


def test_anomalies_and_alerts(spark, at):
    rows = [(f"v{n}", "r", "t", 0, n) for n in range(9)] + [("v0", "r", "t", 3600, 90), ("v0", "r", "t", 7200, 91), ("v0", "q", "t", 0, 92)]
    anomalies = gold.route_activity_anomalies(positions(spark, at, *rows))
    got = {(r.route_id, r.active_vehicles): r.anomaly_status for r in anomalies.collect()}
    assert got == {("r", 9): "HIGH_ACTIVITY", ("r", 1): "LOW_ACTIVITY", ("q", 1): "NORMAL"}
    alerts = gold.mobility_alerts(anomalies).orderBy("alert_id").collect()
    assert [a.alert_id for a in alerts] == [1, 2, 3]
    assert alerts[0].alert_type == "HIGH_ACTIVITY" and alerts[0].message.startswith("Route r: HIGH_ACTIVITY at 2024-01-01")
    assert [a.alert_id for a in gold.recent_alerts(gold.mobility_alerts(anomalies), 2).collect()] == [3, 2]


def test_hourly_comparison_looks_back_one_day(spark):
    hour = lambda d, h: datetime(2024, 1, d, h, tzinfo=timezone.utc)
    df = spark.createDataFrame([(hour(1, 5), 10), (hour(2, 5), 14), (hour(2, 6), 3)], "hour timestamp, active_vehicles bigint")
    got = {(r.hour.day, r.hour.hour): r.difference for r in gold.hourly_comparison(df).collect()}
    assert got == {(1, 5): None, (2, 5): 4, (2, 6): None}
