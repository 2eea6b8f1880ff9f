import math
import random

import pytest
from pyspark.sql import functions as F

from waybill.functions.geo import haversine_km
from waybill.operators.movement import movement_profile, vehicle_movement

SCHEMA = (
    "vehicle_id string, route_id string, trip_id string, latitude double, longitude double, "
    "vehicle_timestamp timestamp, kafka_offset bigint"
)


def brute_force(rows, max_gap=300.0):
    """One pass over the sorted rows of each vehicle."""
    out = []
    previous = {}
    for v, r, t, lat, lon, ts, off in sorted(
        (row for row in rows if None not in (row[0], row[1], row[3], row[4], row[5])),
        key=lambda row: (row[0], row[5], row[6]),
    ):
        if v in previous:
            plat, plon, pts = previous[v]
            gap = (ts - pts).total_seconds()
            if gap <= max_gap:
                p1, p2 = math.radians(plat), math.radians(lat)
                a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon - plon) / 2) ** 2
                km = 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))
                minutes = gap / 60 if gap > 0 else None
                speed = km / (minutes / 60) if minutes else None
                fast = speed is not None and speed > 120
                out.append((v, off, round(km, 6), minutes and round(minutes, 6),
                            None if fast or speed is None else round(speed, 5), fast))
        previous[v] = (lat, lon, ts)
    return sorted(out, key=repr)


def measured(df, rows):
    """Result rows keyed back to their offset through position and time."""
    offsets = {}
    for v, r, t, lat, lon, ts, off in rows:
        offsets.setdefault((v, lat, lon, ts.timestamp() if ts else None), off)
    out = []
    for x in df.collect():
        key = (x.vehicle_id, x.latitude, x.longitude, x.vehicle_timestamp.timestamp())
        out.append((
            x.vehicle_id, offsets[key], round(x.distance_km, 6),
            x.time_difference_minutes and round(x.time_difference_minutes, 6),
            None if x.speed_kmh is None else round(x.speed_kmh, 5), x.is_speed_anomaly,
        ))
    return sorted(out, key=repr)


def fleet(at, count=1500, hot=0.4, seed=5):
    """One vehicle owns a large share, many rows share an instant, some gaps are long."""
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        vehicle = "hot" if rng.random() < hot else f"v{rng.randrange(8)}"
        second = rng.choice([rng.randrange(20_000), 7_200, 1_799, 1_800])
        rows.append((
            vehicle, None if n % 31 == 0 else f"r{n % 3}", None if n % 7 == 0 else "t",
            28.6 + n / 1e5, 77.2 + rng.randrange(100) / 1e4, at(second), n,
        ))
    return rows


def test_haversine_known_distance(spark):
    row = spark.range(1).select(
        haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("one_degree"),
        haversine_km(F.lit(28.6), F.lit(77.2), F.lit(28.6), F.lit(77.2)).alias("nowhere"),
    ).first()
    assert row.one_degree == pytest.approx(math.pi * 6371.0 / 180)
    assert row.nowhere == 0


@pytest.mark.parametrize("options", [
    {},
    {"slice_minutes": 5},
    {"count_slices": True, "hot_rows": 10},
    {"count_slices": True, "hot_rows": 10, "slice_minutes": 600},
    {"count_slices": True, "hot_rows": 10**9},
])
def test_movement_matches_brute_force_for_every_plan(spark, at, options):
    rows = fleet(at)
    df = spark.createDataFrame(rows, SCHEMA)
    assert measured(vehicle_movement(df, **options), rows) == brute_force(rows)


def test_zero_time_gap_and_anomaly_rules(spark, at):
    rows = [
        ("v", "r", "t", 28.60, 77.2, at(0), 1),
        ("v", "r", "t", 28.61, 77.2, at(0), 2),    # no time passed: no speed, no anomaly
        ("v", "q", "t", 28.62, 77.2, at(10), 3),   # far too fast, and on another route
        ("v", "r", "t", 28.62, 77.2, at(310), 4),  # exactly five minutes: kept
        ("v", None, "t", 28.9, 77.2, at(320), 5),  # no route: not even a predecessor
        ("v", "r", "t", 28.62, 77.2, at(330), 6),
        ("v", "r", "t", 28.62, 77.2, at(631), 7),  # a second too late
    ]
    got = {r.kafka: r for r in vehicle_movement(
        spark.createDataFrame(rows, SCHEMA)
    ).withColumn("kafka", F.unix_seconds("vehicle_timestamp") - int(at(0).timestamp())).collect()}
    assert set(got) == {0, 10, 310, 330}
    assert got[0].time_difference_minutes is None and got[0].speed_kmh is None
    assert got[0].is_speed_anomaly is False and got[0].distance_km > 1
    assert got[10].is_speed_anomaly is True and got[10].speed_kmh is None
    assert got[310].time_difference_minutes == 5.0 and got[310].speed_kmh == 0
    assert got[330].distance_km == 0


def test_one_instant_holding_most_rows_is_cut(spark, at):
    """A burst of copies at one instant is split by the tie breaker and loses nothing."""
    rows = [("v", "r", "t", 28.6 + n / 1e4, 77.2, at(0), n) for n in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = vehicle_movement(df, count_slices=True, hot_rows=20)
    assert got.count() == 399
    step = got.agg(F.min("distance_km"), F.max("distance_km")).first()
    assert step[0] == pytest.approx(step[1], rel=1e-6)


def test_movement_profile_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tuple(movement_profile(vehicle_movement(empty)).first()) == (0, 0, None, None)


def test_plan_has_one_shuffle_and_prunes_columns(spark, at, tmp_path):
    path = str(tmp_path / "silver")
    df = spark.createDataFrame(fleet(at, 50), SCHEMA).withColumn("unused", F.lit("x"))
    df.write.parquet(path)
    plan = vehicle_movement(spark.read.parquet(path), count_slices=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "unused" not in plan


def test_hand_over_stores(spark):
    from waybill import session

    df = spark.range(10).withColumn("x", F.col("id") * 2)
    stored = session.hand_over(df)
    assert stored.inputFiles() and stored.dtypes == df.dtypes
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))


def test_antipodes_have_a_distance(spark):
    from waybill.functions.geo import haversine_km

    points = spark.range(2001).select((F.col("id") * 0.09 - 90).alias("a"), (F.col("id") * 0.0801).alias("o"))
    km = points.select(haversine_km(F.col("a"), F.col("o"), -F.col("a"), F.col("o") + 180).alias("km"))
    assert km.filter(F.isnan("km") | (F.abs(F.col("km") - 20015.0868) > 0.01)).count() == 0


def test_scratch_stays_below_the_configured_folder(spark):
    from waybill.session import scratch_path, shared_dir

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert one != two and one.startswith(shared_dir(spark))
