"""Derived tables over silver positions and movement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from waybill.functions.geo import grid
from waybill.functions.text import base_name, decimal_text
from waybill.functions.times import filename_timestamp, floor_hour
from waybill.operators.latest import latest_by, top_n
from waybill.operators.median import exact_median
from waybill.operators.movement import movement_metrics, movement_profile
from waybill.operators.silver import historical_silver
from waybill.session import hand_over


def _order_of(df: DataFrame, tie: list[str]) -> list[str]:
    """Event time, then the tie breakers the table has, then the rest for a total order."""
    first = ["vehicle_timestamp", *(name for name in tie if name in df.columns)]
    return [*first, *(name for name in df.columns if name not in (*first, "vehicle_id"))]


ARRIVAL = ["kafka_offset", "ingestion_timestamp", "source_file"]


# -- routes ---------------------------------------------------------------------------

def route_vehicle_summary(positions: DataFrame) -> DataFrame:
    """Vehicles and trips per route, every vehicle counted on the route it was last seen on."""
    placed = positions.dropna(
        subset=["vehicle_id", "route_id", "latitude", "longitude", "vehicle_timestamp"]
    )
    names = [c for c in ("vehicle_id", "route_id", "trip_id", "vehicle_timestamp", *ARRIVAL) if c in placed.columns]
    placed = placed.select(*names)
    return (
        latest_by(placed, ["vehicle_id"], _order_of(placed, ARRIVAL))
        .groupBy("route_id")
        .agg(
            # one row per vehicle is left, so counting rows counts distinct vehicles
            F.count("vehicle_id").alias("active_vehicles"),
            F.count_distinct("trip_id").alias("unique_trips"),
        )
    )


def busiest_routes(summary: DataFrame, n: int = 10) -> DataFrame:
    return top_n(summary, n, F.desc("active_vehicles"), F.asc("route_id"))


def summary_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.coalesce(F.sum("active_vehicles"), F.lit(0)).alias("total_active_vehicles"),
        F.count(F.lit(1)).alias("total_routes"),
    )


def route_performance(
    movement: DataFrame, min_records: int = 5, max_speed_kmh: float = 120,
    median_by_rank: bool = True,
) -> DataFrame:
    """Speed statistics per route with at least ``min_records`` rows that have a speed.

    Vehicles are counted over all rows of the route. The median comes from ``exact_median``,
    which reads ``movement`` twice more, so store it first. Without ``median_by_rank`` it is the
    built-in one, which buffers all speeds of a route; the results are the same.
    """
    routed = movement.filter(F.col("route_id").isNotNull())
    statistics = [
        F.count("speed_kmh").alias("movement_records"),
        F.sum(F.when(F.col("speed_kmh").isNotNull(), F.col("distance_km"))).alias("total_distance_km"),
        F.avg("speed_kmh").alias("average_speed_kmh"),
        F.min("speed_kmh").alias("minimum_speed_kmh"),
        F.max("speed_kmh").alias("maximum_speed_kmh"),
    ]
    if not median_by_rank:
        statistics.append(F.median("speed_kmh").alias("median_speed_kmh"))
    # Vehicle and route first: a busy route is spread over its vehicles, and what is left
    # for the route itself is one row per vehicle.
    performance = routed.groupBy("route_id").agg(
        *statistics, F.count_distinct("vehicle_id").alias("active_vehicles")
    ).filter(F.col("movement_records") >= min_records)
    if median_by_rank:
        median = exact_median(routed, ["route_id"], "speed_kmh", 0.0, max_speed_kmh, "median_speed_kmh")
        performance = performance.join(median, "route_id")
    return performance.select(
        "route_id", "movement_records", "total_distance_km", "average_speed_kmh",
        "median_speed_kmh", "minimum_speed_kmh", "maximum_speed_kmh", "active_vehicles",
    )


def slowest_routes(performance: DataFrame, n: int = 10) -> DataFrame:
    return top_n(performance, n, F.asc("average_speed_kmh"), F.asc("route_id"))


def fastest_routes(performance: DataFrame, n: int = 10) -> DataFrame:
    return top_n(performance, n, F.desc("average_speed_kmh"), F.asc("route_id"))


def route_registry(silver: DataFrame) -> DataFrame:
    """First and last sighting, vehicles and trips of every route."""
    return silver.filter(F.col("route_id").isNotNull()).groupBy("route_id").agg(
        F.min("vehicle_timestamp").alias("first_seen_at"),
        F.max("vehicle_timestamp").alias("last_seen_at"),
        F.count_distinct("vehicle_id").alias("active_vehicle_count"),
        F.count_distinct("trip_id").alias("active_trip_count"),
    )


# -- time -----------------------------------------------------------------------------

def hourly_vehicle_activity(silver: DataFrame) -> DataFrame:
    return (
        silver.dropna(subset=["vehicle_timestamp", "vehicle_id"])
        .groupBy(floor_hour(F.col("vehicle_timestamp")).alias("hour"))
        .agg(
            F.count_distinct("vehicle_id").alias("active_vehicles"),
            F.count_distinct("route_id").alias("active_routes"),
            F.count(F.lit(1)).alias("total_records"),
        )
    )


def hourly_comparison(hourly: DataFrame, days: int = 1) -> DataFrame:
    """Each hour beside the same hour ``days`` earlier; null where that hour is missing."""
    second = F.unix_seconds("hour")
    same_hour = (
        Window.partitionBy(F.pmod(second, F.lit(86_400))).orderBy(second)
        .rangeBetween(-86_400 * days, -86_400 * days)
    )
    previous = F.max("active_vehicles").over(same_hour)
    return hourly.select("hour", "active_vehicles", previous.alias("previous_active_vehicles")).withColumn(
        "difference", F.col("active_vehicles") - F.col("previous_active_vehicles")
    )


def snapshot_metrics(decoded: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """Per snapshot: newest event time, poll time from the name, vehicles, routes, rows.

    Empty ids are not counted. Give the snapshot listing to keep files without positions,
    as rows of zeros.
    """
    named = decoded.withColumns({
        "_vehicle": F.nullif("vehicle_id", F.lit("")),
        "_route": F.nullif("route_id", F.lit("")),
    })
    metrics = named.groupBy("source_file").agg(
        F.max("vehicle_timestamp").alias("snapshot_time"),
        F.count_distinct("_vehicle").alias("active_vehicles"),
        F.count_distinct("_route").alias("active_routes"),
        F.count(F.lit(1)).alias("total_records"),
    )
    if snapshots is not None:
        files = snapshots.select(base_name(F.col("path")).alias("source_file")).distinct()
        metrics = files.join(metrics, "source_file", "left").na.fill(0)
    return (
        metrics.withColumn("ingestion_timestamp", filename_timestamp(F.col("source_file")))
        .select("snapshot_time", "ingestion_timestamp", "source_file", "active_vehicles",
                "active_routes", "total_records")
    )


# -- space ----------------------------------------------------------------------------

def inferred_stops(silver: DataFrame, decimals: int = 3, min_observations: int = 10) -> DataFrame:
    """Grid cells with enough sightings, as inferred mobility points."""
    stop_id = F.concat(
        F.lit("INF_"), decimal_text(F.col("latitude"), decimals),
        F.lit("_"), decimal_text(F.col("longitude"), decimals),
    )
    return (
        silver.dropna(subset=["latitude", "longitude", "vehicle_timestamp"])
        .groupBy(
            grid(F.col("latitude"), decimals).alias("latitude"),
            grid(F.col("longitude"), decimals).alias("longitude"),
        )
        .agg(
            F.count("vehicle_id").alias("observation_count"),
            F.min("vehicle_timestamp").alias("first_seen_at"),
            F.max("vehicle_timestamp").alias("last_seen_at"),
        )
        .filter(F.col("observation_count") >= min_observations)
        .withColumn("stop_id", stop_id)
        .select(
            "stop_id",
            F.concat(F.lit("Inferred Mobility Point "), "stop_id").alias("stop_name"),
            "latitude", "longitude",
            F.lit(0).alias("location_type"),
            F.lit("realtime_inferred").alias("source"),
            "observation_count", "first_seen_at", "last_seen_at",
        )
    )


# -- profiles -------------------------------------------------------------------------

def silver_profile(decoded: DataFrame, silver: DataFrame) -> DataFrame:
    """Row counts before and after cleaning, distinct vehicles and routes, time range."""
    raw = decoded.agg(F.count(F.lit(1)).alias("raw_records"))
    clean = silver.agg(
        F.count(F.lit(1)).alias("clean_records"),
        F.count_distinct("vehicle_id").alias("unique_vehicles"),
        F.count_distinct("route_id").alias("unique_routes"),
        F.min("vehicle_timestamp").alias("first_time"),
        F.max("vehicle_timestamp").alias("last_time"),
    )
    both = raw.unionByName(clean, allowMissingColumns=True)
    return both.agg(*(F.max(name).alias(name) for name in both.columns))


def silver_with_profile(decoded: DataFrame, path: str, clean=historical_silver) -> DataFrame:
    """Writes cleaned positions below ``path``; their ``silver_profile``, gathered while they are written.

    The input is read once, to store it. Counts and times are metrics observed by the tasks that write: those run
    in a job's last stage, of which no task counts twice when executors are lost. Distinct counts come from two
    columns of what was written.
    """
    raw, kept = Observation(), Observation()
    rows = clean(hand_over(decoded.observe(raw, F.count(F.lit(1)).alias("records"))))
    rows.observe(
        kept, F.count(F.lit(1)).alias("records"), F.min("vehicle_timestamp").alias("first"), F.max("vehicle_timestamp").alias("last"),
    ).write.mode("overwrite").parquet(path)
    spark, seen = decoded.sparkSession, kept.get
    stored = spark.read.schema(rows.schema).parquet(path)
    values = [(raw.get["records"], seen["records"], seen["first"], seen["last"])]
    known = spark.createDataFrame(values, "raw_records long, clean_records long, first_time timestamp, last_time timestamp")
    distinct = stored.agg(F.count_distinct("vehicle_id").alias("unique_vehicles"), F.count_distinct("route_id").alias("unique_routes"))
    return known.crossJoin(distinct).select(  # one row each
        "raw_records", "clean_records", "unique_vehicles", "unique_routes", "first_time", "last_time")


def movement_with_profile(movement: DataFrame, path: str) -> DataFrame:
    """Writes a movement table below ``path``; its ``movement_profile``, gathered while it is written."""
    seen = Observation()
    movement.observe(seen, *movement_metrics()).write.mode("overwrite").parquet(path)
    schema = movement_profile(movement).schema
    return movement.sparkSession.createDataFrame([tuple(seen.get[n] for n in schema.fieldNames())], schema)


# -- unusual activity -----------------------------------------------------------------

def activity_status(deviation: Column, high: float, low: float) -> Column:
    return F.when(deviation >= high, "HIGH_ACTIVITY").when(deviation <= low, "LOW_ACTIVITY").otherwise("NORMAL")


def route_activity_anomalies(silver: DataFrame, high: float = 50, low: float = -50) -> DataFrame:
    """Vehicles per route and hour against the route's mean over its observed hours.

    The window by route runs over one row per route and hour, not over positions.
    """
    active = (
        silver.dropna(subset=["vehicle_id", "route_id", "vehicle_timestamp"])
        .groupBy("route_id", floor_hour(F.col("vehicle_timestamp")).alias("hour"))
        .agg(F.count_distinct("vehicle_id").alias("active_vehicles"))
    )
    mean = F.avg("active_vehicles").over(Window.partitionBy("route_id"))
    deviation = F.lit(100) * (F.col("active_vehicles") - F.col("avg_active_vehicles")) / F.col("avg_active_vehicles")
    return (
        active.withColumn("avg_active_vehicles", mean)
        .withColumn("deviation_percent", deviation)
        .withColumn("anomaly_status", activity_status(F.col("deviation_percent"), high, low))
    )


def mobility_alerts(anomalies: DataFrame) -> DataFrame:
    """Unusual route hours as alerts, numbered by hour and route.

    The number is the count of alerts in earlier hours plus the rank within the hour, so
    only one row per hour meets in a single task.
    """
    unusual = anomalies.filter(F.col("anomaly_status") != "NORMAL")
    per_hour = unusual.groupBy("hour").agg(F.count(F.lit(1)).alias("_alerts"))
    earlier = F.sum("_alerts").over(Window.orderBy("hour")) - F.col("_alerts")
    rank = F.row_number().over(Window.partitionBy("hour").orderBy("route_id"))
    message = F.format_string(
        "Route %s: %s at %s (%d vehicles)",
        "route_id", "anomaly_status", F.date_format("hour", "yyyy-MM-dd HH:mm"), "active_vehicles",
    )
    return unusual.join(per_hour.select("hour", earlier.alias("_earlier")), "hour").select(
        (F.col("_earlier") + rank).alias("alert_id"),
        "route_id",
        F.col("hour").alias("alert_time"),
        F.col("anomaly_status").alias("alert_type"),
        "deviation_percent",
        message.alias("message"),
    )


def top_anomalies(anomalies: DataFrame, n: int = 20) -> DataFrame:
    return top_n(
        anomalies.filter(F.col("anomaly_status") != "NORMAL"),
        n, F.abs("deviation_percent").desc(), F.asc("hour"), F.asc("route_id"),
    )


def recent_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    return top_n(alerts, n, F.desc("alert_id"))
