"""Current-state tables and the answers read from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from waybill.functions.times import iso_text
from waybill.operators.latest import latest_by, top_n
from waybill.schemas import LATEST_POSITIONS

MAX_LIMIT = 1000  # fixed bound of the serving answers


def latest_positions(events: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """One row per vehicle: newest event time, and of equal times the later arrival."""
    columns = [name for name in LATEST_POSITIONS.fieldNames() if name != "updated_at"]
    known = events.filter(
        F.col("vehicle_id").isNotNull() & F.col("vehicle_timestamp").isNotNull()
    ).select(*columns)
    newest = latest_by(
        known, ["vehicle_id"],
        ["vehicle_timestamp", "kafka_offset", *(c for c in columns if c not in ("vehicle_id", "vehicle_timestamp", "kafka_offset"))],
    )
    return newest.withColumn("updated_at", F.current_timestamp() if updated_at is None else updated_at)


def route_activity_summary(latest: DataFrame, run_time: datetime | Column) -> DataFrame:
    """Distinct vehicles and trips per route over the latest positions."""
    at = run_time if isinstance(run_time, Column) else F.lit(run_time)
    return latest.filter(F.col("route_id").isNotNull()).groupBy("route_id").agg(
        F.count_distinct("vehicle_id").alias("active_vehicle_count"),
        F.count_distinct("trip_id").alias("active_trip_count"),
        F.max("vehicle_timestamp").alias("last_observed_at"),
    ).withColumn("updated_at", at.cast("timestamp"))


def metrics_overview(latest: DataFrame) -> DataFrame:
    """One row, zeros and a null time for an empty table."""
    return latest.agg(
        F.count(F.lit(1)).alias("total_vehicles"),
        F.count_distinct("route_id").alias("active_routes"),
        F.count_distinct("trip_id").alias("active_trips"),
        F.max("vehicle_timestamp").alias("latest_vehicle_timestamp"),
    )


def _checked(limit: int) -> int:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    return limit


def vehicles_latest(latest: DataFrame, limit: int = 100) -> DataFrame:
    return top_n(
        latest.select(*LATEST_POSITIONS.fieldNames()), _checked(limit),
        F.desc("updated_at"), F.asc("vehicle_id"),
    )


def vehicles_live(latest: DataFrame) -> DataFrame:
    """All latest positions, most recently updated first."""
    return latest.orderBy(F.desc("updated_at"), F.asc("vehicle_id")).select(
        "vehicle_id", "route_id", "trip_id", "latitude", "longitude",
        "vehicle_timestamp", "ingestion_timestamp",
    )


def routes_activity(summary: DataFrame, limit: int = 100) -> DataFrame:
    return top_n(summary, _checked(limit), F.desc("active_vehicle_count"), F.asc("route_id"))


def as_answer(df: DataFrame) -> DataFrame:
    """Timestamps as ISO-8601 text, the form in which answers leave the service."""
    return df.select(*(
        iso_text(F.col(name)).alias(name) if kind == "timestamp" else F.col(name)
        for name, kind in df.dtypes
    ))
