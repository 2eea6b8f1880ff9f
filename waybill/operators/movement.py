"""Movement of each vehicle between consecutive observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waybill.functions.geo import haversine_km, speed_kmh
from waybill.functions.times import elapsed_minutes
from waybill.operators.previous import HOT_SLICE_ROWS, with_previous

MOVEMENT_COLUMNS = [
    "vehicle_id", "route_id", "trip_id", "latitude", "longitude", "vehicle_timestamp",
    "distance_km", "time_difference_minutes", "speed_kmh", "is_speed_anomaly",
]
NEEDED = ["vehicle_id", "route_id", "latitude", "longitude", "vehicle_timestamp"]


def vehicle_movement(
    positions: DataFrame,
    max_gap_minutes: float = 5,
    max_speed_kmh: float = 120,
    tie: str | list[str] | None = None,
    slice_minutes: float | None = None,
    hot_rows: int = HOT_SLICE_ROWS,
    count_slices: bool | None = None,
) -> DataFrame:
    """Distance, elapsed time and speed since a vehicle's previous observation.

    Rows without a route are gone before the look back, which crosses routes. Rows more
    than ``max_gap_minutes`` after the previous one are left out. Where no time has passed
    both the elapsed time and the speed are null; a speed above ``max_speed_kmh`` is
    flagged and blanked, the row stays. ``tie`` orders observations of equal time; by
    default the topic offset or else the snapshot name, whichever the table has.
    """
    if tie is None:
        tie = [name for name in ("kafka_offset", "source_file") if name in positions.columns][:1]
    ties = [tie] if isinstance(tie, str) else list(tie)
    # the remaining columns make the order total, so that reruns agree on it
    ties = list(dict.fromkeys([*ties, "route_id", "trip_id", "latitude", "longitude"]))
    columns = dict.fromkeys([*NEEDED, "trip_id", *ties])
    steps = with_previous(
        positions.dropna(subset=NEEDED).select(*columns),
        key="vehicle_id",
        time="vehicle_timestamp",
        tie=ties,
        values=["latitude", "longitude"],
        reach_minutes=max_gap_minutes,
        slice_minutes=slice_minutes,
        hot_rows=hot_rows,
        count_slices=count_slices,
    )
    minutes = elapsed_minutes(F.col("vehicle_timestamp"), F.col("previous.vehicle_timestamp"))
    distance = haversine_km(
        F.col("previous.latitude"), F.col("previous.longitude"), F.col("latitude"), F.col("longitude")
    )
    speed = speed_kmh(F.col("distance_km"), F.col("time_difference_minutes"))
    too_fast = F.coalesce(F.col("speed_kmh") > max_speed_kmh, F.lit(False))
    return (
        steps.withColumns({
            "distance_km": distance, "time_difference_minutes": F.when(minutes > 0, minutes),
        })
        .withColumn("speed_kmh", speed)
        .withColumns({
            "is_speed_anomaly": too_fast, "speed_kmh": F.when(~too_fast, F.col("speed_kmh")),
        })
        .select(*MOVEMENT_COLUMNS)
    )


def movement_profile(movement: DataFrame) -> DataFrame:
    """Row count, anomalies, total distance and mean speed of a movement table."""
    return movement.agg(*movement_metrics())


def movement_metrics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("movement_records"),
        F.count_if("is_speed_anomaly").alias("speed_anomalies"),
        F.sum("distance_km").alias("total_distance_km"),
        F.avg("speed_kmh").alias("average_speed_kmh"),
    ]
