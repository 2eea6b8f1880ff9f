"""Table health: emptiness, freshness, observability, run records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from waybill.functions.times import elapsed_minutes
from waybill.operators.quality import not_empty, run_checks
from waybill.session import hand_over


def not_empty_check(df: DataFrame, name: str) -> DataFrame:
    rows = F.count(F.lit(1))
    return df.agg(
        F.lit(name).alias("table_name"), rows.alias("row_count"), (rows > 0).alias("passed")
    )


def freshness(df: DataFrame, now: datetime | Column, max_age_minutes: float = 10) -> DataFrame:
    """Age of the newest arrival: ``fresh``, ``stale`` or ``no_data``; none is an error."""
    newest = df.agg(F.max("ingestion_timestamp").alias("latest_ingestion_timestamp"))
    return _aged(newest, now, max_age_minutes)


def _aged(newest: DataFrame, now: datetime | Column, max_age_minutes: float) -> DataFrame:
    at = (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")
    age = elapsed_minutes(at, F.col("latest_ingestion_timestamp"))
    return (
        newest.withColumn("age_minutes", age)
        .withColumn(
            "status",
            F.when(F.col("age_minutes").isNull(), "no_data")
            .when(F.col("age_minutes") > max_age_minutes, "stale")
            .otherwise("fresh"),
        )
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row; missing values are keys like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def table_observability(df: DataFrame, table_name: str) -> DataFrame:
    """Rows, rows without id or arrival time, and repeated (id, event time) pairs, in one pass."""
    return _observed(df, table_name).drop("latest_ingestion_timestamp")


def _observed(df: DataFrame, table_name: str) -> DataFrame:
    missing = F.col("vehicle_id").isNull() | F.col("ingestion_timestamp").isNull()
    pairs = df.groupBy("vehicle_id", "vehicle_timestamp").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(missing).alias("_missing"),
        F.max("ingestion_timestamp").alias("_newest"),
    )
    return pairs.agg(
        F.lit(table_name).alias("table_name"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("_missing"), F.lit(0)).alias("null_count"),
        F.count_if(F.col("_rows") > 1).alias("duplicate_count"),
        F.max("_newest").alias("latest_ingestion_timestamp"),
    )


def table_health(
    df: DataFrame, table_name: str, now: datetime | Column, max_age_minutes: float = 10
) -> tuple[DataFrame, DataFrame]:
    """(observability, freshness) of a table from one pass over three of its columns."""
    observed = hand_over(_observed(df, table_name))  # one row
    newest = observed.select("latest_ingestion_timestamp")
    return observed.drop("latest_ingestion_timestamp"), _aged(newest, now, max_age_minutes)


def validate_route_ids(summary: DataFrame) -> DataFrame:
    """The not-empty rule over every route id of the summary."""
    return run_checks(summary, [not_empty("route_id", name="route_id_not_empty")])


def run_record(
    name: str, start: datetime, end: datetime, processed: DataFrame, passed: bool
) -> DataFrame:
    """One monitoring row for a finished run; its status follows from the check results."""
    return processed.agg(F.count(F.lit(1)).alias("records_processed")).select(
        F.lit(name).alias("pipeline_name"),
        F.lit("SUCCESS" if passed else "FAILED").alias("status"),
        F.lit(start).cast("timestamp").alias("start_time"),
        F.lit(end).cast("timestamp").alias("end_time"),
        F.lit((end - start).total_seconds()).alias("duration_seconds"),
        "records_processed",
        F.lit("PASSED" if passed else "FAILED").alias("data_quality_status"),
    )
