"""Gold tables brought up to date by what is new: only partitions that new rows touch are computed again.

A gold table is stored partitioned by the values that its groups consist of (an hour, a snapshot file).
New silver rows name the partitions they belong to; those alone are read back from silver, computed again and
overwritten, partition by partition, in one committed job. All other files stay as they are.

Silver is partitioned by event date, so reading some hours back reads their days only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from waybill.functions.times import floor_hour
from waybill.plans.gold import hourly_vehicle_activity, snapshot_metrics
from waybill.session import hand_over

PART = "part"


def append_silver(rows: DataFrame, path: str) -> None:
    """New silver rows, by event date."""
    rows.withColumn("event_date", F.to_date("vehicle_timestamp")).write.mode("append").partitionBy("event_date").parquet(path)


def update_parts(
    new: DataFrame, silver: DataFrame, gold: str, part: Callable[[DataFrame], Column], compute: Callable[[DataFrame], DataFrame],
    within: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Computes the parts of ``gold`` that ``new`` rows touch from all of ``silver``; the parts, stored.

    ``part`` names the part of a row, of silver and of gold alike, as text; ``within`` may narrow silver by a
    filter that reaches its scan. A part's rows go to one file.
    """
    touched = hand_over(new.select(part(new).alias(PART)).dropna().distinct())
    rows = within(silver) if within else silver
    # stored touched parts: the semi-join is of two plain shuffles or, where they are few, a broadcast that Spark sizes
    needed = rows.withColumn(PART, part(rows)).join(touched, PART, "left_semi").drop(PART)
    fresh = compute(needed)
    fresh = fresh.withColumn(PART, part(fresh))
    (fresh.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(gold))
    return touched


def read_parts(spark: SparkSession, gold: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(gold).select(*schema.fieldNames())


def _hour(df: DataFrame) -> Column:
    hour = F.col("hour") if "hour" in df.columns else floor_hour(F.col("vehicle_timestamp"))
    return F.date_format(hour, "yyyyMMddHH")


def update_hourly_activity(new: DataFrame, silver: DataFrame, gold: str) -> DataFrame:
    """``gold.hourly_vehicle_activity`` for the hours of ``new`` rows, which ``silver`` holds already."""
    days = [r[0] for r in new.select(F.to_date("vehicle_timestamp").alias("d")).dropna().distinct().collect()]  # days of one load
    within = (lambda rows: rows.filter(F.col("event_date").isin(days))) if "event_date" in silver.columns else None
    return update_parts(new, silver, gold, _hour, hourly_vehicle_activity, within)


def update_snapshot_metrics(new: DataFrame, silver: DataFrame, gold: str) -> DataFrame:
    """``gold.snapshot_metrics`` for the snapshot files of ``new`` rows."""
    return update_parts(new, silver, gold, lambda df: F.col("source_file"), snapshot_metrics)
