"""Cleaning of decoded snapshot positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waybill import schemas


def exact_dedupe(df: DataFrame) -> DataFrame:
    """Drop equal rows. Copies collapse on the map side, so a heavily repeated row is cheap."""
    return df.dropDuplicates()


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def _time(name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def historical_silver(decoded: DataFrame) -> DataFrame:
    """Clean positions of many snapshots; empty ids stay, a copy from another file stays.

    A number or time that cannot be read counts as missing, and missing or out-of-range
    values fail the range test. The filter runs before the dedupe: it depends on the row
    alone, so the result is the same and fewer rows are shuffled.
    """
    usable = decoded.filter(
        F.col("vehicle_id").isNotNull()
        & _number("latitude").between(*schemas.LATITUDE_RANGE)
        & _number("longitude").between(*schemas.LONGITUDE_RANGE)
        & _time("vehicle_timestamp").isNotNull()
    )
    return exact_dedupe(usable).withColumns({
        "latitude": _number("latitude"),
        "longitude": _number("longitude"),
        "vehicle_timestamp": _time("vehicle_timestamp"),
        "ingestion_timestamp": _time("ingestion_timestamp"),
    })


def snapshot_silver(decoded: DataFrame) -> DataFrame:
    """Clean positions of one snapshot, without its file name."""
    return historical_silver(decoded.drop("source_file"))
