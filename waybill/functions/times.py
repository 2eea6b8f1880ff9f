"""Time conversions; every timestamp is UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SNAPSHOT_NAME = r"vehicle_positions_(\d{8})_(\d{6})\.bin"  # fixed file name pattern
SNAPSHOT_NAME_TIME = "yyyyMMdd_HHmmss"
MICROS_PER_MINUTE = 60_000_000


def parse_iso(text: Column) -> Column:
    """ISO text to a timestamp; anything else becomes null instead of failing the query."""
    return F.try_to_timestamp(text)


def iso_text(ts: Column) -> Column:
    """ISO-8601 text in UTC, microseconds only where there are any."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(seconds, F.when(fraction == ".000000", "").otherwise(fraction), F.lit("+00:00"))


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def elapsed_micros(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def elapsed_minutes(later: Column, earlier: Column) -> Column:
    return elapsed_micros(later, earlier) / F.lit(1e6) / 60


def date_parts(ts: Column) -> list[Column]:
    """year, month, day as the zero-padded text a YYYY/MM/DD folder layout uses."""
    return [
        F.date_format(ts, "yyyy").alias("year"),
        F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"),
    ]


def filename_timestamp(path: Column) -> Column:
    """Poll time carried by a snapshot's file name; other names are an error."""
    name = F.element_at(F.split(path, "/"), -1)
    stamp = F.concat_ws(
        "_", F.regexp_extract(name, SNAPSHOT_NAME, 1), F.regexp_extract(name, SNAPSHOT_NAME, 2)
    )
    return F.when(
        name.rlike(SNAPSHOT_NAME), F.to_timestamp(stamp, SNAPSHOT_NAME_TIME)
    ).when(
        name.isNotNull(), F.raise_error(F.concat(F.lit("Invalid snapshot file name: "), name)).cast("timestamp")
    )
