"""The previous observation of the same key, for time lines of any shape.

A plain ``lag`` over a window by key puts the whole history of a key into one task. Here
only a predecessor at most ``reach`` earlier counts, so a key's time line can be cut into
slices that are processed apart: the rows in the last ``reach`` of a slice are sent to the
next slice as well, where they serve as predecessors and are dropped again. One shuffle,
and its unit is one key in one slice instead of one key.

A slice that is still too large for a task (blank ids, a burst of copies) is found by
counting, and such slices alone are range-partitioned on the full sort order, which splits
anything down to single instants; the row before each cut is then handed over the seam.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from waybill.session import hand_over

HOT_SLICE_ROWS = 2_000_000
MAX_BROADCAST_SLICES = 500_000


def with_previous(
    df: DataFrame,
    key: str,
    time: str,
    tie: list[str],
    values: list[str],
    reach_minutes: float,
    slice_minutes: float | None = None,
    hot_rows: int = HOT_SLICE_ROWS,
    count_slices: bool = True,
) -> DataFrame:
    """Rows that have a predecessor within reach, plus struct ``previous(values, time)``.

    The predecessor of a row is the row of the same ``key`` just before it in the order
    ``(time, *tie)``; rows whose predecessor lies more than ``reach_minutes`` back, and
    first rows, are left out. ``key`` and ``time`` must not be null.

    The search for oversized slices reads ``df`` once more for its key and time; without
    ``count_slices`` the caller vouches that none is too large for a task.
    """
    reach = round(reach_minutes * 60_000_000)
    width = round((slice_minutes or 6 * reach_minutes) * 60_000_000)
    if width < reach:
        raise ValueError("a slice must not be shorter than the reach")

    placed = _place_in_slices(df, time, reach, width)
    unit = [key, "_slice"]
    order = [time, *tie]
    hot = _hot_slices(placed, unit, hot_rows) if count_slices else None

    if hot is None:
        followed = _follow(placed, unit, order, values)
    else:
        slices, hot_slices, total = hot
        slices = F.broadcast(slices) if hot_slices <= MAX_BROADCAST_SLICES else slices
        cool = placed.join(slices, unit, "left_anti")
        busy = placed.join(slices, unit, "left_semi")
        parts = math.ceil(total / hot_rows) + 1
        followed = _follow(cool, unit, order, values).unionByName(
            _follow_across_cuts(busy, unit, order, values, parts)
        )
    gap = F.unix_micros(time) - F.unix_micros(f"previous.{time}")
    return followed.filter(~F.col("_borrowed") & (gap <= reach)).drop("_slice", "_borrowed")


def _place_in_slices(df: DataFrame, time: str, reach: int, width: int) -> DataFrame:
    micros = F.unix_micros(time)
    into = F.pmod(micros, F.lit(width))
    start = micros - into
    own = F.struct(start.alias("_slice"), F.lit(False).alias("_borrowed"))
    lent = F.struct((start + F.lit(width)).alias("_slice"), F.lit(True).alias("_borrowed"))
    places = F.when(into >= width - reach, F.array(own, lent)).otherwise(F.array(own))
    return df.select("*", F.inline(places))


def _follow(placed: DataFrame, unit: list[str], order: list[str], values: list[str]) -> DataFrame:
    line = Window.partitionBy(*unit).orderBy(*order)
    # lags of single columns, put together after the shuffle: nothing travels twice
    lags = {f"_before_{name}": F.lag(name).over(line) for name in _carried(values, order)}
    previous = F.struct(*(F.col(f"_before_{name}").alias(name) for name in _carried(values, order)))
    return placed.withColumns(lags).withColumn("previous", previous).drop(*lags)


def _carried(values: list[str], order: list[str]) -> list[str]:
    return list(dict.fromkeys([*values, order[0]]))


def _hot_slices(placed: DataFrame, unit: list[str], hot_rows: int):
    """Oversized slices, how many there are and how many rows they hold; None if there are none.

    At most ``rows / hot_rows`` slices can qualify, so the list stays short.
    """
    sizes = placed.groupBy(*unit).agg(F.count(F.lit(1)).alias("_rows"))
    hot = hand_over(sizes.filter(F.col("_rows") > hot_rows))
    hot_slices, total = hot.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    return (hot.select(*unit), hot_slices, total) if hot_slices else None


def _follow_across_cuts(
    busy: DataFrame, unit: list[str], order: list[str], values: list[str], parts: int
) -> DataFrame:
    """``_follow`` with the rows cut into ``parts`` ranges of the full sort order.

    The rows are stored before the cut, which draws its points from a sample, and after it,
    as the points must not be drawn again by a second reader. Rows equal in all of ``sort``
    can't be parted: they are one row as far as the order goes.
    """
    sort = [*unit, *order]
    cut = hand_over(
        hand_over(busy).repartitionByRange(parts, *sort).withColumn("_part", F.spark_partition_id())
    )
    carried = F.struct(*unit, *_carried(values, order))
    inside = Window.partitionBy("_part").orderBy(*sort)
    # one row per part: at most ``parts`` rows meet in the window over all parts
    last_rows = cut.groupBy("_part").agg(F.max_by(carried, F.struct(*sort)).alias("_last"))
    seams = last_rows.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_seam"))
    found = (
        cut.withColumn("_before", F.lag(carried).over(inside))
        .join(F.broadcast(seams), "_part", "left")
        .withColumn("_before", F.coalesce("_before", "_seam"))
    )
    same_unit = F.lit(True)
    for name in unit:
        same_unit = same_unit & (F.col(f"_before.{name}") == F.col(name))
    previous = F.struct(*(F.col(f"_before.{name}") for name in _carried(values, order)))
    return found.withColumn("previous", F.when(same_unit, previous)).drop("_part", "_before", "_seam")
