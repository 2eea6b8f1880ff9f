"""Keyed upsert of one table into another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OVERWRITE = "overwrite"
NOT_OLDER = "not_older"
WIDEN_TIMES = "widen_times"


def keyed_merge(
    state: DataFrame,
    updates: DataFrame,
    keys: list[str],
    policy: str = OVERWRITE,
    time: str | None = None,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """State after applying ``updates``, both with one row per key and equal columns.

    ``overwrite``    the update replaces the stored row;
    ``not_older``    only if the stored ``time`` is not later than the update's, and a
                     missing time on either side keeps the stored row;
    ``widen_times``  the update replaces the row, but ``first`` keeps the smaller and
                     ``last`` the greater of both values, nulls ignored.

    Keys that are on one side only pass through. One row per key on both sides means no
    key can be hot in this join.
    """
    updates = updates.select(*state.columns)
    values = [name for name in state.columns if name not in keys]
    old, new = state.alias("old"), updates.alias("new")
    same_key = [F.col(f"old.{key}") == F.col(f"new.{key}") for key in keys]
    joined = (
        old.withColumn("_stored", F.lit(True)).alias("old")
        .join(new.withColumn("_update", F.lit(True)).alias("new"), same_key, "full_outer")
    )
    stored, update = F.col("_stored").isNotNull(), F.col("_update").isNotNull()

    if policy in (OVERWRITE, WIDEN_TIMES):
        replace = update
    elif policy == NOT_OLDER:
        if time is None:
            raise ValueError("policy not_older needs the time column")
        not_older = F.coalesce(F.col(f"old.{time}") <= F.col(f"new.{time}"), F.lit(False))
        replace = update & (~stored | not_older)
    else:
        raise ValueError(f"unknown merge policy: {policy}")

    def merged(name: str) -> Column:
        if policy == WIDEN_TIMES and name == first:
            return F.least(f"old.{name}", f"new.{name}")
        if policy == WIDEN_TIMES and name == last:
            return F.greatest(f"old.{name}", f"new.{name}")
        return F.when(replace, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))

    return joined.select(
        *(F.coalesce(f"old.{key}", f"new.{key}").alias(key) for key in keys),
        *(merged(name).alias(name) for name in values),
    ).select(*state.columns)


def not_yet_stored(updates: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` whose key is not in ``stored``: makes a replayed append harmless."""
    return updates.join(stored.select(*keys).distinct(), keys, "left_anti")
