"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The row with the greatest ``order`` per key, whole.

    ``order`` must tell the rows of a key apart. The rank filter is pushed below the
    shuffle, so each input partition sends at most one row per key and a key that owns
    a large share of the table is reduced before it moves.
    """
    newest_first = [F.desc(column) if isinstance(column, str) else column.desc() for column in order]
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", ranked).filter(F.col("_rank") == 1).drop("_rank")


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows of a total order; each task keeps ``n`` rows, nothing is fully sorted."""
    return df.orderBy(*order).limit(n)
