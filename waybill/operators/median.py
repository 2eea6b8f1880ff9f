"""Exact median per group without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from waybill.session import hand_over

BINS = 1024  # bins per level; two levels are about a million bins over the value range
CROWDED = 1_000_000  # rows in a target bin beyond which the bin is divided again


def exact_median(
    df: DataFrame, keys: list[str], value: str, low: float, high: float,
    alias: str = "median", bins: int = BINS, crowded: int = CROWDED,
) -> DataFrame:
    """Exact median of the non-null ``value`` per ``keys``; groups without a value have no row.

    The built-in aggregate keeps every distinct value of a group in one buffer. Here the two
    middle ranks are closed in on. Values are counted once per fine bin of ``[low, high]``;
    coarse bins are sums of those counts. The at most two fine bins of a group that hold the
    middle are divided again while more than ``crowded`` distinct values crowd in one, and
    then the values in them are ranked, equal values counted first. Counting combines before
    the shuffle; a window sees at most ``bins`` counts of a group, and at the end at most
    ``crowded`` distinct values. Values outside the range fall into the edge bins; the bounds
    affect balance, not the result. ``df`` is read twice, and once more per extra division.
    """
    fine_bins = bins * bins
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_value"))
    position = F.floor((F.col("_value") - low) / F.lit((high - low) / fine_bins))
    rows = rows.withColumn("_bin", F.least(F.greatest(position, F.lit(0)), F.lit(fine_bins - 1)))

    fine = rows.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_rows"))  # its shuffle serves both readers
    group = Window.partitionBy(*keys)
    coarse = fine.groupBy(*keys, F.expr(f"_bin div {bins}").alias("_coarse")).agg(F.sum("_rows").alias("_rows"))
    coarse = coarse.withColumn("_total", F.sum("_rows").over(group)).select(
        *keys, "_coarse", "_rows", F.lit(0).cast("long").alias("_before"),
        F.expr("(_total - 1) div 2").alias("_lower"), F.expr("_total div 2").alias("_upper"),
    )
    middle = _around_the_middle(coarse, keys, [], "_coarse").drop("_upto")
    inner = fine.withColumn("_coarse", F.expr(f"_bin div {bins}")).join(middle, [*keys, "_coarse"])
    targets = _around_the_middle(inner, keys, ["_coarse"], "_bin").drop("_upto")

    # the values in the target bins counted, stored
    counts = hand_over(_values_in(rows, targets, keys))
    while (largest := _most_distinct(counts, keys)) > crowded:
        narrowed = _divided(counts, keys, bins)
        counts, before = hand_over(narrowed), largest
        if _most_distinct(counts, keys) == before:
            break  # as fine as doubles are
    targets = _around_the_middle(counts, keys, ["_bin"], "_value")

    def at(rank: str):
        here = (F.col("_before") <= F.col(rank)) & (F.col(rank) < F.col("_upto"))
        return F.max(F.when(here, F.col("_value")))

    return targets.groupBy(*keys).agg(((at("_lower") + at("_upper")) / 2).alias(alias))


def _values_in(rows: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(targets, [*keys, "_bin"]).groupBy(*keys, "_bin", "_before", "_lower", "_upper", "_value").agg(
        F.count(F.lit(1)).alias("_rows"))


def _most_distinct(counts: DataFrame, keys: list[str]) -> int:
    return counts.groupBy(*keys, "_bin").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]


def _divided(counts: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """Counted values with every target bin replaced by its parts that hold a middle rank.

    A part is a share of the range between the bin's least and greatest value.
    """
    unit = [*keys, "_bin"]
    ends = counts.groupBy(*unit).agg(F.min("_value").alias("_least"), F.max("_value").alias("_most"))
    width = (F.col("_most") - F.col("_least")) / bins
    part = F.when(width > 0, F.least(F.floor((F.col("_value") - F.col("_least")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    placed = hand_over(counts.join(ends, unit).withColumn("_part", part).drop("_least", "_most"))
    sums = placed.groupBy(*unit, "_before", "_lower", "_upper", "_part").agg(F.sum("_rows").alias("_rows"))
    middle = _around_the_middle(sums, keys, ["_bin"], "_part", keep=["_bin"]).drop("_upto")
    kept = placed.drop("_before", "_lower", "_upper").join(middle, [*unit, "_part"])
    return kept.withColumn("_bin", F.col("_bin") * bins + F.col("_part")).drop("_part")


def _around_the_middle(
    counts: DataFrame, keys: list[str], outer: list[str], inner: str, keep: list[str] = ()
) -> DataFrame:
    """The ``inner`` entries that hold a middle rank, with the ranks before and after each."""
    upto = F.col("_before") + F.sum("_rows").over(Window.partitionBy(*keys, *outer).orderBy(inner))
    return (
        counts.withColumn("_upto", upto)
        .withColumn("_before", F.col("_upto") - F.col("_rows"))
        .filter((F.col("_upto") > F.col("_lower")) & (F.col("_before") <= F.col("_upper")))
        .select(*keys, *keep, inner, "_before", "_upto", "_lower", "_upper")
    )
