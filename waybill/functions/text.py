"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_blank(text: Column) -> Column:
    """True for empty text and text of white space only, tabs and Unicode spaces included."""
    return text.rlike(r"(?U)^\s*$")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def decimal_text(value: Column, decimals: int) -> Column:
    """Shortest plain text of a number with at most ``decimals`` places, at least one."""
    fixed = value.cast(f"decimal({12 + decimals},{decimals})").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0*$", "$1")


def status_label(status: Column, missing: str = "UNKNOWN") -> Column:
    """``HIGH_ACTIVITY`` to ``High Activity``; null or empty gets the ``missing`` label."""
    words = F.initcap(F.translate(F.lower(status), "_", " "))
    return F.when(status != "", words).otherwise(F.lit(missing))
