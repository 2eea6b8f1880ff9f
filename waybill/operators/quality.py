"""Rules over a table, all evaluated in one aggregation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from waybill.functions.text import is_blank

RESULT_SCHEMA = "check_name string, passed boolean, failed_count bigint, message string"


@dataclass(frozen=True)
class Rule:
    """A named rule: ``breaches(df)`` gives (condition, message) pairs, the first that holds counts.

    A rule about the table itself returns a message, or None if it holds, from ``table``.
    """

    name: str
    breaches: Callable[[DataFrame], list[tuple[Column, str]]] | None = None
    table: Callable[[DataFrame], str | None] | None = None


def not_empty(column: str, name: str | None = None) -> Rule:
    """Null, empty or white-space-only values break the rule."""
    def breaches(df: DataFrame):
        value = df[column]
        found = [(value.isNull(), f"{column} is null")]
        if dict(df.dtypes)[column] == "string":
            found.append((is_blank(value), f"{column} is empty"))
        return found

    return Rule(name or f"{column}_not_empty", breaches)


def non_negative(column: str, name: str | None = None) -> Rule:
    def breaches(df: DataFrame):
        value = _numeric(df, column)
        return [(value.isNull(), f"{column} is null"), (value < 0, f"{column} must be non-negative")]

    return Rule(name or f"{column}_non_negative", breaches)


def in_range(column: str, minimum: float, maximum: float, name: str | None = None) -> Rule:
    def breaches(df: DataFrame):
        value = _numeric(df, column)
        return [
            (value.isNull(), f"{column} is null"),
            (~value.between(minimum, maximum), f"{column} must be between {minimum} and {maximum}"),
        ]

    return Rule(name or f"{column}_in_range", breaches)


def required_columns(names: list[str], name: str = "required_columns") -> Rule:
    """Tests the schema, runs no job."""
    def table(df: DataFrame):
        missing = [column for column in names if column not in df.columns]
        return f"Missing columns: {', '.join(missing)}" if missing else None

    return Rule(name, table=table)


def _numeric(df: DataFrame, column: str) -> Column:
    if not isinstance(df.schema[column].dataType, NumericType):
        raise TypeError(f"{column} is not numeric")
    return df[column]


def run_checks(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One result row per rule: name, verdict, number of failing rows, message.

    A rule that cannot be evaluated, for want of its column for instance, is a failed
    result and does not stop the others.
    """
    counters: list[Column] = []
    results: list[Column] = []
    for position, rule in enumerate(rules):
        try:
            if rule.table is not None:
                problem = rule.table(df)
                failed, message = F.lit(0), F.lit(problem or "")
                passed = F.lit(problem is None)
            else:
                reasons = rule.breaches(df)
                first = F.coalesce(*(F.when(broken, F.lit(at)) for at, (broken, _) in enumerate(reasons)))
                names = [f"_{position}_{at}" for at in range(len(reasons))]
                counters += [F.count_if(first == at).alias(name) for at, name in enumerate(names)]
                failed = sum((F.col(name) for name in names[1:]), F.col(names[0]))
                passed = failed == 0
                message = F.coalesce(
                    *(F.when(F.col(name) > 0, F.lit(text)) for name, (_, text) in zip(names, reasons)),
                    F.lit(""),
                )
        except Exception as error:
            passed, failed = F.lit(False), F.lit(0)
            message = F.lit(f"Check execution failed: {_brief(error)}")
        results.append(F.struct(
            F.lit(rule.name).alias("check_name"),
            passed.alias("passed"),
            failed.cast("bigint").alias("failed_count"),
            message.alias("message"),
        ))
    if not results:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    counted = df.agg(*counters) if counters else df.sparkSession.range(1)
    return counted.select(F.inline(F.array(*results)))


def _brief(error: Exception) -> str:
    return str(error).splitlines()[0] if str(error) else type(error).__name__


def all_checks_passed(results: DataFrame) -> bool:
    """True if every result passed, also for no results at all; one row reaches the driver."""
    return results.agg(F.coalesce(F.bool_and("passed"), F.lit(True))).first()[0]
