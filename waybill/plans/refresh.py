"""The periodic refresh of the serving tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from waybill.operators.merge import OVERWRITE, keyed_merge
from waybill.operators.quality import all_checks_passed
from waybill.plans.monitoring import not_empty_check, run_record, table_health, validate_route_ids
from waybill.plans.serving import latest_positions, route_activity_summary
from waybill.schemas import ROUTE_SUMMARY
from waybill.sources.sinks import append_metrics, read_merged, write_merged


def refresh(
    events: DataFrame, root: str, now: datetime | None = None, latest: DataFrame | None = None
) -> DataFrame:
    """Bring the route summary below ``root`` up to date and record the run.

    Steps: summary of the stored ``latest`` positions merged over the stored summary, checks on
    it, freshness and observability of the event table in one pass over three of its columns,
    run record. Without ``latest`` the positions are found in all events. Stale data is
    reported, not an error; an empty summary or a blank route id stops the run after recording
    it.
    """
    start = datetime.now(timezone.utc)
    spark = events.sparkSession
    now = now or start
    summary_path = f"{root}/route_activity_summary"

    current = latest if latest is not None else latest_positions(events)
    updates = route_activity_summary(current, now)
    stored = read_merged(spark, summary_path, ROUTE_SUMMARY)
    version = write_merged(keyed_merge(stored, updates, ["route_id"], OVERWRITE), summary_path)
    summary = read_merged(spark, summary_path, ROUTE_SUMMARY, before=version + 1)

    filled = not_empty_check(summary, "route_activity_summary").select(
        F.lit("route_activity_summary_not_empty").alias("check_name"),
        "passed",
        F.lit(0).cast("bigint").alias("failed_count"),
        F.when(~F.col("passed"), "table is empty").otherwise("").alias("message"),
    )
    results = validate_route_ids(summary).unionByName(filled)
    passed = all_checks_passed(results)
    observed, fresh = table_health(events, "vehicle_positions", now)
    run = now.isoformat()  # a run that is repeated for its moment replaces its rows
    append_metrics(fresh, f"{root}/freshness", run)
    append_metrics(observed, f"{root}/data_quality_metrics", run)
    end = datetime.now(timezone.utc)
    append_metrics(run_record("route_activity_refresh", start, end, summary, passed), f"{root}/runs", run)
    if not passed:
        raise RuntimeError("route_activity_summary is empty or holds blank route ids")
    return summary
