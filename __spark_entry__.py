"""

The positions every query works on are derived by Spark from the whole ``events`` table
(``waybill.fixtures``); ``oracles.py`` derives the same rows in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import oracles
from waybill import fixtures, schemas
from waybill.functions.text import base_name, status_label
from waybill.functions.times import filename_timestamp
from waybill.operators import events as ev, merge, movement as mv, quality, silver as sv
from waybill.plans import gold, incremental, monitoring, refresh as rf, serving
from waybill.session import hand_over, scratch_path, use_utc
from waybill.sources import buckets, sinks, snapshots, streams, tables
from waybill.streaming import jobs

SMOKE_DIR = "/root/testdata/sf0.001"
NOW = datetime(2024, 1, 2, 8, 0, tzinfo=timezone.utc)
SPLIT = datetime(2024, 1, 1, 15, 0, tzinfo=timezone.utc)  # stored before, updates from here on
ONCE = {"availableNow": True}


# -- inputs ---------------------------------------------------------------------------

def _positions(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.positions(use_utc(spark), d)


def _silver(spark, d):
    return sv.historical_silver(_positions(spark, d))


def _movement(spark, d):
    return mv.vehicle_movement(hand_over(_silver(spark, d)))


def _performance(spark, d, **options):
    return gold.route_performance(hand_over(_movement(spark, d)), **options)


def _decoded(spark, d):
    return ev.kafka_decode(fixtures.records(use_utc(spark), d))


def _parsed(spark, d, **options):
    return ev.parse_events(_decoded(spark, d), **options)


def _events(spark, d):
    return ev.streaming_silver(_parsed(spark, d))


def _stored_events(spark, d):
    return ev.streaming_silver(fixtures.stored_events(use_utc(spark), d))


def _latest(spark, d):
    return serving.latest_positions(_stored_events(spark, d), updated_at=F.col("ingestion_timestamp"))


def _summary(spark, d):
    return serving.route_activity_summary(_latest(spark, d), NOW)


def _anomalies(spark, d):
    # the derived fleet is even, so a tenth above or below the mean counts as unusual here
    return gold.route_activity_anomalies(_silver(spark, d), high=10, low=-10)


def _before(df: DataFrame) -> DataFrame:
    return df.filter(F.col("vehicle_timestamp") < F.lit(SPLIT))


def _since(df: DataFrame) -> DataFrame:
    return df.filter(F.col("vehicle_timestamp") >= F.lit(SPLIT))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six decimals by the same arithmetic as the SQL side."""
    return df.withColumns({n: F.floor(F.col(n) * 1e6 + 0.5) / F.lit(1e6) for n in names})


MOVED = ("distance_km", "time_difference_minutes", "speed_kmh")
SPEEDS = ("total_distance_km", "average_speed_kmh", "median_speed_kmh", "minimum_speed_kmh", "maximum_speed_kmh")
DEVIATION = ("avg_active_vehicles", "deviation_percent")


# -- streams --------------------------------------------------------------------------

def _records_stream(spark, d):
    return fixtures.stream_records(use_utc(spark), d)


def _parsed_stream(spark, d):
    return ev.parse_events(ev.kafka_decode(_records_stream(spark, d)))


def _run(query) -> None:
    query.awaitTermination()


def _event_stream(spark, d):
    """Records stored as files, then read back as a stream through the event source."""
    stored, out, state = (scratch_path(use_utc(spark), n) for n in ("records", "decoded", "state"))
    fixtures.records(spark, d).write.parquet(stored)
    decoded = ev.kafka_decode(streams.event_source(spark, "parquet", path=stored))
    _run(jobs.history_of(decoded, jobs.folder_writer(out), state, ONCE))
    return sinks.read_batches(spark, out).select(
        "key", "kafka_partition", "kafka_offset", "kafka_timestamp", F.length("value").alias("value_length")
    )


def _keyed_stream_result(spark, aggregated: DataFrame, key: str) -> DataFrame:
    """Last row written per key over all batches."""
    out, state = scratch_path(spark, "keyed"), scratch_path(spark, "state")
    _run(jobs.keyed_stream(aggregated, out, state, ONCE))
    return gold.latest_by(sinks.read_batches(spark, out), [key], ["write"]).drop("write")


def _events_per_minute_stream(spark, d):
    return _keyed_stream_result(spark, jobs.events_per_minute(_parsed_stream(spark, d)), "window_start")


def _latest_vehicle_state_stream(spark, d):
    return _keyed_stream_result(spark, jobs.latest_vehicle_state(_parsed_stream(spark, d)), "vehicle_id")


def _silver_stream(spark, d, source=_records_stream):
    records = source(spark, d)
    out, state = scratch_path(spark, "silver"), scratch_path(spark, "state")
    _run(jobs.silver_stream(records, out, state, ONCE))
    return tables.table_scan(spark, out, schemas.STREAMING_SILVER).drop("event_date")


def _quality_stream(spark, d, part: str, source=_records_stream):
    records = source(spark, d)
    silver, refused, state = (scratch_path(spark, n) for n in ("silver", "quarantine", "state"))
    _run(jobs.quality_stream(records, silver, refused, state, ONCE))
    if part == "silver":
        return sinks.read_batches(spark, silver).select(*schemas.STREAMING_SILVER.fieldNames())
    return sinks.read_batches(spark, refused).select("kafka_partition", "kafka_offset", "validation_error")


def _bronze_stream(spark, d, source=_records_stream):
    records = source(spark, d)
    out, state = scratch_path(spark, "bronze"), scratch_path(spark, "state")
    _run(jobs.bronze_stream(records, out, state, ONCE))
    line = "event_version int, vehicle_id string, latitude double, kafka_partition int, kafka_offset bigint, bronze_ingestion_timestamp string"
    return spark.read.text(out).select(F.from_json("value", line).alias("e")).select(
        "e.event_version", "e.vehicle_id", "e.latitude", "e.kafka_partition", "e.kafka_offset",
        F.col("e.bronze_ingestion_timestamp").isNotNull().alias("has_arrival"),
    )


def _history_stream(spark, d):
    out, state = scratch_path(spark, "history"), scratch_path(spark, "state")
    _run(jobs.history_stream(_records_stream(spark, d), jobs.folder_writer(out), state, ONCE))
    return sinks.read_batches(spark, out).drop("write")


def _latest_stream(spark, d):
    out, state = scratch_path(spark, "latest"), scratch_path(spark, "state")
    _run(jobs.latest_stream(_records_stream(spark, d), out, state, ONCE))
    return sinks.read_merged(spark, out, schemas.LATEST_POSITIONS).drop("updated_at")


def _halves(spark, d) -> list[DataFrame]:
    """The records as two streams of several batches each, earlier half and later half by offset
    parity, so that equal times and late rows fall on both sides. A batch holds whole topic partitions."""
    stored = scratch_path(use_utc(spark), "records")
    batch = F.pmod(F.hash("partition"), F.lit(3))
    records = fixtures.records(spark, d).withColumn("file_no", batch)
    halves = [(f"{stored}/half={n}", records.filter(F.col("offset") % 2 == n)) for n in (0, 1)]
    return [
        streams.event_source(spark, "parquet", path=path, maxFilesPerTrigger=str(fixtures.write_in_order(half, path)))
        for path, half in halves
    ]


def _history_stream_restart(spark, d):
    """Two halves of the events under two checkpoints into one table, in several batches."""
    halves, out = _halves(spark, d), scratch_path(spark, "history")
    for half in halves:
        _run(jobs.history_stream(half, jobs.folder_writer(out), scratch_path(spark, "state"), ONCE))
    return sinks.read_batches(spark, out).drop("write")


def _latest_stream_restart(spark, d):
    halves, out = _halves(spark, d), scratch_path(spark, "latest")
    for half in halves:
        _run(jobs.latest_stream(half, out, scratch_path(spark, "state"), ONCE))
    return sinks.read_merged(spark, out, schemas.LATEST_POSITIONS).drop("updated_at")


def _latest_stream_bucketed(spark, d):
    halves, out = _halves(spark, d), scratch_path(spark, "latest")
    for half in halves:
        _run(jobs.latest_stream_bucketed(half, out, scratch_path(spark, "state"), ONCE, buckets=16))
    return buckets.read(spark, out, schemas.LATEST_POSITIONS).drop("updated_at")


def _late_stream(spark, d):
    """A stream of several folders, a batch each, in which some rows come much too late."""
    stored = scratch_path(use_utc(spark), "records")
    files = fixtures.write_in_order(fixtures.late_records(spark, d), stored)
    return streams.event_source(spark, "parquet", path=stored, maxFilesPerTrigger=str(files))


def _parsed_late(spark, d):
    return ev.parse_events(ev.kafka_decode(_late_stream(spark, d)))


def _latest_vehicle_state_restart(spark, d):
    """The query ends in the middle of its input and goes on from its checkpoint, late rows on both sides."""
    stored, out, state = (scratch_path(use_utc(spark), n) for n in ("records", "keyed", "state"))
    records = fixtures.late_records(spark, d)
    for first, last in ((0, 3), (4, 7)):
        part = scratch_path(spark, "part")
        taken = fixtures.write_in_order(records.filter(F.col("file_no").between(first, last)), part)
        for number in range(first, last + 1):
            files, folder = sinks.folder(spark, f"{part}/file_no={number}")
            if files.exists(folder):
                _, target = sinks.folder(spark, f"{stored}/file_no={number}")
                files.mkdirs(target.getParent())
                files.rename(folder, target)
        stream = streams.event_source(spark, "parquet", path=stored, maxFilesPerTrigger=str(taken))
        parsed = ev.parse_events(ev.kafka_decode(stream))
        _run(jobs.keyed_stream(jobs.latest_vehicle_state(parsed), out, state, ONCE))
    return gold.latest_by(sinks.read_batches(spark, out), ["vehicle_id"], ["write"]).drop("write")


def _snapshot_stream(spark, d):
    """Snapshots of the earlier part, then those of the later one beside them, under one checkpoint."""
    root, out, state = (scratch_path(use_utc(spark), n) for n in ("snapshots", "decoded", "state"))
    early = F.coalesce(F.col("vehicle_timestamp") < F.lit(SPLIT), F.lit(True))
    for k, part in enumerate((early, ~early)):
        fixtures.write_snapshots(_positions(spark, d).filter(part), f"{root}/{k}")
        _run(jobs.snapshot_history(snapshots.snapshot_stream(spark, root, 200), out, state, ONCE))
    return sinks.read_batches(spark, out).drop("write")


# -- files ----------------------------------------------------------------------------

def _snapshot_files(spark, d):
    root = scratch_path(spark, "snapshots")
    fixtures.write_snapshots(_positions(spark, d), root)
    return snapshots.snapshot_scan(spark, root)


def _snapshot_scan(spark, d):
    files = _snapshot_files(spark, d)
    return files.select(
        base_name(F.col("path")).alias("source_file"),
        filename_timestamp(F.col("path")).alias("ingestion_timestamp"),
    ).distinct()


def _latest_snapshot_scan(spark, d):
    """The newest of the snapshots; modification times are set to follow the file names."""
    root = scratch_path(spark, "snapshots")
    fixtures.write_snapshots(_positions(spark, d), root)
    fixtures.date_by_name(spark, root)
    newest = snapshots.latest_snapshot_scan(spark, root)
    return newest.select(base_name(F.col("path")).alias("source_file"), F.lit(newest.count()).cast("long").alias("files"))


def _chronological(df: DataFrame, *order: str) -> DataFrame:
    """A gold table stored in time order and read back with each row's place in it."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "gold")
    sinks.write_table(df, path, sort_by=order)
    stored = spark.read.schema(df.schema).parquet(path).withColumns(
        {"file": F.col("_metadata.file_name"), "at": F.col("_metadata.row_index")})
    # files are numbered in the order of their ranges
    sizes = {r["file"]: r["n"] for r in stored.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, seen = [], 0
    for name in sorted(sizes):
        before.append((name, seen))
        seen += sizes[name]
    offsets = spark.createDataFrame(before, "file string, before long")
    return stored.join(F.broadcast(offsets), "file").withColumn("place", F.col("before") + F.col("at")).drop("file", "at", "before")


def _decode_snapshots(spark, d):
    return snapshots.decode_snapshots(_snapshot_files(spark, d))


def _snapshot_metrics_from_files(spark, d):
    files = _snapshot_files(spark, d)
    return gold.snapshot_metrics(snapshots.decode_snapshots(files), files)


def _table_scan(spark, d):
    path = scratch_path(spark, "silver")
    sinks.write_table(_silver(spark, d).select(*_silver_columns()), path, sort_by=("vehicle_id", "vehicle_timestamp"))
    return tables.table_scan(spark, path, required=("vehicle_id", "latitude", "longitude", "vehicle_timestamp"))


def _silver_columns() -> list[str]:
    return [name for name in schemas.HISTORICAL_SILVER.fieldNames() if name != "vehicle_status"]


def _write_merged(spark, d):
    """Route registry stored from the earlier part, then merged with the later part on disk."""
    path = scratch_path(spark, "routes")
    silver = _silver(spark, d)
    sinks.write_merged(gold.route_registry(_before(silver)), path)
    stored = sinks.read_merged(spark, path, schemas.ROUTE_REGISTRY)
    sinks.write_merged(_widened(stored, gold.route_registry(_since(silver))), path)
    return sinks.read_merged(spark, path, schemas.ROUTE_REGISTRY)


def _append_metrics(spark, d):
    """Two runs, the first of them twice."""
    path = scratch_path(spark, "metrics")
    positions = _positions(spark, d)
    for part, name in ((positions, "before"), (_since(positions), "since"), (_before(positions), "before")):
        sinks.append_metrics(monitoring.table_observability(part, name), path, run=name)
    return sinks.read_metrics(spark, path).drop("run")


def _incremental(spark, d, update, schema):
    """A gold table from the earlier part of silver, brought up to date by the later one."""
    silver, out = scratch_path(use_utc(spark), "silver"), scratch_path(spark, "gold")
    rows = hand_over(_silver(spark, d))
    for part in (_before(rows), _since(rows)):
        incremental.append_silver(part, silver)
        update(part, spark.read.parquet(silver), out)
    return incremental.read_parts(spark, out, schema(rows).schema)


def _silver_write_profile(spark, d):
    return gold.silver_with_profile(_positions(spark, d), scratch_path(spark, "silver"))


def _publish_events(spark, d):
    path = scratch_path(spark, "topic")
    jobs.publish_events(ev.build_event(_positions(spark, d)), "parquet", path=path)
    event = F.from_json("value", schemas.EVENT)
    return spark.read.parquet(path).select("key", event.alias("e")).select("key", "e.*")


def _refresh(spark, d):
    """The latest positions are a stored table, as the stream job keeps them."""
    root = scratch_path(spark, "serving")
    sinks.write_merged(_latest(spark, d), f"{root}/latest")
    latest = sinks.read_merged(spark, f"{root}/latest", schemas.LATEST_POSITIONS)
    return rf.refresh(_stored_events(spark, d), root, NOW, latest)


# -- merges ---------------------------------------------------------------------------

def _widened(state, updates):
    return merge.keyed_merge(
        state, updates, ["route_id"], merge.WIDEN_TIMES, first="first_seen_at", last="last_seen_at"
    )


def _route_registry_merge(spark, d):
    silver = _silver(spark, d)
    return _widened(gold.route_registry(_before(silver)), gold.route_registry(_since(silver)))


def _inferred_stops_merge(spark, d):
    silver = _silver(spark, d)
    return merge.keyed_merge(
        gold.inferred_stops(_before(silver)), gold.inferred_stops(_since(silver)), ["stop_id"]
    )


def _route_summary_merge(spark, d):
    events = _stored_events(spark, d)
    stored, fresh = (
        serving.route_activity_summary(serving.latest_positions(part), at)
        for part, at in ((_before(events), SPLIT), (_since(events), NOW))
    )
    return merge.keyed_merge(stored, fresh, ["route_id"])


def _latest_positions_merge(spark, d):
    """The later part is stored and the earlier part arrives late: nothing may move back."""
    events = _stored_events(spark, d)
    stored, late = (
        serving.latest_positions(part, updated_at=F.col("ingestion_timestamp"))
        for part in (_since(events), _before(events))
    )
    return merge.keyed_merge(stored, late, ["vehicle_id"], merge.NOT_OLDER, time="vehicle_timestamp")


# -- quality --------------------------------------------------------------------------

def _rules() -> list[quality.Rule]:
    return [
        quality.not_empty("vehicle_id"),
        quality.not_empty("route_id"),
        quality.non_negative("kafka_offset"),
        quality.in_range("latitude", -90, 90),
        quality.in_range("longitude", -180, 180),
        quality.required_columns(["vehicle_id", "vehicle_timestamp"]),
        quality.required_columns(["vehicle_id", "bearing"], name="bearing_present"),
        quality.not_empty("kafka_partition"),
    ]


def _run_checks(spark, d):
    return quality.run_checks(_positions(spark, d), _rules())


def _all_checks_passed(spark, d):
    results = _run_checks(spark, d)
    return results.agg(F.bool_and("passed").alias("all_passed"), F.count(F.lit(1)).alias("checks"))


def _run_record(spark, d):
    summary = _summary(spark, d)
    start, end = datetime(2024, 1, 2, 7, 59, 50, tzinfo=timezone.utc), NOW
    passed = quality.all_checks_passed(monitoring.validate_route_ids(summary))
    return monitoring.run_record("route_activity_refresh", start, end, summary, passed)


def _freshness_outcomes(spark, d):
    """Every outcome: judged at the newest arrival, a day later, and with no rows."""
    positions = _positions(spark, d)
    newest = positions.agg(F.max("ingestion_timestamp")).first()[0]
    cases = [("now", positions, newest), ("later", positions, newest + timedelta(days=1)), ("none", positions.filter("false"), newest)]
    parts = [monitoring.freshness(df, at).select(F.lit(name).alias("case"), "status") for name, df, at in cases]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _failed_run_record(spark, d):
    """Route ids with blank ones among them: the check fails and the record says so."""
    summary = _summary(spark, d).withColumn("route_id", F.when(F.col("route_id") == "R1", " ").otherwise(F.col("route_id")))
    passed = quality.all_checks_passed(monitoring.validate_route_ids(summary))
    return monitoring.run_record("route_activity_refresh", NOW - timedelta(seconds=10), NOW, summary, passed)


def _faulty_events(spark, d) -> DataFrame:
    """Records of which some are damaged by a rule on their offset, one damage each."""
    decoded = _decoded(spark, d)
    value = F.col("value")
    rules = [
        (3, F.concat(value, F.lit(" x"))), (5, F.concat(value, value)),
        (7, F.regexp_replace(value, '"latitude":[-0-9.]+', '"latitude":"north"')), (9, F.regexp_replace(value, r'^\{', '{"extra":1,')),
        (11, F.lit("{bad")), (13, F.lit(None).cast("string")),
        (15, F.regexp_replace(value, '"event_version":[0-9]+', '"event_version":"1"')),
        (17, F.regexp_replace(value, '"event_version":[0-9]+,', "")),
        (19, F.regexp_replace(value, '"event_type":"[a-z_]*",', "")),
        (21, F.regexp_replace(value, ',?"ingestion_timestamp":"[^"]*"', "")),
    ]
    out = value
    for left, damaged in rules:
        out = F.when(F.col("kafka_offset") % 40 == left, damaged).otherwise(out)
    return decoded.withColumn("value", out)


def _contract_breaches(spark, d):
    return ev.contract_check(_faulty_events(spark, d)).select("kafka_partition", "kafka_offset", "contract_ok")


def _every_validation_error(spark, d):
    parsed = ev.parse_events(_faulty_events(spark, d), keep_raw=True)
    return ev.with_validation_error(parsed).select("kafka_partition", "kafka_offset", "validation_error")


def _alerts(spark, d):
    return gold.mobility_alerts(_anomalies(spark, d))


def _anomaly_labels(spark, d):
    shown = gold.top_anomalies(_anomalies(spark, d))
    return shown.select("route_id", "hour", status_label(F.col("anomaly_status")).alias("label"))


def entry(spark: SparkSession) -> DataFrame:
    """Which routes are slow: raw positions to silver, movement and route performance."""
    return gold.slowest_routes(_performance(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | _added()[0]


def oracle_sql() -> dict[str, str]:
    return own_sql() | _added()[1]


def _added() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, where that subpackage and the pipeline exist."""
    try:
        import corpus_pipeline
        from waybill.llm import oracles as llm_oracles, queries as llm_queries
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "waybill.llm", "waybill.llm.oracles", "waybill.llm.queries"):
            raise
        return {}, {}
    sql = dict(llm_oracles.SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}, sql


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # events
        "event_source": _event_stream,
        "kafka_decode": lambda s, d: _decoded(s, d),
        "parse_events": lambda s, d: _parsed(s, d),
        "streaming_silver": _events,
        "event_time_filter": lambda s, d: ev.event_time_filter(_parsed(s, d)).select(
            "vehicle_id", "vehicle_timestamp", "kafka_partition", "kafka_offset"),
        "validation_error": lambda s, d: ev.with_validation_error(_parsed(s, d)).select(
            "kafka_partition", "kafka_offset", "validation_error"),
        "valid_events": lambda s, d: ev.valid_events(ev.with_validation_error(_parsed(s, d, keep_raw=True))),
        "quarantine": lambda s, d: ev.quarantine(
            ev.with_validation_error(_parsed(s, d, parse_times=False, keep_raw=True))
        ).drop("raw_event", "vehicle_timestamp", "ingestion_timestamp"),
        "contract_check": lambda s, d: ev.contract_check(_decoded(s, d)).select(
            "kafka_partition", "kafka_offset", "contract_ok"),
        "build_event": lambda s, d: ev.build_event(_positions(s, d)),
        "publish_events": _publish_events,
        # snapshots and silver
        "snapshot_scan": _snapshot_scan,
        "latest_snapshot_scan": _latest_snapshot_scan,
        "decode_snapshots": _decode_snapshots,
        "exact_dedupe": lambda s, d: sv.exact_dedupe(_positions(s, d)),
        "historical_silver": _silver,
        "snapshot_silver": lambda s, d: sv.snapshot_silver(_positions(s, d)),
        "silver_profile": lambda s, d: gold.silver_profile(_positions(s, d), _silver(s, d)),
        "table_scan": _table_scan,
        # movement
        "vehicle_movement": lambda s, d: _rounded(_movement(s, d), *MOVED),
        "vehicle_movement_hot_slices": lambda s, d: _rounded(
            mv.vehicle_movement(_silver(s, d), hot_rows=6, count_slices=True), *MOVED),
        "movement_profile": lambda s, d: _rounded(
            mv.movement_profile(_movement(s, d)), "total_distance_km", "average_speed_kmh"),
        "route_performance": lambda s, d: _rounded(_performance(s, d, median_by_rank=False), *SPEEDS),
        "route_performance_by_rank": lambda s, d: _rounded(
            _performance(s, d, median_by_rank=True), *SPEEDS),
        "slowest_routes": lambda s, d: _rounded(gold.slowest_routes(_performance(s, d)), *SPEEDS),
        "fastest_routes": lambda s, d: _rounded(gold.fastest_routes(_performance(s, d)), *SPEEDS),
        # activity
        "route_vehicle_summary": lambda s, d: gold.route_vehicle_summary(_silver(s, d)),
        "busiest_routes": lambda s, d: gold.busiest_routes(gold.route_vehicle_summary(_silver(s, d))),
        "summary_totals": lambda s, d: gold.summary_totals(gold.route_vehicle_summary(_silver(s, d))),
        "hourly_vehicle_activity": lambda s, d: gold.hourly_vehicle_activity(_silver(s, d)),
        "hourly_comparison": lambda s, d: gold.hourly_comparison(gold.hourly_vehicle_activity(_silver(s, d))),
        "snapshot_metrics": lambda s, d: gold.snapshot_metrics(_positions(s, d)),
        "snapshot_metrics_from_files": _snapshot_metrics_from_files,
        "inferred_stops": lambda s, d: gold.inferred_stops(_silver(s, d)),
        "inferred_stops_merge": _inferred_stops_merge,
        "route_registry": lambda s, d: gold.route_registry(_silver(s, d)),
        "route_registry_merge": _route_registry_merge,
        "write_merged": _write_merged,
        "route_activity_anomalies": lambda s, d: _rounded(_anomalies(s, d), *DEVIATION),
        "mobility_alerts": lambda s, d: _rounded(_alerts(s, d), "deviation_percent"),
        "top_anomalies": lambda s, d: _rounded(gold.top_anomalies(_anomalies(s, d)), *DEVIATION),
        "anomaly_labels": _anomaly_labels,
        "recent_alerts": lambda s, d: _rounded(gold.recent_alerts(_alerts(s, d)), "deviation_percent"),
        # serving
        "latest_positions": _latest,
        "latest_positions_from_json": lambda s, d: serving.latest_positions(
            _events(s, d), updated_at=F.col("ingestion_timestamp")),
        "latest_positions_merge": _latest_positions_merge,
        "route_activity_summary": _summary,
        "route_summary_merge": _route_summary_merge,
        "metrics_overview": lambda s, d: serving.metrics_overview(_latest(s, d)),
        "vehicles_latest": lambda s, d: serving.vehicles_latest(_latest(s, d)),
        "vehicles_live": lambda s, d: serving.vehicles_live(_latest(s, d)),
        "routes_activity": lambda s, d: serving.routes_activity(_summary(s, d), limit=20),
        "as_answer": lambda s, d: serving.as_answer(serving.vehicles_live(_latest(s, d))),
        "refresh": _refresh,
        # monitoring and quality
        "table_observability": lambda s, d: monitoring.table_observability(_positions(s, d), "vehicle_positions"),
        "append_metrics": _append_metrics,
        "duplicate_keys": lambda s, d: monitoring.duplicate_keys(
            _positions(s, d), ["vehicle_id", "vehicle_timestamp"]),
        "freshness": lambda s, d: _rounded(monitoring.freshness(_positions(s, d), NOW), "age_minutes"),
        "freshness_outcomes": _freshness_outcomes,
        "failed_run_record": _failed_run_record,
        "contract_breaches": _contract_breaches,
        "every_validation_error": _every_validation_error,
        "hourly_chronological": lambda s, d: _chronological(gold.hourly_vehicle_activity(_silver(s, d)), "hour"),
        "snapshots_chronological": lambda s, d: _chronological(
            gold.snapshot_metrics(_positions(s, d)), "snapshot_time", "source_file"),
        "not_empty_check": lambda s, d: monitoring.not_empty_check(_summary(s, d), "route_activity_summary"),
        "run_record": _run_record,
        "run_checks": _run_checks,
        "all_checks_passed": _all_checks_passed,
        "validate_route_ids": lambda s, d: monitoring.validate_route_ids(_summary(s, d)),
        # streams
        "events_per_minute": lambda s, d: jobs.events_per_minute(_parsed(s, d)),
        "events_per_minute_stream": _events_per_minute_stream,
        "latest_vehicle_state": lambda s, d: jobs.latest_vehicle_state(_parsed(s, d)),
        "latest_vehicle_state_stream": _latest_vehicle_state_stream,
        "silver_stream": _silver_stream,
        "quality_stream": lambda s, d: _quality_stream(s, d, "silver"),
        "quality_stream_quarantine": lambda s, d: _quality_stream(s, d, "quarantine"),
        "bronze_stream": _bronze_stream,
        "history_stream": _history_stream,
        "latest_stream": _latest_stream,
        "history_stream_restart": _history_stream_restart,
        "latest_stream_restart": _latest_stream_restart,
        "latest_stream_bucketed": _latest_stream_bucketed,
        "events_per_minute_late": lambda s, d: _keyed_stream_result(
            s, jobs.events_per_minute(_parsed_late(s, d)), "window_start"),
        "latest_vehicle_state_restart": _latest_vehicle_state_restart,
        "silver_stream_batches": lambda s, d: _silver_stream(s, d, _late_stream),
        "quality_stream_batches": lambda s, d: _quality_stream(s, d, "silver", _late_stream),
        "quality_stream_batches_quarantine": lambda s, d: _quality_stream(s, d, "quarantine", _late_stream),
        "bronze_stream_batches": lambda s, d: _bronze_stream(s, d, _late_stream),
        "snapshot_stream": _snapshot_stream,
        # brought up to date
        "hourly_activity_incremental": lambda s, d: _incremental(
            s, d, incremental.update_hourly_activity, gold.hourly_vehicle_activity),
        "snapshot_metrics_incremental": lambda s, d: _incremental(
            s, d, incremental.update_snapshot_metrics, gold.snapshot_metrics),
        "silver_write_profile": _silver_write_profile,
        "movement_write_profile": lambda s, d: _rounded(
            gold.movement_with_profile(_movement(s, d), scratch_path(s, "movement")), "total_distance_km", "average_speed_kmh"),
    }


def own_sql() -> dict[str, str]:
    return oracles.sql()
