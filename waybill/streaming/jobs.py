"""Structured Streaming jobs; every one is restartable from its checkpoint.

``trigger`` takes the keyword arguments of ``DataStreamWriter.trigger``. Batches may be
replayed after a failure, and a query may start anew, with batch numbers from 0, on output
that another has written. So whatever a batch writes carries the query's identity (that of
its checkpoint) and the batch number; it replaces itself and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from waybill.functions.times import date_parts
from waybill.operators.events import (
    contract_check, event_time_filter, kafka_decode, parse_events, split_valid, streaming_silver,
    to_records, with_validation_error,
)
from waybill.operators.merge import NOT_OLDER, keyed_merge, not_yet_stored
from waybill.plans.serving import latest_positions
from waybill.schemas import LATEST_POSITIONS
from waybill.sources import appends, buckets as keyed
from waybill.sources.sinks import read_merged, write_jdbc, write_merged
from waybill.sources.snapshots import decode_snapshots

EVERY_30_SECONDS = {"processingTime": "30 seconds"}  # fixed default of the jobs
HISTORY_COLUMNS = [name for name in LATEST_POSITIONS.fieldNames() if name != "updated_at"]
BatchWriter = Callable[[DataFrame, int], None]


def _start(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_30_SECONDS)).start()
    )


def batch_source(batch: DataFrame, batch_id: int) -> str:
    """Which batch of which query this is; stays the same when the batch is replayed."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("a batch can only be written from within its streaming query")
    return f"{query}.{batch_id}"


def console(df: DataFrame, checkpoint: str, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Print a stream, for inspection."""
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", "false")
    return _start(writer, checkpoint, trigger)


# -- event time -----------------------------------------------------------------------

def events_per_minute(
    events: DataFrame, window: str = "1 minute", watermark: str = "2 minutes"
) -> DataFrame:
    """Events per tumbling window of event time.

    On a stream, rows later than the watermark are dropped and closed windows leave the
    state. On a table every row counts. Counts are combined before the shuffle.
    """
    return (
        event_time_filter(events)
        .withWatermark("vehicle_timestamp", watermark)
        .groupBy(F.window("vehicle_timestamp", window).alias("_window"))
        .agg(F.count(F.lit(1)).alias("vehicle_events"))
        .select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"),
                "vehicle_events")
    )


def latest_vehicle_state(events: DataFrame) -> DataFrame:
    """Newest known position per vehicle; on a stream the state is kept between batches.

    A late row does not move a vehicle back, and of equal times the later offset wins. The
    state holds one row per vehicle ever seen and has no expiry.
    """
    position = F.struct("route_id", "trip_id", "latitude", "longitude", "vehicle_timestamp")
    order = F.struct("vehicle_timestamp", "kafka_offset")
    return (
        event_time_filter(events)
        .groupBy("vehicle_id")
        .agg(F.max_by(position, order).alias("_latest"))
        .select("vehicle_id", "_latest.*")
    )


def keyed_stream(
    aggregated: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the changed rows of an aggregated stream to a log, batch by batch. Of the rows of a
    key the one with the largest ``write`` is the newest (``sinks.read_batches``)."""
    writer = aggregated.writeStream.outputMode("update").foreachBatch(folder_writer(path))
    return _start(writer, checkpoint, trigger)


# -- files ----------------------------------------------------------------------------

def bronze_rows(records: DataFrame, arrived=None) -> DataFrame:
    """Records as received plus partition, offset and arrival time, as JSON text by day.

    Unknown fields survive with their types; of equal names the transport field wins. Text
    that is no JSON object is kept whole under ``raw_value``.
    """
    arrived = F.current_timestamp() if arrived is None else arrived
    decoded = kafka_decode(records).withColumn("_arrived", arrived)
    added = {
        "kafka_partition": F.col("kafka_partition"),
        "kafka_offset": F.col("kafka_offset"),
        "bronze_ingestion_timestamp": F.date_format("_arrived", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
    }
    received = F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>")
    kept = F.map_filter(received, lambda name, _: ~name.isin(*added))
    extra = F.create_map(*(part for name, value in added.items() for part in (F.lit(name), value.cast("variant"))))
    broken = F.to_json(F.struct(F.col("value").alias("raw_value"), *(v.alias(n) for n, v in added.items())))
    return decoded.select(
        F.coalesce(F.to_json(F.map_concat(kept, extra)), broken).alias("value"),
        *date_parts(F.col("_arrived")),
    )


def bronze_stream(
    records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    writer = (
        bronze_rows(records).writeStream.format("text").outputMode("append")
        .partitionBy("year", "month", "day").option("path", path)
    )
    return _start(writer, checkpoint, trigger)


def _by_day(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("vehicle_timestamp"))


def silver_stream(
    records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Valid events as Parquet by event date; a folder per route would mean tiny files."""
    events = streaming_silver(parse_events(kafka_decode(records)))
    writer = (
        _by_day(events).writeStream.format("parquet").outputMode("append")
        .partitionBy("event_date").option("path", path)
    )
    return _start(writer, checkpoint, trigger)


def quality_stream(
    records: DataFrame, silver: str, quarantine: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Valid events to ``silver``, refused ones with their reason to ``quarantine``.

    One query: each batch is read and parsed once, then written to both places. Readers use
    ``sinks.read_batches``, which leaves out what isn't complete.
    """
    validated = with_validation_error(parse_events(kafka_decode(records), keep_raw=True))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid, refused = split_valid(batch)
            source = batch_source(batch, batch_id)
            appends.append(_by_day(valid), silver, source, ("event_date",))
            appends.append(refused, quarantine, source)
        finally:
            batch.unpersist()

    return _start(validated.writeStream.foreachBatch(write), checkpoint, trigger)


# -- tables ---------------------------------------------------------------------------

def folder_writer(path: str) -> BatchWriter:
    """Append to an append log of Parquet folders; a replayed batch that it has already does nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        appends.append(batch, path, batch_source(batch, batch_id))

    return write


def database_writer(table: str, options: dict[str, str]) -> BatchWriter:
    """Append to a database table, leaving out rows whose partition and offset it has.

    The stored keys are looked up only within the batch's offset range of each partition, and
    the filter runs in the database. The batch is computed once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            spans = batch.groupBy("kafka_partition").agg(F.min("kafka_offset"), F.max("kafka_offset")).collect()
            if not spans:
                return
            within = [(F.col("kafka_partition") == p) & F.col("kafka_offset").between(low, high) for p, low, high in spans]
            stored = (
                batch.sparkSession.read.format("jdbc").options(**options).option("dbtable", table).load()
                .filter(reduce(or_, within))
            )
            write_jdbc(not_yet_stored(batch, stored, ["kafka_partition", "kafka_offset"]), table, options)
        finally:
            batch.unpersist()

    return write


def history_of(
    rows: DataFrame, writer: BatchWriter, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Every row of a stream handed to ``writer`` batch by batch."""
    return _start(rows.writeStream.foreachBatch(writer), checkpoint, trigger)


def history_stream(
    records: DataFrame, writer: BatchWriter, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Every valid event appended by ``writer``, without its version, type and topic time."""
    events = streaming_silver(parse_events(kafka_decode(records))).select(*HISTORY_COLUMNS)
    return history_of(events, writer, checkpoint, trigger)


def snapshot_history(
    snapshots: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Positions of a stream of snapshot files (``sources.snapshots.snapshot_stream``) in an append log;
    a later run with the same checkpoint decodes new files only."""
    return history_of(decode_snapshots(snapshots), folder_writer(path), checkpoint, trigger)


def latest_stream(
    records: DataFrame, state_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Current position per vehicle, merged batch by batch if not older than what is stored.

    A batch reads the newest version and writes the next, which records query and batch; a
    replay of a batch that a version records already does nothing. A batch without valid
    events leaves the state as it is. Old versions stay for their readers until
    ``sinks.expire_versions`` is called.
    """
    events = streaming_silver(parse_events(kafka_decode(records)))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            state = read_merged(batch.sparkSession, state_path, LATEST_POSITIONS)
            merged = keyed_merge(
                state, latest_positions(batch), ["vehicle_id"], NOT_OLDER, time="vehicle_timestamp"
            )
            write_merged(merged, state_path, source=batch_source(batch, batch_id))
        finally:
            batch.unpersist()

    return _start(events.writeStream.foreachBatch(write), checkpoint, trigger)


def latest_stream_bucketed(
    records: DataFrame, state_path: str, checkpoint: str, trigger: dict | None = None, buckets: int = keyed.BUCKETS
) -> StreamingQuery:
    """``latest_stream`` on a bucketed table: a batch rewrites the buckets of its vehicles, not the whole state.

    Old folders leave by themselves once no recent manifest names them (``sources.manifests``).
    """
    events = streaming_silver(parse_events(kafka_decode(records)))

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed.upsert(latest_positions(batch), state_path, ["vehicle_id"], LATEST_POSITIONS, NOT_OLDER,
                        source=batch_source(batch, batch_id), buckets=buckets, time="vehicle_timestamp")

    return _start(events.writeStream.foreachBatch(write), checkpoint, trigger)


# -- publishing -----------------------------------------------------------------------

def publishable(events: DataFrame) -> DataFrame:
    """Key and value of the events that obey the contract."""
    return contract_check(to_records(events)).filter("contract_ok").drop("contract_ok")


def publish_events(events: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Send contract-checked events to a topic keyed by vehicle, or to files with ``fmt``.

    For a topic give ``servers`` and ``topic``; a record counts as sent once all replicas
    have it.
    """
    writer = publishable(events).write.format(fmt).mode("append")
    if fmt == "kafka":
        writer = (
            writer.option("kafka.bootstrap.servers", options.pop("servers"))
            .option("topic", options.pop("topic"))
            .option("kafka.acks", "all").option("kafka.retries", "3")
        )
    writer.options(**options).save()
