"""Vehicle positions derived from the ``events`` table, with faults of every kind mixed in.

The given tables hold no vehicles; this maps each event to one position, adds exact copies
of some rows and second sightings of others, and breaks fields by rule, so that every
operator has work to do at any scale. One scan, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waybill.functions.times import MICROS_PER_MINUTE, floor_hour
from waybill.operators.events import event_json
from waybill.schemas import STREAMING_SILVER
from waybill.sources.sinks import folder
from waybill.sources.snapshots import feed_message
from waybill.sources.tables import spread_files

BASE_MICROS = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
ROWS_PER_FILE = 200_000


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def positions_of(events: DataFrame) -> DataFrame:
    """Works on a batch and on a streaming ``events`` table alike."""
    none = F.array().cast("array<int>")
    copies = F.concat(
        F.array(F.lit(0)),
        F.when(_every(50), F.array(F.lit(0))).otherwise(none),
        F.when(_every(70), F.array(F.lit(1))).otherwise(none),
    )
    seen = events.select("event_id", "user_id", "ts", F.explode(copies).alias("copy"))
    seen = seen.withColumn(
        "_at",
        F.expr(f"{BASE_MICROS} + (unix_micros(cast(ts as timestamp)) - {BASE_MICROS}) div 24"),
    )
    user, event = F.col("user_id"), F.col("event_id")
    delay = (F.lit(1) + event % 90) * F.lit(1_000_000) + F.col("copy") * F.lit(60 * MICROS_PER_MINUTE)
    ingested = F.timestamp_micros(F.col("_at") + delay)
    file_hour = F.date_format(floor_hour(ingested), "yyyyMMdd_HHmmss")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return seen.select(
        F.when(_every(131), 2).otherwise(1).alias("event_version"),
        F.when(_every(137), "heartbeat").otherwise("vehicle_position").alias("event_type"),
        F.when(_every(211), None).when(_every(223), "").otherwise(text("V", user)).alias("vehicle_id"),
        F.when(_every(23), None).otherwise(text("R", (user + event % 2) % 12)).alias("route_id"),
        F.when(_every(29), None).otherwise(text("T", user, "_", event % 5)).alias("trip_id"),
        F.when(_every(97), 95.0).when(_every(101), None)
        .otherwise(F.lit(28.6) + ((event * 7919) % 200) / F.lit(10000)).alias("latitude"),
        F.when(_every(103), -190.0).when(_every(107), None)
        .otherwise(F.lit(77.2) + ((event * 104729) % 40) / F.lit(10000)).alias("longitude"),
        F.when(_every(109), None).otherwise(F.timestamp_micros("_at")).alias("vehicle_timestamp"),
        ingested.alias("ingestion_timestamp"),
        text("vehicle_positions_", file_hour, ".bin").alias("source_file"),
        (event % 3).cast("int").alias("kafka_partition"),
        (event + F.col("copy") * F.lit(1_000_000_000)).alias("kafka_offset"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream; a stream reads folders, so a single file is picked by name."""
    table = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(read_events(spark, sf_dir).schema)
    files, location = folder(spark, table)
    if files.getFileStatus(location).isDirectory():
        return reader.parquet(table)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions_of(spread_files(read_events(spark, sf_dir), "event_id"))


def records_of(positions: DataFrame, *more: Column) -> DataFrame:
    """Positions as topic records: binary key and value plus transport fields, and ``more`` columns."""
    return positions.select(
        F.col("vehicle_id").cast("binary").alias("key"),
        event_json().cast("binary").alias("value"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingestion_timestamp").alias("timestamp"),
        *more,
    )


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as events already parsed and stored, with the transport fields."""
    return positions(spark, sf_dir).withColumn("kafka_timestamp", F.col("ingestion_timestamp")).select(
        *STREAMING_SILVER.fieldNames()
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(positions(spark, sf_dir))


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(positions_of(stream_events(spark, sf_dir)))


def write_in_order(records: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Records as one folder per ``file_no``, a small number, modified in that order, for streams that take a folder
    a batch; returns how many files each folder has, which is what such a stream takes at once.

    Files are as many as the largest folder needs, so that a task has about ``rows_per_file`` rows whatever the
    table's size; other folders are filled up with empty files.
    """
    spark = records.sparkSession
    counts = {r["file_no"]: r["count"] for r in records.groupBy("file_no").count().collect()}  # a row a folder
    parts = max(1, -(-max(counts.values(), default=0) // rows_per_file))
    part = F.pmod(F.xxhash64("partition", "offset", "value"), F.lit(parts))
    place = F.col("file_no") * parts + part - min(counts, default=0) * parts
    folders = max(counts, default=0) - min(counts, default=0) + 1
    dealt = records.repartitionById(folders * parts, place.cast("int"))
    dealt.write.partitionBy("file_no").parquet(path)
    found = {number: _parquet_files(spark, f"{path}/file_no={number}") for number in counts}
    most = max(map(len, found.values()), default=1)
    empty = spark.createDataFrame([], records.drop("file_no").schema).coalesce(1)
    for number, names in found.items():
        for _ in range(most - len(names)):
            empty.write.mode("append").parquet(f"{path}/file_no={number}")
        for name in _parquet_files(spark, f"{path}/file_no={number}"):
            files, location = folder(spark, name)
            files.setTimes(location, BASE_MICROS // 1000 + 1000 * number, -1)
    return most


def _parquet_files(spark: SparkSession, path: str) -> list[str]:
    files, location = folder(spark, path)
    names = [str(entry.getPath()) for entry in files.listStatus(location)]
    return [name for name in names if name.endswith(".parquet")]


def late_records(spark: SparkSession, sf_dir: str, files: int = 8) -> DataFrame:
    """Records numbered by event time into ``files`` parts, of which every 13th comes two or more parts late."""
    rows = positions(spark, sf_dir).withColumn("_us", F.unix_micros("vehicle_timestamp"))
    low, high = rows.agg(F.min("_us"), F.max("_us")).first()
    part = F.coalesce(F.expr(f"((_us - {low}) * {files}) DIV ({high} - {low} + 1)"), F.lit(0))
    late = F.when(F.col("kafka_offset") % 13 == 5, 2 + F.col("kafka_offset") % 3).otherwise(0)
    return records_of(rows, F.least(part + late, F.lit(files - 1)).cast("int").alias("file_no"))


def write_snapshots(positions: DataFrame, path: str) -> None:
    """Encode positions as raw feed snapshots below ``path``.

    Every Arrow batch writes its own part of each snapshot into a folder of its own, so no
    snapshot is gathered in one task, and a task that runs again replaces its files.
    """
    _, location = folder(positions.sparkSession, path)
    root = location.getFileSystem(positions.sparkSession._jsc.hadoopConfiguration()).makeQualified(location).toUri().toString()
    root = root.replace("file:/", "file:///", 1) if not root.startswith("file://") else root

    def encode(batches: Iterator) -> Iterator:
        import pandas as pd
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        message = feed_message()
        files, folder = FileSystem.from_uri(root)
        for number, batch in enumerate(batches):
            part = f"{folder}/part-{TaskContext.get().partitionId()}-{number}"
            files.create_dir(part, recursive=True)
            for source_file, rows in batch.groupby("source_file"):
                feed = message()
                feed.header.gtfs_realtime_version = "2.0"
                for at, row in enumerate(rows.itertuples(index=False)):
                    entity = feed.entity.add(id=str(at))
                    position = entity.vehicle
                    position.SetInParent()
                    if row.vehicle_id is not None:
                        position.vehicle.id = row.vehicle_id
                    if row.route_id is not None or row.trip_id is not None:
                        position.trip.SetInParent()
                    if row.route_id is not None:
                        position.trip.route_id = row.route_id
                    if row.trip_id is not None:
                        position.trip.trip_id = row.trip_id
                    if pd.notna(row.latitude) and pd.notna(row.longitude):
                        position.position.latitude = row.latitude
                        position.position.longitude = row.longitude
                    if pd.notna(row.epoch_seconds):
                        position.timestamp = int(row.epoch_seconds)
                    position.current_status = int(row.status)
                with files.open_output_stream(f"{part}/{source_file}") as out:
                    out.write(feed.SerializeToString())
            yield pd.DataFrame({"files": [batch["source_file"].nunique()]})

    rows = positions.select(
        "vehicle_id", "route_id", "trip_id", "latitude", "longitude",
        F.unix_seconds("vehicle_timestamp").alias("epoch_seconds"),
        (F.col("kafka_offset") % 3).alias("status"), "source_file",
    )
    rows.mapInPandas(encode, "files bigint").write.format("noop").mode("overwrite").save()


def date_by_name(spark: SparkSession, path: str) -> None:
    """Sets the modification times of snapshot files to the order of their names."""
    names = [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.bin")
             .option("recursiveFileLookup", "true").load(path).select("path").collect()]
    for name in names:
        files, location = folder(spark, name)
        polled = datetime.strptime(location.getName(), "vehicle_positions_%Y%m%d_%H%M%S.bin").replace(tzinfo=timezone.utc)
        files.setTimes(location, int(polled.timestamp()) * 1000, -1)
