"""Raw feed snapshots: listing and decoding."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from waybill import schemas
from waybill.functions.text import base_name
from waybill.functions.times import filename_timestamp, from_epoch_seconds

DECODED = (
    "vehicle_id string, route_id string, trip_id string, latitude double, longitude double, "
    "epoch_seconds bigint, vehicle_status string, path string"
)

# The part of the public GTFS-Realtime wire format that carries positions,
# as (field, number, type). proto2, so presence of every field is known.
WIRE_FORMAT = {
    "FeedHeader": [("gtfs_realtime_version", 1, "string")],
    "TripDescriptor": [("trip_id", 1, "string"), ("route_id", 5, "string")],
    "VehicleDescriptor": [("id", 1, "string")],
    "Position": [("latitude", 1, "float"), ("longitude", 2, "float")],
    "VehiclePosition": [
        ("trip", 1, "TripDescriptor"), ("position", 2, "Position"), ("current_status", 4, "int32"),
        ("timestamp", 5, "uint64"), ("vehicle", 8, "VehicleDescriptor"),
    ],
    "FeedEntity": [("id", 1, "string"), ("vehicle", 4, "VehiclePosition")],
    "FeedMessage": [("header", 1, "FeedHeader"), ("entity", 2, "*FeedEntity")],
}


def feed_message():
    """The message class of a snapshot, built from ``WIRE_FORMAT``."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as error:
        raise ImportError("decoding snapshots needs the protobuf package on the executors") from error

    field = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="feed.proto", package="feed", syntax="proto2")
    for name, fields in WIRE_FORMAT.items():
        message = file.message_type.add(name=name)
        for label, number, kind in fields:
            entry = message.field.add(name=label, number=number, label=field.LABEL_OPTIONAL)
            if kind.startswith("*"):
                entry.label = field.LABEL_REPEATED
            target = kind.lstrip("*")
            if target in WIRE_FORMAT:
                entry.type, entry.type_name = field.TYPE_MESSAGE, f".feed.{target}"
            else:
                entry.type = getattr(field, f"TYPE_{target.upper()}")
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("feed.FeedMessage"))


def snapshot_scan(spark: SparkSession, path: str) -> DataFrame:
    """All snapshot files below ``path`` as path, modificationTime, length, content."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.bin").option("recursiveFileLookup", "true").load(path)
    )
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no snapshot files below {path}")
    return files


def snapshot_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Snapshot files below ``path`` as a stream with the columns of ``snapshot_scan``.

    The source keeps a log of the files it has seen in the query's checkpoint, so every snapshot is
    decoded once in its life, whatever number of runs the query has.
    """
    kind = "path string, modificationTime timestamp, length bigint, content binary"
    return (
        spark.readStream.format("binaryFile").schema(kind)
        .option("pathGlobFilter", "*.bin").option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(files_per_batch)).load(path)
    )


def latest_snapshot_scan(spark: SparkSession, path: str) -> DataFrame:
    """The most recently modified snapshot; only its content is read.

    Of equal modification times the last path wins.
    """
    listing = snapshot_scan(spark, path).select("path", "modificationTime")
    newest = listing.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    return spark.read.format("binaryFile").load(newest)


def _positions(batches: Iterator) -> Iterator:
    import pandas as pd

    message = feed_message()
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = [
                (
                    v.vehicle.id if v.HasField("vehicle") else None,
                    v.trip.route_id if v.HasField("trip") else None,
                    v.trip.trip_id if v.HasField("trip") else None,
                    v.position.latitude if v.HasField("position") else None,
                    v.position.longitude if v.HasField("position") else None,
                    v.timestamp if v.HasField("timestamp") else None,
                    str(v.current_status) if v.HasField("current_status") else None,
                    path,
                )
                for v in (e.vehicle for e in message.FromString(bytes(content)).entity if e.HasField("vehicle"))
            ]
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in DECODED.split(", ")])
            frame["epoch_seconds"] = frame["epoch_seconds"].astype("Int64")
            yield frame


def decode_snapshots(snapshots: DataFrame) -> DataFrame:
    """One row per vehicle position; entities without a vehicle are skipped.

    A missing submessage gives nulls, an unset text in a present one gives ``''``.
    Coordinates are 32-bit in the feed and keep that precision. The arrival time comes
    from the file name, so decoding the same files again gives the same table. Files are
    decoded where Spark placed them, one at a time; Spark bounds the bytes it hands over at
    once (``spark.sql.execution.arrow.maxBytesPerBatch``).
    """
    return (
        snapshots.select("path", "content").mapInPandas(_positions, DECODED)
        .withColumn("vehicle_timestamp", from_epoch_seconds(F.col("epoch_seconds")))
        .withColumn("ingestion_timestamp", filename_timestamp(F.col("path")))
        .withColumn("source_file", base_name(F.col("path")))
        .select(*schemas.SNAPSHOT_POSITION.fieldNames())
    )
