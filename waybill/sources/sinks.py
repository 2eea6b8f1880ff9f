"""Table writes: whole-table, keyed with versions, append."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from waybill.session import hand_over
from waybill.sources import appends, manifests

VERSION = re.compile(r"/version=(\d+)(?:\.([^/]+))?$")
WRITE = re.compile(r"/write=(\d+)\.([^/]+)$")


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite",
    partition_by: tuple[str, ...] = (), sort_by: tuple[str, ...] = (),
) -> None:
    """Parquet write. ``sort_by`` lays rows out in ranges of these columns, sorted in each
    file, so that readers can skip files; one hot key is split over files by the range. The
    ranges are drawn from a sample, so the rows are stored first and not computed twice."""
    if sort_by:
        df = hand_over(df)
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def append_metrics(df: DataFrame, path: str, run: str | None = None) -> None:
    """Append the metrics of a run; a run that appends again replaces its own (``read_metrics``).
    Without ``run`` every call is a run of its own."""
    appends.append(df.withColumn("run", F.lit(run or uuid.uuid4().hex)), path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """What every run appended last, with ``run``."""
    rows = appends.read(spark, path)
    last = rows.groupBy("run").agg(F.max("write").alias("write"))  # a row a run
    return rows.join(last, ["run", "write"], "left_semi").drop("write")


def folder(spark: SparkSession, path: str):
    """The file system a path lives on, and the path for it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _numbered(spark: SparkSession, path: str, pattern: re.Pattern) -> list[tuple[int, str | None, str, bool]]:
    """(number, source, folder, committed) of the folders below ``path`` that ``pattern`` names,
    ascending. A job's success marker is the commit."""
    files, location = folder(spark, path)
    if not files.exists(location):
        return []
    found = []
    for entry in files.listStatus(location):
        name = str(entry.getPath())
        if match := pattern.search(name):
            marker = spark._jvm.org.apache.hadoop.fs.Path(f"{name}/_SUCCESS")
            found.append((int(match.group(1)), match.group(2), name, files.exists(marker)))
    return sorted(found)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a keyed table, ascending."""
    return [number for number, _, _, committed in _numbered(spark, path, VERSION) if committed]


def read_merged(
    spark: SparkSession, path: str, schema: StructType, before: int | None = None
) -> DataFrame:
    """Newest committed version, optionally only versions below ``before``; empty if none."""
    usable = [name for number, _, name, committed in _numbered(spark, path, VERSION)
              if committed and (before is None or number < before)]
    if not usable:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(usable[-1])


def write_merged(df: DataFrame, path: str, source: str | None = None) -> int:
    """Write ``df`` as a new version, one above all there are, beside the one it was read from.

    Readers see it once it is complete. ``source`` names what the version adds, such as one batch
    of one query; if a committed version carries it already this is a replay, and nothing is
    written. Nothing is deleted: see ``expire_versions``.
    """
    existing = _numbered(df.sparkSession, path, VERSION)
    for number, known, _, committed in existing:
        if source is not None and known == source and committed:
            return number
    version = existing[-1][0] + 1 if existing else 0
    df.write.mode("error").parquet(f"{path}/version={version}" + (f".{source}" if source else ""))
    return version


def expire_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Delete all but the newest ``keep`` committed versions, and say which.

    Call it when no reader holds an older one.
    """
    files, _ = folder(spark, path)
    committed = [x for x in _numbered(spark, path, VERSION) if x[3]]
    old = committed[: max(0, len(committed) - max(1, keep))]
    for _, _, name, _ in old:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(name), True)
    return [number for number, *_ in old]


def write_batch(df: DataFrame, path: str, source: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append ``df`` below ``path`` as what ``source`` wrote.

    A source that writes again replaces its own folder, whatever other sources have written
    since. Folders are numbered in the order of first writing.
    """
    existing = _numbered(df.sparkSession, path, WRITE)
    own = [name for _, known, name, _ in existing if known == source]
    number = existing[-1][0] + 1 if existing else 0
    target = own[0] if own else f"{path}/write={number:010d}.{source}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)


def read_batches(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """What ``write_batch`` or ``appends.append`` has committed, with the column ``write`` that orders the writes."""
    if manifests.exists(spark, path):
        return appends.read(spark, path, schema)
    names = [name for _, _, name, committed in _numbered(spark, path, WRITE) if committed]
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    if not names and schema is not None:
        return spark.createDataFrame([], schema)
    return reader.parquet(*names)


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).option("dbtable", table).mode(mode).save()
