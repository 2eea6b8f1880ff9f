"""Append logs: batches as folders named by a manifest, small ones merged into larger ones.

Every append is a folder of level 0. As soon as ``FAN`` folders of a level exist they are merged into one of the
next, so the live folders of n appends are at most FAN - 1 on each of about log(n) levels, a row is rewritten
once a level, and neither readers nor writers list more than that. A merge is a commit of its own: readers see
all its rows once, before or after.

Rows carry ``write``, the number of the append they came with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from waybill.sources import manifests

FAN = 8
FILE_BYTES = 128 << 20
SORTED_ROWS = 500_000  # rows a task of a merge by partition values sorts, about


def append(df: DataFrame, path: str, source: str | None = None, partition_by: tuple[str, ...] = ()) -> bool:
    """Appends ``df`` unless ``source``, one batch of one query, is in the log already; says whether it did."""
    spark = df.sparkSession
    _, content = manifests.newest(spark, path)
    if manifests.committed(content, source):
        return False
    number = content.get("next", 0)
    name = _new()
    df.withColumn("write", F.lit(number).cast("long")).write.partitionBy(*partition_by).parquet(f"{path}/{name}")

    def change(content: dict) -> dict:
        content["live"][name] = {"name": name, "level": 0}
        content["next"] = max(content.get("next", 0), number + 1)
        content["partition_by"] = list(partition_by)
        return content

    if manifests.commit(spark, path, change, source) is None:
        return False
    merge_full_levels(spark, path)
    return True


def _new() -> str:
    return f"data/folder={uuid.uuid4().hex}"


def merge_full_levels(spark: SparkSession, path: str) -> int:
    """Merges levels that have ``FAN`` folders, lowest first; the number of merges."""
    merges = 0
    while True:
        _, content = manifests.newest(spark, path)
        levels: dict[int, list[str]] = {}
        for name, entry in content.get("live", {}).items():
            levels.setdefault(entry["level"], []).append(name)
        full = min((level for level, names in levels.items() if len(names) >= FAN), default=None)
        if full is None:
            return merges
        _merge(spark, path, sorted(levels[full]), full + 1, content["partition_by"])
        merges += 1


def _merge(spark: SparkSession, path: str, names: list[str], level: int, partition_by: list[str]) -> None:
    merged = _new()
    size = sum(manifests.folder_files(spark, f"{path}/{name}")[1] for name in names)
    files = max(1, -(-size // FILE_BYTES))
    rows = _rows(spark, path, names)
    if rows is None:
        spark.createDataFrame([], "write long").write.parquet(f"{path}/{merged}")
    else:
        # files compress well, so their size says little of the memory their rows take when sorted by partition values
        files = max(files, -(-rows.count() // SORTED_ROWS)) if partition_by else files
        # a partition value with very many rows goes to up to `files` files
        part = [*partition_by, F.pmod(F.xxhash64(*(c for c in rows.columns if c not in partition_by)), F.lit(files))]
        dealt = rows.repartition(files, *part) if partition_by else rows.coalesce(files)
        dealt.write.partitionBy(*partition_by).parquet(f"{path}/{merged}")

    def change(content: dict) -> dict | None:
        if not all(name in content["live"] for name in names):
            return None  # merged by another writer
        for name in names:
            del content["live"][name]
        content["live"][merged] = {"name": merged, "level": level}
        return content

    manifests.commit(spark, path, change)


def _rows(spark: SparkSession, path: str, names: list[str], schema: StructType | None = None) -> DataFrame | None:
    """Rows of some folders; without a schema it is that of the first folder that has a file of rows."""
    reader = spark.read.option("basePath", f"{path}/data")
    if schema is None:
        usable = [n for n in names if _has_rows(spark, f"{path}/{n}")]
        return reader.parquet(*(f"{path}/{n}" for n in usable)).drop("folder") if usable else None
    added = [] if "write" in schema.fieldNames() else [StructField("write", LongType())]
    return reader.schema(StructType(schema.fields + added)).parquet(*(f"{path}/{n}" for n in names)).drop("folder") if names else None


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a folder has more files than its marker: partitioned writes of no rows leave none."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = location.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(location, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def live_folders(spark: SparkSession, path: str) -> list[str]:
    return sorted(manifests.newest(spark, path)[1].get("live", {}))


def read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows of the log as of now, with ``write``."""
    rows = _rows(spark, path, live_folders(spark, path), schema)
    if rows is not None:
        return rows
    if schema is None:
        raise ValueError(f"nothing is stored in {path}")
    added = [] if "write" in schema.fieldNames() else [StructField("write", LongType())]
    return spark.createDataFrame([], StructType(schema.fields + added))
