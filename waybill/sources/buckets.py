"""Keyed tables in hash buckets: an update rewrites the buckets of its keys and leaves all others as they are.

A key's bucket is a hash of the key modulo a number fixed when the table is made; choose it so that a bucket, the
table's size over that number, is about a file. A manifest names the live folder of every bucket.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from waybill.operators.merge import OVERWRITE, keyed_merge
from waybill.session import hand_over
from waybill.sources import manifests

BUCKETS = 64


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert(
    updates: DataFrame, path: str, keys: list[str], schema: StructType, policy: str = OVERWRITE,
    source: str | None = None, buckets: int = BUCKETS, **times: str,
) -> list[int]:
    """Merges ``updates``, one row per key, into the table by ``policy`` of ``keyed_merge``; the buckets rewritten.

    Nothing is written for a ``source`` (one batch of one query) that the table has taken in already.
    """
    spark = updates.sparkSession
    number, content = manifests.newest(spark, path)
    if manifests.committed(content, source):
        return []
    buckets = content.get("buckets", buckets)
    updates = hand_over(updates.select(*schema.fieldNames()))  # read twice
    touched = sorted(r[0] for r in updates.select(_bucket(keys, buckets)).distinct().collect())  # at most ``buckets``
    names = {}
    if touched:
        stored = _read(spark, path, [content["live"][str(b)] for b in touched if str(b) in content.get("live", {})], schema)
        merged = keyed_merge(stored, updates, keys, policy, **times).withColumn("bucket", _bucket(keys, buckets))
        written = f"data/{uuid.uuid4().hex}"
        merged.repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(f"{path}/{written}")
        names = {str(b): f"{written}/bucket={b}" for b in touched}

    def change(after: dict) -> dict:
        if after["live"] != content.get("live", {}):
            raise RuntimeError(f"another writer changed {path} meanwhile")
        after["live"] |= names
        after["buckets"] = buckets
        return after

    manifests.commit(spark, path, change, source)
    return touched


def _read(spark: SparkSession, path: str, names: list[str], schema: StructType) -> DataFrame:
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{name}" for name in names))


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table as of the newest commit."""
    live = manifests.newest(spark, path)[1].get("live", {})
    return _read(spark, path, [live[b] for b in sorted(live, key=int)], schema)
