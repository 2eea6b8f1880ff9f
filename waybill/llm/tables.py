"""Tables in the folder all executors share, and fixed-size summaries summed over partitions."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from waybill.session import scratch_path


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs started within hand Python few rows at a time, so that batches of texts take little memory on either side."""
    before = spark.conf.get(BATCH_ROWS)
    use_small_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def use_small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """The same for all jobs from now on, for a frame whose reader starts the job."""
    before = int(spark.conf.get(BATCH_ROWS))
    spark.conf.set(BATCH_ROWS, str(min(rows, before) if before > 0 else rows))


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.shared_path = path
    return kept


def forget(*kept: DataFrame) -> None:
    """Deletes kept tables that nothing reads any more."""
    for df in kept:
        spark: SparkSession = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.shared_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of finished steps, which it does when the driver
    collects its garbage; a long job would otherwise hold the files of all its steps."""
    gc.collect()
    spark._jvm.System.gc()


_REMEMBERED: dict = {}


def remembered(owner, make=dict):
    """What this worker process keeps between tasks for ``owner``. It keeps one thing at a time: what another owner
    left is dropped, and its memory given back, as processes serve one job after the other."""
    if owner not in _REMEMBERED:
        _REMEMBERED.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
        _REMEMBERED[owner] = make()
    return _REMEMBERED[owner]


def summed(parts: DataFrame, dtype, join=np.add) -> np.ndarray | None:
    """Element-wise sum of equally long arrays, one binary row a partition, through a tree.

    The arrays have a fixed length, so the driver gets a few of them whatever the input's size.
    """
    def merge(a: bytes, b: bytes) -> bytes:
        if not a or not b:
            return bytes(a or b)
        return join(np.frombuffer(a, dtype), np.frombuffer(b, dtype)).tobytes()

    with small_batches(parts.sparkSession):
        total = parts.rdd.map(lambda row: bytes(row[0])).treeAggregate(b"", merge, merge, depth=4)
    return np.frombuffer(total, dtype) if total else None


BLOOM_BITS = 24


def _slots(values: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    values = values.astype(np.uint64, copy=False)
    mask = np.uint64((1 << bits) - 1)
    return values & mask, (values >> np.uint64(24)) & mask, (values * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & mask


def membership(values: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """A Bloom filter of one column of mixed 64-bit values. Its size is fixed (2 MB), so it can be
    broadcast whatever the number of values; a full one lets more pass and loses nothing."""
    def part(batches):
        found = np.zeros(1 << bits, bool)
        for batch in batches:
            for slot in _slots(batch.column(0).to_numpy(zero_copy_only=False), bits):
                found[slot] = True
        yield pa.RecordBatch.from_pydict({"part": pa.array([np.packbits(found).tobytes()], pa.binary())})

    total = summed(values.dropna().mapInArrow(part, "part binary"), np.uint8, np.bitwise_or)
    return np.zeros(1 << bits >> 3, np.uint8) if total is None else total


def may_contain(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    bits = (len(bitmap) * 8).bit_length() - 1
    hit = np.ones(len(values), bool)
    for slot in _slots(values, bits):
        hit &= (bitmap[slot >> np.uint64(3)] >> (np.uint64(7) - (slot & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return hit
