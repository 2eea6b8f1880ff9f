"""Streams of transport records: key, value, partition, offset, timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.schemas import RECORD


def event_source(
    spark: SparkSession, fmt: str = "kafka", starting: str = "earliest",
    fail_on_data_loss: bool = False, **options: str,
) -> DataFrame:
    """A topic, or files with the same columns (``fmt`` parquet or json, option ``path``).

    For a topic give ``servers`` and ``topic``; other options go to the reader as they are.
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", options.pop("servers"))
            .option("subscribe", options.pop("topic"))
            .option("startingOffsets", starting)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
        )
        return reader.options(**options).load()
    return spark.readStream.format(fmt).schema(RECORD).options(**options).load()
