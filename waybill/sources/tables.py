"""Table reads that refuse missing, empty or incomplete input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_scan(
    spark: SparkSession, path: str, schema: StructType | None = None, required: tuple[str, ...] = ()
) -> DataFrame:
    """Parquet scan. With a ``schema`` partition columns keep their declared type.

    Errors: no such path, a required column absent from the files, no rows.
    """
    stored = spark.read.parquet(path)
    missing = [name for name in required if name not in stored.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    df = spark.read.schema(schema).parquet(path) if schema is not None else stored
    if df.isEmpty():
        raise ValueError(f"table is empty: {path}")
    return df


def jdbc_scan(spark: SparkSession, table: str, options: dict[str, str]) -> DataFrame:
    """Read a database table. Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` in the options to spread a large table over tasks."""
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def spread_files(df: DataFrame, key: str) -> DataFrame:
    """Give a table that sits in fewer files than there are cores to all cores.

    One file with one row group is one task, however many cores are idle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if len(df.inputFiles()) < cores else df
