"""Parquet tables between the stages of a pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.cleaning import nan_to_null
from ..schema import ROOM


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table; NaN, which would spoil every mean, becomes NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return nan_to_null(reader.parquet(path))


def sink_parquet(df: DataFrame, path: str, partition_by: str | None = ROOM, mode: str = "errorifexists") -> None:
    """Write a table partitioned by room.

    The rebalance hint gathers each room's rows into few files and lets adaptive execution
    split a room that is too large for one task.
    """
    if partition_by is None:
        df.write.mode(mode).parquet(path)
    else:
        df.hint("rebalance", partition_by).write.mode(mode).partitionBy(partition_by).parquet(path)
