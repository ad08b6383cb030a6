"""Exactly-once tables of batch outputs.

Every micro-batch writes a folder of its own, named by the batch id, in overwrite mode: a batch that is repeated after a
failure replaces its folder, so nothing is written twice. Streams that update earlier rows are read with :func:`latest`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

BATCH = "_batch"


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str, most_files: int | None = None):
    """Start ``stream`` over all input that is there now; returns the query, which ends by itself.

    Run again with the same ``checkpoint``, it goes on with what has arrived since, whether or not the run before ended well.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    """Process all input that is there now and wait for the end; a failed batch raises."""
    write_batches(stream, path, checkpoint, mode).awaitTermination()


def all_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of every batch, for streams that only append."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(path)


def latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The last version of every key, for streams that update; a batch has one row at most for a key."""
    rest = [f.name for f in schema.fields if f.name not in keys]
    row = F.max_by(F.struct(*rest), BATCH).alias("_row")
    found = all_batches(spark, path, schema).groupBy(*keys).agg(row)
    return found.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in schema.names])


def compacted(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """:func:`latest`, written once; what follows reads a table without older versions."""
    return materialize(latest(spark, path, schema, keys), "latest")
