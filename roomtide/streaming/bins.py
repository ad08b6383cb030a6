"""Bin means over readings that keep arriving.

The state store keeps, per series and small bin, what adds up to a mean; a bin leaves it once the watermark has passed. Every
micro-batch hands on the bins it touched, so the table is up to date after each batch, and readings may arrive in any order
within ``lateness``. Later ones are left out, as everywhere in Spark.

Bins that do not divide a day count from the first day of their series, which a stream learns last. So the stream keeps bins
of the common divisor of step and day; the reader moves them to their series' marks, by the code the batch operator uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import duration_micros
from ..operators.timeseries import common_step, mean_of, merged_bins, with_empty_bins
from ..schema import ROOM, TIME
from .sink import compacted, run_to_end

LATENESS = "10 minutes"


def stream_bins(
    stream: DataFrame, every: str, columns: Sequence[str], time: str = TIME, by: Sequence[str] = (ROOM,), lateness: str = LATENESS
) -> DataFrame:
    """``by``, ``_bin`` and the parts of each column's mean, for update mode."""
    marked = stream.withColumn("_event", F.col(time).cast("timestamp")).withWatermark("_event", lateness)
    window = F.window("_event", f"{common_step(duration_micros(every))} microseconds").alias("_window")
    parts = [c.alias(n) for a in map(mean_of, columns) for n, c in zip(a.part_names(), a.parts.values(), strict=True)]
    binned = marked.groupBy(*by, window).agg(*parts)
    kept = [F.col(f"`{n}`") for a in map(mean_of, columns) for n in a.part_names()]
    return binned.select(*by, F.unix_micros("_window.start").alias("_bin"), *kept)


def update_means(
    stream: DataFrame,
    every: str,
    columns: Sequence[str],
    path: str,
    checkpoint: str,
    time: str = TIME,
    by: Sequence[str] = (ROOM,),
    lateness: str = LATENESS,
) -> T.StructType:
    """Take in all readings that are there now; the schema returned is for :func:`read_means`."""
    binned = stream_bins(stream, every, columns, time, by, lateness)
    run_to_end(binned, path, checkpoint, "update")
    return binned.schema


def read_means(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    every: str,
    columns: Sequence[str],
    time: str = TIME,
    by: Sequence[str] = (ROOM,),
) -> DataFrame:
    """The means so far, one row for each bin between the first and the last reading of a series; empty bins are missing."""
    step = duration_micros(every)
    small = compacted(spark, path, schema, [*by, "_bin"])
    binned = merged_bins(small, step, [mean_of(c) for c in columns], by)
    ends = binned.groupBy(*by).agg(F.min("_bin").alias("_first"), F.max("_bin").alias("_last"))
    return with_empty_bins(binned, ends.filter(F.col("_first").isNotNull()), step, time, by)
