"""One row per key over readings that keep arriving; the state of a key is dropped once the watermark has passed its time.

The time is part of the key. So a copy that arrives after its key has left the state is behind the watermark itself and is left
out: a key never comes twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ROOM, TIME
from .bins import LATENESS


def _marked(stream: DataFrame, keys: Sequence[str], time: str, lateness: str) -> DataFrame:
    if time not in keys:
        raise ValueError(f"the time {time} has to be one of the keys")
    return stream.withColumn("_event", F.col(time).cast("timestamp")).withWatermark("_event", lateness)


def drop_repeats(stream: DataFrame, keys: Sequence[str] = (TIME, ROOM), time: str = TIME, lateness: str = LATENESS) -> DataFrame:
    """The copy of each key that arrives first, at once; for append mode."""
    return _marked(stream, keys, time, lateness).dropDuplicates(["_event", *[k for k in keys if k != time]]).drop("_event")


def first_per_key(
    stream: DataFrame, tiebreak: Sequence[str], keys: Sequence[str] = (TIME, ROOM), time: str = TIME, lateness: str = LATENESS
) -> DataFrame:
    """The copy of each key that is the smallest by ``tiebreak``, then by the other columns, whichever arrives first.

    For update mode: a smaller copy replaces the one before, so the table is read with :func:`roomtide.streaming.sink.latest`.
    """
    rest = [c for c in stream.columns if c not in keys]
    row = F.min(F.struct(*tiebreak, *[c for c in rest if c not in tiebreak])).alias("_kept")
    others = [k for k in keys if k != time]
    kind = stream.schema[time].dataType
    found = _marked(stream, keys, time, lateness).groupBy("_event", *others).agg(row)
    return found.select(
        F.col("_event").cast(kind).alias(time), *others, *[F.col(f"_kept.{c}").alias(c) for c in rest]
    ).select(*stream.columns)
