"""Queries over the streaming operators: whole tables arrive in slices of time, and each slice is a run of its own.

Every run starts anew from the checkpoint folder, so state, watermark and source offsets are restored each time. The twins are
those of the batch operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.session import new_path
from roomtide.streaming import bins, changes, dedup, sink

from . import views
from .registry import ORACLES, query

SLICES = 3


def arrive(df: DataFrame, run: Callable[[DataFrame], None], slices: int = SLICES, time: str = "date_time") -> None:
    """Write ``df`` to a folder in slices of equal time ranges; ``run`` gets a stream of the folder after each slice."""
    spark = df.sparkSession
    folder = new_path(spark, "arrivals")
    at = F.unix_micros(F.col(time).cast("timestamp"))
    first, last = df.agg(F.min(at), F.max(at)).first()
    cut = at if first is None else F.least(F.floor((at - first) * slices / F.lit(last - first + 1)), F.lit(slices - 1))
    for i in range(slices):
        df.filter(cut == i).write.mode("append").parquet(folder)
        run(spark.readStream.schema(df.schema).parquet(folder))


def _means(spark: SparkSession, sf: str, every: str, columns: list[str]) -> DataFrame:
    path, checkpoint = new_path(spark, "stream-bins"), new_path(spark, "stream-state")
    schemas = []
    df = views.rooms(spark, sf).select("date_time", "room_number", *columns)
    arrive(df, lambda stream: schemas.append(bins.update_means(stream, every, columns, path, checkpoint)))
    return bins.read_means(spark, path, schemas[-1], every, columns)


@query("stream_resample_mean", ORACLES["resample_mean"])
def _(spark, sf):
    return _means(spark, sf, "1d", ["CO2", "tmp", "BLE"])


@query("stream_resample_mean_odd_size", ORACLES["resample_mean_odd_size"])
def _(spark, sf):
    return _means(spark, sf, "7h", ["CO2"])


def _to_end(spark: SparkSession, df: DataFrame, operator: Callable[[DataFrame], DataFrame], mode: str) -> tuple[str, DataFrame]:
    path, checkpoint, streams = new_path(spark, "stream-rows"), new_path(spark, "stream-state"), []

    def run(stream: DataFrame) -> None:
        streams.append(operator(stream))
        sink.run_to_end(streams[-1], path, checkpoint, mode)

    arrive(df, run)
    return path, streams[-1]


@query("stream_dedup_key", ORACLES["dedup_key"])
def _(spark, sf):
    path, rows = _to_end(spark, views.readings_dup(spark, sf), lambda s: dedup.first_per_key(s, ["event_id"]), "update")
    return sink.latest(spark, path, rows.schema, ["date_time", "room_number"])


@query("stream_drop_repeats", "SELECT DISTINCT date_time, room_number FROM readings_dup", ("readings_dup",))
def _(spark, sf):
    path, rows = _to_end(spark, views.readings_dup(spark, sf), dedup.drop_repeats, "append")
    return sink.all_batches(spark, path, rows.schema).select("date_time", "room_number")


@query("stream_room_diff", ORACLES["room_diff"])
def _(spark, sf):
    changes.use_keyed_state(spark)
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number", "CO2", "tmp", "vis")
    path, rows = _to_end(spark, df, lambda s: changes.stream_room_diff(s, ["event_id"]), "append")
    return sink.all_batches(spark, path, rows.schema).drop(sink.BATCH)


@query("stream_drop_fast_rise_by_room", ORACLES["drop_fast_rise_by_room"])
def _(spark, sf):
    changes.use_keyed_state(spark)
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number", "CO2", "VOC")
    path, rows = _to_end(spark, df, lambda s: changes.stream_drop_fast_rise(s, ["event_id"]), "append")
    return sink.all_batches(spark, path, rows.schema).drop(sink.BATCH)
