"""Dashboard tables: hourly and daily profiles, counts and selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ROOM, TIME

ALL_ROOMS = "all"
SHOWN_MEASURES = 2


def select_measures(measures: Sequence[str]) -> list[str]:
    """The dashboard's rule: its charts show at most the first two measures."""
    return list(measures)[:SHOWN_MEASURES]


def _scopes(rooms: Sequence[str], room: str) -> Column:
    """The series a row counts for: its own room if selected, and all rooms if asked for."""
    chosen = [r for r in rooms if r != ALL_ROOMS]
    own = F.when(F.col(room).isin(chosen), F.col(room)) if chosen else F.lit(None).cast("string")
    both = F.lit(ALL_ROOMS) if ALL_ROOMS in rooms else F.lit(None).cast("string")
    return F.array_compact(F.array(both, own))


def _wanted(df: DataFrame, rooms: Sequence[str], room: str) -> DataFrame:
    return df if ALL_ROOMS in rooms else df.filter(F.col(room).isin(list(rooms)) if rooms else F.lit(False))


def select_rooms(df: DataFrame, rooms: Sequence[str], room: str = ROOM) -> DataFrame:
    """One copy of a row for each series it belongs to, named in ``scope``."""
    return _wanted(df, rooms, room).withColumn("scope", F.explode(_scopes(rooms, room)))


def _profile(df: DataFrame, key: Column, name: str, rooms: Sequence[str], measures: Sequence[str], room: str) -> DataFrame:
    """Means per key and series. Readings are summed once per (key, room); series are added up from that."""
    sums = _wanted(df, rooms, room).groupBy(key.alias(name), room).agg(
        *[F.sum(m).alias(f"_s{i}") for i, m in enumerate(measures)],
        *[F.count(m).alias(f"_n{i}") for i, m in enumerate(measures)],
    )
    return (
        sums.withColumn("scope", F.explode(_scopes(rooms, room)))
        .groupBy("scope", name)
        .agg(*[F.try_divide(F.sum(f"_s{i}"), F.sum(f"_n{i}")).alias(m) for i, m in enumerate(measures)])
    )


def hourly_profile(
    df: DataFrame, rooms: Sequence[str] = (ALL_ROOMS,), measures: Sequence[str] = ("tmp",), time: str = TIME, room: str = ROOM
) -> DataFrame:
    return _profile(df, F.hour(time), "hour", rooms, measures, room)


def select_date(df: DataFrame, date: str, time: str = TIME) -> DataFrame:
    """Rows of one calendar day; text that is no date selects nothing.

    Written as a time range so that it reaches the parquet scan.
    """
    day = F.try_to_timestamp(F.lit(date)).cast("date")
    start = day.cast("timestamp_ntz")
    end = F.date_add(day, 1).cast("timestamp_ntz")
    return df.filter((F.col(time) >= start) & (F.col(time) < end))


def hourly_profile_for_day(
    df: DataFrame, date: str, rooms: Sequence[str] = (ALL_ROOMS,), measures: Sequence[str] = ("tmp",), time: str = TIME, room: str = ROOM
) -> DataFrame:
    return hourly_profile(select_date(df, date, time), rooms, measures, time, room)


def daily_means(
    df: DataFrame, rooms: Sequence[str] = (ALL_ROOMS,), measures: Sequence[str] = ("tmp",), time: str = TIME, room: str = ROOM
) -> DataFrame:
    return _profile(df, F.to_date(time), "date", rooms, measures, room)


def daily_counts(df: DataFrame, rooms: Sequence[str] = (ALL_ROOMS,), time: str = TIME, room: str = ROOM) -> DataFrame:
    counted = _wanted(df, rooms, room).groupBy(F.to_date(time).alias("date"), room).agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.withColumn("scope", F.explode(_scopes(rooms, room)))
        .groupBy("scope", "date")
        .agg(F.sum("n").alias("n"))
    )


def distinct_rooms(df: DataFrame, room: str = ROOM) -> DataFrame:
    return df.select(room).distinct().orderBy(room)


def date_range(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.agg(F.to_date(F.min(time)).alias("first_date"), F.to_date(F.max(time)).alias("last_date"))


def latest_predictions(predictions: DataFrame, history: DataFrame, time: str = TIME, room: str = ROOM) -> DataFrame:
    """Predictions made at the newest time of the training table, by room."""
    newest = history.agg(F.max(time).alias("newest")).first().newest
    return predictions.filter(F.col(time) == F.lit(newest).cast("timestamp_ntz")).orderBy(room)
