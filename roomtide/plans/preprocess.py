"""From raw readings to the preprocessed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.calendar import calendar_features
from ..functions.climate import voc_co2_ratio
from ..operators.asof import asof_nearest
from ..operators.chain import Stage, filter_chain, repeats
from ..operators.cleaning import (
    convert_types,
    drop_features,
    drop_incomplete_rows,
    drop_null_time,
    extract_room,
    fast_rise_stage,
    fill_na,
    fill_radio_counts,
    frozen_stages,
    nan_to_null,
    range_condition,
    replace_inf,
)
from ..operators.forest import remove_outliers_forest
from ..operators.ordered import RowOrder
from ..operators.timeseries import resample_roll, room_diff
from ..schema import ROOM, TIME
from ..session import materialize
from ..sources.weather import clean_weather


def invalid_value_stages(columns: Sequence[str], label: str = "CO2", time: str = TIME, **limits) -> list[Stage]:
    """Range, fast-rise, zero and frozen-sensor filters, in that order, for a table with these columns."""
    risen = [c for c in ("VOC", "CO2") if c in columns]
    valid = range_condition(**limits)
    first = fast_rise_stage(risen, time=time, gate=valid) if risen else Stage(valid, {"one": "1"}, lambda now, before: now["one"] > before["one"])
    return [first, *frozen_stages(columns, label)]


def remove_invalid_values(df: DataFrame, within: Sequence[str], label: str = "CO2", time: str = TIME, room: str = ROOM) -> DataFrame:
    """:func:`invalid_value_stages` in one pass over the readings."""
    return filter_chain(df, RowOrder(df, [time, room], within), invalid_value_stages(df.columns, label, time))


def first_valid_readings(df: DataFrame, within: Sequence[str], label: str = "CO2", time: str = TIME, room: str = ROOM) -> DataFrame:
    """One reading per (time, room), then :func:`remove_invalid_values`, then without the radio columns: one shuffle, one table written.

    Of several readings the smallest by the other columns in name order stays, as in :func:`dedup_key`. Copies are neighbours in
    the order, so finding them is one more stage, and a time and room with very many copies is spread over buckets.
    """
    order = RowOrder(df, [time, room, *sorted(c for c in df.columns if c not in (time, room))], within)
    kept = drop_features(df).columns
    return filter_chain(df, order, [repeats(time, room), *invalid_value_stages(df.columns, label, time)], kept)


def preprocess(
    readings: DataFrame,
    weather: DataFrame,
    window: str = "3d",
    every: str = "1d",
    *,
    outliers: bool = True,
    roll: bool = True,
    label: str = "CO2",
    time: str = TIME,
    within: Sequence[str] = (),
    fill_counts: bool = False,
    contamination: float = 0.075,
    seed: int = 0,
    fill_direction: str = "both",
) -> DataFrame:
    """Clean readings, add weather, resample and roll per room, derive features.

    ``within=()`` checks jumps and fills gaps along the overall time order, across rooms;
    ``within=['room_number']`` keeps both inside a room. Tables that several passes read
    are written to the shared folder once.
    """
    df = nan_to_null(readings)
    df = fill_radio_counts(df) if fill_counts else df
    # Rows whose time cannot be read have no place in any order.
    df = drop_null_time(convert_types(drop_incomplete_rows(df), time), time)
    if outliers:
        df = remove_outliers_forest(df, contamination, seed=seed)
    df = first_valid_readings(extract_room(df), within, label, time)
    # Weather depends on the time alone and no filter looks at it: joined here, the tables above stay narrow.
    df = asof_nearest(df, clean_weather(weather), time, left_order=[ROOM]).drop("date", "prcp")
    df = materialize(resample_roll(df, window, every, roll, time, cut_lineage=True), "rolled")
    df = replace_inf(room_diff(df, RowOrder(df, [time], [ROOM]), label))
    df = calendar_features(df, time).withColumn("VOC_CO2_ratio", voc_co2_ratio())
    df = materialize(df, "features")
    return fill_na(df, RowOrder(df, [time, ROOM], within), direction=fill_direction)


def sort_time(df: DataFrame, time: str = TIME, room: str = ROOM) -> DataFrame:
    return df.orderBy(time, room)
