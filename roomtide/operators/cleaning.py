"""Row and column cleaning of sensor readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import DAY, UNIT_MICROS, micros
from ..functions.text import number, quoted
from ..schema import RADIO_COLUMNS, ROOM, TIME, WEATHER_MEASURES, ZERO_CHECKED
from .chain import Stage, filter_chain
from .ordered import RowOrder


def _replaced(df: DataFrame, values: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{values[c]} AS {quoted(c)}" if c in values else quoted(c) for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark aggregates skip NULL but propagate NaN, so NaN is turned into NULL on ingest."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return _replaced(df, {c: f"nanvl({quoted(c)}, NULL)" for c in floats})


def drop_incomplete_rows(df: DataFrame, max_null_fraction: float | None = None) -> DataFrame:
    """Drop rows with any missing value, or with more than the given share of missing values."""
    if max_null_fraction is None:
        return df.dropna("any")
    missing = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    return df.filter(missing <= F.lit(max_null_fraction * len(df.columns)))


def fill_radio_counts(df: DataFrame, columns: Sequence[str] = ("WIFI", "BLE")) -> DataFrame:
    return df.fillna(0, [c for c in columns if c in df.columns])


def drop_null_time(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.filter(F.col(time).isNotNull())


def convert_types(df: DataFrame, time: str = TIME) -> DataFrame:
    """Parse the timestamp and the signal-to-noise ratio; an unreadable value becomes NULL."""
    df = drop_null_time(df, time)
    if isinstance(df.schema[time].dataType, T.StringType):
        df = df.withColumn(time, F.try_to_timestamp(time).cast("timestamp_ntz"))
    if "snr" in df.columns:
        df = df.withColumn("snr", F.col("snr").try_cast("double"))
    return df


def extract_room(df: DataFrame, device: str = "device_id", room: str = ROOM) -> DataFrame:
    """The room is the last ``-`` token of the device id."""
    return df.withColumn(room, F.substring_index(device, "-", -1))


def extract_building(df: DataFrame, room: str = ROOM) -> DataFrame:
    return df.withColumn("building_name", F.regexp_replace(room, "[0-9]+", ""))


def filter_building(df: DataFrame, building: str = "m") -> DataFrame:
    return df.filter(F.col("building_name") == building)


def dedup_key(
    df: DataFrame, keys: Sequence[str] = (TIME, ROOM), tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row of each key.

    The first row is the smallest by ``tiebreak``, then by the other columns; without a
    tiebreak by all other columns in name order. An aggregate, not a window: copies of one
    key collapse before the shuffle, so a key that holds a large share of the rows never
    gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ties = list(tiebreak) if tiebreak is not None else sorted(rest)
    kept = F.min(F.struct(*ties, *[c for c in rest if c not in ties])).alias("_kept")
    return df.groupBy(*keys).agg(kept).select(*[c if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def dedup_full(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_features(df: DataFrame, columns: Sequence[str] = RADIO_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def range_condition(max_hum: float = 100.0, min_tmp: float = 10.0, max_tmp: float = 50.0) -> str:
    return f"hum <= {number(max_hum)} AND tmp BETWEEN {number(min_tmp)} AND {number(max_tmp)}"


def range_validity(df: DataFrame, **limits: float) -> DataFrame:
    """Readings within the limits of :func:`range_condition`."""
    return df.filter(range_condition(**limits))


def risen_fast(
    previous: Mapping[str, str], previous_time: str, rise: float, seconds: int, whole_delta: bool, time: str
) -> Column:
    """Whether any value rose by ``rise`` or more since the previous row (``column: column of its value before``)."""
    step = micros(time) - micros(previous_time)
    if not whole_delta:
        step = F.pmod(step, F.lit(DAY))
    quick = F.floor(step / F.lit(UNIT_MICROS["s"])) < seconds
    risen = F.lit(False)
    for c, before in previous.items():
        risen = risen | ((F.col(c) - F.col(before)) >= rise)
    return F.coalesce(risen & quick, F.lit(False))


def drop_fast_rise(
    df: DataFrame,
    order: RowOrder,
    columns: Sequence[str] = ("VOC", "CO2"),
    rise: float = 1000.0,
    seconds: int = 60,
    whole_delta: bool = False,
    time: str = TIME,
) -> DataFrame:
    """Drop a row whose value rose by ``rise`` or more since the previous row within ``seconds``.

    By default only the seconds part of the time step counts, so a step of one day and
    30 s is taken as 30 s; ``whole_delta`` compares the whole step.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    df = order.shift(
        order.attach(df), {"_time": (time, 1), **{f"_prev{i}": (c, 1) for i, c in enumerate(present)}}
    )
    kept = df.filter(~risen_fast({c: f"_prev{i}" for i, c in enumerate(present)}, "_time", rise, seconds, whole_delta, time))
    return order.detach(kept.drop("_time", *[f"_prev{i}" for i in range(len(present))]))


def drop_zero_readings(df: DataFrame, columns: Sequence[str] = ZERO_CHECKED) -> DataFrame:
    """Drop rows in which any of the columns is 0; a missing value is not a zero."""
    for c in columns:
        if c in df.columns:
            df = df.filter(F.coalesce(F.col(c) != 0, F.lit(True)))
    return df


def fast_rise_stage(
    columns: Sequence[str], rise: float = 1000.0, seconds: int = 60, whole_delta: bool = False, time: str = TIME, gate: str = "true"
) -> Stage:
    """:func:`drop_fast_rise` as a stage of a chain."""
    values = {f"c{i}": f"CAST({quoted(c)} AS DOUBLE)" for i, c in enumerate(columns)}
    at = f"unix_micros(CAST({quoted(time)} AS TIMESTAMP))"

    def risen(now, before):
        step = now["at"] - before["at"]
        quick = (step if whole_delta else step % DAY) < seconds * UNIT_MICROS["s"]
        found = now["c0"] - before["c0"] >= rise
        for c in list(values)[1:]:
            found = found | (now[c] - before[c] >= rise)
        return found & quick

    return Stage(gate, {**values, "at": at}, risen)


def frozen_stages(
    columns: Sequence[str], label: str = "CO2", spike: float = 20_000.0, frozen: Sequence[str] = ("VOC", "BLE", "tmp")
) -> list[Stage]:
    """:func:`drop_frozen_spikes` as stages of a chain, for a table with these columns."""
    def nonzero(names: Sequence[str]) -> str:
        return " AND ".join(["true", *[f"coalesce({quoted(c)} <> 0, true)" for c in names if c in columns]])

    values = {"CO2": "CAST(CO2 AS DOUBLE)"} | {f"f{i}": f"CAST({quoted(c)} AS DOUBLE)" for i, c in enumerate(frozen)}

    def stuck(now, before):
        found = now["CO2"] > spike
        for i in range(len(frozen)):
            found = found & (now[f"f{i}"] == before[f"f{i}"])
        return found

    checkable = all(c in columns for c in ("CO2", *frozen))
    if not checkable:
        if label not in ZERO_CHECKED:
            raise ValueError(f"columns missing for the frozen-sensor check: {', '.join(c for c in ('CO2', *frozen) if c not in columns)}")
        return [Stage(nonzero(ZERO_CHECKED), {"one": "1"}, lambda now, before: now["one"] > before["one"])]
    if label not in ZERO_CHECKED:
        return [Stage(nonzero(ZERO_CHECKED), values, stuck)]
    # One zero filter and one check for each measure in turn come to these two.
    return [Stage(nonzero([c for c in ZERO_CHECKED if c != "hum"]), values, stuck), Stage(nonzero(["hum"]), values, stuck)]


def drop_frozen_spikes(
    df: DataFrame,
    order: RowOrder,
    label: str = "CO2",
    spike: float = 20_000.0,
    frozen: Sequence[str] = ("VOC", "BLE", "tmp"),
) -> DataFrame:
    """Drop zero readings, and rows whose CO2 is extreme while the other sensors stand still.

    With a label outside the zero-checked measures there is one check after all zero
    filters. With a label among them the zero filters and the frozen check alternate
    once per measure; that equals two checks, with the humidity filter in between. Both run in one pass.
    """
    if not all(c in df.columns for c in ("CO2", *frozen)) and label in ZERO_CHECKED:
        return drop_zero_readings(df)
    return filter_chain(df, order, frozen_stages(df.columns, label, spike, frozen))


def fill_na(
    df: DataFrame, order: RowOrder, columns: Sequence[str] | None = None, direction: str = "both"
) -> DataFrame:
    """Changes (``*_diff``) become 0; other columns are filled backward, then forward, along ``order``.

    ``direction='forward'`` uses past values only.
    """
    columns = list(columns) if columns is not None else df.columns
    changes = [c for c in columns if "_diff" in c]
    df = df.fillna(0, changes) if changes else df
    rest = [c for c in columns if c not in changes and c not in order.keys]
    if not rest:
        return df
    return order.detach(order.fill_gaps(order.attach(df), rest, both=direction == "both"))


def replace_inf(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return _replaced(df, {c: f"CASE WHEN abs({quoted(c)}) = double('inf') THEN 0D ELSE {quoted(c)} END" for c in floats})


def select_variants(df: DataFrame) -> dict[str, DataFrame]:
    """The three feature sets compared by the forecast: all, without weather, without season."""
    weather = WEATHER_MEASURES + [f"{c}_diff" for c in WEATHER_MEASURES]
    return {"full": df, "no_weather": df.drop(*weather), "no_season": df.drop("season")}


def split_features_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(label), df.select(label)
