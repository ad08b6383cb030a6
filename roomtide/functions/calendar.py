"""Calendar and clock functions over naive timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_YEAR = 2021
UNIT_MICROS = {
    "s": 1_000_000, "min": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000,
}
DAY = UNIT_MICROS["d"]


def duration_micros(text: str) -> int:
    """Length of a fixed-size step such as ``'1d'``, ``'3d'``, ``'7h'``, ``'1min'``, ``'30s'``."""
    match = re.fullmatch(r"\s*(\d*)\s*(s|min|h|d)\s*", text.lower())
    if not match:
        raise ValueError(f"not a fixed-size step: {text!r}")
    size = int(match.group(1) or 1) * UNIT_MICROS[match.group(2)]
    if size <= 0:
        raise ValueError(f"step must be positive: {text!r}")
    return size


def micros(time: Column | str) -> Column:
    time = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(time.cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def floor_micros(value: Column, size: int) -> Column:
    return value - F.pmod(value, F.lit(size))


def floor_time(time: Column | str, every: str) -> Column:
    return from_micros(floor_micros(micros(time), duration_micros(every)))


def year_index(time: Column | str, base: int = BASE_YEAR) -> Column:
    return F.year(time) - F.lit(base)


def day_of_week(time: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(time)


def season(time: Column | str) -> Column:
    month = F.month(time)
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .when(month.isin(9, 10, 11), "fall")
    )


def hour_label(hour: Column | str) -> Column:
    return F.format_string("%02d:00", F.col(hour) if isinstance(hour, str) else hour)


def hour_fraction(time: Column | str) -> Column:
    """Time of day in decimal hours."""
    return F.pmod(micros(time), F.lit(DAY)) / F.lit(float(UNIT_MICROS["h"]))


def calendar_features(df: DataFrame, time: str = "date_time", base: int = BASE_YEAR) -> DataFrame:
    return df.withColumns(
        {
            "year": year_index(time, base),
            "dayofweek": day_of_week(time),
            "hour": F.hour(time),
            "season": season(time),
        }
    )
