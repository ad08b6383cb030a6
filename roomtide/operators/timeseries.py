"""Time bins, gaps and rolling means."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import (
    DAY,
    day_of_week,
    duration_micros,
    floor_micros,
    from_micros,
    hour_fraction,
    micros,
)
from ..functions.text import quoted
from ..schema import LECTURE_SLOTS, ROOM, TIME, WEEKDAYS, numeric_columns
from ..session import materialize
from .cleaning import drop_incomplete_rows
from .ordered import RowOrder
from .outliers import iqr_replace

CHUNK_BINS = 4096


def _range_of(df: DataFrame, step: int, time: str, by: Sequence[str]) -> DataFrame:
    """First and last bin of each series, counted from 1970."""
    ends = df.groupBy(*by).agg(F.min(micros(time)).alias("_min"), F.max(micros(time)).alias("_max"))
    ends = ends.filter(F.col("_min").isNotNull())
    return ends.select(*by, floor_micros(F.col("_min"), step).alias("_first"), floor_micros(F.col("_max"), step).alias("_last"))


@dataclass(frozen=True)
class Aggregate:
    """An aggregate of a bin, in one step or in two: ``parts`` of a small bin add up to the value of a larger one."""

    name: str
    direct: Column
    parts: dict[str, Column]
    merged: Callable[[list[str]], Column]

    def part_names(self) -> list[str]:
        return [f"{self.name}#{p}" for p in self.parts]


def mean_of(column: str) -> Aggregate:
    def merged(parts: list[str]) -> Column:
        total, count = (F.sum(F.col(quoted(p))) for p in parts)
        return F.try_divide(total, count)

    source = F.col(quoted(column))
    return Aggregate(column, F.avg(source), {"sum": F.sum(source), "n": F.count(source)}, merged)


def first_of(column: str, order: Sequence[str]) -> Aggregate:
    """The first value that is not missing, by ``order``."""
    source = F.col(quoted(column))
    row = F.when(source.isNotNull(), F.struct(*[F.col(quoted(o)).alias(f"o{i}") for i, o in enumerate(order)], source.alias("value")))
    return Aggregate(
        column,
        F.min_by(source, F.when(source.isNotNull(), F.struct(*[F.col(quoted(o)) for o in order]))),
        {"first": F.min(row)},
        lambda parts: F.min(F.col(quoted(parts[0])))["value"],
    )


def rows_of(name: str) -> Aggregate:
    count = F.count(F.lit(1))
    return Aggregate(name, count, {"n": count}, lambda parts: F.sum(F.col(quoted(parts[0]))))


def common_step(step: int) -> int:
    """Bins of this size start at midnight and fill a bin of ``step`` exactly, whatever day that counts from."""
    return math.gcd(step, DAY)


def small_bins(df: DataFrame, step: int, aggregates: Sequence[Aggregate], time: str, by: Sequence[str]) -> DataFrame:
    """The parts of all aggregates per series and bin of the common step, as ``_bin`` in microseconds."""
    binned = df.filter(F.col(time).isNotNull()).withColumn("_bin", floor_micros(micros(time), common_step(step)))
    return binned.groupBy(*by, "_bin").agg(*[c.alias(n) for a in aggregates for n, c in zip(a.part_names(), a.parts.values(), strict=True)])


def merged_bins(small: DataFrame, step: int, aggregates: Sequence[Aggregate], by: Sequence[str]) -> DataFrame:
    """Bins of ``step`` that count from midnight of each series' first day, from :func:`small_bins`.

    Only the small bins, one row for each, meet their series' first day; readings do not.
    """
    if step != common_step(step):
        first = floor_micros(F.min("_bin"), DAY).alias("_origin")
        if by:
            origins = small.groupBy(*by).agg(first).select(*[F.col(k).alias(f"_k_{k}") for k in by], "_origin")
            match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by]
            small = small.join(origins, match).drop(*[f"_k_{k}" for k in by])
        else:
            small = small.withColumn("_origin", F.lit(small.agg(first).first()["_origin"]))
        small = small.withColumn("_bin", F.col("_origin") + floor_micros(F.col("_bin") - F.col("_origin"), step))
    return small.groupBy(*by, "_bin").agg(*[a.merged(a.part_names()).alias(a.name) for a in aggregates])


def _with_bin(df: DataFrame, step: int, time: str) -> DataFrame:
    """Add ``_bin``, the start of each row's bin in microseconds, counted from 1970."""
    return df.filter(F.col(time).isNotNull()).withColumn("_bin", floor_micros(micros(time), step))


def _spread(ends: DataFrame, step: int, by: Sequence[str]) -> DataFrame:
    """Every bin from ``_first`` to ``_last``, in chunks, so that many tasks generate one long series."""
    chunk = step * CHUNK_BINS
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = ends.select(
        *by, "_last", F.explode(F.sequence("_first", "_last", F.lit(chunk))).alias("_chunk")
    ).repartition(parts, *by, "_chunk")
    last = F.least(F.col("_chunk") + (chunk - step), F.col("_last"))
    return chunks.select(*by, F.explode(F.sequence(F.col("_chunk"), last, F.lit(step))).alias("_bin"))


def bin_grid(df: DataFrame, every: str, time: str = TIME, by: Sequence[str] = ()) -> DataFrame:
    """Every bin, counted from 1970, between the first and the last reading of each series, as ``_bin`` in microseconds."""
    step = duration_micros(every)
    return _spread(_range_of(df, step, time, by), step, by)


def with_empty_bins(binned: DataFrame, ends: DataFrame, step: int, time: str, by: Sequence[str]) -> DataFrame:
    """``binned`` and, between ``_first`` and ``_last`` of each series, a row of missing values for every other bin."""
    values = [c for c in binned.columns if c not in by and c != "_bin"]
    grid = _spread(ends, step, by).select(*[F.col(k).alias(f"_g_{k}") for k in by], F.col("_bin").alias("_g_bin"))
    match = [F.col("_bin") == F.col("_g_bin")] + [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in by]
    return grid.join(binned, match, "left").select(
        *[F.col(f"_g_{k}").alias(k) for k in by], from_micros(F.col("_g_bin")).alias(time), *values
    )


def resample(
    df: DataFrame,
    every: str,
    aggregates: Sequence[Aggregate],
    time: str = TIME,
    by: Sequence[str] = (),
    origin: str = "start_day",
    cut_lineage: bool = False,
) -> DataFrame:
    """Aggregate per series and fixed time bin (left-closed, left-labelled); empty bins stay as rows.

    Bins that divide a day fall on the same marks whatever day they count from. Others (``origin='start_day'``) count from the
    series' first day: readings are put into bins of the common divisor of step and day, which are written once and
    then moved to their series' marks.

    The range of each series comes from a second, two-column pass over ``df``. Where ``df``
    is costly to compute, ``cut_lineage`` writes the far smaller bins once and takes the
    range from them.
    """
    step = duration_micros(every)
    binned, ends = _bins_and_ends(df, step, aggregates, time, by, origin, cut_lineage)
    return with_empty_bins(binned, ends, step, time, by)


def _bins_and_ends(
    df: DataFrame, step: int, aggregates: Sequence[Aggregate], time: str, by: Sequence[str], origin: str = "start_day", cut_lineage: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The bins that have rows, as ``_bin``, and the first and last bin of each series; see :func:`resample`."""
    odd = origin == "start_day" and DAY % step != 0
    if odd:
        binned = merged_bins(materialize(small_bins(df, step, aggregates, time, by), "small-bins"), step, aggregates, by)
    else:
        binned = _with_bin(df, step, time).groupBy(*by, "_bin").agg(*[a.direct.alias(a.name) for a in aggregates])
    if cut_lineage or odd:
        binned = materialize(binned, "bins")
        ends = binned.groupBy(*by).agg(F.min("_bin").alias("_first"), F.max("_bin").alias("_last"))
        if not by:
            ends = ends.filter(F.col("_first").isNotNull())
    else:
        ends = _range_of(df, step, time, by)
    return binned, ends


def resample_mean(
    df: DataFrame,
    every: str,
    columns: Sequence[str] | None = None,
    time: str = TIME,
    by: Sequence[str] = (ROOM,),
    origin: str = "start_day",
) -> DataFrame:
    columns = [c for c in columns or numeric_columns(df.schema) if c not in by and c != time]
    return resample(df, every, [mean_of(c) for c in columns], time, by, origin)


def rolling_time_mean(
    df: DataFrame,
    window: str,
    step: str,
    columns: Sequence[str],
    time: str = TIME,
    by: Sequence[str] = (ROOM,),
    min_count: int = 1,
) -> DataFrame:
    """Mean over ``(t - window, t]`` of bins that are ``step`` apart; missing bins are skipped.

    Each series is cut into stretches as long as the window. A window then is the end of one stretch and the
    beginning of the next: a running sum from the start of its own stretch, and one from the end of the stretch before,
    whose bins are handed on, moved by the window, if they have a value. So a bin costs the same whatever the width, nothing is
    subtracted, and no task gets a whole series.
    """
    return _rolled(_placed(df, duration_micros(window), columns, time, True), columns, df.columns, by, min_count)


def _placed(df: DataFrame, width: int, columns: Sequence[str], time: str, asked: bool) -> DataFrame:
    """Every bin in its stretch and, if it has a value, moved to the next; the mean is ``_asked`` for at the former or not at all."""
    at = micros(time)
    own = ((at - F.pmod(at, F.lit(width))) / F.lit(width)).cast("bigint")
    here = F.struct(at.alias("_at"), own.alias("_stretch"), F.lit(False).alias("_moved"), F.lit(asked).alias("_asked"))
    moved = F.struct((at + F.lit(width)).alias("_at"), (own + 1).alias("_stretch"), F.lit(True).alias("_moved"), F.lit(False).alias("_asked"))
    valued = F.coalesce(*[F.col(quoted(c)).cast("double") for c in columns]).isNotNull() if columns else F.lit(False)
    places = F.explode(F.when(valued, F.array(here, moved)).otherwise(F.array(here)))
    return df.filter(F.col(time).isNotNull()).withColumn("_place", places).select(*df.columns, "_place.*")


def _rolled(spread: DataFrame, columns: Sequence[str], kept: Sequence[str], by: Sequence[str], min_count: int) -> DataFrame:
    series = ", ".join([*map(quoted, by), "_stretch"])
    # At equal times the moved bin lies just outside the window, so the bin itself comes first.
    frames = (f"(PARTITION BY {series} ORDER BY _at)", f"(PARTITION BY {series} ORDER BY _at DESC, _moved)")
    means = {}
    for c in columns:
        parts = [f"CASE WHEN {test} THEN {quoted(c)} END" for test in ("NOT _moved", "_moved")]
        total = " + ".join(f"coalesce(sum(CAST({p} AS DOUBLE)) OVER {f}, 0)" for p, f in zip(parts, frames, strict=True))
        count = " + ".join(f"count({p}) OVER {f}" for p, f in zip(parts, frames, strict=True))
        means[c] = f"CASE WHEN {count} >= {max(min_count, 1)} THEN ({total}) / ({count}) END AS {quoted(c)}"
    return spread.selectExpr("_asked", *[means.get(c, quoted(c)) for c in kept]).filter("_asked").drop("_asked")


def rolling_bin_mean(
    binned: DataFrame, ends: DataFrame, window: str, step: int, columns: Sequence[str], time: str = TIME, by: Sequence[str] = (ROOM,)
) -> DataFrame:
    """:func:`rolling_time_mean` at every bin from ``_first`` to ``_last`` of each series, from the bins that have rows.

    The bins asked for and those with values meet in the stretches, so they need no join before.
    """
    width, kept = duration_micros(window), [*by, time, *columns]
    values = binned.select(*by, from_micros(F.col("_bin")).alias(time), *[F.col(quoted(c)) for c in columns])
    none = [F.lit(None).cast(binned.schema[c].dataType).alias(c) for c in columns]
    grid = _spread(ends, step, by).select(*by, from_micros(F.col("_bin")).alias(time), *none)
    spread = _placed(values, width, columns, time, False).unionByName(_placed(grid, width, (), time, True))
    return _rolled(spread, columns, kept, by, 1)


def resample_roll(
    df: DataFrame,
    window: str = "3d",
    every: str = "1h",
    roll: bool = True,
    time: str = TIME,
    room: str = ROOM,
    tiebreak: Sequence[str] = (),
    cut_lineage: bool = False,
) -> DataFrame:
    """Per room: bin means, rolled over time, rejoined with the first other value of each bin.

    Rows that still miss a value are dropped; with ``roll=False`` readings pass through.
    """
    if not roll:
        return drop_incomplete_rows(df)
    numbers = [c for c in numeric_columns(df.schema) if c != room]
    others = [c for c in df.columns if c not in numbers and c not in (room, time)]
    aggregates = [mean_of(c) for c in numbers] + [first_of(c, [time, *tiebreak]) for c in others]
    if others or not numbers:
        binned = resample(df, every, aggregates, time, [room], cut_lineage=cut_lineage)
        rolled = rolling_time_mean(binned, window, every, numbers, time, [room])
    else:
        step = duration_micros(every)
        bins, ends = _bins_and_ends(df, step, aggregates, time, [room], cut_lineage=cut_lineage)
        rolled = rolling_bin_mean(bins, ends, window, step, numbers, time, [room])
    return drop_incomplete_rows(rolled).select(*df.columns)


def rolling_count_mean(
    df: DataFrame, columns: Sequence[str], rows: int = 5, every: str = "1d", time: str = TIME, by: Sequence[str] = ()
) -> DataFrame:
    """Mean of the last ``rows`` consecutive bins; missing unless all of them have a value."""
    unit = duration_micros(every) // 1_000_000
    return rolling_time_mean(df, f"{unit * rows}s", every, columns, time, by, min_count=rows)


def calendar_resample(df: DataFrame, columns: Sequence[str], every: str = "1d", time: str = TIME) -> DataFrame:
    """Mean of each column per calendar bin over the whole table, all columns in one pass."""
    return resample_mean(df, every, columns, time, by=())


def align_measures(series: Sequence[DataFrame], time: str = TIME) -> DataFrame:
    """Outer-align separately resampled series on time."""
    aligned = series[0]
    for other in series[1:]:
        aligned = aligned.join(other, time, "full_outer")
    return aligned


def cyclic_resample(
    df: DataFrame, columns: Sequence[str], freq: str, weekday: bool = False, time: str = TIME
) -> DataFrame:
    """Mean per hour of day (``h``), day of month (``d``) or weekday (``d`` with ``weekday``)."""
    if freq.lower() == "h":
        key = F.hour(time)
    elif freq.lower() == "d":
        key = day_of_week(time) if weekday else F.dayofmonth(time)
    else:
        key = F.col(time)
    return df.groupBy(key.alias(time)).agg(*[F.avg(c).alias(c) for c in columns])


def missing_bins(df: DataFrame, every: str = "1d", time: str = TIME) -> DataFrame:
    """All bins between the first and the last reading, with a flag on those without one."""
    seen = resample(df, every, [rows_of("_n")], time, (), origin="epoch")
    return seen.select(time, F.col("_n").isNull().alias("missing"))


def calendar_anti(df: DataFrame, every: str = "1d", time: str = TIME) -> DataFrame:
    """The bins in range that have no reading."""
    step = duration_micros(every)
    grid = bin_grid(df, every, time)
    seen = _with_bin(df, step, time).select("_bin").distinct()
    return grid.join(seen, "_bin", "left_anti").select(from_micros(F.col("_bin")).alias(time))


def daily_counts_dense(df: DataFrame, time: str = TIME, cut_lineage: bool = False) -> DataFrame:
    """Rows per day, 0 on days without a reading."""
    counted = resample(df, "1d", [rows_of("n")], time, (), "epoch", cut_lineage)
    return counted.select(F.to_date(time).alias("date"), F.coalesce("n", F.lit(0)).alias("n"))


def daily_presence(df: DataFrame, time: str = TIME) -> DataFrame:
    return daily_counts_dense(df, time).select("date", (F.col("n") > 0).cast("int").alias("present"))


def missing_by_weekday(df: DataFrame, time: str = TIME) -> DataFrame:
    """Days without a reading, counted for each of the seven weekdays."""
    days = df.sparkSession.createDataFrame(list(enumerate(WEEKDAYS)), "dayofweek int, weekday string")
    missing = calendar_anti(df, "1d", time).groupBy(day_of_week(time).alias("dayofweek")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(missing, "dayofweek", "left").select("dayofweek", "weekday", F.coalesce("n", F.lit(0)).alias("n_missing"))


def tag_lecture_slot(
    df: DataFrame, slots: Sequence[tuple[float, float]] = LECTURE_SLOTS, time: str = TIME
) -> DataFrame:
    """Number of the lecture slot (from 1) a reading falls into, else NULL."""
    hour = hour_fraction(time)
    slot = F.lit(None).cast("int")
    for number, (start, end) in reversed(list(enumerate(slots, 1))):
        slot = F.when((hour >= start) & (hour < end), F.lit(number)).otherwise(slot)
    return df.withColumn("lecture_slot", slot)


def room_diff(
    df: DataFrame, order: RowOrder, label: str = "CO2", columns: Sequence[str] | None = None
) -> DataFrame:
    """Change of every number but the label against the previous row of its series, as ``*_diff``."""
    columns = [c for c in columns or numeric_columns(df.schema) if c != label and c not in order.keys]
    df = order.shift(order.attach(df), {f"_prev{i}": (c, 1) for i, c in enumerate(columns)})
    diffs = [f"{quoted(c)} - _prev{i} AS {quoted(c + '_diff')}" for i, c in enumerate(columns)]
    return order.detach(df.selectExpr("*", *diffs).drop(*[f"_prev{i}" for i in range(len(columns))]))


def winsorized_daily_counts(df: DataFrame, time: str = TIME) -> DataFrame:
    """Rows per day, outlying days replaced by the largest count that is none."""
    return iqr_replace(daily_counts_dense(df, time, cut_lineage=True), "n", "max")
