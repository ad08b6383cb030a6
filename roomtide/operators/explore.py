"""Exploratory statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MEASURES, ROOM, numeric_columns
from ..session import materialize
from .encoding import minmax_scale
from .ordered import RowOrder
from .outliers import iqr_filter_cascade, iqr_replace
from .quantiles import exact_quantiles



def counts_by_room(df: DataFrame, room: str = ROOM) -> DataFrame:
    return df.groupBy(room).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), room)


def head_n(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of every number."""
    columns = list(columns) if columns is not None else numeric_columns(df.schema)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rows = [
        F.struct(
            F.lit(c).alias("measure"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            *[F.lit(q).cast("double").alias(f"q{p}") for p, q in zip((25, 50, 75), quartiles[c], strict=True)],
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).selectExpr("inline(rows)")


def profile_schema(df: DataFrame) -> DataFrame:
    """Position, type and number of non-null values of every column."""
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("type"), F.count(name).alias("non_null")
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return df.agg(F.array(*rows).alias("rows")).selectExpr("inline(rows)")


def room_means(df: DataFrame, columns: Sequence[str] = MEASURES, room: str = ROOM) -> DataFrame:
    return df.groupBy(room).agg(*[F.avg(c).alias(c) for c in columns])


def rotate_tail(df: DataFrame, order_by: str, tail: int = 5) -> DataFrame:
    """Display position: the last ``tail`` rows come first. ``df`` has one row per room."""
    order = RowOrder(df, [order_by])
    rest = max(order.total - tail, 0)
    rank = F.col("position")
    place = F.when(rank >= rest, rank - rest).otherwise(rank + (order.total - rest))
    return order.detach(order.index(order.attach(df), "position")).withColumn("position", place.cast("int"))


def room_heatmap(df: DataFrame, columns: Sequence[str] = MEASURES, room: str = ROOM, tail: int = 5) -> DataFrame:
    """Room means with outlying rooms replaced by the mean, scaled to [0, 1], as (measure, room, position, value)."""
    # One row per room: written once, so that the statistics below do not scan the readings again.
    means = materialize(room_means(df, columns, room), "room-means")
    means = minmax_scale(iqr_replace(means, columns, "mean"), columns)
    return rotate_tail(means, room, tail).unpivot([room, "position"], list(columns), "measure", "value")


def room_heatmap_matrix(df: DataFrame, columns: Sequence[str] = MEASURES, room: str = ROOM, tail: int = 5) -> DataFrame:
    """The heatmap as one row per measure and one column per room, in display order.

    The columns are named after the rooms, so the driver has to know those; :func:`room_heatmap` does without.
    """
    long = room_heatmap(df, columns, room, tail)
    names = [r[0] for r in long.select(room).distinct().orderBy(room).collect()]
    return long.groupBy("measure").pivot(room, names[-tail:] + names[:-tail]).agg(F.first("value"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] = MEASURES, cascade: bool = True) -> DataFrame:
    """Pairwise Pearson correlation of cleaned measures, every pair in one aggregation."""
    cleaned = iqr_filter_cascade(df, columns, scale=False) if cascade else df
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("corr")) for a, b in combinations(columns, 2)]
    same = [F.struct(F.lit(a).alias("a"), F.lit(a).alias("b"), F.corr(a, a).alias("corr")) for a in columns]
    upper = cleaned.agg(F.array(*pairs, *same).alias("rows")).selectExpr("inline(rows)")
    mirrored = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = F.when(F.col("a") == F.col("b"), F.slice(mirrored, 1, 1)).otherwise(mirrored)
    return upper.select(F.explode(both).alias("p"), "corr").select("p.a", "p.b", "corr")
