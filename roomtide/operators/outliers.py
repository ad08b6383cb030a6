"""Outliers by the interquartile range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles, finite_ends


class Bounds(NamedTuple):
    low: float
    high: float
    q1: float
    q3: float

    def inside(self, column: str) -> Column:
        return F.col(column).between(F.lit(self.low), F.lit(self.high))

    def outside(self, column: str) -> Column:
        return (F.col(column) < F.lit(self.low)) | (F.col(column) > F.lit(self.high))


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], reach: float = 1.5, ends: Mapping[str, tuple[float, float]] | None = None
) -> dict[str, Bounds | None]:
    bounds: dict[str, Bounds | None] = {}
    for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75], ends).items():
        bounds[c] = None if q1 is None else Bounds(q1 - reach * (q3 - q1), q3 + reach * (q3 - q1), q1, q3)
    return bounds


def iqr_filter(df: DataFrame, column: str) -> DataFrame:
    """Keep rows inside the bounds; missing values are dropped."""
    bounds = iqr_bounds(df, [column])[column]
    return df.filter(bounds.inside(column)) if bounds else df.filter(F.lit(False))


def iqr_replace(df: DataFrame, columns: str | Sequence[str], fill: str) -> DataFrame:
    """Replace low and high outliers alike by the max, min or mean of the values inside the bounds.

    The columns do not affect one another, so they share the aggregation passes.
    """
    how = fill.lower()
    aggregates = {"max": F.max, "min": F.min, "mean": F.avg}
    if how not in aggregates:
        raise ValueError(f"outliers can be replaced by {', '.join(aggregates)}, not by {fill!r}")
    columns = [columns] if isinstance(columns, str) else list(columns)
    bounds = {c: b for c, b in iqr_bounds(df, columns).items() if b}
    if not bounds:
        return df
    values = df.agg(
        *[aggregates[how](F.when(b.inside(c), F.col(c))).alias(f"f{i}") for i, (c, b) in enumerate(bounds.items())]
    ).first()
    return df.withColumns(
        {
            c: F.when(b.outside(c), F.lit(values[f"f{i}"])).otherwise(F.col(c))
            for i, (c, b) in enumerate(bounds.items())
        }
    )


def remove_outliers(df: DataFrame, column: str, fill: str = "None") -> DataFrame:
    return iqr_filter(df, column) if fill.lower() == "none" else iqr_replace(df, column, fill)


def iqr_filter_cascade(df: DataFrame, columns: Sequence[str], scale: bool = True) -> DataFrame:
    """Filter column after column, each by the quantiles of the rows left by the one before.

    With ``scale`` each column is also mapped to [0, 1] over the rows left at its own step.
    The bounds and scales are plain literals, so the result is one filtered scan.
    """
    left, inside = df, F.lit(True)
    steps: dict[str, Column] = {}
    # What is left of a column lies between the ends of the whole of it, so one pass serves all steps.
    ends = finite_ends(df, columns) if columns else {}
    for c in columns:
        bounds = iqr_bounds(left, [c], ends=ends)[c]
        inside = inside & bounds.inside(c) if bounds else F.lit(False)
        left, steps[c] = df.filter(inside), inside
    if not scale:
        return left
    ends = df.agg(
        *[F.min(F.when(kept, F.col(c))).alias(f"a{i}") for i, (c, kept) in enumerate(steps.items())],
        *[F.max(F.when(kept, F.col(c))).alias(f"b{i}") for i, (c, kept) in enumerate(steps.items())],
    ).first()
    scaled = {}
    for i, c in enumerate(columns):
        low, high = ends[f"a{i}"], ends[f"b{i}"]
        if low is not None:
            span = float(high - low)
            scaled[c] = (F.col(c) - F.lit(low)) / F.lit(span) if span else F.when(F.col(c).isNotNull(), F.lit(0.0))
    return left.withColumns(scaled)


def outlier_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows outside the bounds for each measure, most first."""
    bounds = iqr_bounds(df, columns)
    counted = df.agg(
        *[
            (F.count_if(b.outside(c)) if b else F.lit(0).cast("bigint")).alias(c)
            for c, b in bounds.items()
        ]
    )
    return counted.unpivot([], list(columns), "measure", "n_outliers").orderBy(F.desc("n_outliers"), "measure")


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends and number of fliers of each measure."""
    median = {}
    bounds = {}
    for c, (q1, q2, q3) in exact_quantiles(df, columns, [0.25, 0.5, 0.75]).items():
        if q1 is not None:
            bounds[c] = Bounds(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1), q1, q3)
            median[c] = q2
    rows = [
        F.struct(
            F.lit(c).alias("measure"),
            F.lit(b.q1).alias("q1"),
            F.lit(median[c]).alias("median"),
            F.lit(b.q3).alias("q3"),
            F.min(F.when(b.inside(c), F.col(c))).alias("whisker_low"),
            F.max(F.when(b.inside(c), F.col(c))).alias("whisker_high"),
            F.count_if(b.outside(c)).alias("n_fliers"),
        )
        for c, b in bounds.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).selectExpr("inline(rows)")
