"""Exact quantiles with linear interpolation, by distributed selection.

``percentile`` keeps every distinct value of a column in one task, which fails on large continuous columns. Here one pass gives the
range of each column, and one counts its values in ``BINS`` bins of equal width, with the smallest and largest value of each bin.
A wanted rank lies in one bin. If the bin holds a single value, that is the answer; if it holds few, they are looked at; else the
bin becomes the range of the next pass, ``BINS`` times finer. All columns and ranks share the passes. Tables of every size take
this path; NaN counts as missing.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import number, quoted

BINS = 4096
GATHER_ROWS = 2_000


@dataclass(frozen=True)
class _Range:
    """The values of a column from ``low`` to ``high``; ``below`` of its values are smaller. Infinite ones lie outside."""

    column: str
    low: float
    high: float
    below: int = 0

    def bin(self) -> str:
        """SQL for the bin of a value; never falls as the value rises, and puts ``low`` and ``high`` into different bins.

        Halves are subtracted, as the whole difference may be too large for a double.
        """
        v, low, high = quoted(self.column), number(self.low), number(self.high)
        width = self.high / 2 - self.low / 2
        if width > 0:
            at = f"CAST(least(floor(({v} / 2D - {number(self.low / 2)}) / {number(width)} * {BINS}), {BINS - 1}) AS INT)"
        else:
            # One value, or neighbours too small to be halved.
            at = f"CASE WHEN {v} > {low} THEN {BINS - 1} ELSE 0 END"
        return f"CASE WHEN {v} < {low} THEN -1 WHEN {v} > {high} THEN {BINS} ELSE {at} END"


def _clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.selectExpr(*[f"nanvl(CAST({quoted(c)} AS DOUBLE), NULL) AS {quoted(c)}" for c in columns])


def finite_ends(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Smallest and largest finite value of each column, in one pass; columns without one have (0, 0)."""
    columns = list(dict.fromkeys(columns))
    finite = [f"CASE WHEN abs({quoted(c)}) < double('inf') THEN {quoted(c)} END" for c in columns]
    row = _clean(df, columns).selectExpr(*[f"min({v}) AS a{i}" for i, v in enumerate(finite)], *[f"max({v}) AS b{i}" for i, v in enumerate(finite)]).first()
    return {c: (row[f"a{i}"] or 0.0, row[f"b{i}"] or 0.0) for i, c in enumerate(columns)}


def _histograms(df: DataFrame, ranges: Sequence[_Range], inside: bool) -> list[list[tuple[int, float, float, int]]]:
    """Per range its bins in order, as (bin, smallest, largest, count); with ``inside`` only values in the range are counted."""
    parts = []
    for i, r in enumerate(ranges):
        v = quoted(r.column)
        wanted = f"{v} BETWEEN {number(r.low)} AND {number(r.high)}" if inside else f"{v} IS NOT NULL"
        parts.append(f"CASE WHEN {wanted} THEN named_struct('t', {i}, 'b', {r.bin()}, 'v', {v}) END")
    rows = df.selectExpr(f"explode(array({', '.join(parts)})) AS x").filter("x IS NOT NULL").select("x.*")
    counted = rows.groupBy("t", "b").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n")).collect()
    found: list[list[tuple[int, float, float, int]]] = [[] for _ in ranges]
    for r in sorted(counted, key=lambda r: (r.t, r.b)):
        found[r.t].append((r.b, r.low, r.high, r.n))
    return found


def _gather(df: DataFrame, ranges: Sequence[_Range]) -> list[list[float]]:
    """The values of each range, sorted; at most ``GATHER_ROWS`` each."""
    found: list[list[float]] = [[] for _ in ranges]
    if not ranges:
        return found
    hits = [
        f"CASE WHEN {quoted(r.column)} BETWEEN {number(r.low)} AND {number(r.high)} THEN named_struct('t', {i}, 'v', {quoted(r.column)}) END"
        for i, r in enumerate(ranges)
    ]
    any_hit = " OR ".join(f"{quoted(r.column)} BETWEEN {number(r.low)} AND {number(r.high)}" for r in ranges)
    for row in df.filter(any_hit).selectExpr(f"explode(array({', '.join(hits)})) AS x").filter("x IS NOT NULL").select("x.*").collect():
        found[row.t].append(row.v)
    return [sorted(values) for values in found]


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    ends: Mapping[str, tuple[float, float]] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles of each column over its values that are neither null nor NaN; ``None`` where there are none.

    ``ends`` spares the first pass: finite values of each column between which all finite values lie.
    """
    columns = list(dict.fromkeys(columns))
    ends = ends or finite_ends(df, columns)
    df = _clean(df, columns)
    ranges = [_Range(c, *ends[c]) for c in columns]
    histograms = _histograms(df, ranges, inside=False)
    sizes = {r.column: sum(b[3] for b in bins) for r, bins in zip(ranges, histograms, strict=True)}
    # A rank between two values needs both.
    wanted = {
        (c, at) for c in columns if sizes[c] for p in probabilities for at in (math.floor(p * (sizes[c] - 1)), math.ceil(p * (sizes[c] - 1)))
    }
    values: dict[tuple[str, int], float] = {}
    open_ranks = {(c, at): i for i, c in enumerate(columns) for d, at in wanted if d == c}
    few: dict[_Range, list[tuple[str, int]]] = {}
    while open_ranks:
        narrower: dict[_Range, list[tuple[str, int]]] = {}
        for key, i in open_ranks.items():
            below = ranges[i].below
            for _, low, high, n in histograms[i]:
                if key[1] < below + n:
                    break
                below += n
            if low == high:
                values[key] = low
            else:
                (few if n <= GATHER_ROWS else narrower).setdefault(_Range(key[0], low, high, below), []).append(key)
        ranges = list(narrower)
        histograms = _histograms(df, ranges, inside=True) if ranges else []
        open_ranks = {key: i for i, r in enumerate(ranges) for key in narrower[r]}
    for r, found in zip(few, _gather(df, list(few)), strict=True):
        for key in few[r]:
            values[key] = found[key[1] - r.below]

    result: dict[str, list[float | None]] = {}
    for c in columns:
        result[c] = []
        for p in probabilities:
            if not sizes[c]:
                result[c].append(None)
                continue
            rank = p * (sizes[c] - 1)
            low, high = values[c, math.floor(rank)], values[c, math.ceil(rank)]
            result[c].append(low + (high - low) * (rank - math.floor(rank)) if high > low else low)
    return result
