"""As-of joins: match each row with the right row nearest in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import UNIT_MICROS, duration_micros, floor_micros, micros
from ..schema import TIME
from .ordered import RowOrder

#: Largest right table, as JSON text, that is broadcast, and the most times in one of its cells.
BROADCAST_BYTES = 32 << 20
TIMES_PER_CELL = 64


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    left_on: str = TIME,
    right_on: str = "date",
    tiebreak: Sequence[str] = (),
    left_order: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each left row takes the right row closest in time; a tie goes to the earlier one.

    Of several right rows at one time, in the order of ``tiebreak`` (of all columns without one), a left row
    at that time or after it takes the last, a left row before it the first.

    A right table of checked size becomes midpoint intervals, cut into time cells and
    broadcast for an equi-join on the cell: the left table is not shuffled. A right table
    that is larger, or crowds many times into one cell, goes through :func:`asof_join`, which
    needs ``left_order`` (columns that order left rows of the same time). Both give the same rows.
    """
    right = right.filter(F.col(right_on).isNotNull())
    size = right.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes"),
        F.min(micros(right_on)).alias("low"),
        F.max(micros(right_on)).alias("high"),
    ).first()
    low, high = size.low or 0, size.high or 0
    cell = max(UNIT_MICROS["s"], (high - low) // max(size.rows, 1))

    def cell_of(value):
        return (floor_micros(value, cell) / F.lit(cell)).cast("bigint")

    fits = (size.bytes or 0) <= broadcast_bytes
    if fits:
        times = right.select(cell_of(micros(right_on)).alias("cell"), right_on).groupBy("cell").agg(F.count_distinct(right_on).alias("n"))
        fits = (times.agg(F.max("n").alias("n")).first().n or 0) <= TIMES_PER_CELL
    ties = list(tiebreak) or sorted(c for c in right.columns if c != right_on)
    if not fits:
        return asof_join(left, right, left_on, right_on, "nearest", left_order=left_order, right_order=ties)

    values = [c for c in right.columns if c != right_on]
    row, order = F.struct(*values), F.struct(*ties)
    one_per_time = (
        right.groupBy(right_on).agg(F.max_by(row, order).alias("_last"), F.min_by(row, order).alias("_first"))
        if values
        else right.distinct()
    )
    # The checked size keeps this window over the right table small.
    by_time = Window.orderBy("_at")
    spans = one_per_time.withColumn("_at", micros(right_on)).withColumns(
        {"_from": F.lag("_at").over(by_time) + F.col("_at"), "_to": F.lead("_at").over(by_time) + F.col("_at")}
    )
    first_cell, last_cell = low // cell, high // cell
    begin = F.coalesce(cell_of(F.floor(F.col("_from") / 2)), F.lit(first_cell))
    end = F.coalesce(cell_of(F.floor(F.col("_to") / 2)), F.lit(last_cell))
    spans = spans.withColumn("_cell", F.explode(F.sequence(begin, end)))

    # Twice the time is compared with the sum of the two neighbours: exact, no midpoint rounding.
    at2 = 2 * micros(left_on)
    joined = left.withColumns(
        {
            "_at2": at2,
            "_cell_left": F.least(F.greatest(cell_of(micros(left_on)), F.lit(first_cell)), F.lit(last_cell)),
        }
    ).join(
        F.broadcast(spans),
        (F.col("_cell_left") == F.col("_cell"))
        & (F.col("_from").isNull() | (F.col("_at2") > F.col("_from")))
        & (F.col("_to").isNull() | (F.col("_at2") <= F.col("_to"))),
        "left",
    )
    passed = F.col("_at2") >= 2 * F.col("_at")
    matched = [F.when(passed, F.col(f"_last.{c}")).otherwise(F.col(f"_first.{c}")).alias(c) for c in values]
    return joined.select(*left.columns, right_on, *matched)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    direction: str = "backward",
    by: Sequence[str] = (),
    tolerance: str | None = None,
    left_order: Sequence[str] = (),
    right_order: Sequence[str] = (),
) -> DataFrame:
    """As-of join of two large tables, optionally within equal ``by`` keys and a tolerance.

    Both sides are put in one order and the right rows are carried along it, so neither
    a hot key nor a hot stretch of time gathers in one task. Of several right rows at
    one time the last in ``right_order`` is taken backward, the first forward.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"direction must be backward, forward or nearest, not {direction!r}")
    by = list(by)
    values = [c for c in right.columns if c not in by]
    # At equal times a backward match must find the right row already passed, a forward match still ahead.
    left_side, right_side = (0, 1) if direction == "forward" else (1, 0)
    rows = left.select(
        *[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)],
        F.col(left_on).alias("_at"),
        F.lit(left_side).alias("_side"),
        F.struct(*left.columns).alias("_left"),
        *[F.col(c).alias(f"_l{i}") for i, c in enumerate(left_order)],
    ).unionByName(
        right.filter(F.col(right_on).isNotNull()).select(
            *[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)],
            F.col(right_on).alias("_at"),
            F.lit(right_side).alias("_side"),
            F.struct(*values).alias("_right"),
            *[F.col(c).alias(f"_r{i}") for i, c in enumerate(right_order)],
        ),
        allowMissingColumns=True,
    )
    ties = [f"_r{i}" for i in range(len(right_order))] + [f"_l{i}" for i in range(len(left_order))]
    order = RowOrder(rows, ["_at", "_side", *ties], within=[f"_by{i}" for i in range(len(by))])
    rows = order.attach(rows)
    if direction in ("backward", "nearest"):
        rows = order.fill(rows, {"_back": "_right"}, forward=True)
    if direction in ("forward", "nearest"):
        rows = order.fill(rows, {"_ahead": "_right"}, forward=False)
    rows = order.detach(rows).filter(F.col("_side") == left_side)

    def gap(match: str):
        return F.abs(micros(F.col("_at")) - micros(F.col(f"{match}.{right_on}")))

    if direction == "nearest":
        backward = F.col("_ahead").isNull() | (gap("_back") <= gap("_ahead"))
        rows = rows.withColumn("_match", F.when(F.col("_back").isNotNull() & backward, F.col("_back")).otherwise(F.col("_ahead")))
    else:
        rows = rows.withColumn("_match", F.col("_back" if direction == "backward" else "_ahead"))
    match = F.col("_match")
    if tolerance is not None:
        match = F.when(gap("_match") <= duration_micros(tolerance), match)
    return rows.withColumn("_match", F.when(F.col("_at").isNotNull(), match)).select(
        *[F.col(f"_left.{c}").alias(c) for c in left.columns], *[F.col(f"_match.{c}").alias(c) for c in values]
    )
