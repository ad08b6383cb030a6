"""Running totals and gapless numbers within groups of any size, without one task per group.

The rows of all groups are put into range buckets along (group, hash, ties, row number). A window runs per bucket and group; a
table with one row per bucket and group carries the totals of the buckets before. As the row number is part of the order, a
group with a third of all rows is spread over many buckets, and so are rows that share a key or agree in everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import BUCKET, RowOrder
from ..session import materialize


def order_hash(*keys: str, seed: str = "") -> Column:
    """Hexadecimal hash of the keys that orders rows alike on every run and in every engine."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def running_total(
    rows: DataFrame, group: Sequence[str], hashed: str, ties: Sequence[str], amount: Column, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the earlier rows of the same group.

    Rows are ordered by ``hashed`` (from :func:`order_hash`), then by ``ties``. Group columns must not
    be null. Rows equal in all of these are interchangeable, so their order does not matter; they are told apart by a number
    that they get when the rows are written.
    """
    rows = materialize(rows.withColumns({"_amount": amount, "_number": F.monotonically_increasing_id()}), "slices")
    order = RowOrder(rows, [hashed, *ties, "_number"], within=group)
    rows, by = order.attach(rows), [BUCKET, *group]
    earlier = Window.partitionBy(*group).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*by)
        .agg(F.sum("_amount").alias("_sum"))
        .select(*by, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    here = Window.partitionBy(*by).orderBy(hashed, *ties, "_number").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(offsets, by)
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum("_amount").over(here), F.lit(0)))
        .drop(BUCKET, "_amount", "_number", "_offset")
    )
