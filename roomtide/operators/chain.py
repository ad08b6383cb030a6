"""Filters that look at the row before, one after another, in one shuffle and one pass.

A chain has stages. A stage takes the rows its predecessor kept, if they pass its gate (a condition on the row alone), and drops a
row if its check says so of the row and the one before it *in that stage*. So what one stage drops changes who is whose neighbour
in the next. Done one by one, every stage needs the table in order anew.

Here the rows are put into range buckets once, and all stages run as windows in the bucket's order. What a bucket lets through
depends on the rows before it, but only at few places: the first row that enters stage 0 has an unknown neighbour; the next row
after it that enters stage 1 has; and so on. Behind the last of these places every neighbour lies in the bucket. So a bucket is
summed up by at most one open row and one last row for each stage. These summaries compose: a fold over the buckets in their
order, on a table with at most twice as many rows per bucket (and series) as stages, settles the open rows, and the few that come
out otherwise than assumed are joined back.

Written once: the rows kept, the open rows and the last rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import quoted
from ..session import materialize
from .ordered import BUCKET, RowOrder

Values = Mapping[str, object]


@dataclass(frozen=True)
class Stage:
    """``gate``: SQL condition on a row, a missing value fails it. ``check``: whether a row is dropped, from its ``values`` and those before.

    ``values`` names SQL expressions, numbers or text. The check is written with operators that mean the same for columns and for
    plain numbers and text, as it is used for both; a missing value must make it false.
    """

    gate: str
    values: Mapping[str, str]
    check: Callable[[Values, Values], object]


def _settle(stages: Sequence[Stage]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The fold over one series: open rows in order, then the last rows of their bucket, bucket by bucket."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([BUCKET, "_n"], kind="stable")
        before: list[dict | None] = [None] * len(stages)
        found = []
        for bucket, part in rows.groupby(BUCKET, sort=True):
            records = part.to_dict("records")
            for row in records:
                if row["_open"] < 0:
                    continue
                alive = True
                for k in range(row["_open"], len(stages)):
                    if not alive or (k > row["_open"] and not row[f"_g{k}"]):
                        alive = False
                        break
                    own = {v: row[f"_v{k}_{v}"] for v in stages[k].values}
                    alive = before[k] is None or not bool(stages[k].check(own, before[k]))
                    before[k] = own
                if alive != row["_kept"]:
                    found.append((bucket, row["_n"], alive))
            for k, stage in enumerate(stages):
                for row in records:
                    if row[f"_last{k}"]:
                        before[k] = {v: row[f"_v{k}_{v}"] for v in stage.values}
        return pd.DataFrame(found, columns=["_b", "_m", "_settled"])

    return fold


def filter_chain(df: DataFrame, order: RowOrder, stages: Sequence[Stage], columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``df`` that all stages keep, with ``columns`` (by default all).

    ``order`` is the order of the rows; inside a series, rows never have a neighbour in another.
    """
    columns = list(columns or df.columns)
    keys = [F.col(quoted(k)).asc_nulls_first() for k in order.keys]
    series = [F.col(quoted(k)) for k in order.within]
    rest = keys[len(order.within) :]
    rows = order.attach(df).withColumn("_n", F.row_number().over(Window.partitionBy(BUCKET).orderBy(*keys)))
    for k, stage in enumerate(stages):
        added = {f"_v{k}_{v}": F.expr(text) for v, text in stage.values.items()}
        rows = rows.withColumns({f"_g{k}": F.coalesce(F.expr(stage.gate), F.lit(False)), **added})
    here = Window.partitionBy(BUCKET, *series).orderBy(*rest)
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    whole = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    alive, sure = F.lit(True), F.lit(True)
    for k, stage in enumerate(stages):
        inside = alive & F.col(f"_g{k}")
        values = F.struct(*[F.col(f"_v{k}_{v}").alias(v) for v in stage.values])
        rows = rows.withColumns({f"_in{k}": inside, f"_sure{k}": (inside & sure).cast("int")})
        rows = rows.withColumns(
            {
                f"_before{k}": F.last(F.when(F.col(f"_in{k}"), values), ignorenulls=True).over(earlier),
                f"_run{k}": F.sum(f"_sure{k}").over(so_far),
                f"_all{k}": F.sum(f"_sure{k}").over(whole),
            }
        )
        now = {v: F.col(f"_v{k}_{v}") for v in stage.values}
        dropped = F.coalesce(stage.check(now, {v: F.col(f"_before{k}.{v}") for v in stage.values}), F.lit(False))
        certain = F.col(f"_sure{k}") == 1
        rows = rows.withColumns(
            {
                f"_out{k}": F.col(f"_in{k}") & ~dropped,
                f"_open{k}": certain & (F.col(f"_run{k}") == 1),
                f"_last{k}": certain & (F.col(f"_run{k}") == F.col(f"_all{k}")),
            }
        )
        alive, sure = F.col(f"_out{k}"), F.col(f"_run{k}") - F.col(f"_sure{k}") >= 1
    # The last pieces as SQL text: one call to the JVM each.
    lasts = [f"_last{k}" for k in range(len(stages))]
    last = " OR ".join(lasts)
    opened = " ".join(f"WHEN _open{k} THEN {k}" for k in range(len(stages)))
    rows = rows.withColumns({"_open": F.expr(f"CASE {opened} ELSE -1 END"), "_kept": alive}).filter(f"_kept OR _open >= 0 OR {last}")
    known = [*[f"_g{k}" for k in range(len(stages))], *[f"_v{k}_{v}" for k, s in enumerate(stages) for v in s.values]]
    listed = list(dict.fromkeys([*columns, *order.within]))
    # Values are of use in open and last rows alone.
    told = [f"CASE WHEN _open >= 0 OR {last} THEN {c} END AS {c}" for c in known]
    written = materialize(rows.selectExpr(*map(quoted, listed), BUCKET, "_n", "_kept", "_open", *lasts, *told), "chain")
    summary = written.filter(f"_open >= 0 OR {last}").select(*map(quoted, order.within), BUCKET, "_n", "_kept", "_open", *lasts, *known)
    settled = summary.withColumn("_whole", F.lit(0)).groupBy("_whole", *order.within).applyInPandas(_settle(stages), "_b int, _m int, _settled boolean")
    settled = materialize(settled, "chain-settled")
    joined = written.join(settled, (F.col(BUCKET) == F.col("_b")) & (F.col("_n") == F.col("_m")), "left")
    return joined.filter(F.coalesce("_settled", "_kept")).select(*map(quoted, columns))


def repeats(time: str, room: str) -> Stage:
    """Drops all but the first row of each (time, room); the order has to begin with these two, in either order."""
    values = {"at": f"unix_micros(CAST({quoted(time)} AS TIMESTAMP))", "room": f"coalesce(concat('1', {quoted(room)}), '0')"}
    return Stage("true", values, lambda now, before: (now["at"] == before["at"]) & (now["room"] == before["room"]))
