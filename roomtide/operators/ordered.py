"""Row-order operators without a single-task window.

``lag``, fill and row position are defined over one long order: the whole table by
time, or each room by time. A window over such an order puts a whole table (or a hot
room) into one task. Here the order is first cut into range buckets of about equal
size, whatever the skew in rooms, days or single timestamps: the bounds come from a
sorted sample of the *full* order key, tiebreak included. Windows then run per bucket,
and what crosses a bucket edge travels in a table with one row per bucket.

The bounds only steer balance. Any bounds give the same result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import quoted
from ..session import materialize

BUCKET = "_bucket"
MAX_BUCKETS = 32_768
ROWS_PER_BUCKET = 2_000_000
SAMPLES_PER_BUCKET = 64
MAX_SAMPLES = 262_144
CARRY_BROADCAST_CELLS = 4_000_000


def _sortable(name: str, kind: T.DataType) -> tuple[Column, str]:
    """Order-preserving form of a key column that survives a JSON literal."""
    column = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")), "bigint"
    if isinstance(kind, T.DateType):
        return F.unix_date(column), "int"
    if isinstance(kind, (T.IntegralType, T.StringType, T.BooleanType, T.DoubleType)):
        return column, kind.simpleString()
    raise TypeError(f"{name}: cannot order rows by {kind.simpleString()}")


class RowOrder:
    """A total order of the rows of ``df``: by ``within`` first, then by ``order_by``.

    ``within`` names the series (for instance the room); neighbours, fills and changes
    never cross from one series to the next. ``order_by`` must end in a tiebreak.
    The object stays valid for any subset of the rows.
    """

    def __init__(
        self,
        df: DataFrame,
        order_by: Sequence[str],
        within: Sequence[str] = (),
        buckets: int | None = None,
    ):
        self.within = list(within)
        self.keys = self.within + [k for k in order_by if k not in within]
        forms = [_sortable(k, df.schema[k].dataType) for k in self.keys]
        self._key = F.struct(*[c.alias(f"k{i}") for i, (c, _) in enumerate(forms)])
        self._kind = ",".join(f"k{i}:{kind}" for i, (_, kind) in enumerate(forms))
        keys = df.select(self._key.alias("key"))
        self.total = keys.count()
        if buckets is None:
            parallel = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            buckets = max(parallel, math.ceil(self.total / ROWS_PER_BUCKET))
        self.buckets = max(1, min(buckets, MAX_BUCKETS))
        self._bounds = self._sample_bounds(keys)

    def _sample_bounds(self, keys: DataFrame) -> list[list]:
        wanted = min(self.buckets * SAMPLES_PER_BUCKET, MAX_SAMPLES)
        if self.buckets == 1 or not self.total:
            return []
        sample = keys if wanted >= self.total else keys.sample(wanted / self.total, seed=17)
        # Missing values come first, as in the ascending order of the windows.
        rows = sorted([list(r.key) for r in sample.collect()], key=lambda k: [(v is not None, v) for v in k])
        cuts = [rows[i * len(rows) // self.buckets] for i in range(1, self.buckets) if rows]
        return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]

    def _bucket(self) -> Column:
        """Number of bounds at or below the row's key, by binary search in a literal array."""
        if not self._bounds:
            return F.lit(0)
        text = json.dumps([{f"k{i}": v for i, v in enumerate(b)} for b in self._bounds])
        bounds = F.from_json(F.lit(text), f"array<struct<{self._kind}>>")
        top = 1 << (len(self._bounds).bit_length() - 1)
        strides = F.array(*[F.lit(top >> i) for i in range(top.bit_length())])

        def search(key: Column) -> Column:
            def advance(passed: Column, stride: Column) -> Column:
                return F.when(F.get(bounds, passed + stride - 1) <= key, passed + stride).otherwise(passed)

            return F.aggregate(strides, F.lit(0), advance)

        # As an array element the key is put together once per row, not once per step.
        return F.get(F.transform(F.array(self._key), search), 0)

    def attach(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, self._bucket())

    @staticmethod
    def detach(df: DataFrame) -> DataFrame:
        return df.drop(BUCKET)

    def _sorted(self, forward: bool) -> list[Column]:
        return [F.col(k).asc() if forward else F.col(k).desc() for k in self.keys]

    def _carried(self, table: DataFrame, width: int) -> DataFrame:
        """Bucket tables hold at most ``MAX_BUCKETS`` rows; broadcast while cells stay few."""
        return F.broadcast(table) if self.buckets * width <= CARRY_BROADCAST_CELLS else table

    def _edge_rows(self, df: DataFrame, row: Column, reach: int, back: bool) -> DataFrame:
        """For each bucket the at most ``reach`` rows just outside it, nearest last.

        Every bucket hands on its outermost ``reach`` rows. Of two neighbours' rows only ``reach`` reach further, and so on, so
        the carry is put together over distances of 1, 2, 4 .. buckets, each time cut to ``reach``: no bucket table holds more
        than that many rows for a bucket, and the rounds end when every bucket has them or has seen all before it.
        """
        from_edge = Window.partitionBy(BUCKET).orderBy(*self._sorted(not back))
        edge = (
            df.select(BUCKET, row.alias("row"), F.row_number().over(from_edge).alias("rank"))
            .filter(F.col("rank") <= reach)
            .groupBy(BUCKET)
            .agg(F.sort_array(F.collect_list(F.struct((-F.col("rank")).alias("far"), "row"))).alias("rows"))
        )
        step = F.col(BUCKET).asc() if back else F.col(BUCKET).desc()
        in_order = Window.orderBy(step)
        table = edge.select(BUCKET, F.col("rows.row").alias("rows"))
        none = F.array().cast(table.schema["rows"].dataType)
        if reach > 1:
            # The buckets that hold rows, numbered in the direction of the carry.
            table = materialize(table.withColumn("at", F.row_number().over(in_order)), "edges")
            buckets, least = table.agg(F.count(F.lit(1)), F.min(F.size("rows"))).first()
            distance = 1
            while buckets and distance < buckets and least < reach:
                further = table.select((F.col("at") + distance).alias("at"), F.col("rows").alias("_further"))
                more = F.concat(F.coalesce("_further", none), "rows")
                cut = F.slice(more, F.greatest(F.size(more) - reach, F.lit(0)) + 1, reach).alias("rows")
                table = materialize(table.join(further, "at", "left").select(BUCKET, "at", cut), "edges")
                distance *= 2
                # Buckets no further from the start than that have met all rows before them.
                least = table.filter(F.col("at") > distance).agg(F.min(F.size("rows"))).first()[0] or reach
            before = table.select((F.col("at") + 1).alias("at"), F.col("rows").alias("_before"))
            return table.join(before, "at", "left").select(BUCKET, F.coalesce("_before", none).alias("carry"))
        return table.select(BUCKET, F.coalesce(F.lag("rows").over(in_order), none).alias("carry"))

    def shift(self, df: DataFrame, wanted: Mapping[str, tuple[str, int]]) -> DataFrame:
        """Add columns: ``new: (column, offset)``, the value ``offset`` rows back (ahead if negative)."""
        for back in (True, False):
            offsets = sorted({abs(o) for _, o in wanted.values() if o and (o > 0) == back})
            if not offsets:
                continue
            sources = list(dict.fromkeys(c for c, o in wanted.values() if o and (o > 0) == back))
            fields = [(c, f"w{i}") for i, c in enumerate(self.within)] + [(c, f"v{i}") for i, c in enumerate(sources)]
            row = F.expr("named_struct(" + ", ".join(f"'{n}', {quoted(c)}" for c, n in fields) + ")")
            carry = self._edge_rows(df, row, offsets[-1], back)
            width = offsets[-1] * (len(sources) + len(self.within))
            here = Window.partitionBy(BUCKET).orderBy(*self._sorted(back))
            df = df.withColumns(
                {"_n": F.row_number().over(here), **{f"_near{o}": F.lag(row, o).over(here) for o in offsets}}
            ).join(self._carried(carry, width), BUCKET, "left")
            kept = [quoted(c) for c in df.columns if c not in ("_n", "carry") and not c.startswith("_near")]
            near = [
                f"CASE WHEN _n > {o} THEN _near{o} ELSE get(carry, size(carry) - 1 - ({o} - _n)) END AS _near{o}"
                for o in offsets
            ]
            # A neighbour counts only if it belongs to the same series.
            same = {
                o: " AND ".join(["true", *[f"_near{o}.w{i} <=> {quoted(c)}" for i, c in enumerate(self.within)]])
                for o in offsets
            }
            added = [
                f"CASE WHEN {same[abs(o)]} THEN _near{abs(o)}.v{sources.index(c)} END AS {quoted(name)}"
                for name, (c, o) in wanted.items()
                if o and (o > 0) == back
            ]
            df = df.selectExpr(*kept, *near).selectExpr(*kept, *added)
        here = [f"{quoted(c)} AS {quoted(n)}" for n, (c, o) in wanted.items() if o == 0]
        return df.selectExpr("*", *here) if here else df

    def fill(self, df: DataFrame, wanted: Mapping[str, str], forward: bool = True) -> DataFrame:
        """Add columns ``new: column``: the value here or else the nearest earlier (later) non-null one."""
        if not wanted:
            return df
        here = (
            Window.partitionBy(BUCKET, *self.within)
            .orderBy(*self._sorted(forward))
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        nearest = F.max_by if forward else F.min_by
        order = F.struct(*self.keys)
        ends = df.groupBy(BUCKET, *self.within).agg(
            *[
                nearest(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"_end{i}")
                for i, c in enumerate(wanted.values())
            ]
        )
        if self.within:
            # Only the outermost series of a bucket can continue in the next one.
            outer = [F.col(k).desc() if forward else F.col(k).asc() for k in self.within]
            ends = (
                ends.withColumn("_o", F.row_number().over(Window.partitionBy(BUCKET).orderBy(*outer)))
                .filter("_o = 1")
                .drop("_o")
            )
        step = F.col(BUCKET).asc() if forward else F.col(BUCKET).desc()
        so_far = Window.partitionBy(*self.within).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
        carry = ends.select(
            F.lead(BUCKET).over(Window.orderBy(step)).alias("_b"),
            *[F.col(k).alias(f"_w{i}") for i, k in enumerate(self.within)],
            *[F.last(f"_end{i}", ignorenulls=True).over(so_far).alias(f"_end{i}") for i in range(len(wanted))],
        )
        match = F.col(BUCKET) == F.col("_b")
        for i, k in enumerate(self.within):
            match = match & F.col(k).eqNullSafe(F.col(f"_w{i}"))
        df = df.withColumns(
            {f"_fill{i}": F.last(c, ignorenulls=True).over(here) for i, c in enumerate(wanted.values())}
        ).join(self._carried(carry, len(wanted) + 1), match, "left")
        helpers = [f"_fill{i}" for i in range(len(wanted))] + [f"_end{i}" for i in range(len(wanted))]
        return df.withColumns(
            {name: F.coalesce(f"_fill{i}", f"_end{i}") for i, name in enumerate(wanted)}
        ).drop("_b", *helpers, *[f"_w{i}" for i in range(len(self.within))])

    def fill_gaps(self, df: DataFrame, columns: Sequence[str], both: bool = True) -> DataFrame:
        """Replace missing values by the next one of their series, else by the last one; with ``both`` off by the last one alone.

        One aggregation takes from every bucket the ends of both directions and the number of gaps, and is written; columns without
        a gap are left as they are.
        """
        names, numbers = list(map(quoted, columns)), range(len(columns))
        order, series = ", ".join(map(quoted, self.keys)), ", ".join(map(quoted, self.within))
        texts = [f"max_by({c}, CASE WHEN {c} IS NOT NULL THEN struct({order}) END) AS _last{i}" for i, c in enumerate(names)]
        texts += [f"min_by({c}, CASE WHEN {c} IS NOT NULL THEN struct({order}) END) AS _first{i}" for i, c in enumerate(names)]
        texts += [f"count_if({c} IS NULL) AS _gaps{i}" for i, c in enumerate(names)]
        ends = df.groupBy(BUCKET, *self.within).agg(*map(F.expr, texts))

        def over(partition: str, by: str, end: str) -> str:
            return f"OVER ({f'PARTITION BY {partition} ' if partition else ''}ORDER BY {by} ROWS BETWEEN UNBOUNDED PRECEDING AND {end})"

        earlier, later = over(series, BUCKET, "1 PRECEDING"), over(series, f"{BUCKET} DESC", "1 PRECEDING")
        carry = materialize(
            ends.selectExpr(
                f"{BUCKET} AS _b",
                *[f"{quoted(k)} AS _w{i}" for i, k in enumerate(self.within)],
                *[f"_gaps{i}" for i in numbers],
                *[f"last(_last{i}, true) {earlier} AS _before{i}" for i in numbers],
                *([f"last(_first{i}, true) {later} AS _after{i}" for i in numbers] if both else []),
            ),
            "fill-ends",
        )
        gaps = carry.selectExpr(*[f"sum(_gaps{i}) AS g{i}" for i in numbers]).first()
        gappy = {i: c for i, c in enumerate(names) if gaps[f"g{i}"]}
        if not gappy:
            return df
        carried = [f"_before{i}" for i in gappy] + ([f"_after{i}" for i in gappy] if both else [])
        # Only series that go on beyond a bucket have something to carry: at most two of them for each bucket.
        carry = carry.filter(" OR ".join(f"{n} IS NOT NULL" for n in carried))
        carry = carry.select("_b", *[f"_w{i}" for i in range(len(self.within))], *carried)
        match = F.col(BUCKET) == F.col("_b")
        for i, k in enumerate(self.within):
            match = match & F.col(quoted(k)).eqNullSafe(F.col(f"_w{i}"))
        own = ", ".join([BUCKET, *map(quoted, self.within)])
        ways = {"_fill": over(own, order, "CURRENT ROW")}
        if both:
            ways["_next"] = over(own, ", ".join(f"{quoted(k)} DESC" for k in self.keys), "CURRENT ROW")
        filled = df.selectExpr("*", *[f"last({c}, true) {way} AS {name}{i}" for name, way in ways.items() for i, c in gappy.items()])
        joined = filled.join(self._carried(carry, 2 * len(carried) + 1), match, "left")
        ahead = "{c}, _next{i}, _after{i}, " if both else "{c}, "
        found = {c: f"coalesce({ahead.format(c=c, i=i)}_fill{i}, _before{i}) AS {c}" for i, c in gappy.items()}
        return joined.selectExpr(*[found.get(c, c) for c in map(quoted, df.columns)])

    def index(self, df: DataFrame, name: str = "row_index") -> DataFrame:
        """Add the 0-based position of each row in the whole order."""
        before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            df.groupBy(BUCKET)
            .agg(F.count(F.lit(1)).alias("_rows"))
            .select(BUCKET, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
        )
        here = Window.partitionBy(BUCKET).orderBy(*self._sorted(True))
        return (
            df.withColumn(name, F.row_number().over(here))
            .join(self._carried(offsets, 1), BUCKET, "left")
            .withColumn(name, F.col(name) - 1 + F.col("_before"))
            .drop("_before")
        )


def global_diff(df: DataFrame, columns: Sequence[str], order: RowOrder, suffix: str = "_diff") -> DataFrame:
    """Change of each column against the previous row of the order."""
    df = order.shift(order.attach(df), {f"_prev{i}": (c, 1) for i, c in enumerate(columns)})
    df = df.withColumns({f"{c}{suffix}": F.col(c) - F.col(f"_prev{i}") for i, c in enumerate(columns)})
    return order.detach(df.drop(*[f"_prev{i}" for i in range(len(columns))]))
