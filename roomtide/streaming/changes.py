"""Each reading beside the one before it in its room, over readings that keep arriving.

The state of a room is its last reading. A micro-batch's readings of a room are put in order, each meets the one before, and the
last one is kept. A reading that is not after its room's last one is late and is left out: its place in the order
has already been passed. With ``idle`` a timer on event time drops the state of a room that has been silent that long; its next
reading then is a first one again.

A room is one key of the state store, so one micro-batch's readings of a room meet in one task. How many that are is bounded by
the source's limits (``maxFilesPerTrigger``, ``maxBytesPerTrigger``), not by the length of the stream.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.calendar import duration_micros, from_micros, micros
from ..functions.text import quoted
from ..operators.cleaning import risen_fast
from ..schema import ROOM, TIME, numeric_columns
from .bins import LATENESS

#: Readings of a room that are handed on at once.
ROWS_AT_ONCE = 10_000

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_state(spark: SparkSession) -> None:
    """Keyed state with timers needs the RocksDB state store; checkpoints still go to the checkpoint folder."""
    spark.conf.set(PROVIDER, ROCKS)


class PreviousReading(StatefulProcessor):
    """``ties`` and ``columns`` number the tiebreaks ``t<i>`` and those columns ``c<i>`` whose value before is asked for."""

    def __init__(self, ties: int, columns: Sequence[int], state: T.StructType, idle_ms: int | None):
        self.order, self.columns = ["at", *[f"t{i}" for i in range(ties)]], [f"c{i}" for i in columns]
        self.state, self.idle_ms = state, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Columns of Arrow while they wait to be put in order, the room left out; rows become objects a few at a time.
        parts = [pa.Table.from_pandas(part.drop(columns="room"), preserve_index=False) for part in rows]
        table = pa.concat_tables(parts, promote_options="default").combine_chunks()
        del parts
        places = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in self.order])
        before = self.last.get() if self.last.exists() else None
        if before is not None:
            passed = np.ones(len(table), bool)
            for name, mark in reversed([*zip(self.order, before, strict=False)]):
                values = table[name].to_numpy()
                passed = (values < mark) | ((values == mark) & passed)
            places = places.slice(int(passed.sum()))
        if not len(places):
            return
        asked = ["at", *self.columns]
        first = [None] * len(asked) if before is None else [before[0], *before[len(self.order) :]]
        end = table.take(places.slice(len(places) - 1)).to_pandas()
        last = [end[c].iloc[-1] for c in [*self.order, *self.columns]]
        self.last.update(tuple(None if pd.isna(v) else getattr(v, "item", lambda v=v: v)() for v in last))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(last[0]) // 1000 + self.idle_ms)
        for start in range(0, len(places), ROWS_AT_ONCE):
            found = table.take(places.slice(start, ROWS_AT_ONCE)).to_pandas()
            ends = [found[name].iloc[-1] for name in asked]
            for i, (name, value) in enumerate(zip(asked, first, strict=True)):
                # Objects keep whole numbers and missing values as they are.
                column = pd.Series([value, *found[name].iloc[:-1]], dtype=object)
                found[f"p{i}"] = column.astype(float) if found[name].dtype.kind == "f" else column.map(lambda v: v if v is None else str(v))
            found.insert(0, "room", pd.Series([key[0]] * len(found), dtype=object))
            yield found
            first = ends

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def _carried_as(kind: T.DataType) -> str:
    """Types that pandas keeps as they are, nulls included; others travel as text."""
    return "double" if isinstance(kind, (T.DoubleType, T.FloatType)) else "string"


def with_previous(
    stream: DataFrame,
    columns: Sequence[str],
    ties: Sequence[str],
    time: str = TIME,
    room: str = ROOM,
    lateness: str = LATENESS,
    idle: str | None = None,
) -> DataFrame:
    """Add ``_prev_time`` and, for each column ``i``, ``_prev<i>``: those of the room's reading before; for append mode.

    Rows without a time are left out. ``ties`` are whole numbers that are never null and order readings at one time.
    """
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    rest = [c for c in stream.columns if c not in (time, room, *ties)]
    known = stream.filter(F.col(quoted(time)).isNotNull())
    marked = known.withColumn("event", F.col(quoted(time)).cast("timestamp")).withWatermark("event", lateness)
    carried = marked.select(
        F.col(quoted(room)).cast("string").alias("room"),
        micros(F.col(quoted(time))).alias("at"),
        *[F.col(quoted(t)).cast("long").alias(f"t{i}") for i, t in enumerate(ties)],
        *[F.col(quoted(c)).cast(_carried_as(kinds[c])).alias(f"c{i}") for i, c in enumerate(rest)],
        "event",
    )
    types = dict(carried.dtypes)
    asked = [rest.index(c) for c in columns]
    state = ["at bigint", *[f"t{i} bigint" for i in range(len(ties))], *[f"c{i} {types[f'c{i}']}" for i in asked]]
    previous = ["p0 string", *[f"p{i + 1} {types[f'c{at}']}" for i, at in enumerate(asked)]]
    processor = PreviousReading(len(ties), asked, T.StructType.fromDDL(", ".join(state)), duration_micros(idle) // 1000 if idle else None)
    found = carried.groupBy("room").transformWithStateInPandas(
        processor,
        outputStructType=", ".join([*[f"{n} {k}" for n, k in types.items()], *previous]),
        outputMode="append",
        timeMode="EventTime",
    )
    back = {time: from_micros(F.col("at")), room: F.col("room")}
    back |= {t: F.col(f"t{i}") for i, t in enumerate(ties)} | {c: F.col(f"c{i}") for i, c in enumerate(rest)}
    return found.select(
        *[back[c].cast(kinds[c]).alias(c) for c in stream.columns],
        from_micros(F.col("p0").cast("long")).alias("_prev_time"),
        *[F.col(f"p{i + 1}").cast(kinds[c]).alias(f"_prev{i}") for i, c in enumerate(columns)],
    )


def stream_room_diff(
    stream: DataFrame, ties: Sequence[str], label: str = "CO2", columns: Sequence[str] | None = None, time: str = TIME, room: str = ROOM, **how
) -> DataFrame:
    """Change of every number but the label against the room's reading before, as ``*_diff``."""
    columns = [c for c in columns or numeric_columns(stream.schema) if c not in (label, time, room, *ties)]
    found = with_previous(stream, columns, ties, time, room, **how)
    diffs = [f"{quoted(c)} - _prev{i} AS {quoted(c + '_diff')}" for i, c in enumerate(columns)]
    return found.selectExpr(*map(quoted, stream.columns), *diffs)


def stream_drop_fast_rise(
    stream: DataFrame,
    ties: Sequence[str],
    columns: Sequence[str] = ("VOC", "CO2"),
    rise: float = 1000.0,
    seconds: int = 60,
    whole_delta: bool = False,
    time: str = TIME,
    room: str = ROOM,
    **how,
) -> DataFrame:
    """Drop a reading whose value rose by ``rise`` or more since the room's reading before, within ``seconds``."""
    columns = [c for c in columns if c in stream.columns]
    if not columns:
        return stream
    found = with_previous(stream, columns, ties, time, room, **how)
    previous = {c: f"_prev{i}" for i, c in enumerate(columns)}
    return found.filter(~risen_fast(previous, "_prev_time", rise, seconds, whole_delta, time)).select(*map(quoted, stream.columns))
