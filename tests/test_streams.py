"""Streams fed file by file: late rows, restarts, released state."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from roomtide.operators import timeseries
from roomtide.streaming import bins, changes, dedup, sink

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "id long, date_time timestamp_ntz, room_number string, CO2 double, n int"


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


class Feed:
    """A folder that files arrive in, and a place for output and checkpoint."""

    def __init__(self, spark, folder):
        self.spark, self.arrivals = spark, f"{folder}/arrivals"
        self.path, self.checkpoint = f"{folder}/out", f"{folder}/state"

    def arrive(self, *rows):
        frame = self.spark.createDataFrame([(i, at(m), room, v, n) for i, m, room, v, n in rows], SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(self.arrivals)

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).parquet(self.arrivals)

    def run(self, operator, mode):
        frame = operator(self.stream())
        query = sink.write_batches(frame, self.path, self.checkpoint, mode)
        query.awaitTermination()
        return frame.schema, query


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def means(feed, schema, every):
    rows = bins.read_means(feed.spark, feed.path, schema, every, ["CO2"]).collect()
    return {(r.room_number, (r.date_time - DAY).total_seconds() / 60): r.CO2 for r in rows}


def test_bins_follow_new_and_disordered_readings_and_leave_out_late_ones(feed):
    operator = lambda s: bins.stream_bins(s, "1h", ["CO2"], lateness="30 minutes")
    feed.arrive((1, 0, "a", 1.0, 0), (2, 59, "a", 3.0, 0), (3, 200, "a", 8.0, 0), (4, 30, None, 5.0, 0), (5, 31, None, None, 0))
    schema, _ = feed.run(operator, "update")
    assert means(feed, schema, "1h") == {("a", 0): 2.0, ("a", 60): None, ("a", 120): None, ("a", 180): 8.0, (None, 0): 5.0}
    # The watermark stands at minute 170: a bin that ended before is closed, one that ends later is open.
    feed.arrive((6, 10, "a", 100.0, 0), (7, 175, "a", 4.0, 0), (8, 190, "a", 10.0, 0))
    feed.run(operator, "update")
    assert means(feed, schema, "1h") == {("a", 0): 2.0, ("a", 60): None, ("a", 120): 4.0, ("a", 180): 9.0, (None, 0): 5.0}


@pytest.mark.parametrize("every", ["7h", "1d", "90min", "36h"])
def test_bins_equal_the_batch_operator(feed, every):
    rows = [(i, 37 * i + 400 * (i % 2), "ab"[i % 2], float(i % 16), 0) for i in range(120)]
    rows.sort(key=lambda r: r[1])
    for part in (rows[:50], rows[50:51], rows[51:]):
        feed.arrive(*part)
        schema, _ = feed.run(lambda s: bins.stream_bins(s, every, ["CO2"], lateness="1 hour"), "update")
    whole = feed.spark.read.schema(SCHEMA).parquet(feed.arrivals)
    expected = {(r.room_number, (r.date_time - DAY).total_seconds() / 60): r.CO2 for r in timeseries.resample_mean(whole, every, ["CO2"]).collect()}
    assert means(feed, schema, every) == expected


def test_a_failed_batch_is_written_once_after_the_restart(feed):
    operator = lambda s: bins.stream_bins(s, "1h", ["CO2"])
    feed.arrive((1, 0, "a", 1.0, 0))
    schema, _ = feed.run(operator, "update")
    feed.arrive((2, 1, "a", 3.0, 0))

    def half(rows, batch):
        rows.write.mode("overwrite").parquet(f"{feed.path}/{sink.BATCH}={batch}")
        raise ValueError("lost")

    broken = operator(feed.stream()).writeStream.outputMode("update").foreachBatch(half)
    with pytest.raises(Exception, match="lost"):
        broken.option("checkpointLocation", feed.checkpoint).trigger(availableNow=True).start().awaitTermination()
    feed.arrive((3, 2, "a", 8.0, 0))
    feed.run(operator, "update")
    assert means(feed, schema, "1h") == {("a", 0): 4.0}


def test_copies_in_later_batches_are_dropped_and_state_is_released(feed):
    operator = lambda s: dedup.drop_repeats(s, lateness="10 minutes")
    feed.arrive((1, 0, "a", 1.0, 0), (2, 0, "a", 2.0, 0), (3, 0, "b", 2.0, 0), (4, 5, None, 2.0, 0))
    schema, first = feed.run(operator, "append")
    assert first.lastProgress["stateOperators"][0]["numRowsTotal"] == 3
    feed.arrive((5, 0, "a", 3.0, 0), (6, 5, None, 3.0, 0), (7, 100, "a", 3.0, 0))
    _, second = feed.run(operator, "append")
    feed.arrive((8, 0, "a", 3.0, 0), (9, 100, "a", 3.0, 0), (10, 101, "a", 3.0, 0))
    _, third = feed.run(operator, "append")
    found = sink.all_batches(feed.spark, feed.path, schema)
    assert sorted((r.room_number or "", r.date_time) for r in found.collect()) == [
        ("", at(5)), ("a", at(0)), ("a", at(100)), ("a", at(101)), ("b", at(0)),
    ]
    # Only the two times after the watermark of minute 90 are still known.
    assert third.lastProgress["stateOperators"][0]["numRowsTotal"] == 2


def test_the_smallest_copy_stays_whichever_comes_first(feed):
    operator = lambda s: dedup.first_per_key(s, ["id"], lateness="10 minutes")
    feed.arrive((5, 0, "a", 1.0, 7), (4, 0, "a", 2.0, None), (9, 0, "b", 2.0, 1))
    schema, _ = feed.run(operator, "update")
    feed.arrive((3, 0, "a", None, 1), (6, 0, "b", 3.0, 1), (12, 1, "b", 3.0, 1))
    feed.run(operator, "update")
    rows = sink.latest(feed.spark, feed.path, schema, ["date_time", "room_number"]).collect()
    assert sorted((r.id, r.date_time, r.room_number, r.CO2, r.n) for r in rows) == [
        (3, at(0), "a", None, 1), (6, at(0), "b", 3.0, 1), (12, at(1), "b", 3.0, 1),
    ]
    with pytest.raises(ValueError, match="date_time"):
        dedup.drop_repeats(feed.stream(), ["room_number"])


def previous(feed, schema):
    rows = sink.all_batches(feed.spark, feed.path, schema).collect()
    return {r.id: (r.CO2_diff, r.n_diff) for r in rows}


def test_changes_go_on_across_batches_and_restarts(spark, feed):
    changes.use_keyed_state(spark)
    operator = lambda s: changes.stream_room_diff(s, ["id"], label="", columns=["CO2", "n"], lateness="1 minute")
    feed.arrive((2, 5, "a", 3.0, 2**31 - 1), (1, 0, "a", 1.0, None), (3, 5, "a", None, 5), (4, 5, "b", 8.0, 1))
    schema, _ = feed.run(operator, "append")
    assert previous(feed, schema) == {1: (None, None), 2: (2.0, None), 3: (None, 5 - (2**31 - 1)), 4: (None, None)}
    # Reading 6 comes after its room has passed that time.
    feed.arrive((5, 9, "a", 4.0, 6), (6, 4, "a", 50.0, 0), (7, 9, "b", 9.0, 3), (8, 9, None, 1.0, 1))
    feed.run(operator, "append")
    feed.arrive((9, 12, "a", 6.0, 6), (10, 12, None, 3.0, 1))
    feed.run(operator, "append")
    found = previous(feed, schema)
    assert 6 not in found and found[5] == (None, 1) and found[7] == (1.0, 2) and found[9] == (2.0, 0) and found[10] == (2.0, 0)


def test_fast_rise_across_a_batch_edge_and_idle_rooms(spark, feed):
    changes.use_keyed_state(spark)
    operator = lambda s: changes.stream_drop_fast_rise(s, ["id"], ["CO2"], whole_delta=True, seconds=10**6, idle="1h", lateness="1 minute")
    feed.arrive((1, 0, "a", 400.0, 0), (2, 0, "b", 400.0, 0))
    schema, _ = feed.run(operator, "append")
    feed.arrive((3, 5, "a", 1500.0, 0), (4, 6, "a", 1600.0, 0), (5, 300, "c", 1.0, 0))
    feed.run(operator, "append")
    feed.arrive((6, 300, "b", 5000.0, 0), (7, 301, "c", 2000.0, 0))
    feed.run(operator, "append")
    rows = sink.all_batches(spark, feed.path, schema)
    # Room b was silent for an hour, so its rise is not seen; that of room c is.
    assert sorted(r.id for r in rows.collect()) == [1, 2, 4, 5, 6]
    assert set(schema.names) == set(feed.stream().columns)


class Kept:
    """A value of state in memory, and the handle that gives it."""

    value = None

    def getValueState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_readings_of_a_room_are_handed_on_a_few_at_a_time(monkeypatch):
    monkeypatch.setattr(changes, "ROWS_AT_ONCE", 7, raising=False)
    room = changes.PreviousReading(1, [0], None, None)
    room.init(Kept())
    order = np.random.default_rng(4).permutation(40)
    frame = pd.DataFrame({"room": "a", "at": order // 2, "t0": order, "c0": np.where(order % 5, order / 2, np.nan), "c1": [f"x{i}" for i in order]})
    got = list(room.handleInputRows(("a",), iter([frame[:25], frame[25:]]), None))
    whole = pd.concat(got, ignore_index=True)
    assert max(map(len, got)) <= 7 and list(whole["t0"]) == list(range(40)) and list(whole["c1"]) == [f"x{i}" for i in range(40)]
    assert list(whole["p0"]) == [None, *[str(i // 2) for i in range(39)]] and set(whole["room"]) == {"a"}
    assert whole["p1"].iloc[1:].tolist() == pytest.approx(whole["c0"].iloc[:-1].tolist(), nan_ok=True)
    assert room.last.value == (19, 39, 19.5)
    late = pd.DataFrame({"room": "a", "at": [19, 3, 20, 19], "t0": [39, 90, 1, 40], "c0": [1.0, 2.0, 3.0, 4.0], "c1": None})
    (after,) = room.handleInputRows(("a",), iter([late]), None)
    assert after[["at", "t0", "p0", "p1"]].values.tolist() == [[19, 40, "19", 19.5], [20, 1, "19", 4.0]]
