"""Chains of filters against the filters one after another on a list."""

import random

import pytest
from pyspark.sql import functions as F

from checks import views
from roomtide import session
from roomtide.operators import chain, cleaning
from roomtide.operators.chain import Stage, filter_chain
from roomtide.operators.ordered import BUCKET, RowOrder
from roomtide.plans import preprocess

SCHEMA = "at long, room string, x double, y double, z int"


# Lambdas, so that workers, which cannot import this file, get them by value.
jump = lambda now, before: now["x"] - before["x"] >= 3
same = lambda now, before: (now["x"] > 4) & (now["y"] == before["y"])

STAGES = [
    Stage("z <> 3", {"x": "x"}, jump),
    Stage("coalesce(y <> 0, true)", {"x": "x", "y": "y"}, same),
    Stage("z <> 1", {"x": "x", "y": "y"}, same),
]


def brute(rows, within, stages=3):
    """Every stage over the whole list."""
    gates = [lambda r: r[4] is not None and r[4] != 3, lambda r: r[3] is None or r[3] != 0, lambda r: r[4] is not None and r[4] != 1]

    def drops(stage, r, p):
        if stage == 0:
            return None not in (r[2], p[2]) and r[2] - p[2] >= 3
        return None not in (r[2], r[3], p[3]) and r[2] > 4 and r[3] == p[3]

    key = (lambda r: (r[1] is not None, r[1] or "", r[0])) if within else (lambda r: r[0])
    rows = sorted(rows, key=key)
    for stage in range(stages):
        rows = [r for r in rows if gates[stage](r)]
        kept = []
        for i, r in enumerate(rows):
            p = rows[i - 1] if i and (not within or rows[i - 1][1] == r[1]) else None
            if p is None or not drops(stage, r, p):
                kept.append(r)
        rows = kept
    return rows


def table(seed, n):
    draw = random.Random(seed)
    return [
        (i, draw.choice(["a", "b", None]), draw.choice([None, 1.0, 5.0, 6.0, 9.0]), draw.choice([None, 0.0, 1.0, 2.0]), draw.choice([None, 1, 2, 3, 4]))
        for i in draw.sample(range(10 * n), n)
    ]


@pytest.mark.parametrize("within", [[], ["room"]])
@pytest.mark.parametrize(("seed", "buckets"), [(1, 1), (2, 7), (3, 60), (4, 150)])
def test_chain_matches_stage_after_stage(spark, within, seed, buckets):
    rows = table(seed, 150)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = filter_chain(df, RowOrder(df, ["at"], within, buckets), STAGES)
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows, within))


@pytest.mark.parametrize("stages", [1, 2])
def test_shorter_chains_and_fewer_columns(spark, stages):
    rows = table(9, 80)
    df = spark.createDataFrame(rows, SCHEMA)
    found = filter_chain(df, RowOrder(df, ["at"], ["room"], 20), STAGES[:stages], ["z", "at"])
    assert sorted(found.collect(), key=lambda r: r.at) == sorted([(r[4], r[0]) for r in brute(rows, True, stages)], key=lambda r: r[1])
    assert filter_chain(df.limit(0), RowOrder(df.limit(0), ["at"]), STAGES).count() == 0


def test_one_time_and_room_with_most_rows_is_spread(spark):
    rows = [(5, "a", float(i % 7), 1.0, i) for i in range(500)] + [(4, "a", 1.0, 1.0, 0), (6, "a", 2.0, 1.0, 0), (5, None, 2.0, 1.0, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.timestamp_seconds("at").cast("timestamp_ntz"))
    order = RowOrder(df, ["at", "room", "x", "y", "z"], (), 20)
    assert order.attach(df).groupBy(BUCKET).count().agg(F.max("count")).first()[0] < 100
    kept = filter_chain(df, order, [chain.repeats("at", "room")])
    assert sorted((r.at.second, r.room or "", r.x, r.z) for r in kept.collect()) == [(4, "a", 1.0, 0), (5, "", 2.0, 0), (5, "a", 0.0, 0), (6, "a", 2.0, 0)]


@pytest.mark.parametrize("within", [[], ["room_number"]])
@pytest.mark.parametrize("label", ["CO2", "vis"])
def test_valid_readings_equal_the_filters_in_turn(spark, sf_dir, within, label):
    df = views.rooms(spark, sf_dir).withColumn("CO2", F.when(F.col("event_id") % 5 < 2, 30_000.0).otherwise(F.col("CO2")))
    df = df.withColumns({"VOC": F.col("event_id") % 3, "BLE": F.lit(2.0), "tmp": F.floor(F.col("tmp") / 30) * 10 + 10}).drop("event_id")
    found = preprocess.first_valid_readings(df, within, label)
    one = cleaning.range_validity(cleaning.dedup_key(df))
    one = cleaning.drop_fast_rise(one, RowOrder(one, ["date_time", "room_number"], within))
    order = RowOrder(one, ["date_time", "room_number"], within)
    if label == "CO2":
        one = cleaning.drop_zero_readings(one, ["CO2", "VOC", "tmp"])
        one = filter_chain(one, order, [Stage("true", *frozen(one))])
        one = filter_chain(cleaning.drop_zero_readings(one, ["hum"]), order, [Stage("true", *frozen(one))])
    else:
        one = filter_chain(cleaning.drop_zero_readings(one), order, [Stage("true", *frozen(one))])
    one = cleaning.drop_features(one).select(*found.columns)
    assert found.exceptAll(one).count() == one.exceptAll(found).count() == 0 and 0 < found.count() < df.count()


def frozen(df):
    stage = cleaning.frozen_stages(df.columns, "other")[0]
    return stage.values, stage.check


def test_one_shuffle_and_one_written_table_of_readings(spark, sf_dir, monkeypatch):
    df = views.rooms(spark, sf_dir).drop("event_id")
    written = []

    def count(frame, label):
        written.append((label, frame.count(), frame._jdf.queryExecution().executedPlan().toString()))
        return session.materialize(frame, label)

    monkeypatch.setattr(chain, "materialize", count)
    found = preprocess.first_valid_readings(df, [])
    readings = [w for w in written if w[1] >= found.count()]
    assert len(readings) == 1 and readings[0][2].count("Exchange hashpartitioning") == 1 and readings[0][2].count("Sort [") == 1
    assert [w[0] for w in written] == ["chain", "chain-settled"]


def test_readings_without_some_measures(spark, sf_dir):
    df = views.rooms(spark, sf_dir).select("date_time", "room_number", "tmp", "hum", "vis")
    kept = preprocess.first_valid_readings(df, [])
    assert kept.count() == cleaning.drop_zero_readings(cleaning.range_validity(cleaning.dedup_key(df))).count()
    with pytest.raises(ValueError, match="CO2"):
        preprocess.first_valid_readings(df, [], label="vis")
