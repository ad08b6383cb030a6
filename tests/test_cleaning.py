from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.functions import hashing
from roomtide.operators import cleaning, forest, outliers
from roomtide.operators.forest import remove_outliers_forest
from roomtide.operators.ordered import RowOrder
from checks import views


def test_any_missing_value_drops_the_row(spark):
    df = spark.createDataFrame([(1, 1, 1), (None, 2, 2), (3, 3, None)], "a int, b int, c int")
    assert cleaning.drop_incomplete_rows(df).count() == 1
    assert cleaning.drop_incomplete_rows(df, max_null_fraction=0.4).count() == 3


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert cleaning.nan_to_null(df).dropna().count() == 1


def rise(spark, step):
    start = datetime(2024, 1, 1)
    rows = [(start, 400.0, 450.0), (start + step, 1500.0, 450.0)]
    return spark.createDataFrame(rows, "date_time timestamp_ntz, CO2 double, VOC double")


@pytest.mark.parametrize(
    "step, whole, kept",
    [
        (timedelta(seconds=30), False, 1),
        (timedelta(seconds=60), False, 2),
        (timedelta(days=1, seconds=30), False, 1),
        (timedelta(days=1, seconds=30), True, 2),
    ],
)
def test_fast_rise_uses_the_seconds_part(spark, step, whole, kept):
    df = rise(spark, step)
    assert cleaning.drop_fast_rise(df, RowOrder(df, ["date_time"]), whole_delta=whole).count() == kept


def test_fast_rise_without_measures_keeps_all(spark):
    df = rise(spark, timedelta(seconds=1)).drop("CO2", "VOC")
    assert cleaning.drop_fast_rise(df, RowOrder(df, ["date_time"])).count() == 2


def test_two_frozen_passes_differ_from_one(spark, sf_dir):
    df = views.readings_spiky(spark, sf_dir)
    order = RowOrder(df, ["date_time", "event_id"])
    assert cleaning.drop_frozen_spikes(df, order, "CO2").count() < cleaning.drop_frozen_spikes(df, order, "other").count()


def test_dedup_key_prefers_the_tiebreak_and_keeps_missing(spark):
    rows = [(1, "a", 9, None), (1, "a", 2, "x"), (2, "a", 1, "y"), (1, None, 1, "z"), (1, None, 0, "w")]
    df = spark.createDataFrame(rows, "date_time int, room_number string, n int, s string")
    got = {(r.date_time, r.room_number): (r.n, r.s) for r in cleaning.dedup_key(df, tiebreak=["n"]).collect()}
    assert got == {(1, "a"): (2, "x"), (2, "a"): (1, "y"), (1, None): (0, "w")}


def test_iqr_replace_options(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100, -100]], "x double")
    for how, value in (("MAX", 4.0), ("min", 1.0), ("Mean", 2.5)):
        got = sorted(r.x for r in outliers.remove_outliers(df, "x", how).collect())
        assert got == sorted([1.0, 2.0, 3.0, 4.0, value, value])
    assert outliers.remove_outliers(df, "x").count() == 4
    with pytest.raises(ValueError, match="replaced by"):
        outliers.iqr_replace(df, "x", "median")


def test_missing_stays_when_replaced_and_goes_when_filtered(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert outliers.iqr_replace(df, ["x"], "mean").count() == 3
    assert outliers.iqr_filter(df, "x").count() == 2


def test_fill_na_is_backward_then_forward(spark):
    rows = [(i, v, d) for i, (v, d) in enumerate([(None, None), (2.0, 1.0), (None, None), (4.0, 2.0), (None, None)])]
    df = spark.createDataFrame(rows, "date_time int, v double, v_diff double")
    got = cleaning.fill_na(df, RowOrder(df, ["date_time"], buckets=3)).orderBy("date_time").collect()
    assert [r.v for r in got] == [2.0, 2.0, 4.0, 4.0, 4.0]
    assert [r.v_diff for r in got] == [0.0, 1.0, 0.0, 2.0, 0.0]


def test_forest_removes_the_share_and_repeats(spark, sf_dir):
    df = views.readings(spark, sf_dir)
    kept = remove_outliers_forest(df, seed=3)
    ids = {r.event_id for r in kept.select("event_id").collect()}
    assert len(ids) == pytest.approx(df.count() * 0.925, abs=2)
    again = remove_outliers_forest(df.repartition(5), seed=3)
    assert ids == {r.event_id for r in again.select("event_id").collect()}


def test_forest_finds_an_obvious_outlier(spark):
    rows = [(i, 400.0 + i % 7, 20.0 + i % 3, 1.0, 40.0, 450.0 + i % 5) for i in range(200)] + [(999, 9000.0, 49.0, 900.0, 99.0, 9000.0)]
    df = spark.createDataFrame(rows, "id int, CO2 double, tmp double, vis double, hum double, VOC double")
    kept = remove_outliers_forest(df, contamination=0.02)
    assert 999 not in {r.id for r in kept.collect()}


def brute_forest(points, hashes, trees, share, seed, levels):
    """Paths of all points in all trees, with lists of points instead of sums."""
    paths = []
    for tree in range(trees):
        taken = [i for i, h in enumerate(hashes) if hashing.uniform(seed, np.array([h], np.int64).view(np.uint64), np.array([tree]))[0] < share]
        path = {}
        todo = [(1, taken, list(range(len(points))), 0)]
        while todo:
            node, own, every, level = todo.pop()
            ranges = [(min(points[i][f] for i in own), max(points[i][f] for i in own)) for f in range(len(points[0]))]
            varied = [f for f, (a, b) in enumerate(ranges) if b > a]
            if len(own) < 2 or not varied or level == levels:
                path |= {i: level + float(forest.mean_path(np.array(len(own)))) for i in every}
                continue
            draw = [float(hashing.uniform(seed + k, np.array([tree]), np.array([node]))[0]) for k in (1, 2)]
            f = varied[int(draw[0] * len(varied))]
            cut = min(ranges[f][0] + draw[1] * (ranges[f][1] - ranges[f][0]), np.nextafter(ranges[f][1], -np.inf))
            for side, right in ((2 * node, False), (2 * node + 1, True)):
                todo.append((side, *[[i for i in rows if (points[i][f] > cut) == right] for rows in (own, every)], level + 1))
        paths.append([path[i] for i in range(len(points))])
    return np.array(paths).mean(axis=0)


@pytest.mark.parametrize(("levels", "share"), [(1, 1.0), (4, 0.8), (8, 0.5)])
def test_forest_matches_trees_grown_from_lists(spark, levels, share):
    draw = np.random.default_rng(5)
    rows = [(float(a), float(b), 1.0) for a, b in draw.integers(0, 12, (150, 2))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = forest.anomaly_scores(df, ["a", "b", "c"], trees=5, sample=share, seed=9, levels=levels)
    got = sorted((r.a, r.b, r.anomaly_score) for r in found.collect())
    keyed = sorted(map(tuple, df.select("a", "b", "c", F.xxhash64("a", "b", "c")).collect()))
    mean = brute_forest([r[:3] for r in keyed], [r[3] for r in keyed], 5, share, 9, levels)
    sampled = max(sum(hashing.uniform(9, np.array([r[3]], np.int64).view(np.uint64), np.array([t]))[0] < share for r in keyed) for t in range(5))
    expected = [(r[0], r[1], -(2 ** (-m / float(forest.mean_path(np.array(sampled)))))) for r, m in zip(keyed, mean, strict=True)]
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert np.allclose([g[2] for g in got], [e[2] for e in expected])


def test_every_reading_takes_part_and_none_is_collected(spark, sf_dir):
    """No pool: over all trees the samples hold the stated share of the whole table."""
    points = views.readings(spark, sf_dir).select(F.xxhash64("event_id").alias("h"), "CO2", "tmp")
    grown = forest.grow_forest(points, 20, 0.8, 1, 3)
    assert 0.75 < grown.sampled / points.count() < 0.85
    sums = forest._level_ranges(points, forest.Forest.of(20, 3), 0, 2, 1.0, 1)
    assert sorted(sums["tree"]) == list(range(20)) and set(sums["n"]) == {points.count()}


def test_forest_without_complete_readings_keeps_all(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 3.0)], "id int, CO2 double, tmp double")
    assert remove_outliers_forest(df, features=["CO2", "tmp"]).count() == 2
    assert remove_outliers_forest(df.limit(0), features=["CO2", "tmp"]).count() == 0


def test_nodes_at_the_height_limit_are_only_counted(spark, sf_dir):
    points = views.readings(spark, sf_dir).select(F.xxhash64("event_id").alias("h"), "CO2", "tmp")
    grown = forest.grow_forest(points, 6, 0.8, 1, 3)
    last = forest._level_ranges(points, grown, 3, 2, 0.8, 1)
    assert (last["node"] >= 8).all() and last["n"].sum() > 0 and np.isinf(last[["low0", "high0", "low1", "high1"]]).all().all()


def test_walks_follow_the_cuts():
    draw = np.random.default_rng(2)
    grown = forest.Forest.of(7, 4)
    grown.feature[:, 1:16] = draw.integers(-1, 3, (7, 15))
    grown.cut[:, 1:16] = draw.random((7, 15))
    points = draw.random((50, 3))
    for levels in range(5):
        got = forest.Walk(grown).places(points, levels).reshape(50, 7) - np.arange(7) * 32
        for (i, t), node in np.ndenumerate(got):
            at = 1
            for _ in range(levels):
                f = grown.feature[t, at]
                at = at if f < 0 else 2 * at + (points[i, f] > grown.cut[t, at])
            assert node == at
