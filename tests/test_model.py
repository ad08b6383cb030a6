import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.operators import encoding, metrics, splits
from roomtide.operators.explore import rotate_tail
from roomtide.operators.ordered import RowOrder
from roomtide.plans import forecast
from checks import views
from checks.model import _hourly


def test_split_positions():
    sizes = splits.split_sizes(101)
    assert (sizes.train_start, sizes.train_end, sizes.test_start) == (1, 81, 81)
    sizes = splits.split_sizes(20_000)
    assert sizes.test_start - sizes.train_end == 2
    with pytest.raises(ValueError):
        splits.split_sizes(100)


def test_split_is_ordered_and_complete(spark):
    df = spark.range(1234).select(F.pmod(F.col("id") * 7919, F.lit(1234)).alias("t"))
    rows = splits.time_series_split(df, RowOrder(df, ["t"])).orderBy("t").collect()
    assert [r.t for r in rows] == list(range(1234))
    labels = [r.split for r in rows]
    order = ["unused", "train", "val", "gap", "test"]
    assert [order.index(x) for x in labels] == sorted(order.index(x) for x in labels)
    assert labels.count("test") == int(1234 * 0.2)


def test_population_scaling_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 7.0, 0), (2.0, 7.0, 1), (4.0, 7.0, 1)], "x double, c double, flag int")
    fitted = encoding.StandardScaler.fit(df)
    assert fitted.features == ("x", "c")
    out = fitted.transform(df).orderBy("x").collect()
    expected = (np.array([1, 2, 4]) - 7 / 3) / np.std([1, 2, 4])
    assert [r.x for r in out] == pytest.approx(list(expected))
    assert [r.c for r in out] == [0.0, 0.0, 0.0]
    assert list(out[0].asDict()) == ["flag", "x", "c"]


def test_missing_value_is_not_binary(spark):
    df = spark.createDataFrame([(0, 0), (1, None)], "a int, b int")
    assert encoding.binary_columns(df) == ["a"]


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([(7.0,), (7.0,), (None,)], "x double")
    assert [r.x for r in encoding.minmax_scale(df, "x").collect()] == [0.0, 0.0, None]


def test_many_categories_have_positions(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 12_000).alias("kind"), F.when(F.col("id") > 5, F.lit("x")).alias("name"))
    got = {r.id: r.encoded for r in encoding.one_hot_sparse(df, ["kind", "name"]).collect()}
    assert got[0] == [0] and got[5] == [5] and got[12_007] == [7, 12_000] and len(got) == 20_000


@pytest.mark.parametrize(
    "y, p, expected",
    [([1.0, 2, 3], [2.0, 4, 7], (7.0, math.sqrt(7), (1 + 1 + 4 / 3) / 3, -9.5)), ([5.0, 5], [5.0, 5], (0, 0, 0, 1.0)), ([5.0, 5], [4.0, 6], (1, 1, 0.2, 0.0))],
)
def test_metrics(spark, y, p, expected):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    row = metrics.evaluate(df, by=())
    got = row.first()
    assert (got.mse, got.rmse, got.mape, got.r2) == pytest.approx([round(v, 2) for v in expected])


@pytest.mark.parametrize("rooms, expected", [(7, [5, 6, 0, 1, 2, 3, 4]), (3, [0, 1, 2])])
def test_last_five_rooms_come_first(spark, rooms, expected):
    df = spark.range(rooms).select(F.col("id").cast("string").alias("room"))
    got = rotate_tail(df, "room").orderBy("room").collect()
    assert [r.position for r in got] == expected


def test_lags_stay_inside_a_split(spark, sf_dir):
    frames = forecast.supervised_frames(_hourly(spark, sf_dir), "CO2", ["dayofweek", "room_number"], within=["room_number"])
    first = frames.rows.groupBy("split", "room_number").agg(F.min("date_time").alias("t"))
    raw = frames.rows.join(first, ["split", "room_number"]).filter("date_time < t")
    assert raw.count() == 0
    assert set(frames.inputs) == {f"{c}(t-1)" for c in frames.columns}


@pytest.mark.parametrize("skip_scale", [True, False])
def test_forecast_round_trip(spark, sf_dir, skip_scale):
    df = _hourly(spark, sf_dir)
    fitted = forecast.supervised_frames(df, "CO2", ["dayofweek", "room_number"], horizons=2, skip_scale=skip_scale)
    models = forecast.forecast_train(fitted)
    scored = forecast.predictions_with_actuals(fitted, models)
    assert {"prediction_t+0", "prediction_t+1", "CO2(t)", "CO2(t+1)"} <= set(scored.columns)
    new = forecast.forecast_predict(forecast.inference_vectors(df, fitted), models)
    assert new.count() == df.count()
    assert new.filter(F.col("`prediction_t+0`").isNull()).count() == 0


def test_views_need_no_row_filters(spark, sf_dir):
    assert views.readings(spark, sf_dir).count() == views.table(spark, sf_dir, "events").count()
