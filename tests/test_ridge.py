import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from checks.model import _hourly
from roomtide.operators import ridge
from roomtide.operators.encoding import SparseOneHot
from roomtide.plans import forecast

SCHEMA = "split string, ones array<int>, numbers array<double>, targets array<double>"


def random_rows(n, ones, numbers, targets, seed=3):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        hot = sorted(draw.choice(ones, draw.integers(0, 4), replace=False).tolist()) if ones else []
        rows.append((["train", "val", "test"][i % 3], hot, draw.normal(size=numbers).tolist(), draw.normal(size=targets).tolist()))
    return rows


def dense(rows, ones, part):
    x = [[*[float(p in r[1]) for p in range(ones)], 1.0, *r[2]] for r in rows if r[0] == part]
    return np.array(x), np.array([r[3] for r in rows if r[0] == part])


@pytest.mark.parametrize(("ones", "numbers"), [(6, 3), (0, 2), (5, 0)])
def test_sums_and_weights_match_numpy(spark, ones, numbers):
    rows = random_rows(150, ones, numbers, 2)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for part, gram in ridge.grams(frame, ones, numbers, 2).items():
        x, y = dense(rows, ones, part)
        assert gram.n == len(x)
        assert np.allclose(gram.xx, x.T @ x) and np.allclose(gram.xy, x.T @ y) and np.allclose(gram.yy, y.T @ y)
    fitted = ridge.fit_ridge(frame, ones, numbers, 2)
    x, y = dense(rows, ones, "train")
    free = np.eye(ones + 1 + numbers)
    free[ones, ones] = 0
    weights = {p: np.linalg.solve(x.T @ x / len(x) + p * free, x.T @ y / len(x)) for p in ridge.PENALTIES}
    x, y = dense(rows, ones, "val")
    errors = {p: ((y - x @ w) ** 2).mean() for p, w in weights.items()}
    assert fitted.errors == pytest.approx(errors) and fitted.penalty == min(errors, key=errors.get)
    assert np.allclose(fitted.weights, weights[fitted.penalty])
    again = ridge.Ridge.from_json(fitted.to_json())
    predicted = np.array([r.p for r in spark.createDataFrame(rows, SCHEMA).coalesce(1).select(again.predict().alias("p")).collect()])
    whole = np.array([[*[float(p in r[1]) for p in range(ones)], 1.0, *r[2]] for r in rows])
    assert np.allclose(predicted, whole @ fitted.weights)


def test_parts_that_are_missing_and_too_many_inputs(spark):
    rows = [r for r in random_rows(60, 3, 1, 1) if r[0] == "train"]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert ridge.fit_ridge(frame, 3, 1, 1, [0.5, 0.1]).penalty == 0.5
    with pytest.raises(ValueError, match="no training rows"):
        ridge.fit_ridge(frame.limit(0), 3, 1, 1)
    with pytest.raises(ValueError, match="estimator"):
        ridge.fit_ridge(frame, ridge.MOST_INPUTS, 1, 1)
    assert frame.limit(0).select(ridge.fit_ridge(frame, 3, 1, 1).predict()).count() == 0


def test_unknown_and_missing_categories_have_no_one(spark):
    known = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "room string, day int")
    encoder = SparseOneHot.fit(known, ["room", "day"])
    asked = spark.createDataFrame([(1, "c", 1), (2, "z", 2), (3, None, None)], "id int, room string, day int")
    rows = {r.id: r for r in encoder.codes(asked).select("id", "room", "day", encoder.ones([["room", "day"]]).alias("ones")).collect()}
    assert (encoder.sizes, rows[1].ones, rows[2].ones, rows[3].ones) == ((3, 2), [2, 3], [4], [])
    assert (rows[2].room, rows[3].day) == (-1, -1)


def test_sparse_and_dense_forecasts_agree(spark, sf_dir):
    df = _hourly(spark, sf_dir)
    found = []
    for make in (forecast.sparse_frames, forecast.supervised_frames):
        fitted = make(df, "CO2", ["dayofweek", "room_number"], input_steps=2, horizons=3, skip_scale=False)
        scored = forecast.predictions_with_actuals(fitted, forecast.forecast_train(fitted, penalties=[0.1]))
        found.append({(r.date_time, r.room_number): r["prediction_t+2"] for r in scored.collect()})
    assert found[0] == pytest.approx(found[1]) and found[0]


def test_no_column_for_a_room_in_the_plan(spark, sf_dir):
    fitted = forecast.sparse_frames(_hourly(spark, sf_dir), "CO2", ["dayofweek", "room_number"])
    plan = fitted.rows._jdf.queryExecution().toString()
    assert "__room_number" not in plan and fitted.ones == 15 and fitted.numbers == 3


def test_estimators_of_spark_ml_still_fit_dense_vectors(spark, sf_dir):
    fitted = forecast.supervised_frames(_hourly(spark, sf_dir), "CO2", ["dayofweek", "room_number"], horizons=2)
    models = forecast.forecast_train(fitted, LinearRegression(regParam=0.1))
    assert len(models) == 2
    scored = forecast.predictions_with_actuals(fitted, models)
    assert scored.filter(F.col("`prediction_t+1`").isNull()).count() == 0
