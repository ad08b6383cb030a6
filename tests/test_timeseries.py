from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roomtide.functions import calendar, climate
from roomtide.operators import lags, timeseries
from roomtide.operators.ordered import RowOrder

START = datetime(2024, 1, 1)


def readings(spark, rows, room="r"):
    data = [(START + timedelta(hours=h), room, v) for h, v in rows]
    return spark.createDataFrame(data, "date_time timestamp_ntz, room_number string, v double")


def test_gap_carry_and_exclusive_window_edge(spark):
    df = readings(spark, [(1, 1.0), (2, 3.0), (25, 10.0), (7 * 24 + 5, 7.0)])
    binned = timeseries.resample_mean(df, "1d", ["v"])
    rolled = timeseries.rolling_time_mean(binned, "3d", "1d", ["v"]).orderBy("date_time").collect()
    assert [r.v for r in rolled] == [2.0, 6.0, 6.0, 10.0, None, None, None, 7.0]
    assert [r.date_time.day for r in rolled] == list(range(1, 9))
    edge = timeseries.resample_mean(readings(spark, [(0, 1.0), (72, 5.0)]), "1d", ["v"])
    values = timeseries.rolling_time_mean(edge, "3d", "1d", ["v"]).orderBy("date_time").collect()
    assert [r.v for r in values][-1] == 5.0


@pytest.mark.parametrize("every, window", [("1d", "3d"), ("1h", "5h"), ("7h", "21h"), ("3d", "9d"), ("30min", "30min")])
def test_resample_and_roll_equal_pandas(spark, every, window):
    df = spark.range(400).select(
        F.expr("timestampadd(MINUTE, CAST(pmod(id * 997, 30011) AS INT), TIMESTAMP_NTZ'2024-02-26 05:17:00')").alias("date_time"),
        F.when(F.col("id") % 5 == 0, "x").otherwise("y").alias("room_number"),
        ((F.col("id") % 64) / 8).alias("v"),
    )
    binned = timeseries.resample_mean(df, every, ["v"])
    got = timeseries.rolling_time_mean(binned, window, every, ["v"]).toPandas()
    frames = []
    for room, part in df.toPandas().groupby("room_number"):
        bins = part.set_index("date_time").sort_index()[["v"]].resample(every).mean()
        frames.append(bins.rolling(window).mean().assign(room_number=room).reset_index())
    expected = pd.concat(frames)
    keys = ["room_number", "date_time"]
    a = got[[*keys, "v"]].sort_values(keys).reset_index(drop=True)
    b = expected[[*keys, "v"]].sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False, check_index_type=False)


def test_cut_lineage_changes_nothing(spark):
    df = readings(spark, [(1, 1.0), (30, 2.0), (31, 4.0), (200, 8.0)])
    a = timeseries.resample_roll(df, "3d", "1d").toPandas().sort_values("date_time").reset_index(drop=True)
    b = timeseries.resample_roll(df, "3d", "1d", cut_lineage=True).toPandas().sort_values("date_time").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)


def test_long_series_is_cut_into_stretches(spark, monkeypatch):
    monkeypatch.setattr(timeseries, "CHUNK_BINS", 5)
    df = readings(spark, [(h, float(h % 8)) for h in range(0, 400, 3)])
    binned = timeseries.resample_mean(df, "1h", ["v"])
    got = timeseries.rolling_time_mean(binned, "12h", "1h", ["v"]).toPandas().set_index("date_time").sort_index()
    bins = df.toPandas().set_index("date_time")[["v"]].resample("1h").mean()
    pd.testing.assert_series_equal(got["v"], bins.rolling("12h").mean()["v"], check_freq=False, check_index_type=False)


def test_count_window_needs_all_values(spark):
    rows = [(24 * i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0])]
    daily = timeseries.calendar_resample(readings(spark, rows), ["v"])
    got = timeseries.rolling_count_mean(daily, ["v"]).orderBy("date_time").collect()
    assert [r.v for r in got] == [None] * 7 + [6.0]


def test_roll_off_passes_readings_through(spark):
    df = readings(spark, [(1, 1.0), (2, None)])
    assert timeseries.resample_roll(df, roll=False).count() == 1


def test_ratio_and_levels(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (450.0, 900.0)], "VOC double, CO2 double")
    assert [r[0] for r in df.select(climate.voc_co2_ratio()).collect()] == [5.0, 0.0, 0.5]
    levels = spark.createDataFrame([(849.0,), (850.0,), (1200.0,), (1600.0,), (None,)], "CO2 double")
    assert [r[0] for r in levels.select(climate.air_quality_level()).collect()] == ["green", "yellow", "red", "red_blinking", None]


def test_weekday_and_season(spark):
    df = readings(spark, [(0, 1.0)])
    row = calendar.calendar_features(df).first()
    assert (row.year, row.dayofweek, row.hour, row.season) == (3, 0, 0, "winter")


@pytest.mark.parametrize("text, size", [("1d", 86_400_000_000), ("7h", 25_200_000_000), ("1min", 60_000_000), ("h", 3_600_000_000)])
def test_durations(text, size):
    assert calendar.duration_micros(text) == size


def test_bad_duration():
    for text in ("1 month", "0d", "d1"):
        with pytest.raises(ValueError):
            calendar.duration_micros(text)


def test_lag_frame_needs_a_horizon(spark):
    df = readings(spark, [(0, 1.0), (1, 2.0)])
    with pytest.raises(ValueError):
        lags.lag_frame(df, RowOrder(df, ["date_time"]), ["v"], "v", horizons=0)
    with pytest.raises(ValueError):
        lags.inference_frame(df, ["v"], input_steps=2)


@pytest.mark.parametrize(("window", "every"), [("3d", "1d"), ("150min", "1h"), ("14h", "7h")])
def test_bins_with_values_roll_without_a_join(spark, window, every):
    """Gaps longer than the window, a null room, a bin without values: the same as rolling over joined bins."""
    rows = [(datetime(2024, 1, 1) + timedelta(hours=h), room, None if h == 50 else float(h), float(h % 7)) for room in ("a", None) for h in (0, 1, 5, 50, 51, 300, 301, 303)]
    df = spark.createDataFrame(rows, "date_time timestamp_ntz, room_number string, v double, w double")
    got = timeseries.resample_roll(df, window, every)
    binned = timeseries.resample_mean(df, every, ["v", "w"])
    joined = timeseries.rolling_time_mean(binned, window, every, ["v", "w"]).dropna().select(*df.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, joined.collect())) and got.count() > 4
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert every == "7h" or "Join" not in plan
