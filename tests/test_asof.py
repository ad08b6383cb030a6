from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roomtide.operators.asof import asof_join, asof_nearest

DAY1, DAY2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def weather(spark):
    return spark.createDataFrame([(DAY1, 1.0), (DAY2, 2.0)], "date timestamp_ntz, tavg double")


@pytest.mark.parametrize("broadcast_bytes", [100_000, 0])
def test_noon_tie_goes_to_the_earlier_day(spark, broadcast_bytes):
    times = [DAY1 + timedelta(hours=12, microseconds=m) for m in (-1, 0, 1)] + [DAY1 - timedelta(days=9), DAY2 + timedelta(days=9)]
    df = spark.createDataFrame([(t,) for t in times], "date_time timestamp_ntz")
    got = asof_nearest(df, weather(spark), broadcast_bytes=broadcast_bytes).orderBy("date_time").collect()
    assert [r.tavg for r in got] == [1.0, 1.0, 1.0, 2.0, 2.0]


@pytest.mark.parametrize("broadcast_bytes", [100_000, 0])
def test_left_rows_stay_without_weather_or_time(spark, broadcast_bytes):
    df = spark.createDataFrame([(DAY1,), (None,)], "date_time timestamp_ntz")
    assert asof_nearest(df, weather(spark).limit(0), broadcast_bytes=broadcast_bytes).count() == 2
    got = asof_nearest(df, weather(spark), broadcast_bytes=broadcast_bytes).collect()
    assert {r.date_time: r.tavg for r in got} == {DAY1: 1.0, None: None}


def sides(spark):
    left = spark.range(300).select(
        F.col("id").alias("l"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"),
        F.expr("timestampadd(MINUTE, CAST(pmod(id * 37, 500) AS INT), TIMESTAMP_NTZ'2024-01-01')").alias("t"),
    )
    right = spark.range(60).select(
        F.col("id").alias("r"),
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("k"),
        F.expr("timestampadd(MINUTE, CAST(pmod(id * 61, 490) AS INT), TIMESTAMP_NTZ'2024-01-01')").alias("u"),
    )
    return left, right


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("tolerance", [None, "5min"])
def test_equals_pandas(spark, direction, by, tolerance):
    left, right = sides(spark)
    if not by:
        right = right.drop("k")
    got = asof_join(left, right, "t", "u", direction, by, tolerance, ["l"], ["r"])
    expected = pd.merge_asof(
        left.toPandas().sort_values(["t", "l"]),
        right.toPandas().sort_values(["u", "r"]),
        left_on="t",
        right_on="u",
        by=by or None,
        direction=direction,
        tolerance=None if tolerance is None else pd.Timedelta(tolerance),
    )
    a = got.select("l", "u", "r").toPandas().sort_values("l").reset_index(drop=True)
    b = expected[["l", "u", "r"]].sort_values("l").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_crowded_right_table_is_not_broadcast(spark):
    left, right = sides(spark)
    crowd = spark.range(200).select(
        (F.col("id") + 1000).alias("r"), F.expr("timestampadd(MILLISECOND, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 03:00:00')").alias("u")
    )
    right = right.drop("k").unionByName(crowd).withColumnRenamed("u", "date")
    right = right.unionByName(spark.sql("SELECT 5000L AS r, TIMESTAMP_NTZ'2030-01-01' AS date"))
    got = asof_nearest(left, right, "t", tiebreak=["r"], left_order=["l"])
    assert "_cell" not in got._jdf.queryExecution().toString()
    expected = pd.merge_asof(
        left.toPandas().sort_values(["t", "l"]), right.toPandas().sort_values(["date", "r"]), left_on="t", right_on="date", direction="nearest"
    )
    a = got.select("l", "date").toPandas().sort_values("l").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, expected[["l", "date"]].sort_values("l").reset_index(drop=True), check_dtype=False)
