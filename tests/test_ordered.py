"""Bucketed order operators equal a plain window, whatever the skew and the bucket count."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from roomtide.operators.ordered import RowOrder


def skewed(spark, rows=700):
    """A third of the rows in one room, a third at one instant, with gaps in the values."""
    return spark.range(rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % 23).cast("string"))).alias("room"),
        F.expr(
            "CASE WHEN id % 3 = 1 THEN TIMESTAMP_NTZ'2024-01-05 00:00:00' ELSE timestampadd(MINUTE, CAST(pmod(id * 7919, 9973) AS INT), TIMESTAMP_NTZ'2024-01-01') END"
        ).alias("t"),
        F.when(F.col("id") % 11 == 5, (F.col("id") * 3).cast("double")).alias("v"),
        F.when(F.col("id") == 300, F.lit("once")).alias("s"),
    )


def plain(df, within):
    w = Window.partitionBy(*within).orderBy("t", "id")
    return df.select(
        "id",
        F.lag("id", 1).over(w).alias("l1"),
        F.lag("v", 4).over(w).alias("l4"),
        F.lead("id", 2).over(w).alias("f2"),
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("vf"),
        F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("vb"),
        F.last("s", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("sf"),
        (F.row_number().over(Window.orderBy(*within, "t", "id")) - 1).alias("i"),
    )


def bucketed(df, within, buckets):
    order = RowOrder(df, ["t", "id"], within, buckets)
    out = order.attach(df)
    out = order.shift(out, {"l1": ("id", 1), "l4": ("v", 4), "f2": ("id", -2)})
    out = order.fill(out, {"vf": "v", "sf": "s"})
    out = order.fill(out, {"vb": "v"}, forward=False)
    return order.index(out, "i").select("id", "l1", "l4", "f2", "vf", "vb", "sf", "i")


def sort(df):
    return df.toPandas().sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("within", [[], ["room"]])
@pytest.mark.parametrize("buckets", [1, 2, 13, 350])
def test_equals_plain_window(spark, within, buckets):
    df = skewed(spark)
    pd.testing.assert_frame_equal(
        sort(bucketed(df, within, buckets)), sort(plain(df, within)), check_dtype=False
    )


def test_hot_instant_and_hot_room_are_split(spark):
    df = skewed(spark, 20_000)
    for within in ([], ["room"]):
        order = RowOrder(df, ["t", "id"], within, buckets=40)
        sizes = [r["count"] for r in order.attach(df).groupBy("_bucket").count().collect()]
        assert len(sizes) >= 38
        assert max(sizes) < 4 * 20_000 / 40


def test_order_holds_for_a_filtered_table(spark):
    df = skewed(spark)
    order = RowOrder(df, ["t", "id"], ["room"], buckets=50)
    part = df.filter("id % 4 <> 1")
    got = order.shift(order.attach(part), {"l1": ("id", 1)}).select("id", "l1")
    w = Window.partitionBy("room").orderBy("t", "id")
    assert sort(got).equals(sort(part.select("id", F.lag("id", 1).over(w).alias("l1"))))


def test_input_order_does_not_matter(spark):
    df = skewed(spark)
    a = sort(bucketed(df, ["room"], 20))
    b = sort(bucketed(df.repartition(7, "v").sortWithinPartitions(F.desc("id")), ["room"], 9))
    pd.testing.assert_frame_equal(a, b)


def test_missing_keys_come_first(spark):
    df = skewed(spark).withColumn("t", F.when(F.col("id") % 10 != 0, F.col("t")))
    order = RowOrder(df, ["t", "id"], buckets=30)
    got = order.index(order.attach(df), "i").select("id", "i")
    expected = df.select("id", (F.row_number().over(Window.orderBy("t", "id")) - 1).alias("i"))
    pd.testing.assert_frame_equal(sort(got), sort(expected), check_dtype=False)


@pytest.mark.parametrize("within", [[], ["room"]])
@pytest.mark.parametrize("buckets", [3, 40, 350])
def test_a_long_reach_over_short_buckets(spark, within, buckets):
    df = skewed(spark)
    order = RowOrder(df, ["t", "id"], within, buckets)
    got = order.shift(order.attach(df), {"far": ("id", 100), "near": ("id", 3), "ahead": ("id", -57)}).select("id", "far", "near", "ahead")
    w = Window.partitionBy(*within).orderBy("t", "id")
    expected = df.select("id", F.lag("id", 100).over(w).alias("far"), F.lag("id", 3).over(w).alias("near"), F.lead("id", 57).over(w).alias("ahead"))
    pd.testing.assert_frame_equal(sort(got), sort(expected), check_dtype=False)


@pytest.mark.parametrize("reach", [1, 7, 100])
def test_a_carry_is_never_longer_than_the_reach(spark, reach):
    df = skewed(spark)
    order = RowOrder(df, ["t", "id"], buckets=90)
    rows = order._edge_rows(order.attach(df), F.col("id"), reach, True).orderBy("_bucket").collect()
    placed = order.attach(df).select("_bucket", "t", "id").collect()
    for r in rows:
        before = [p.id for p in sorted(placed, key=lambda p: (p.t, p.id)) if p._bucket < r._bucket]
        assert r.carry == before[-reach:]


@pytest.mark.parametrize("within", [[], ["room"]])
@pytest.mark.parametrize(("buckets", "both"), [(1, True), (13, True), (350, True), (40, False)])
def test_gaps_are_filled_like_by_plain_windows(spark, within, buckets, both):
    df = skewed(spark).withColumn("whole", F.col("id") * 2)
    order = RowOrder(df, ["t", "id"], within, buckets)
    got = RowOrder.detach(order.fill_gaps(order.attach(df), ["v", "s", "whole"], both))
    w = Window.partitionBy(*within).orderBy("t", "id")
    last = {c: F.last(c, True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for c in ("v", "s")}
    ahead = {c: F.first(c, True).over(w.rowsBetween(0, Window.unboundedFollowing)) for c in ("v", "s")}
    expected = df.select(*[(F.coalesce(ahead[c], last[c]) if both else last[c]).alias(c) if c in last else F.col(c) for c in df.columns])
    pd.testing.assert_frame_equal(sort(got), sort(expected), check_dtype=False)


def test_one_pass_before_the_one_that_fills(spark, monkeypatch):
    from roomtide.operators import ordered

    df = skewed(spark)
    order = RowOrder(df, ["t", "id"], [], 20)
    written = []
    monkeypatch.setattr(ordered, "materialize", lambda frame, label, real=ordered.materialize: written.append(label) or real(frame, label))
    out = order.fill_gaps(order.attach(df), ["v", "s"])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert written == ["fill-ends"] and text.count("Range (") == 1 and text.count("Scan parquet") == 1
    whole = order.attach(df)
    assert order.fill_gaps(whole, ["id"]) is whole
