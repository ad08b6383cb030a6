"""Physical plans: what is shuffled, broadcast and pushed to the scan."""

import pytest

from checks import QUERIES, views
from roomtide.operators import views as dashboard
from roomtide.operators.asof import asof_nearest
from roomtide.operators.ordered import RowOrder
from roomtide.sources.weather import clean_weather


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries whose plan may put a checked, bounded table (bucket edges, weather rows, totals) in one partition.
READING_SIDE = ["drop_fast_rise", "drop_fast_rise_by_room", "fill_na", "global_diff", "global_row_index", "room_diff", "lag_frame", "time_series_split"]


@pytest.mark.parametrize("name", READING_SIDE)
def test_no_window_over_all_readings(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1]
            assert "Aggregate" in below, f"unaggregated rows gather in one task: {below}"


JOINED = [
    "asof_nearest_weather", "asof_nearest_large", "asof_backward_by_room", "resample_mean_odd_size", "resample_roll",
    "missing_by_weekday", "calendar_anti", "winsorized_daily_counts", "room_heatmap", "iqr_replace_mean", "minmax_scale",
    "correlation_matrix", "fill_na_by_room", "lag_frame_by_room", "supervised_frames", "tag_lecture_slot", "latest_predictions",
]


@pytest.mark.parametrize("name", JOINED)
def test_no_cross_joins(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_weather_is_broadcast_and_readings_are_not_shuffled(spark, sf_dir):
    df = views.readings(spark, sf_dir)
    text = plan(asof_nearest(df, clean_weather(views.weather(spark, sf_dir))))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    left = text.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in left


def test_one_shuffle_for_several_order_operators(spark, sf_dir):
    df = views.rooms(spark, sf_dir).select("date_time", "event_id", "vis", "tmp")
    order = RowOrder(df, ["date_time", "event_id"])
    out = order.shift(order.attach(df), {"a": ("vis", 1)})
    out = order.shift(out, {"b": ("tmp", 2)})
    main = plan(out).split("BroadcastExchange")[0]
    assert main.count("Exchange hashpartitioning") == 1


def test_date_and_columns_reach_the_scan(spark, sf_dir):
    df = views.table(spark, sf_dir, "events").withColumnRenamed("ts", "date_time").select("date_time", "value", "user_id")
    text = plan(dashboard.select_date(df, "2024-01-07").select("value"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_profiles_sum_before_the_shuffle(spark, sf_dir):
    text = plan(dashboard.hourly_profile(views.rooms(spark, sf_dir), ["all", "m000"], ["CO2"]))
    assert "Expand" not in text
    assert text.rstrip().splitlines()[-1].lstrip(" +-:").startswith("FileScan")


def test_release_deletes_intermediate_tables(spark):
    import os

    from roomtide.session import materialize, release

    release(spark)
    table = materialize(spark.range(5), "released")
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file:"))
    assert table.count() == 5 and os.path.isdir(folder)
    assert release(spark) == 1 and not os.path.exists(folder) and release(spark) == 0
