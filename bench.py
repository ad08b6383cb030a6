"""Seconds per headline query: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.

Every query runs once to warm up and then twice; the faster run counts. Results go to the
``noop`` sink, so all rows are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import QUERIES  # noqa: E402
from roomtide.session import local_session  # noqa: E402

HEADLINE = [
    "scan_dat",
    "hourly_profile",
    "daily_means",
    "daily_counts_dense",
    "missing_bins_hourly",
    "room_means",
    "describe",
    "describe_lines",
    "outlier_counts",
    "iqr_replace_mean",
    "correlation_matrix",
    "room_heatmap",
    "dedup_key",
    "range_validity",
    "drop_fast_rise",
    "drop_frozen_spikes",
    "fill_na",
    "asof_nearest_weather",
    "asof_nearest_large",
    "asof_backward_by_room",
    "resample_mean",
    "resample_roll",
    "resample_roll_lines",
    "resample_roll_minutes",
    "room_diff",
    "lag_frame",
    "calendar_features",
    "supervised_frames",
    "supervised_frames_sparse",
    "forecast",
    "one_hot",
    "standard_scale",
    "time_series_split_lines",
    "evaluate_persistence",
    "forest_outliers",
    "preprocess_without_forest",
]


def seconds(run, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    taken = {}
    for name in chosen:
        seconds(QUERIES[name], spark, sf_dir)
        taken[name] = round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(2)), 3)
        print(f"{name:32s} {taken[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(taken.values()), 3), "unit": "sec", "queries": taken, "sf": sf, "cpus": cpus}
        )
    )


if __name__ == "__main__":
    main()
