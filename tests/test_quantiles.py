import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import views
from roomtide.operators import quantiles
from roomtide.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.075, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("gather", [3, 2_000])
@pytest.mark.parametrize("rows", [1, 2, 7, 5_000])
def test_selection_equals_numpy(spark, rows, gather, monkeypatch):
    monkeypatch.setattr(quantiles, "GATHER_ROWS", gather)
    df = spark.range(rows).select(
        (F.pmod(F.col("id") * 7919, F.lit(10007)) / 8).alias("spread"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise((F.col("id") % 17).cast("double")).alias("tied"),
        F.when(F.col("id") % 4 == 1, (F.col("id") ** 2).cast("double")).alias("gappy"),
        F.lit(2.5).alias("constant"),
        F.lit(None).cast("double").alias("empty"),
    )
    got = exact_quantiles(df, df.columns, PROBABILITIES)
    frame = df.toPandas().astype(float)
    for c in df.columns:
        values = frame[c].dropna().to_numpy()
        if not len(values):
            assert got[c] == [None] * len(PROBABILITIES)
            continue
        expected = np.quantile(values, PROBABILITIES)
        assert got[c] == pytest.approx(expected, rel=1e-12)


def test_linear_interpolation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.25]) == {"x": [1.75]}


@pytest.mark.parametrize("rows", [6, 4_000])
def test_nan_is_missing_and_frequent_values_are_halved(spark, rows, monkeypatch):
    monkeypatch.setattr(quantiles, "GATHER_ROWS", 2)
    # Nine in ten values are one of two, the rest lie far out.
    df = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 11 + 0.5).alias("x"),
        F.when(F.col("id") % 10 == 9, (F.col("id") * 1e9).cast("double")).otherwise((F.col("id") % 2).cast("double")).alias("y"),
    )
    frame = df.toPandas()
    got = exact_quantiles(df, ["x", "y"], PROBABILITIES)
    for c in ("x", "y"):
        assert got[c] == pytest.approx(np.quantile(frame[c].dropna(), PROBABILITIES), rel=1e-12)


def test_infinite_tiny_and_huge_values(spark):
    values = [-np.inf, -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1e-323, 1.0, 1.7e308, np.inf, np.inf]
    df = spark.createDataFrame([(v, 5e-324 * (i % 2), 1.5) for i, v in enumerate(values)], "x double, y double, z double")
    ranks = [i / 10 for i in range(11)]
    got = exact_quantiles(df, ["x", "y", "z"], ranks)
    assert got["x"] == sorted(values) and got["z"] == [1.5] * 11
    assert got["y"] == sorted(5e-324 * (i % 2) for i in range(11))


def test_bins_cut_what_a_pass_has_to_look_at(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "GATHER_ROWS", 50)
    seen = []
    real = quantiles._histograms
    monkeypatch.setattr(quantiles, "_histograms", lambda df, ranges, inside: seen.append(len(ranges)) or real(df, ranges, inside))
    df = spark.range(200_000).select((F.pmod(F.col("id") * 7919, F.lit(200_003)) ** 3).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    got = exact_quantiles(df, ["x", "y"], [0.001, 0.5])
    assert got["y"] == pytest.approx([199.999, 99_999.5])
    # Both columns share the first pass; few ranges need another.
    assert seen[0] == 2 and len(seen) <= 3


@pytest.mark.parametrize(("columns", "most"), [(["CO2"], 6), (["CO2", "tmp", "vis", "hum", "IR"], 6)])
def test_number_of_jobs_does_not_grow_with_columns_and_ranks(spark, sf_dir, columns, most):
    df = views.readings(spark, sf_dir)
    spark.sparkContext.setJobGroup(f"quantiles-{len(columns)}", "count")
    exact_quantiles(df, columns, [0.05, 0.25, 0.5, 0.75, 0.95])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"quantiles-{len(columns)}")
    spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) <= most
