"""Forecast errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPSILON = 2.220446049250313e-16


def mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def mape(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(EPSILON)))


def r2(y: Column, p: Column) -> Column:
    residual = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return F.when(spread != 0, 1 - F.try_divide(residual, spread)).otherwise(
        F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )


METRICS = {"mse": mse, "rmse": rmse, "mape": mape, "r2": r2}


def evaluate(
    df: DataFrame, actual: str = "y", predicted: str = "p", by: Sequence[str] = ("variant", "horizon"), digits: int = 2
) -> DataFrame:
    """MSE, RMSE, MAPE and R2 for each group of a long (group, actual, predicted) table, in one pass."""
    y, p = F.col(actual), F.col(predicted)
    return (
        df.filter(y.isNotNull() & p.isNotNull())
        .groupBy(*by)
        .agg(*[F.bround(metric(y, p), digits).alias(name) for name, metric in METRICS.items()])
    )


def evaluate_models(frames: dict[str, DataFrame], label: str, horizons: int) -> DataFrame:
    """Errors per feature variant and horizon; each frame holds ``label(t+i)`` and ``prediction_t+i``."""
    long = None
    for variant, frame in frames.items():
        part = forecast_vs_actual(frame, label, horizons, keep=()).withColumn("variant", F.lit(variant))
        long = part if long is None else long.unionByName(part)
    return evaluate(long)


def forecast_vs_actual(df: DataFrame, label: str, horizons: int, keep: Sequence[str] = ("date_time", "room_number")) -> DataFrame:
    """Actual and predicted label side by side, one row per horizon."""
    steps = [
        F.struct(
            F.lit(i).alias("horizon"),
            F.col(f"{label}(t)" if i == 0 else f"{label}(t+{i})").cast("double").alias("y"),
            F.col(f"prediction_t+{i}").cast("double").alias("p"),
        )
        for i in range(horizons)
    ]
    return df.select(*keep, F.explode(F.array(*steps)).alias("s")).select(*keep, "s.horizon", "s.y", "s.p")
