"""Daily weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import drop_incomplete_rows, nan_to_null
from ..schema import WEATHER


def clean_weather(weather: DataFrame) -> DataFrame:
    """Drop the unused measures, then every day with a missing value."""
    return drop_incomplete_rows(nan_to_null(weather.drop("snow", "tsun")))


def scan_weather(spark: SparkSession, path: str) -> DataFrame:
    return clean_weather(spark.read.csv(path, header=True, schema=WEATHER, enforceSchema=False))
