"""How much text goes to a Python worker at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Cut Arrow batches by size: ten thousand long texts would not fit beside a worker's model."""
    spark.conf.set(SETTING, str(MOST_BYTES))
