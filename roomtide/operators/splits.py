"""Train, validation and test parts of a time-ordered table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import RowOrder

MIN_ROWS = 100


class SplitSizes(NamedTuple):
    train_start: int
    val_start: int
    train_end: int
    test_start: int
    total: int


def split_sizes(total: int, n_splits: int = 3, test_size: float = 0.2, gap: float = 0.0001, val_size: float = 0.1) -> SplitSizes:
    """Positions of the last expanding-window fold: the newest rows are the test part."""
    if total <= MIN_ROWS:
        raise ValueError(f"a time-series split needs more than {MIN_ROWS} rows, got {total}")
    test, skipped, longest = int(total * test_size), int(total * gap), int(total * (1 - test_size))
    folds = n_splits
    while folds > 2 and total - skipped - test * folds <= 0:
        folds -= 1
    if total - skipped - test * folds <= 0:
        raise ValueError(f"test size {test_size} leaves no training rows")
    test_start = total - test
    train_end = test_start - skipped
    train_start = max(0, train_end - longest)
    validation = int(val_size * (train_end - train_start))
    return SplitSizes(train_start, train_end - validation, train_end, test_start, total)


def time_series_split(
    df: DataFrame, order: RowOrder, n_splits: int = 3, test_size: float = 0.2, column: str = "split"
) -> DataFrame:
    """Label every row ``train``, ``val``, ``gap``, ``test`` or (before a capped training part) ``unused``."""
    sizes = split_sizes(order.total, n_splits, test_size)
    at = F.col("_position")
    part = (
        F.when(at >= sizes.test_start, "test")
        .when(at >= sizes.train_end, "gap")
        .when(at >= sizes.val_start, "val")
        .when(at >= sizes.train_start, "train")
        .otherwise("unused")
    )
    indexed = order.detach(order.index(order.attach(df), "_position"))
    return indexed.withColumn(column, part).drop("_position")


def label_distribution(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows per label value in the train and the test part; NULL where a side has none."""
    counts = [
        F.nullif(F.count_if(F.col(split) == part), F.lit(0)).alias(f"freq_in_{part}_data") for part in ("train", "test")
    ]
    return df.filter(F.col(split).isin("train", "test") & F.col(label).isNotNull()).groupBy(label).agg(*counts)
