"""Registry of the checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.session import use_utc

from .views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        def with_session(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return run(spark, sf_dir)

        assert name not in QUERIES, name
        QUERIES[name] = with_session
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return run

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round results whose last bits depend on summation order; the SQL twin rounds alike."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def r6(*columns: str) -> str:
    """SQL select list that rounds the columns like :func:`rounded`."""
    return ", ".join(f'round("{c}", 6) AS "{c}"' for c in columns)


def as_times(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as midnight timestamps, which both engines hand over alike."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
