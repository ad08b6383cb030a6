"""One-hot encoding and scaling with fitted parameters kept as small tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import number, quoted
from ..schema import numeric_columns
from ..session import materialize
from .ordered import RowOrder


@dataclass(frozen=True)
class OneHot:
    """Sorted categories per feature; each becomes a 0/1 column ``__<feature>_<value>``.

    The names of the columns are the categories, so the driver has to know them. For features with
    very many categories :func:`one_hot_sparse` gives the positions of the ones instead.
    """

    categories: dict[str, list]

    @staticmethod
    def fit(df: DataFrame, features: Sequence[str]) -> OneHot:
        found = {}
        for f in features:
            found[f] = sorted(r[0] for r in df.select(f).filter(F.col(f).isNotNull()).distinct().collect())
        return OneHot(found)

    @property
    def columns(self) -> list[str]:
        return [f"__{f}_{v}" for f, values in self.categories.items() for v in values]

    def codes(self, df: DataFrame) -> DataFrame:
        """Replace each feature by the place of its value among the categories, -1 for an unknown or missing one."""
        found = {}
        for f, values in self.categories.items():
            known = F.array(*[F.lit(v) for v in values]) if values else F.lit(None)
            place = F.array_position(known.cast(T.ArrayType(df.schema[f].dataType)), F.col(quoted(f)))
            found[f] = F.coalesce(place.cast("int"), F.lit(0)) - 1
        return df.withColumns(found)

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace the features by their 0/1 columns; an unknown value is all zeros."""
        kept = [c for c in df.columns if c not in self.categories]
        encoded = []
        for f, values in self.categories.items():
            source = F.col(f)
            encoded += [F.coalesce(source == v, F.lit(False)).cast("int").alias(f"__{f}_{v}") for v in values]
        return df.select(*kept, *encoded)


@dataclass(frozen=True)
class SparseOneHot:
    """Categories as tables of value and place, met in joins; their number is not limited and none is named on the driver."""

    tables: dict[str, DataFrame]
    sizes: tuple[int, ...]

    @staticmethod
    def fit(df: DataFrame, features: Sequence[str]) -> SparseOneHot:
        tables, sizes = {}, []
        for f in features:
            values = materialize(df.select(F.col(quoted(f)).alias("_value")).filter(F.col("_value").isNotNull()).distinct(), "categories")
            order = RowOrder(values, ["_value"])
            tables[f] = materialize(RowOrder.detach(order.index(order.attach(values), "_place")), "category-places")
            sizes.append(order.total)
        return SparseOneHot(tables, tuple(sizes))

    @property
    def width(self) -> int:
        return sum(self.sizes)

    def codes(self, df: DataFrame) -> DataFrame:
        """Replace each feature by the place of its value among the categories, -1 for an unknown or missing one."""
        columns = df.columns
        for f, table in self.tables.items():
            # A value that many rows share does not gather them: categories are few beside rows, and Spark splits the larger side.
            df = df.join(table.withColumnRenamed("_value", "_known"), F.col(quoted(f)) == F.col("_known"), "left").drop("_known")
            df = df.withColumn(f, F.coalesce(F.col("_place").cast("int"), F.lit(-1))).drop("_place")
        return df.select(*map(quoted, columns))

    def ones(self, features: Sequence[Sequence[str]]) -> Column:
        """Sorted positions of the ones; ``features`` names the columns of codes, a list for each time step."""
        starts = [sum(self.sizes[:i]) for i in range(len(self.sizes))]
        places = [
            F.when(F.col(quoted(c)) >= 0, F.col(quoted(c)) + F.lit(step * self.width + start))
            for step, columns in enumerate(features)
            for c, start in zip(columns, starts, strict=True)
        ]
        return F.array_compact(F.array(*places)) if places else F.array().cast("array<int>")


def one_hot_sparse(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Replace the features by ``encoded``: the sorted positions of the ones among all categories of all features.

    Positions follow the order of features, then values; an unknown or missing value has none.
    """
    encoder = SparseOneHot.fit(df if fit_on is None else fit_on, features)
    kept = [c for c in df.columns if c not in features]
    return encoder.codes(df).select(*kept, encoder.ones([features]).alias("encoded"))


def minmax_scale(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Map each column to [0, 1]; a constant column becomes 0."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    ends = df.agg(
        *[F.min(c).alias(f"a{i}") for i, c in enumerate(columns)], *[F.max(c).alias(f"b{i}") for i, c in enumerate(columns)]
    ).first()
    scaled = {}
    for i, c in enumerate(columns):
        low, high = ends[f"a{i}"], ends[f"b{i}"]
        if low is not None:
            span = float(high - low)
            scaled[c] = (F.col(c) - F.lit(low)) / F.lit(span) if span else F.when(F.col(c).isNotNull(), F.lit(0.0))
    return df.withColumns(scaled)


def binary_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns that hold only 0 and 1 (a missing value disqualifies)."""
    columns = list(columns) if columns is not None else numeric_columns(df.schema)
    row = df.agg(*[_other_values(c).alias(f"o{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if not row[f"o{i}"]]


def _other_values(column: str):
    return F.expr(f"count_if(coalesce({quoted(column)} NOT IN (0, 1), true))")


@dataclass(frozen=True)
class StandardScaler:
    """Mean and population deviation per feature, in fitted order."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    SCHEMA = "feature string, mean double, deviation double, position int"

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str] | None = None) -> StandardScaler:
        """Fit on every numeric column that is not binary, all in one aggregation."""
        columns = list(columns) if columns is not None else numeric_columns(df.schema)
        row = df.agg(
            *[_other_values(c).alias(f"o{i}") for i, c in enumerate(columns)],
            *[F.expr(f"avg({quoted(c)}) AS m{i}") for i, c in enumerate(columns)],
            *[F.expr(f"stddev_pop({quoted(c)}) AS s{i}") for i, c in enumerate(columns)],
        ).first()
        kept = [(c, row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns) if row[f"o{i}"] and row[f"m{i}"] is not None]
        return StandardScaler(*[tuple(k[j] for k in kept) for j in range(3)])

    def transform(self, df: DataFrame) -> DataFrame:
        """Unscaled columns first, then the scaled ones in fitted order; missing becomes 0."""
        scaled = [
            f"coalesce(({quoted(c)} - {number(m)}) / {number(s or 1.0)}, 0D) AS {quoted(c)}"
            for c, m, s in zip(self.features, self.means, self.deviations, strict=True)
        ]
        return df.selectExpr(*[quoted(c) for c in df.columns if c not in self.features], *scaled)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (f, m, s, i)
            for i, (f, m, s) in enumerate(zip(self.features, self.means, self.deviations, strict=True))
        ]
        return spark.createDataFrame(rows, self.SCHEMA)

    @staticmethod
    def from_frame(frame: DataFrame) -> StandardScaler:
        rows = frame.orderBy("position").collect()
        return StandardScaler(
            tuple(r.feature for r in rows), tuple(r["mean"] for r in rows), tuple(r.deviation for r in rows)
        )


def sort_columns(df: DataFrame) -> DataFrame:
    """Columns in name order, upper case first."""
    return df.select(*sorted(df.columns))


def assemble_vectors(df: DataFrame, inputs: Sequence[str], targets: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Inputs and targets as two float arrays."""
    def vector(columns: Sequence[str]):
        return F.array(*[F.col(c).cast("float") for c in columns]).cast(T.ArrayType(T.FloatType()))

    out = df.select(*keep, vector(inputs).alias("features"), *([vector(targets).alias("targets")] if targets else []))
    return out
