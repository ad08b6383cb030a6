"""Supervised frames, training, inference."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.pipeline import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import quoted
from ..operators.encoding import OneHot, SparseOneHot, StandardScaler, assemble_vectors, sort_columns
from ..operators.lags import inference_frame, label_names, lag_frame, lag_names
from ..operators.ordered import RowOrder
from ..operators.ridge import PENALTIES, Ridge, fit_ridge
from ..operators.splits import time_series_split
from ..schema import ROOM, TIME
from ..session import materialize

CATEGORIES = ["season", "room_number", "dayofweek"]
KEY = "_room"


def _doubles(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(quoted(c)).cast("double") for c in columns]).cast("array<double>")


@dataclass(frozen=True)
class SupervisedFrames:
    """Framed and scaled rows, labelled by ``split``, with the fitted state needed at inference."""

    rows: DataFrame | None
    encoder: OneHot
    scaler: StandardScaler
    pre_scaler: StandardScaler | None
    columns: tuple[str, ...]
    inputs: tuple[str, ...]
    label: str
    horizons: int

    @property
    def targets(self) -> list[str]:
        return label_names(self.label, self.horizons)

    def part(self, split: str) -> DataFrame:
        return self.rows.filter(F.col("split") == split)

    def vectors(self, split: str) -> DataFrame:
        return assemble_vectors(self.part(split), self.inputs, self.targets, keep=(TIME, ROOM))

    @property
    def ones(self) -> int:
        return 0

    @property
    def numbers(self) -> int:
        return len(self.inputs)

    def design(self, rows: DataFrame | None = None, targets: bool = True) -> DataFrame:
        """``rows``, by default those of all parts, as ``ones``, ``numbers`` and ``targets``; all inputs are numbers here."""
        rows = self.rows if rows is None else rows
        out = rows.select(
            TIME, ROOM, *(["split"] if targets else []), F.array().cast("array<int>").alias("ones"), _doubles(self.inputs).alias("numbers"),
            *([_doubles(self.targets).alias("targets")] if targets else []),
        )
        return out


@dataclass(frozen=True)
class SparseFrames:
    """Framed and scaled rows as sparse vectors: ``ones`` holds positions, ``numbers`` values, ``targets`` the label ahead.

    The ones of all time steps come first, in the order of the dense form, then the numbers that need no scaling, then the scaled ones.
    """

    rows: DataFrame | None
    encoder: SparseOneHot
    scaler: StandardScaler
    pre_scaler: StandardScaler | None
    columns: tuple[str, ...]
    plain: tuple[str, ...]
    label: str
    horizons: int
    input_steps: int = 1

    @property
    def targets(self) -> list[str]:
        return label_names(self.label, self.horizons)

    @property
    def ones(self) -> int:
        return self.input_steps * self.encoder.width

    @property
    def numbers(self) -> int:
        return len(self.plain) + len(self.scaler.features)

    def part(self, split: str) -> DataFrame:
        return self.rows.filter(F.col("split") == split)

    def design(self) -> DataFrame:
        return self.rows


def _framed(
    df: DataFrame,
    encoder: OneHot | SparseOneHot,
    categories: Sequence[str],
    label: str,
    input_steps: int,
    horizons: int,
    skip_scale: bool,
    within: Sequence[str],
    time: str,
    room: str,
) -> tuple[DataFrame, list[str], StandardScaler | None]:
    """Each part framed on its own. A category is lagged as one column of codes, however many values it has."""
    df = materialize(encoder.codes(df).filter("split in ('train', 'val', 'test')"), "encoded")
    numbers = [c for c in df.columns if c not in (time, KEY, "split", label, *categories)]
    pre_scaler = None
    if not skip_scale:
        pre_scaler = StandardScaler.fit(df.filter("split = 'train'"), numbers)
        df = pre_scaler.transform(df)
        numbers = [c for c in df.columns if c not in (time, KEY, "split", label, *categories)]
    series = ["split", *[KEY if w == room else w for w in within]]
    order = RowOrder(df, [time, KEY], series)
    framed = lag_frame(df, order, [*numbers, label, *categories], label, input_steps, horizons, keep=(time, KEY, "split"))
    # Without a room among the categories its name is free for the key; with one, the name is that of the codes before the lag.
    return materialize(framed.withColumnRenamed(KEY, room), "framed"), numbers, pre_scaler


def _split(df: DataFrame, time: str, room: str) -> DataFrame:
    df = sort_columns(df)
    df = df.withColumn(KEY, F.col(room))
    return time_series_split(df, RowOrder(df, [time, KEY]))


def supervised_frames(
    df: DataFrame,
    label: str,
    categories: Sequence[str] = CATEGORIES,
    input_steps: int = 1,
    horizons: int = 1,
    skip_scale: bool = True,
    within: Sequence[str] = (),
    fit_on: str = "all",
    time: str = TIME,
    room: str = ROOM,
) -> SupervisedFrames:
    """Encode, split by time, frame each part on its own, scale with the training part's fit; one 0/1 column per category.

    ``within=[]`` lags along the overall time order, ``within=['room_number']`` inside a
    room. ``fit_on='train'`` fits the encoder on the training part only.
    """
    df = _split(df, time, room)
    encoder = OneHot.fit(df if fit_on == "all" else df.filter("split = 'train'"), categories)
    framed, numbers, pre_scaler = _framed(df, encoder, categories, label, input_steps, horizons, skip_scale, within, time, room)
    scaled_before = pre_scaler.features if pre_scaler else ()
    columns = [*[c for c in numbers if c not in scaled_before], *encoder.columns, *[c for c in numbers if c in scaled_before], label]
    lagged = lag_names(columns, input_steps)
    scaler = StandardScaler.fit(framed.filter("split = 'train'"), lag_names([*numbers, label], input_steps))
    # Encoded categories are 0 or 1 by construction and stay unscaled; they become columns only here.
    flags = {
        f"__{f}_{v}(t-{i})": f"CAST({quoted(f'{f}(t-{i})')} = {at} AS INT)"
        for i in range(1, input_steps + 1)
        for f, values in encoder.categories.items()
        for at, v in enumerate(values)
    }
    targets = label_names(label, horizons)
    rows = framed.selectExpr(*map(quoted, (time, room, "split")), *[f"{flags.get(c, quoted(c))} AS {quoted(c)}" for c in lagged], *map(quoted, targets))
    inputs = [c for c in lagged if c not in scaler.features] + list(scaler.features)
    return SupervisedFrames(
        scaler.transform(rows), encoder, scaler, pre_scaler, tuple(columns), tuple(inputs), label, horizons
    )


def sparse_frames(
    df: DataFrame,
    label: str,
    categories: Sequence[str] = CATEGORIES,
    input_steps: int = 1,
    horizons: int = 1,
    skip_scale: bool = True,
    within: Sequence[str] = (),
    fit_on: str = "all",
    time: str = TIME,
    room: str = ROOM,
) -> SparseFrames:
    """:func:`supervised_frames` with sparse vectors: no plan and no driver holds a column or a name for each category."""
    df = _split(df, time, room)
    encoder = SparseOneHot.fit(df if fit_on == "all" else df.filter("split = 'train'"), categories)
    framed, numbers, pre_scaler = _framed(df, encoder, categories, label, input_steps, horizons, skip_scale, within, time, room)
    lagged = lag_names([*numbers, label], input_steps)
    scaler = StandardScaler.fit(framed.filter("split = 'train'"), lagged)
    plain = [c for c in lagged if c not in scaler.features]
    steps = [[f"{c}(t-{i})" for c in categories] for i in range(input_steps, 0, -1)]
    rows = scaler.transform(framed).select(
        time,
        room,
        "split",
        encoder.ones(steps).alias("ones"),
        _doubles([*plain, *scaler.features]).alias("numbers"),
        _doubles(label_names(label, horizons)).alias("targets"),
    )
    return SparseFrames(rows, encoder, scaler, pre_scaler, (*numbers, label), tuple(plain), label, horizons, input_steps)


def _present(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"inputs missing for inference: {', '.join(missing)}")


def _inference_rows(df: DataFrame, fitted: SupervisedFrames | SparseFrames, time: str, room: str) -> DataFrame:
    """New rows with the fitted inputs' names, scaled; categories are codes (sparse) or 0/1 columns."""
    sparse = isinstance(fitted, SparseFrames)
    categories = list(fitted.encoder.tables) if sparse else list(fitted.encoder.categories)
    _present(df, [c for c in categories if c not in df.columns])
    df = df.withColumn(KEY, F.col(room))
    df = fitted.encoder.codes(df) if sparse else fitted.encoder.transform(df)
    if fitted.pre_scaler is not None:
        df = fitted.pre_scaler.transform(df)
    columns = [*fitted.columns, *categories] if sparse else fitted.columns
    _present(df, columns)
    return fitted.scaler.transform(inference_frame(df, columns, keep=(time, KEY)).withColumnRenamed(KEY, room))


def inference_vectors(df: DataFrame, fitted: SupervisedFrames, time: str = TIME, room: str = ROOM) -> DataFrame:
    """Preprocessed rows as dense input vectors, in the fitted column order; keys stay columns."""
    return assemble_vectors(_inference_rows(df, fitted, time, room), fitted.inputs, keep=(time, room))


def inference_design(df: DataFrame, fitted: SupervisedFrames | SparseFrames, time: str = TIME, room: str = ROOM) -> DataFrame:
    """Preprocessed rows as ``ones`` and ``numbers``; keys stay columns."""
    rows = _inference_rows(df, fitted, time, room)
    if isinstance(fitted, SupervisedFrames):
        return fitted.design(rows, targets=False)
    ones = fitted.encoder.ones([[f"{c}(t-1)" for c in fitted.encoder.tables]])
    return rows.select(time, room, ones.alias("ones"), _doubles([*fitted.plain, *fitted.scaler.features]).alias("numbers"))


def forecast_train(
    fitted: SupervisedFrames | SparseFrames, estimator: Estimator | None = None, penalties: Sequence[float] = PENALTIES
) -> Ridge | list[Model]:
    """Fit all horizons on the training part, in one pass over the rows; the validation part picks the penalty.

    With an ``estimator`` of Spark ML one regressor per horizon on dense vectors. These are written once, so each horizon
    reads them instead of scaling the frame again.
    """
    if estimator is None:
        return fit_ridge(fitted.design(), fitted.ones, fitted.numbers, fitted.horizons, penalties)
    vectors = materialize(fitted.vectors("train"), "training-vectors")
    train = vectors.withColumn("features", array_to_vector("features"))
    return [
        estimator.fit(train.withColumn("label", F.get("targets", F.lit(i)).cast("double")))
        for i in range(fitted.horizons)
    ]


def forecast_predict(rows: DataFrame, models: Ridge | Sequence[Model]) -> DataFrame:
    """Add ``prediction_t+i`` for each horizon: to ``ones`` and ``numbers``, or to dense ``features``."""
    if isinstance(models, Ridge):
        if "ones" not in rows.columns:
            dense = {"ones": F.array().cast("array<int>"), "numbers": F.col("features").cast("array<double>")}
            rows = rows.withColumns(dense).drop("features")
        scored = rows.withColumn("_predicted", models.predict())
        found = {f"prediction_t+{i}": F.get("_predicted", F.lit(i)) for i in range(models.weights.shape[1])}
        return scored.withColumns(found).drop("_predicted", "ones", "numbers")
    df = rows.withColumn("features", array_to_vector("features"))
    for i, model in enumerate(models):
        df = model.transform(df).withColumnRenamed("prediction", f"prediction_t+{i}")
    return df.drop("features")


def persistence_predict(frames: DataFrame, label: str, horizons: int) -> DataFrame:
    """Baseline: every horizon repeats the last known label."""
    return frames.withColumns({f"prediction_t+{i}": F.col(f"{label}(t-1)") for i in range(horizons)})


def predictions_with_actuals(
    fitted: SupervisedFrames | SparseFrames, models: Ridge | Sequence[Model], split: str = "test"
) -> DataFrame:
    ridge = isinstance(models, Ridge)
    df = forecast_predict(fitted.design().filter(F.col("split") == split).drop("split") if ridge else fitted.vectors(split), models)
    return df.withColumns(
        {name: F.get("targets", F.lit(i)).cast("double") for i, name in enumerate(fitted.targets)}
    ).drop("targets")


def train_variants(
    frames: Mapping[str, DataFrame],
    label: str,
    horizons: int = 1,
    categories: Sequence[str] = CATEGORIES,
    estimator: Estimator | None = None,
    **options,
) -> dict[str, tuple[SupervisedFrames | SparseFrames, Ridge | list[Model]]]:
    """Fit the same forecast on each feature set; a set without ``season`` does not encode it."""
    fitted = {}
    for name, df in frames.items():
        present = [c for c in categories if c in df.columns]
        make = sparse_frames if estimator is None else supervised_frames
        frame = make(df, label, present, horizons=horizons, **options)
        fitted[name] = (frame, forecast_train(frame, estimator))
    return fitted


def save_forecast(path: str, spark: SparkSession, fitted: SupervisedFrames | SparseFrames, models: Ridge | Sequence[Model]) -> None:
    """Write all that inference needs below ``path``: encoder, scalers, column order and the models.

    Categories of the dense form have to be text, numbers or booleans, as JSON keeps them; those of the sparse form are tables.
    """
    state = {
        "columns": fitted.columns,
        "label": fitted.label,
        "horizons": fitted.horizons,
        "scaler": asdict(fitted.scaler),
        "pre_scaler": fitted.pre_scaler and asdict(fitted.pre_scaler),
        "ridge": models.to_json() if isinstance(models, Ridge) else None,
    }
    if isinstance(fitted, SparseFrames):
        state |= {"features": list(fitted.encoder.tables), "sizes": fitted.encoder.sizes, "plain": fitted.plain, "input_steps": fitted.input_steps}
        for i, table in enumerate(fitted.encoder.tables.values()):
            table.write.parquet(f"{path}/categories-{i}")
    else:
        state |= {"categories": {f: list(values) for f, values in fitted.encoder.categories.items()}, "inputs": fitted.inputs}
    spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.parquet(f"{path}/state")
    if not isinstance(models, Ridge):
        PipelineModel(list(models)).write().save(f"{path}/models")


def load_forecast(path: str, spark: SparkSession) -> tuple[SupervisedFrames | SparseFrames, Ridge | list[Model]]:
    """What :func:`save_forecast` wrote; the training rows are not part of it."""
    state = json.loads(spark.read.parquet(f"{path}/state").first().state)

    def scaler(saved: dict | None) -> StandardScaler | None:
        return saved and StandardScaler(*[tuple(saved[k]) for k in ("features", "means", "deviations")])

    scalers, columns = (scaler(state["scaler"]), scaler(state["pre_scaler"])), tuple(state["columns"])
    models = Ridge.from_json(state["ridge"]) if state["ridge"] else PipelineModel.load(f"{path}/models").stages
    if "sizes" in state:
        tables = {f: spark.read.parquet(f"{path}/categories-{i}") for i, f in enumerate(state["features"])}
        encoder = SparseOneHot(tables, tuple(state["sizes"]))
        return SparseFrames(None, encoder, *scalers, columns, tuple(state["plain"]), state["label"], state["horizons"], state["input_steps"]), models
    encoder = OneHot(state["categories"])
    return SupervisedFrames(None, encoder, *scalers, columns, tuple(state["inputs"]), state["label"], state["horizons"]), models
