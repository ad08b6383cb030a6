"""Forecast new readings with a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame

from ..operators.ridge import Ridge
from .forecast import SparseFrames, SupervisedFrames, forecast_predict, inference_design, inference_vectors
from .preprocess import preprocess


def inference_pipeline(
    readings: DataFrame,
    weather: DataFrame,
    fitted: SupervisedFrames | SparseFrames,
    is_forecast: bool = True,
    window: str = "3d",
    every: str = "1d",
    outliers: bool = False,
    dense: bool = False,
    **options,
) -> DataFrame:
    """Preprocess new readings (outliers stay by default) and shape them like the training inputs.

    The result has ``ones`` and ``numbers``, or dense ``features`` with ``dense``.
    """
    df = preprocess(readings, weather, window, every, outliers=outliers, label=fitted.label, **options)
    if not is_forecast and fitted.label not in fitted.columns:
        df = df.drop(fitted.label)
    return inference_vectors(df, fitted) if dense else inference_design(df, fitted)


def forecast_new(readings: DataFrame, weather: DataFrame, fitted: SupervisedFrames | SparseFrames, models: Ridge | Sequence[Model], **options) -> DataFrame:
    dense = not isinstance(models, Ridge)
    return forecast_predict(inference_pipeline(readings, weather, fitted, dense=dense, **options), models)
