"""Supervised frames: lagged inputs and future labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import RowOrder


def lag_names(columns: Sequence[str], steps: int) -> list[str]:
    return [f"{c}(t-{i})" for i in range(steps, 0, -1) for c in columns]


def label_names(label: str, horizons: int) -> list[str]:
    return [f"{label}(t)" if i == 0 else f"{label}(t+{i})" for i in range(horizons)]


def lag_frame(
    df: DataFrame,
    order: RowOrder,
    columns: Sequence[str],
    label: str,
    input_steps: int = 1,
    horizons: int = 1,
    dropna: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns at t-n .. t-1 as inputs and the label at t, t+1, .. as targets.

    Neighbours follow ``order``; its ``within`` columns keep a lag inside its own series.
    """
    if horizons < 1:
        raise ValueError("at least one step must be forecast")
    wanted = {f"{c}(t-{i})": (c, i) for i in range(input_steps, 0, -1) for c in columns}
    wanted |= {name: (label, -i) for i, name in enumerate(label_names(label, horizons))}
    framed = order.detach(order.shift(order.attach(df), wanted)).select(*keep, *wanted)
    return framed.dropna("any", subset=list(wanted)) if dropna else framed


def lead_labels(df: DataFrame, order: RowOrder, label: str, horizons: int, keep: Sequence[str] = ()) -> DataFrame:
    return lag_frame(df, order, [], label, 0, horizons, keep=keep)


def inference_frame(df: DataFrame, columns: Sequence[str], input_steps: int = 1, keep: Sequence[str] = ()) -> DataFrame:
    """Name the current values as the inputs of the next step, without shifting."""
    if input_steps != 1:
        raise ValueError("inference frames have exactly one input step")
    return df.select(*keep, *[F.col(c).alias(f"{c}(t-1)") for c in columns])
