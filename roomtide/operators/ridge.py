"""Linear forecasts of all horizons from one pass over the rows.

A row is a sparse vector: the positions of its ones (encoded categories) and a short array of numbers. One aggregation sums up the
products of all inputs and targets for each part of the data (X'X, X'Y, Y'Y); these sums merge, so tasks add up what they see and
Spark adds up the tasks. Everything else follows from the sums: the weights for each penalty from the training part, and their
errors on the validation part, without looking at a row again.

The system is solved on the driver, so what grows there is the square of the number of inputs, at most ``MOST_INPUTS`` of them;
a wider problem raises, and can be fitted with an estimator of Spark ML.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PENALTIES = (0.001, 0.01, 0.1, 1.0)
MOST_INPUTS = 8192


@dataclass(frozen=True)
class Gram:
    """Sums of products: inputs are ``ones`` positions, the constant 1, then ``numbers``; ``xy`` and ``yy`` are for the targets."""

    n: int
    xx: np.ndarray
    xy: np.ndarray
    yy: np.ndarray


def _lists(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _sums(part: str, ones: int, numbers: int, targets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The non-zero sums of one task as ``part, i, j, value`` with i <= j."""
    width = 1 + numbers + targets
    found: dict[str, list] = {}
    for batch in batches:
        parts = np.array(batch.column(0).to_pylist())
        rows = len(parts)
        dense = np.hstack([np.ones((rows, 1)), _lists(batch.column(2), numbers), _lists(batch.column(3), targets)])
        lengths = np.diff(batch.column(1).offsets.to_numpy())
        positions = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(rows), lengths)
        padded = np.full((rows, int(lengths.max(initial=0))), -1, np.int64)
        padded[owner, np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = positions
        for name in np.unique(parts):
            own = parts == name
            state = found.setdefault(name, [np.zeros((width, width)), np.zeros((ones, width)), {}])
            state[0] += dense[own].T @ dense[own]
            mine = own[owner]
            for column in range(width):
                if ones:
                    state[1][:, column] += np.bincount(positions[mine], weights=dense[owner[mine], column], minlength=ones)
            for a in range(padded.shape[1]):
                for b in range(a, padded.shape[1]):
                    both = own & (padded[:, a] >= 0) & (padded[:, b] >= 0)
                    low, high = np.minimum(padded[both, a], padded[both, b]), np.maximum(padded[both, a], padded[both, b])
                    for pair, count in zip(*np.unique(low * ones + high, return_counts=True), strict=True):
                        state[2][pair] = state[2].get(pair, 0) + count
    for name, (corner, border, pairs) in found.items():
        i, j = np.nonzero(np.triu(corner))
        p, q = np.nonzero(border)
        pair = np.fromiter(pairs, np.int64, len(pairs))
        yield pa.RecordBatch.from_pydict(
            {
                part: pa.array([str(name)] * (len(i) + len(p) + len(pair)), pa.string()),
                "i": pa.array(np.concatenate([i + ones, p, pair // max(ones, 1)]), pa.int64()),
                "j": pa.array(np.concatenate([j + ones, q + ones, pair % max(ones, 1)]), pa.int64()),
                "value": pa.array(np.concatenate([corner[i, j], border[p, q], np.fromiter(pairs.values(), float, len(pairs))])),
            }
        )


def grams(rows: DataFrame, ones: int, numbers: int, targets: int, part: str = "split") -> dict[str, Gram]:
    """One :class:`Gram` for each part; ``rows`` has that column, ``ones``, ``numbers`` and ``targets``, nothing of it missing."""
    inputs = ones + 1 + numbers
    if inputs > MOST_INPUTS:
        raise ValueError(f"{inputs} inputs are too many to solve for at once; pass an estimator")
    narrow = rows.select(
        F.col(part).cast("string").alias(part),
        F.col("ones").cast("array<bigint>").alias("ones"),
        F.col("numbers").cast("array<double>").alias("numbers"),
        F.col("targets").cast("array<double>").alias("targets"),
    )
    summed = (
        narrow.mapInArrow(lambda batches: _sums(part, ones, numbers, targets, batches), f"{part} string, i long, j long, value double")
        .groupBy(part, "i", "j")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    found = {}
    for name, sums in summed.groupby(part):
        whole = np.zeros((inputs + targets, inputs + targets))
        whole[sums["i"], sums["j"]] = sums["value"]
        whole = np.triu(whole) + np.triu(whole, 1).T
        found[name] = Gram(round(whole[ones, ones]), whole[:inputs, :inputs], whole[:inputs, inputs:], whole[inputs:, inputs:])
    return found


@dataclass(frozen=True)
class Ridge:
    """Weights per input and target, in the order of :class:`Gram`, and what the validation part said of each penalty."""

    weights: np.ndarray
    ones: int
    penalty: float
    errors: dict[float, float]

    def predict(self) -> Column:
        """Array of the predictions of a row with ``ones`` and ``numbers``."""
        ones, weights = self.ones, self.weights

        def score(positions: pd.Series, numbers: pd.Series) -> pd.Series:
            total = np.stack(numbers.to_list()) @ weights[ones + 1 :] + weights[ones] if len(numbers) else np.empty((0, weights.shape[1]))
            lengths = positions.map(len).to_numpy()
            owner = np.repeat(np.arange(len(lengths)), lengths)
            if len(owner):
                np.add.at(total, owner, weights[np.concatenate(positions.to_list()).astype(int)])
            return pd.Series(list(total))

        return F.pandas_udf(score, "array<double>")(F.col("ones"), F.col("numbers"))

    def to_json(self) -> str:
        return json.dumps({"weights": self.weights.tolist(), "ones": self.ones, "penalty": self.penalty, "errors": list(self.errors.items())})

    @staticmethod
    def from_json(text: str) -> Ridge:
        state = json.loads(text)
        return Ridge(np.array(state["weights"]), state["ones"], state["penalty"], dict(map(tuple, state["errors"])))


def mean_squared_error(gram: Gram, weights: np.ndarray) -> float:
    """Over all rows and targets of a part."""
    cross = 2 * (weights * gram.xy).sum() - (weights * (gram.xx @ weights)).sum()
    return (np.trace(gram.yy) - cross) / (gram.n * gram.xy.shape[1])


def fit_ridge(rows: DataFrame, ones: int, numbers: int, targets: int, penalties: Sequence[float] = PENALTIES) -> Ridge:
    """Least squares on the part ``train`` with the penalty that does best on ``val``, the first one if there is no such part.

    The penalty is on the squared weights, beside the mean squared error; the constant is free.
    """
    found = grams(rows.filter(F.col("split").isin("train", "val")), ones, numbers, targets)
    if "train" not in found:
        raise ValueError("no training rows")
    train, free = found["train"], np.ones(ones + 1 + numbers)
    free[ones] = 0.0
    tried = {p: np.linalg.solve(train.xx / train.n + p * np.diag(free), train.xy / train.n) for p in penalties}
    errors = {p: mean_squared_error(found["val"], w) for p, w in tried.items()} if "val" in found else {}
    best = min(errors, key=errors.get) if errors else penalties[0]
    return Ridge(tried[best], ones, best, errors)
