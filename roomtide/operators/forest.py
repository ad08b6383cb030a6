"""Outlier removal with an isolation forest (Liu, Ting and Zhou, ICDM 2008) over all readings.

Trees grow level by level on the cluster. In each level one pass sends every reading down the trees so far and sums up, per tree
and node, how many readings of the tree's sample reach it and their range in each feature; the cuts of the level are
drawn from these ranges. Whether a reading is in a tree's sample is a test of its hash, so any share of the table can be used, no
reading is collected, and the same forest grows whatever the partitioning.

What reaches the driver and goes back to the tasks is the forest itself, at most ``trees * 2 ** (levels + 1)`` nodes. Scoring is a
vectorised column function over Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..functions.text import quoted
from ..schema import FOREST_FEATURES
from ..session import materialize
from .quantiles import exact_quantiles

EULER_GAMMA = 0.5772156649015329
#: Height limit of the trees. A node at the limit counts the mean path that its readings would still have.
LEVELS = 8
#: Share of the readings that each tree is grown on.
SAMPLE = 0.8
#: Readings summed up together, and those of them sent down the trees at once, whose places stay in the processor's cache.
ROWS_AT_ONCE, ROWS_WALKED = 4096, 256


def mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` points."""
    many = np.maximum(n, 3).astype(float)
    long = 2.0 * (np.log(many - 1.0) + EULER_GAMMA) - 2.0 * (many - 1.0) / many
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Per tree and node: the feature it is cut by (-1 for a leaf), the cut, and a leaf's path. The children of node i are 2i and 2i + 1."""

    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    sampled: int

    @classmethod
    def of(cls, trees: int, levels: int) -> Forest:
        shape = (trees, 2 << levels)
        return cls(np.full(shape, -1, np.int8), np.zeros(shape), np.zeros(shape), 0)

    def nodes(self, points: np.ndarray, levels: int) -> np.ndarray:
        """The node of every point in every tree after ``levels`` steps, or the leaf where it stopped before."""
        walk = Walk(self)
        return walk.places(points, levels).reshape(len(points), -1) - walk.base


class Walk:
    """A forest laid out for walking: node i of tree t has place ``base[t] + i``, and a leaf leads to itself."""

    def __init__(self, forest: Forest):
        trees, width = forest.feature.shape
        self.base = np.arange(trees) * width
        node, leaf = np.arange(width), forest.feature < 0
        self.feature = np.maximum(forest.feature, 0).astype(np.intp).ravel()
        self.cut = np.where(leaf, np.inf, forest.cut).ravel()
        self.left = (self.base[:, None] + np.where(leaf, node, 2 * node)).astype(np.intp).ravel()

    def places(self, points: np.ndarray, levels: int) -> np.ndarray:
        """Where every point is in every tree after ``levels`` steps, the trees of a point one after the other."""
        trees, values = len(self.base), points.ravel()
        place = np.tile(self.base + 1, len(points))
        row = np.repeat(np.arange(len(points)) * points.shape[1], trees)
        at, value, cut, right = np.empty_like(place), np.empty(len(place)), np.empty(len(place)), np.empty(len(place), bool)
        for _ in range(levels):
            # All places are inside; to clip them spares a check and a buffer.
            np.take(self.feature, place, out=at, mode="clip")
            at += row
            np.take(values, at, out=value, mode="clip")
            np.take(self.cut, place, out=cut, mode="clip")
            np.greater(value, cut, out=right)
            np.take(self.left, place, out=at, mode="clip")
            np.add(at, right, out=place)
        return place


def _in_sample(hashes: np.ndarray, trees: int, share: float, seed: int) -> np.ndarray:
    return uniform(seed, hashes.view(np.uint64)[:, None], np.arange(trees, dtype=np.uint64)[None, :]) < share


def _level_ranges(points: DataFrame, forest: Forest, level: int, features: int, share: float, seed: int) -> pd.DataFrame:
    """``tree, node, n`` and the range of each feature for the nodes of one level; one row for each leaves a task.

    Nodes at the height limit are not cut, so these are only counted, and their ranges are empty.
    """
    shared = points.sparkSession.sparkContext.broadcast(forest)
    (trees, places), width = forest.feature.shape, 1 << level
    cuts = 2 * width < places

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(shared.value)
        n = np.zeros(trees * places, np.int64)
        low, high = np.full((features, trees * places), np.inf), np.full((features, trees * places), -np.inf)
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            data = np.ascontiguousarray(np.column_stack([batch.column(i + 1).to_numpy() for i in range(features)]))
            for start in range(0, len(data), ROWS_AT_ONCE):
                part = data[start : start + ROWS_AT_ONCE]
                keys, rows = [], []
                for k in range(0, len(part), ROWS_WALKED):
                    at = walk.places(part[k : k + ROWS_WALKED], level)
                    here = at.reshape(-1, trees) >= walk.base + width
                    here &= _in_sample(hashes[start + k : start + min(k + ROWS_WALKED, ROWS_AT_ONCE)], trees, share, seed)
                    taken = np.flatnonzero(here)
                    keys.append(at.take(taken))
                    rows.append(taken // trees + k)
                key, row = np.concatenate(keys), np.concatenate(rows)
                if not cuts:
                    n += np.bincount(key, minlength=len(n))
                    continue
                if not len(key):
                    continue
                # Sixteen bits, where they do, are sorted by counting.
                key = key.astype(np.uint16) if len(n) <= 1 << 16 else key
                order = np.argsort(key, kind="stable")
                row, key = row.take(order), key.take(order)
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                found = key[first]
                n[found] += np.diff(np.append(first, len(key)))
                columns = np.ascontiguousarray(part.T)
                for f in range(features):
                    values = columns[f].take(row)
                    low[f, found] = np.minimum(low[f, found], np.minimum.reduceat(values, first))
                    high[f, found] = np.maximum(high[f, found], np.maximum.reduceat(values, first))
        seen = np.flatnonzero(n)
        found = {"tree": pa.array(seen // places, pa.int32()), "node": pa.array(seen % places, pa.int32()), "n": pa.array(n[seen])}
        for f in range(features):
            found |= {f"low{f}": pa.array(low[f, seen]), f"high{f}": pa.array(high[f, seen])}
        yield pa.RecordBatch.from_pydict(found)

    schema = "tree int, node int, n long, " + ", ".join(f"low{f} double, high{f} double" for f in range(features))
    ranges = [a for f in range(features) for a in (F.min(f"low{f}").alias(f"low{f}"), F.max(f"high{f}").alias(f"high{f}"))]
    summed = points.mapInArrow(sum_up, schema).groupBy("tree", "node").agg(F.sum("n").alias("n"), *ranges).toPandas()
    shared.unpersist()
    return summed


def grow_forest(points: DataFrame, trees: int, share: float, seed: int, levels: int = LEVELS) -> Forest:
    """A forest over ``points``: a hash and then the features, none of them missing."""
    features = len(points.columns) - 1
    forest = Forest.of(trees, levels)
    for level in range(levels + 1):
        found = _level_ranges(points, forest, level, features, share, seed)
        if found.empty:
            break
        tree, node, n = (found[c].to_numpy() for c in ("tree", "node", "n"))
        if level == 0:
            forest.sampled = int(n.max())
        low = np.column_stack([found[f"low{f}"] for f in range(features)])
        high = np.column_stack([found[f"high{f}"] for f in range(features)])
        varied = high > low
        splits = (n > 1) & varied.any(axis=1) & (level < levels)
        forest.path[tree, node] = level + mean_path(n)
        tree, node, low, high, varied = (x[splits] for x in (tree, node, low, high, varied))
        # One of the features that vary, and a cut below its largest value, so neither side is empty.
        wanted = np.floor(uniform(seed + 1, tree, node) * varied.sum(axis=1)).astype(int)
        feature = (varied.cumsum(axis=1) > wanted[:, None]).argmax(axis=1)
        row = np.arange(len(tree))
        at, end = low[row, feature], high[row, feature]
        drawn = at + uniform(seed + 2, tree, node) * (end - at)
        forest.feature[tree, node] = feature
        forest.cut[tree, node] = np.minimum(drawn, np.nextafter(end, -np.inf))
    return forest


def forest_score(spark: SparkSession, forest: Forest, features: Sequence[str]) -> Column:
    """Anomaly score in (-1, 0); the lower, the easier a reading is to isolate."""
    shared = spark.sparkContext.broadcast(forest)
    scale = float(mean_path(np.array(forest.sampled))) or 1.0
    trees, levels = len(forest.feature), forest.feature.shape[1].bit_length() - 2

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        walk, path = Walk(shared.value), shared.value.path.ravel()
        for columns in batches:
            data = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            out = np.empty(len(data))
            for start in range(0, len(data), ROWS_WALKED):
                at = walk.places(data[start : start + ROWS_WALKED], levels)
                out[start : start + ROWS_WALKED] = -np.exp2(-path.take(at).reshape(-1, trees).mean(axis=1) / scale)
            yield pd.Series(out)

    return F.pandas_udf(score, "double")(*[F.col(quoted(c)).cast("double") for c in features])


def anomaly_scores(
    df: DataFrame,
    features: Sequence[str] = FOREST_FEATURES,
    trees: int = 100,
    sample: float = SAMPLE,
    seed: int = 0,
    levels: int = LEVELS,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``anomaly_score``, written once, so that later passes read one column instead of scoring again.

    The forest is grown on the complete readings of ``fit_on``, by default of ``df``; without any all scores are 0.
    """
    spark, base = df.sparkSession, df if fit_on is None else fit_on
    hashed = F.xxhash64(*[F.col(quoted(c)) for c in base.columns]).alias("_hash")
    complete = base.select(hashed, *[F.col(quoted(c)).cast("double").alias(f"f{i}") for i, c in enumerate(features)]).dropna()
    # Hashes spread the readings over all tasks, as the passes to come are bound by computing.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = materialize(complete.repartition(parts, "_hash"), "forest-points")
    forest = grow_forest(points, trees, sample, seed, levels)
    score = forest_score(spark, forest, features) if forest.sampled else F.lit(0.0)
    return materialize(df.withColumn("anomaly_score", score), "forest")


def remove_outliers_forest(df: DataFrame, contamination: float = 0.075, **how) -> DataFrame:
    """Drop the share ``contamination`` of readings that score lowest; ``how`` goes to :func:`anomaly_scores`."""
    scored = anomaly_scores(df, **how)
    threshold = exact_quantiles(scored, ["anomaly_score"], [contamination])["anomaly_score"][0]
    if threshold is None:
        return df
    return scored.filter(F.col("anomaly_score") >= F.lit(threshold)).drop("anomaly_score")
