"""Quality verdicts by gradient-boosted trees over statistics of whole documents.

The trees are grown here on a bounded sample of labelled documents (``SAMPLE`` rows, those with the smallest hash of
their id) and flattened into numpy node arrays, which a whole batch walks level by level. Symbols, capitals,
exclamation marks and repetition are constrained: more of them never makes a document better.

Two base rules come first: too few words, or too many words in repeated passages.

Nulls: a null text has no words and fails the base rules; a null id cannot be labelled. Labels other than 0 and 1
are ignored; without labels of both kinds only the base rules judge. Repeated documents are judged alike. Empty tables give
empty results. ``judge`` keeps all columns and replaces those of the added names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches

#: Most labelled documents that the trees are grown on.
SAMPLE = 20_000
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "symbols_per_char",
    "capitals_per_letter",
    "exclamations_per_word",
    "duplicate_lines",
    "repeated_words",
    "word_length",
    "log_words",
    "digits_per_char",
    "stops_per_word",
    "words_per_line",
    "distinct_words",
)
#: +1: the probability may only rise with the feature, -1: only fall, 0: free.
MONOTONE = (-1, -1, -1, -1, -1, 0, 0, 0, 0, 0, 0)
#: Fixed odd multipliers, one per place in a window.
PLACES = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64 | 1 for i in range(WINDOW)], np.uint64)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of eight words found twice or more.

    Windows are hashed first; those whose hash repeats are then compared word by word.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    hashed = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        hashed += codes[i : i + n] * PLACES[i]
    ordered = np.sort(hashed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(hashed, twice)).tolist():
        seen.setdefault(tuple(words[i : i + WINDOW]), []).append(i)
    starts = np.array([i for at in seen.values() if len(at) > 1 for i in at], int)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + WINDOW, -1)
    return int((covered.cumsum() > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts and features of one whole text."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    spaces = int(by_byte[list(SPACES)].sum())
    chars = int(len(data) - by_byte[0x80:0xC0].sum())
    symbols = int(by_byte[list(SYMBOLS)].sum())
    lines = [line for line in data.split(b"\n") if line.strip(SPACES)]
    duplicates = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    capitals, small = int(by_byte[65:91].sum()), int(by_byte[97:123].sum())
    counts = [n, chars - spaces, symbols, duplicates, repeated]
    one = max(1, n)
    features = [
        symbols / max(1, chars),
        capitals / max(1, capitals + small),
        int(by_byte[33]) / one,
        duplicates / max(1, len(lines)),
        repeated / one,
        (chars - spaces) / one,
        float(np.log1p(n)),
        int(by_byte[48:58].sum()) / max(1, chars),
        int(by_byte[list(b".,;:?")].sum()) / one,
        n / max(1, len(lines)),
        len(set(words)) / one,
    ]
    return counts, features


@dataclass
class Trees:
    """Flat node arrays: a node is a leaf if its feature is -1. ``roots`` are the trees' first nodes."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                down = np.where(x[row, np.maximum(f, 0)] <= self.cut[at], self.left[at], self.right[at])
                at = np.where(f < 0, at, down)
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


@dataclass
class _Growing:
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def node(self) -> int:
        for column, start in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            column.append(start)
        return len(self.feature) - 1


def boost(
    x: np.ndarray,
    y: np.ndarray,
    monotone: tuple[int, ...] = MONOTONE,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    least: int = 10,
    smooth: float = 1.0,
) -> Trees:
    """Logistic gradient boosting over binned features."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    share = y.mean()
    start = float(np.log(share / (1 - share)))
    score, grown, roots = np.full(len(y), start), _Growing(), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-6)

        def grow(rows: np.ndarray, level: int, low: float, high: float, slope=slope, bend=bend) -> int:
            node = grown.node()
            total_s, total_b = slope[rows].sum(), bend[rows].sum()
            best = (1e-6, None)
            for j, c in enumerate(cuts) if level < depth else ():
                if not len(c):
                    continue
                s = np.bincount(binned[rows, j], slope[rows], len(c) + 1).cumsum()[:-1]
                b = np.bincount(binned[rows, j], bend[rows], len(c) + 1).cumsum()[:-1]
                n = np.bincount(binned[rows, j], minlength=len(c) + 1).cumsum()[:-1]
                left = np.clip(s / (b + smooth), low, high)
                right = np.clip((total_s - s) / (total_b - b + smooth), low, high)
                worth = lambda v, s, b: s * v - (b + smooth) * v * v / 2
                none = np.clip(total_s / (total_b + smooth), low, high)
                gain = worth(left, s, b) + worth(right, total_s - s, total_b - b) - worth(none, total_s, total_b)
                gain[(n < least) | (len(rows) - n < least) | (monotone[j] * (right - left) < 0)] = -np.inf
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, left[k], right[k]))
            if best[1] is None:
                grown.value[node] = rate * float(np.clip(total_s / (total_b + smooth), low, high))
                score[rows] += grown.value[node]
                return node
            j, k, lv, rv = best[1]
            middle = (lv + rv) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[monotone[j]]
            under = binned[rows, j] <= k
            grown.feature[node], grown.cut[node] = j, float(cuts[j][k])
            grown.left[node] = grow(rows[under], level + 1, *bounds[0])
            grown.right[node] = grow(rows[~under], level + 1, *bounds[1])
            return node

        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    arrays = (np.array(a, t) for a, t in zip((grown.feature, grown.cut, grown.left, grown.right, grown.value), (int, float, int, int, float), strict=True))
    return Trees(*arrays, np.array(roots), start, depth)


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``most`` labelled documents; the same ones on every run.

    A repeated id has one label and counts once, with the smallest of its rows' features.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(label).alias("_y"))
    # At most ``most`` rows of two numbers, so they may be broadcast.
    picked = known.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(picked), "_id")

    def measure(batches):
        for batch in batches:
            x = [statistics(t.as_py())[1] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64())), batch.column(2)], names=["id", "x", "y"])

    measured = rows.select("_id", "_text", F.col("_y").cast("int")).mapInArrow(measure, f"id {rows.schema['_id'].dataType.simpleString()}, x array<double>, y int")
    frame = measured.groupBy("id").agg(F.min(F.struct("x", "y")).alias("_least")).select("_least.x", "_least.y").toArrow()
    return np.array(frame["x"].to_pylist(), float).reshape(-1, len(FEATURES)), frame["y"].to_numpy().astype(float)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = SAMPLE
) -> Trees | None:
    """Trees for the probability that ``label`` is 1, or None without labels of both kinds."""
    x, y = labelled_sample(docs, labels, key, text, label, most)
    if len(np.unique(y)) < 2:
        return None
    order = np.lexsort((*x.T, y))
    return boost(x[order], y[order])


def judge(docs: DataFrame, trees: Trees | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """Add the counts, ``base_failed``, ``probability`` and ``kept`` to every document; no shuffle."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kept = [c for c in docs.columns if c not in (*COUNTS, "base_failed", "probability", "kept")]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("probability", "double").add("kept", "boolean")

    def decide(batches):
        model = shared.value
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column(batch.schema.get_field_index(text))]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            x = np.array([f for _, f in found], float).reshape(-1, len(FEATURES))
            failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED_PERCENT * counts[:, 0])
            p = model.probability(x) if model else np.ones(len(x))
            out = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            out += [pa.array(counts[:, i]) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([*out, pa.array(failed), pa.array(p), pa.array(~failed & (p >= least))], names=schema.names)

    return docs.mapInArrow(decide, schema)
