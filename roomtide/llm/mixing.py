"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Every source has a weight schedule over training progress 0 to 1. Its integral gives the source's
share of the mix; its running integral, inverted, gives the progress at which a cumulative number
of the source's words is due. A document's turn in the source's (hashed) order thus becomes a
training position, and one range sort by position yields the training order.

Whole documents are taken, once per epoch of the source, while the middle of the document lies below
the target; a source's words therefore miss the target by at most half a document.

Nulls: a null source is a source of its own, ordered last; a null text has size 0. Documents of size
0 are never taken (``taken`` 0, no positions). Rows that repeat are separate documents. An empty
table gives an empty result. Extra columns are kept; columns named like the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import RowOrder
from ..session import materialize
from .slices import order_hash, running_total

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: For each weight in turn, (progress, relative weight) knots, linear between them, with mean 1:
#: heavy sources fade, middling ones stay, light ones come in late.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)
ADDED = ("size", "source_size", "target", "taken", "positions")


def word_count(text: str = "text") -> Column:
    """Number of runs of characters other than ASCII white space; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def integral(knots: Sequence[tuple[float, float]]) -> float:
    return sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:], strict=False))


def progress(part: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Progress at which ``part`` (0 to 1) of the schedule's integral is reached.

    Within a piece the weight is v + s(u - a), so the demand is a quadratic in u; its root is
    written in the form that stays exact when s is 0.
    """
    whole = integral(knots)
    due, met = part * F.lit(whole), 0.0
    result: Column | None = None
    for i, ((a, v), (b, w)) in enumerate(zip(knots, knots[1:], strict=False)):
        slope, area = (w - v) / (b - a), (b - a) * (v + w) / 2
        rest = F.greatest(due - F.lit(met), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(v * v) + F.lit(2 * slope) * rest, F.lit(0.0)))
        here = F.least(F.lit(a) + F.when(rest > 0, 2 * rest / (F.lit(v) + root)).otherwise(F.lit(0.0)), F.lit(b))
        met += area
        last = i == len(knots) - 2
        if result is None:
            result = here if last else F.when(due <= F.lit(met), here)
        else:
            result = result.otherwise(here) if last else result.when(due <= F.lit(met), here)
    return result


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """Per source key: ``source_size``, ``kind`` (its place in the repeating weights) and ``target``.

    The targets share ``share`` times all words by weight; a source is held at ``most`` times its words
    and the excess goes to the others. The level of the others rises as sources reach their limit, so
    repeating the two sums until no further source is limited ends after a few passes over the sources.
    """
    sources = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    sources = materialize(sources, "sources")
    order = RowOrder(sources, ["_source"])
    ranked = RowOrder.detach(order.index(order.attach(sources), "_rank"))
    kind = F.pmod(F.col("_rank"), F.lit(len(weights))).cast("int")
    means = [integral(k) for k in schedules]
    by_kind = F.element_at(F.array(*[F.lit(w * m) for w, m in zip(weights, means, strict=True)]), kind + 1)
    ranked = materialize(
        ranked.select("_source", "source_size", kind.alias("kind"), by_kind.alias("weight")).withColumn(
            "limit", F.col("source_size") * F.lit(most)
        ),
        "source-weights",
    )
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * min(share, most)
    level, limited = 0.0, -1
    while True:
        full = F.col("limit") <= F.col("weight") * F.lit(level)
        row = ranked.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if row.n == limited or not row.weight:
            break
        limited, level = row.n, (total - row.held) / row.weight
    target = F.least(F.col("limit"), F.col("weight") * F.lit(level)) if limited >= 0 else F.col("limit")
    return ranked.select("_source", "source_size", "kind", target.alias("target"))


def _positions(knots: Sequence[tuple[float, float]]) -> Column:
    return F.transform("_due", lambda m: progress(m / F.col("target"), knots))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``taken`` and ``positions`` to every document.

    ``positions`` holds one training position in 0 to 1 for every time the document is taken. A
    source with a third of all rows, or an id with as many, is cut into range buckets.
    """
    amount = word_count() if size is None else size
    named = F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))
    rows = docs.withColumns({"_size": amount, "_source": named, "_hash": order_hash(key, seed=seed)})
    rows = rows.drop(*ADDED).withColumnRenamed("_size", "size")
    targets = source_targets(rows.select("_source", "size"), weights, schedules, share, most)
    rows = running_total(rows, ["_source"], "_hash", [key, "size"], F.col("size"), "_before")
    rows = rows.join(targets, "_source")
    epochs = F.sequence(F.lit(0), F.lit(max(0, int(-(-most // 1)) - 1)))
    middle = F.transform(epochs, lambda e: e * F.col("source_size") + F.col("_before") + F.col("size") / 2)
    due = F.filter(middle, lambda m: (F.col("size") > 0) & (m < F.col("target")))
    by_kind = F.lit(None).cast("array<double>")
    for i, knots in enumerate(schedules):
        by_kind = F.when(F.col("kind") == i, _positions(knots)).otherwise(by_kind)
    return (
        rows.withColumn("_due", due)
        .withColumns({"taken": F.size("_due") * F.col("size"), "positions": by_kind})
        .drop("_source", "_hash", "_before", "_due", "kind")
    )


def training_order(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The documents as often as they are taken, range-sorted by position, with the columns of ``docs`` as they were."""
    rows = docs.select(key, source, word_count(text).alias("_words"), F.struct("*").alias("_row"))
    mixed = mix(rows, key, source, F.col("_words"), **how).withColumn("_position", F.explode("positions"))
    return mixed.orderBy("_position", key).select("_row.*")
