"""Merkle manifest of a dataset by checkpoint and recompute.

Every row becomes a leaf, the SHA-256 of its fields. The leaves of a group, in the order of their key, are the lowest level of a
tree; runs of ``FANOUT`` nodes become their hash until one node, the subroot, is left. The subroots, in the order of their
groups, are the leaves of a last tree that ends in the root.

Only every ``EVERY``-th level is written, a row for each *aligned subtree*: the at most ``FANOUT ** EVERY`` consecutive nodes
below one node of the next written level. A proof needs the levels in between, too. Proof extraction builds them again from the
subtree's stored nodes, reads the siblings off them and drops them; what is above comes from the next written level, by a join
on (group, subtree), which is unique on both sides. A row never holds more than one subtree and one path to the root, so a group
with a third of all rows is spread like any other; its leaves are numbered in range buckets, not in a window of its own.

Nulls: a null field is written ``-``; the null group is a group of its own and comes first, as do null keys within a group. Rows
that repeat a key go by their leaf; rows that agree in the leaf, too, are leaves each, next to each other. Empty and very
long texts are hashed whole. An empty table has no leaf and no root. Only the named columns are read; others may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import BUCKET, RowOrder
from ..session import materialize, new_path

FANOUT = 16
#: Levels from one written level to the next.
EVERY = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<left:string,right:string>>"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(fields: Mapping[str, Column] | Sequence[str] = FIELDS) -> Column:
    """SHA-256 of the fields one after another, each ``-`` or its UTF-8 length, ``:`` and its value."""
    columns = fields.values() if isinstance(fields, Mapping) else [F.col(f"`{f}`") for f in fields]
    texts = [c.cast("string") for c in columns]
    return sha256(
        F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    )


def group_key(group: Column) -> Column:
    """A string for every group that keeps null apart and sorts it first, and sorts the others by their UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def _parents(nodes: str) -> str:
    """SQL for the level above an array of nodes that starts at a multiple of the fan-out."""
    runs = f"sequence(0, (size({nodes}) - 1) div {FANOUT})"
    return f"transform({runs}, r -> sha2(array_join(slice({nodes}, r * {FANOUT} + 1, {FANOUT}), ''), 256))"


def _steps(n: str, every: int) -> str:
    """SQL for how many levels a subtree climbs in a tree with ``n`` nodes at its lowest level."""
    return " + ".join(f"int({n} > {FANOUT**j}L)" for j in range(every))


def _regenerated(subtrees: DataFrame, every: int) -> DataFrame:
    """Add ``_l1`` to ``_l<every>``, the levels above ``nodes``; those above the tree's last level repeat it."""
    below = "nodes"
    for j in range(1, every + 1):
        subtrees = subtrees.selectExpr("*", f"CASE WHEN n > {FANOUT ** (j - 1)}L THEN {_parents(below)} ELSE {below} END AS _l{j}")
        below = f"_l{j}"
    return subtrees


def _tops(subtrees: DataFrame, every: int) -> DataFrame:
    """``grp, pos, hash, n``: the node above each subtree, its place and the number of nodes on its level."""
    found = _regenerated(subtrees, every)
    return found.selectExpr("grp", "sub AS pos", f"_l{every}[0] AS hash", f"(n + {FANOUT**every - 1}L) div {FANOUT**every}L AS n")


def _subtrees(nodes: DataFrame, every: int, carried: Sequence[str] = ()) -> DataFrame:
    """Nodes (``grp, pos, hash, n`` and carried columns) as one row for each aligned subtree."""
    row = F.struct("pos", "hash", *carried)
    grouped = nodes.groupBy("grp", F.expr(f"pos div {FANOUT**every}").alias("sub"))
    grouped = grouped.agg(F.max("n").alias("n"), F.array_sort(F.collect_list(row)).alias("rows"))
    return grouped.select("grp", "sub", "n", F.col("rows.hash").alias("nodes"), *[F.col(f"rows.{c}").alias(c) for c in carried])


def _numbered(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the place within ``grp``, and ``n``, the rows of ``grp``.

    Rows run in range buckets over all groups; a table with one row per bucket and group carries what comes before.
    """
    places = RowOrder(leaves, order, within=["grp"])
    rows = places.attach(leaves)
    by_group = Window.partitionBy("grp")
    parts = rows.groupBy(BUCKET, "grp").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(by_group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(BUCKET, "grp", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(by_group).alias("n"))
    here = F.row_number().over(Window.partitionBy(BUCKET, "grp").orderBy(*[F.col(k).asc_nulls_first() for k in order]))
    rows = rows.withColumn("pos", here - 1).join(parts, [BUCKET, "grp"])
    return rows.withColumn("pos", F.col("pos") + F.col("_before")).drop(BUCKET, "_before")


@dataclass
class Manifest:
    """The written levels of a dataset's trees: ``levels[k]`` holds the subtrees that start at level ``k * every``.

    ``top`` holds the same for the tree over the subroots, as a single group. ``subroots`` has one row per group.
    """

    levels: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: str | None
    every: int
    carried: list[str]


def _climb(nodes: DataFrame, path: str, name: str, every: int, carried: Sequence[str] = ()) -> list[DataFrame]:
    """Write the subtrees of every ``every``-th level, up to the last subtree of the largest group."""
    spark, levels = nodes.sparkSession, []
    while True:
        at = f"{path}/{name}-{len(levels)}"
        _subtrees(nodes, every, () if levels else carried).write.parquet(at)
        levels.append(spark.read.parquet(at))
        if not levels[-1].filter(f"n > {FANOUT**every}").limit(1).count():
            return levels
        nodes = _tops(levels[-1].filter(f"n > {FANOUT**every}"), every)


def _ends(levels: Sequence[DataFrame], every: int) -> DataFrame:
    """``grp, hash, k``: the last node of each group and the written level whose subtree reaches it."""
    found = [_tops(t.filter(f"n <= {FANOUT**every}"), every).select("grp", "hash", F.lit(k).alias("k")) for k, t in enumerate(levels)]
    ends = found[0]
    for other in found[1:]:
        ends = ends.unionByName(other)
    return ends


def build(
    docs: DataFrame,
    group: str = "source",
    key: str = "doc_id",
    fields: Sequence[str] = FIELDS,
    carry: Mapping[str, Column] | None = None,
    path: str | None = None,
    every: int = EVERY,
) -> Manifest:
    """Hash all rows and write the manifest below ``path`` (a new folder in the shared one if not given).

    ``carry`` names further columns, computed from ``docs``, that stay beside the leaves. Texts are read once and not shuffled.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "merkle")
    carry = dict(carry or {})
    # Columns are numbered here so that no name of the table clashes with one of the tree.
    narrow = docs.select(
        group_key(F.col(f"`{group}`")).alias("grp"),
        F.col(f"`{key}`").alias("key"),
        leaf_hash(fields).alias("hash"),
        *[c.alias(f"c{i}") for i, c in enumerate(carry.values())],
    )
    kept = ["key", *[f"c{i}" for i in range(len(carry))]]
    leaves = _numbered(materialize(narrow, "leaves"), ["key", "hash"])
    levels = _climb(leaves, path, "level", every, kept)
    _ends(levels, every).write.parquet(f"{path}/subroots")
    subroots = spark.read.parquet(f"{path}/subroots")
    over = _numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "hash"), ["member"])
    _climb(over, path, "top", every, ["member"])
    spark.createDataFrame(list(enumerate(carry)), "at int, name string").coalesce(1).write.parquet(f"{path}/carried")
    spark.createDataFrame([(len(levels), every)], "levels int, every int").coalesce(1).write.parquet(f"{path}/shape")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Manifest:
    """The manifest written below ``path``."""
    shape = spark.read.parquet(f"{path}/shape").first()
    carried = [r.name for r in spark.read.parquet(f"{path}/carried").orderBy("at").collect()]
    subroots = spark.read.parquet(f"{path}/subroots")
    top, most = [], subroots.count()
    while not top or most > 1:
        top.append(spark.read.parquet(f"{path}/top-{len(top)}"))
        most = -(-most // FANOUT**shape.every)
    root = _ends(top, shape.every).first()
    levels = [spark.read.parquet(f"{path}/level-{k}") for k in range(shape.levels)]
    return Manifest(levels, top, subroots, root.hash if root else None, shape.every, carried)


def _own_steps(every: int) -> str:
    """SQL for the siblings of node ``i`` of a subtree, level by level, as far as its tree goes."""
    parts = []
    for j in range(every):
        level = "nodes" if j == 0 else f"_l{j}"
        at, run = f"(i div {FANOUT**j})", f"(i div {FANOUT ** (j + 1)} * {FANOUT})"
        left = f"array_join(slice({level}, {run} + 1, {at} - {run}), '')"
        right = f"array_join(slice({level}, {at} + 2, {run} + {FANOUT - 1} - {at}), '')"
        parts.append(f"named_struct('left', {left}, 'right', {right})")
    return f"slice(array({', '.join(parts)}), 1, steps)"


def _paths(levels: Sequence[DataFrame], ends: DataFrame, every: int, kept: Sequence[str]) -> DataFrame:
    """``grp, leaf, proof, subroot`` and the carried columns of every node of the lowest level.

    ``ends`` (``grp, k, proof, subroot``) goes on from the last node of each group, whose subtree is on written level ``k``.
    """
    above = None
    for k in reversed(range(len(levels))):
        last = ends.filter(F.col("k") == k).select("grp", F.lit(0).cast("long").alias("sub"), "proof", "subroot")
        above = last if above is None else above.select("grp", F.col("pos").alias("sub"), "proof", "subroot").unionByName(last)
        carried = list(kept) if k == 0 else []
        rows = _regenerated(levels[k].join(above, ["grp", "sub"]).selectExpr("*", f"{_steps('n', every)} AS steps"), every)
        fields = ", ".join(["'at', i", "'leaf', nodes[i]", "'own', " + _own_steps(every), *[f"'{c}', {c}[i]" for c in carried]])
        rows = rows.selectExpr("grp", "sub", "proof", "subroot", f"inline(transform(sequence(0, size(nodes) - 1), i -> named_struct({fields})))")
        above = rows.selectExpr(
            "grp", f"sub * {FANOUT**every} + at AS pos", "leaf", "concat(own, proof) AS proof", "subroot", *carried
        )
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf with its way to the root: ``key, leaf, subroot, root, proof`` and the carried columns.

    ``proof`` has a struct for each level: the siblings before the node (``left``) and after it (``right``), in one text each.
    """
    every, kept = manifest.every, ["key", *[f"c{i}" for i in range(len(manifest.carried))]]
    done = F.from_json(F.lit("[]"), STEP)
    root = F.lit(manifest.root).cast("string")
    one = manifest.subroots.sparkSession.range(1).select(
        F.lit("").alias("grp"), F.lit(len(manifest.top) - 1).alias("k"), done.alias("proof"), root.alias("subroot")
    )
    over = _paths(manifest.top, one, every, ["member"]).select(F.col("member").alias("grp"), "proof")
    ends = manifest.subroots.withColumnRenamed("hash", "subroot").join(over, "grp")
    rows = _paths(manifest.levels, materialize(ends, "subroot-proofs"), every, kept)
    named = [F.col(f"c{i}").alias(name) for i, name in enumerate(manifest.carried)]
    return rows.select("key", "leaf", "subroot", root.alias("root"), "proof", *named)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda node, p: sha256(F.concat(p["left"], node, p["right"])))


def proof_hash(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, from left to right."""
    return sha256(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), ""))
