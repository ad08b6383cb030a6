"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``); the root is the smallest node reachable.

    Large stars hang every larger neighbour of a node on the smallest node of its neighbourhood, small stars
    do so for the smaller ones. The rounds end when the edges stay as they are; then every node hangs on its
    root. Minima are summed up before the shuffle, no neighbourhood is collected, and each round is
    written to the shared folder so that a lost executor costs one round at most.
    """
    larger = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    larger = materialize(larger, "edges")
    before = None
    while True:
        mark = larger.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return larger.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                larger.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        before = mark
        both = larger.unionByName(larger.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # Every edge now leads from a node to a smaller one: small stars take the smallest of them.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(down.select("a", F.col("m").alias("b")))
        larger = materialize(small.filter("a <> b").distinct(), "edges")
