"""Jump consistent hashing: a document's shard follows from its key and the shard count alone.

No ring table is kept or broadcast. When shards are appended, a row either stays or moves into one
of the new shards, so going from n to n + 1 shards moves about one row in n + 1.

Nulls: a null key is hashed like the empty string, a null text has no bytes. Rows with equal keys
share a shard. An empty table gives an empty result. Extra columns are kept by ``with_shard`` (a
column of the new name is replaced) and ignored by ``shard_slots``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .slices import order_hash, running_total

#: Multiplier of the published algorithm's linear congruential generator (fixed value).
STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; expected rounds grow with the logarithm of ``shards``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    following = np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while active.size:
        shard[active] = following[active]
        state[active] = state[active] * STEP + np.uint64(1)
        spread = (state[active] >> np.uint64(33)).astype(np.float64) + 1
        following[active] = np.floor((shard[active] + 1) * (2.0**31 / spread)).astype(np.int64)
        active = active[following[active] < shards]
    return shard.astype(np.int32)


def shard_of(key: str, shards: int) -> Column:
    """Shard number of the stable key column, from its 64-bit hash."""

    @F.pandas_udf("int")
    def place(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))))


def with_shard(docs: DataFrame, shards: int, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """Add the shard; no shuffle."""
    return docs.withColumn(out, shard_of(key, shards))


def moved(docs: DataFrame, before: int, after: int, key: str = "doc_id") -> DataFrame:
    """The rows that change shard between two shard counts, with ``shard_before`` and ``shard_after``."""
    placed = with_shard(with_shard(docs, before, key, "shard_before"), after, key, "shard_after")
    return placed.filter("shard_before <> shard_after")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", files: int = 1) -> None:
    """Write one folder per shard with at most ``files`` files each, however many tasks read the input."""
    placed = with_shard(docs, shards, key).withColumn("_file", F.pmod(F.xxhash64(F.col(key)), F.lit(files)))
    placed.repartition(shards * files, "shard", "_file").drop("_file").write.partitionBy("shard").parquet(path)


def shard_slots(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the UTF-8 length plus one. ``slot`` numbers the rows of a shard from 0 without gaps; rows
    are numbered in range buckets, so one shard's rows, or one id's, are never in one task. ``grown_shard`` is the shard
    with one shard more. The texts are read once and only these few columns are shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    placed = materialize(
        narrow.withColumns(
            {"shard": shard_of(key, shards), "grown_shard": shard_of(key, shards + 1), "_hash": order_hash(key, seed="slot")}
        ),
        "shards",
    )
    numbered = running_total(placed, ["shard"], "_hash", [key, "text_crc32", "size"], F.lit(1), "slot")
    return numbered.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
