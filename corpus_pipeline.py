"""From raw documents to packed training sequences, in five stages.

Every stage takes what its predecessor kept, as ``docs``, and all but the last return the columns of ``documents``:

1. ``language``: learns the languages of the rows that have one; rejects texts of no language, and those
   that no language fits better than the others.
2. ``quality``: learns from ``labels``; rejects what the base rules or the trees reject.
3. ``near_duplicates``: keeps the row with the smallest id (null ids last), then text hash, of every group of near copies.
4. ``mixing``: repeats and drops documents to meet the sources' target weights, in the order of the curriculum.
5. ``packing``: the pieces of all documents in windows of 4096 ids.

Nulls: a null text has no language and goes in stage 1. Rows that repeat a text are copies of it, so one
stays; different texts are different documents, also under one id or none.
An empty table passes through all stages as an empty table. Extra columns are kept up to stage 4.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.llm import language, mixing, packing, quality, simhash
from roomtide.session import materialize, new_path

#: Least posterior of the best language; a text in two languages has about a half.
LEAST_CERTAIN = 0.35
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _kept(docs: DataFrame, judged: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows that ``judged`` (given the rows and the name of the text) leaves, with the columns of ``docs``.

    Columns go by number meanwhile, so that no name clashes with a verdict's.
    """
    numbered = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    left = judged(numbered, f"_{docs.columns.index('text')}")
    return left.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs, F.lit(True))
    certain = (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_CERTAIN)
    return _kept(docs, lambda rows, text: language.identify(rows, model, text).filter(certain))


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trees = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _kept(docs, lambda rows, text: quality.judge(rows, trees, text).filter("kept"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Neither ids nor texts need be unique, so a row is known by its id, a null one last, and hashes of its text and columns.
    # Join and removal of rows that agree in all go by the same keys, so texts are shuffled once.
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())]
    parts = {
        "none": F.col("doc_id").isNull(),
        "id": F.coalesce("doc_id", F.lit(0)),
        "text": F.xxhash64("text"),
        "row": F.xxhash64(*hashed),
    }
    own = F.struct(*[c.alias(k) for k, c in parts.items()])
    found = simhash.near_duplicates(docs.select(own.alias("own"), "text"), key="own")
    keys = [f"_{k}" for k in parts]
    first = found.filter("own = component_id").select(*[F.col(f"own.{k}").alias(f"_{k}") for k in parts]).distinct()
    # Columns go by number beside the keys, so that no name clashes.
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)], *[c.alias(f"_{k}") for k, c in parts.items()])
    kept = keyed.join(materialize(first, "first"), keys, "left_semi").dropDuplicates(keys)
    return kept.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.training_order(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, TOKENIZER)
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", identify_language),
    ("quality", judge_quality),
    ("near_duplicates", remove_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Trees, byte contexts, XXH64 and subwords have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
