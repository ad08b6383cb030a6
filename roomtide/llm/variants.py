"""Spelling variants: words one edit apart, each grouped with the commonest spelling next to it.

The vocabulary is counted over all texts. Neighbours are found without comparing words with each other:

1. Bloom filters of the vocabulary, one for each word length and cut into blocks of eight 32-bit lanes, are filled by an
   aggregation on (length, block).
2. Every word generates its edits: each deletion, and each replacement by a larger letter. With these every pair of
   neighbours is generated exactly once, from its longer or its smaller word. Hashes of edits follow from the
   word's own by exclusive or, so an edit costs a few operations whatever the word's length, and no string is built.
3. Edits probe the broadcast filters. Only positives become strings and are shuffled to a join with the vocabulary, which
   removes false positives and brings the counts.

The filters of one pass take at most ``FILTER_BYTES``; longer ones are cut into ranges of blocks, and a larger vocabulary takes
more passes, each over the words whose edits can lie in its part. So the broadcast does not grow with the corpus.

Forms lead to words at least ``RATIO`` times as frequent, so chains end; roots come by doubling the way, in as many rounds as
the logarithm of the longest chain.

Nulls: a null text has no words. Texts and words of any length are
whole. Rows that repeat count each. An empty table gives an empty result. Only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import STEP, mixed
from ..session import materialize

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form is at least this many times as frequent as its variant.
RATIO = 5
#: Letters of a word: A to Z in both cases and code points C0 to FF; only A to Z are lowered.
LETTERS = "A-Za-z\u00C0-\u00FF"
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most bytes of filters that are broadcast at a time.
FILTER_BYTES = 32 << 20
LANES, LANE_BITS = 8, 32
#: Filter bits for each word of up to 16 letters; a longer word has more edits and gets more in proportion.
BITS_PER_WORD = 16
#: Most hashes that a task looks at together.
PROBES = 1 << 20


def runs(text: str = "text", least: int = LEAST_LENGTH) -> Column:
    """Array of the maximal runs of at least ``least`` letters, A to Z lowered. A shorter run has no match, so runs stay whole."""
    found = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return F.transform(found, lambda w: F.translate(w, CAPITALS, SMALL))


def vocabulary(words: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` for the column ``word`` of single words; counts are summed up before the shuffle."""
    kept = words.filter(F.char_length("word") >= least)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def letter_keys(places: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """A random 64-bit value for each letter at each place."""
    return mixed((places.astype(np.uint64) * np.uint64(256) + letters.astype(np.uint64) + np.uint64(1)) * STEP)


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points, one byte each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def hashes(letters: np.ndarray) -> np.ndarray:
    """A word's hash: the exclusive or of the keys of its letters."""
    return np.bitwise_xor.reduce(letter_keys(np.arange(letters.shape[1])[None, :], letters), axis=1)


def blocks_for(length: int, words: int) -> int:
    return -(-words * BITS_PER_WORD * max(1, length // 16) // (LANES * LANE_BITS))


def block_and_bits(hashed: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and a value whose eight groups of five bits pick a bit in each lane."""
    final = mixed(hashed)
    return (final >> np.uint64(40)) * np.uint64(blocks) >> np.uint64(24) if blocks < 1 << 24 else final % np.uint64(blocks), mixed(final + np.uint64(1))


def probe(lanes: np.ndarray, first: int, blocks: int, hashed: np.ndarray) -> np.ndarray:
    """Places in ``hashed`` that the filter may hold. ``lanes`` are the blocks from ``first`` on; others are left to other passes."""
    block, bits = block_and_bits(hashed, blocks)
    block = block.astype(np.int64) - first
    at = np.flatnonzero((block >= 0) & (block < len(lanes)))
    for lane in range(LANES):
        bit = (bits[at] >> np.uint64(5 * lane)).astype(np.uint32) & np.uint32(31)
        at = at[(lanes[block[at], lane] >> bit) & np.uint32(1) == 1]
    return at


def filter_rows(words: DataFrame) -> DataFrame:
    """``word, n, length, hash`` of the vocabulary."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            length = np.fromiter(map(len, found), np.int32, len(found))
            hashed = np.zeros(len(found), np.uint64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                for part in np.array_split(at, -(-len(at) * int(size) // PROBES)):
                    hashed[part] = hashes(codes([found[i] for i in part]))
            yield pa.RecordBatch.from_pydict(
                {"word": batch.column("word"), "n": batch.column("n"), "length": pa.array(length), "hash": pa.array(hashed.view(np.int64))}
            )

    return words.select("word", "n").mapInArrow(add, "word string, n long, length int, hash long")


def passes(sizes: dict[int, int], most: int = FILTER_BYTES) -> list[dict[int, tuple[int, int]]]:
    """Per pass the range of blocks of each length's filter, so that a pass holds at most ``most`` bytes."""
    room, found = max(1, most // (LANES * LANE_BITS // 8)), [{}]
    left = room
    for length, words in sorted(sizes.items()):
        first, blocks = 0, blocks_for(length, words)
        while first < blocks:
            if not left:
                found.append({})
                left = room
            end = min(blocks, first + left)
            found[-1][length] = (first, end)
            left, first = left - (end - first), end
    return found


def lanes_of(words: DataFrame, part: dict[int, tuple[int, int]], sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """The filters of one pass, filled by Spark; at most the pass's bytes reach the driver."""
    lengths = sorted(part)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            hashed = batch.column("hash").to_numpy().view(np.uint64)
            for size in np.unique(length).tolist():
                first, end = part[size]
                block, bits = block_and_bits(hashed[length == size], blocks_for(size, sizes[size]))
                inside = (block >= first) & (block < end)
                block, bits = block[inside], bits[inside]
                lane = [np.int64(1) << ((bits >> np.uint64(5 * i)) & np.uint64(31)).astype(np.int64) for i in range(LANES)]
                yield pa.RecordBatch.from_pydict(
                    {"length": pa.array(np.full(len(block), size, np.int32)), "block": pa.array(block.astype(np.int64))}
                    | {f"l{i}": pa.array(x) for i, x in enumerate(lane)}
                )

    schema = "length int, block long, " + ", ".join(f"l{i} long" for i in range(LANES))
    rows = words.filter(F.col("length").isin(lengths)).select("length", "hash").mapInArrow(place, schema)
    table = rows.groupBy("length", "block").agg(*[F.bit_or(f"l{i}").alias(f"l{i}") for i in range(LANES)]).toArrow()
    length, block = table["length"].to_numpy(), table["block"].to_numpy()
    values = np.stack([table[f"l{i}"].to_numpy() for i in range(LANES)], axis=1).astype(np.uint32)
    lanes = {}
    for size, (first, end) in part.items():
        lanes[size] = np.zeros((end - first, LANES), np.uint32)
        own = length == size
        lanes[size][block[own] - first] = values[own]
    return lanes


def edits(words: list[str], filters: dict[int, tuple[np.ndarray, int, int]]) -> Iterator[tuple[int, str]]:
    """``(place in words, edit)`` of every edit that a filter may hold. ``words`` have one length."""
    letters = codes(words)
    n, length = letters.shape
    places = np.arange(length)
    keys = letter_keys(places[None, :], letters)
    if length in filters:
        without = np.bitwise_xor.reduce(keys, axis=1)[:, None] ^ keys
        for letter in ALPHABET:
            row, at = np.nonzero(letters < letter)
            hashed = without[row, at] ^ letter_keys(places, np.full(length, letter))[at]
            for i in probe(*filters[length], hashed):
                word = words[row[i]]
                yield int(row[i]), f"{word[: at[i]]}{chr(letter)}{word[at[i] + 1 :]}"
    if length - 1 in filters:
        # The letters after a deleted one move down by a place.
        down = letter_keys(np.maximum(places - 1, 0)[None, :], letters)
        before = np.bitwise_xor.accumulate(keys, axis=1) ^ keys
        after = np.bitwise_xor.accumulate(down[:, ::-1], axis=1)[:, ::-1] ^ down
        # Deleting any of several equal letters in a row gives the same word: the first stands for all.
        first = np.ones((n, length), bool)
        first[:, 1:] = letters[:, 1:] != letters[:, :-1]
        row, at = np.nonzero(first)
        for i in probe(*filters[length - 1], (before ^ after)[row, at]):
            word = words[row[i]]
            yield int(row[i]), word[: at[i]] + word[at[i] + 1 :]


def neighbours(words: DataFrame, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """``a, n_a, b, n_b`` for every pair of words one edit apart, once, from the rows of :func:`filter_rows`."""
    spark = words.sparkSession
    sizes = {r.length: r["count"] for r in words.groupBy("length").count().collect()}
    found = None
    for part in passes(sizes, most_bytes):
        lanes = lanes_of(words, part, sizes) if part else {}
        shared = spark.sparkContext.broadcast({s: (x, part[s][0], blocks_for(s, sizes[s])) for s, x in lanes.items()})

        def positives(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
                length = np.fromiter(map(len, own), np.int64, len(own))
                for size in np.unique(length).tolist():
                    at = np.flatnonzero(length == size)
                    for rows in np.array_split(at, -(-len(at) * size // (PROBES // 8))):
                        hits = [(rows[i], edit) for i, edit in edits([own[i] for i in rows], shared.value)]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "a": pa.array([own[i] for i, _ in hits], pa.string()),
                                "n_a": pa.array([counts[i] for i, _ in hits], pa.int64()),
                                "b": pa.array([edit for _, edit in hits], pa.string()),
                            }
                        )

        asking = words.filter(F.col("length").isin(sorted({s + d for s in part for d in (0, 1)}))).select("word", "n")
        hits = materialize(asking.mapInArrow(positives, "a string, n_a long, b string"), "variant-hits")
        shared.unpersist()
        found = hits if found is None else found.unionByName(hits)
    return found.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last form of each chain, by doubling the way in every round."""
    ways = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ways = materialize(
            ways.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("on")),
            "variant-roots",
        )
        if not ways.filter("on").limit(1).count():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def group(words: DataFrame, ratio: int = RATIO, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of a vocabulary (``word, n``).

    ``form`` is the commonest neighbour, the first in code-point order among equals, if it is ``ratio`` times as frequent.
    """
    known = materialize(filter_rows(words), "vocabulary")
    pairs = materialize(neighbours(known, most_bytes), "variant-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("low"), "near")).alias("best")
    )
    joined = known.select("word", "n").join(best, "word", "left")
    enough = -F.col("best.low") >= F.col("n") * ratio
    judged = materialize(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.low")).alias("form_n"),
        ),
        "variant-forms",
    )
    ends = roots(judged.filter("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
