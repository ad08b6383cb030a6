"""SimHash near-duplicates by generalised pigeonhole search.

Texts with equal fingerprints collapse first. The 64 bits of the distinct fingerprints are grouped into parts of
correlated bits. With thresholds t_i that sum to d - parts + 1, two fingerprints at distance d or less agree
up to t_i bits in at least one part i; t_i = -1 skips a part. Each fingerprint chooses its thresholds
by dynamic programming over the candidates to expect, which the counts of all part values give exactly. It then
probes the cells (part, value) within its thresholds, and what meets in a cell is compared in full.

A cell that many fingerprints share is cut into blocks, and every two blocks meet in a task of their own. Within a
task, links are reduced to a spanning forest while they are found, so a group of copies gives as many links as
it has members, not as many as it has pairs.

The counts of part values have at most ``parts * 2**(64 / parts)`` entries whatever the input; only they and the 64 x 64
counts of bit pairs reach the driver.

Nulls: a null text has no words and fingerprint zero, which links like any other. Null ids never name a component
that has another id. Rows that repeat are documents of one component. An empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .batches import small_batches
from .graph import components

BITS = 64
SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Members of one block of a cell.
BLOCK = 512
#: Cells of up to this many rows are compared row against row in one sweep.
SMALL = 16
#: Visits of cells that one task compares.
TASK_ROWS = 1_000_000
#: What a probe costs in comparisons.
PROBE_COST = 2.0
#: Hashes whose bits are counted together.
SWEEP = 1 << 16


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle; a shorter text is one shingle, one without words has none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    rows = max(1, len(words) - shingle + 1)
    joined = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False)) if len(words) >= shingle else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(seed)), np.uint64, rows)


def bits_of(values: np.ndarray) -> np.ndarray:
    """Rows of 64 bits, lowest first."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if more than half of the hashes have it."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SWEEP):
        ones += bits_of(hashes[at : at + SWEEP]).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``key`` and ``fp`` (the 64 bits as a signed number) of every document; no shuffle."""
    small_batches(docs.sparkSession)
    schema = docs.select(F.col(key)).schema.add("fp", "long")

    def hash_texts(batches):
        for batch in batches:
            values = [fingerprint(shingle_hashes(t.as_py(), shingle, seed)) for t in batch.column(1)]
            fps = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=schema.names)

    return docs.select(key, text).mapInArrow(hash_texts, schema)


def bit_groups(fps: DataFrame, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of nearly equal size; correlated bits share a group."""

    def pair_counts(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(values), SWEEP):
                bits = bits_of(values[at : at + SWEEP]).astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"at": np.arange(BITS * BITS, dtype=np.int32), "n": total.ravel()})

    summed = fps.select("fp").mapInArrow(pair_counts, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS)
    for row in summed.collect():  # one row per pair of bits
        both[row.at] = row.n
    n = max(1, fps.count())
    joint = both.reshape(BITS, BITS) / n
    ones = joint.diagonal()
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    tied = np.abs((joint - np.outer(ones, ones)) / np.outer(spread, spread))
    np.fill_diagonal(tied, 0)
    free, groups = list(range(BITS)), []
    for i in range(parts):
        group = [max(free, key=lambda b: tied[b, free].sum())]
        free.remove(group[0])
        while len(group) < BITS // parts + (i < BITS % parts):
            group.append(max(free, key=lambda b: tied[b, group].mean()))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def part_values(values: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """Per fingerprint (unsigned) and part the part's bits as a number."""
    result = np.zeros((len(values), len(groups)), np.int64)
    for i, group in enumerate(groups):
        for j, bit in enumerate(group):
            result[:, i] |= ((values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << j
    return result


def part_counts(fps: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """Per part how many distinct fingerprints have each value."""

    def values_of(batches):
        for batch in batches:
            values = part_values(batch.column(0).to_numpy().view(np.uint64), groups)
            for i in range(len(groups)):
                at, n = np.unique(values[:, i], return_counts=True)
                yield pa.RecordBatch.from_pydict({"part": np.full(len(at), i, np.int32), "value": at, "n": n.astype(np.int64)})

    found = fps.select("fp").mapInArrow(values_of, "part int, value long, n long").groupBy("part", "value").agg(F.sum("n").alias("n"))
    frame = found.toArrow()
    counts = [np.zeros(1 << len(g), np.int64) for g in groups]
    part, value, n = (frame[c].to_numpy() for c in ("part", "value", "n"))
    for i, count in enumerate(counts):
        count[value[part == i]] = n[part == i]
    return counts


def near_counts(count: np.ndarray) -> np.ndarray:
    """For every value the fingerprints that differ from it in exactly one bit."""
    at = np.arange(len(count))
    return sum((count[at ^ (1 << b)] for b in range(len(count).bit_length() - 1)), np.zeros_like(count))


def thresholds(values: np.ndarray, exact: list[np.ndarray], near: list[np.ndarray], distance: int) -> np.ndarray:
    """Per fingerprint and part the threshold -1, 0 or 1; they sum to ``distance - parts + 1`` at the least cost."""
    n, parts = values.shape
    goal = distance - parts + 1
    if goal > parts:
        raise ValueError("too few parts for this distance")
    low, spots = -parts, 2 * parts + 1
    best = np.full((n, spots), np.inf)
    best[:, -low] = 0
    choice = np.zeros((parts, n, spots), np.int8)
    for i in range(parts):
        same, close = exact[i][values[:, i]], near[i][values[:, i]]
        width = len(exact[i]).bit_length() - 1
        cost = {-1: np.zeros(n), 0: same + PROBE_COST, 1: same + close + PROBE_COST * (1 + width)}
        after = np.full((n, spots), np.inf)
        for t, c in cost.items():
            shifted = np.full((n, spots), np.inf)
            if t < 0:
                shifted[:, :-1] = best[:, 1:]
            elif t == 0:
                shifted = best.copy()
            else:
                shifted[:, 1:] = best[:, :-1]
            shifted += c[:, None]
            better = shifted < after
            after[better] = shifted[better]
            choice[i][better] = t
        best = after
    result = np.zeros((n, parts), np.int8)
    at = np.full(n, goal - low)
    for i in reversed(range(parts)):
        result[:, i] = choice[i][np.arange(n), at]
        at = at - result[:, i]
    return result


def _copies(block: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers repeated once for every block of their cell, with the two blocks that meet there."""
    row = np.repeat(np.arange(len(block)), blocks)
    other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return row, np.minimum(block[row], other), np.maximum(block[row], other)


def probe_rows(
    fps: np.ndarray, groups: list[list[int]], exact: list[np.ndarray], near: list[np.ndarray], distance: int, block: int
) -> Iterator[pa.RecordBatch]:
    """Where each fingerprint goes: its own cell of every part, and the cells it probes. Cells with one visitor are left out."""
    values = part_values(fps, groups)
    limits = thresholds(values, exact, near, distance)
    signed = fps.view(np.int64)
    for i, group in enumerate(groups):
        own = values[:, i]
        rows, cells = [np.arange(len(fps))], [own]
        wide = np.flatnonzero(limits[:, i] == 1)
        for bit in range(len(group)):
            rows.append(wide)
            cells.append(own[wide] ^ (1 << bit))
        row, cell = np.concatenate(rows), np.concatenate(cells)
        # Every visitor of a cell lies within one bit of it.
        crowd = exact[i][cell] + near[i][cell]
        row, cell, crowd = row[crowd > 1], cell[crowd > 1], crowd[crowd > 1]
        blocks = -(-crowd // block)
        mine = (signed[row].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks
        at, first, second = _copies(mine, blocks)
        for k in range(0, len(at), 1 << 18):
            s = slice(k, k + (1 << 18))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": np.full(len(at[s]), i, np.int32),
                    "cell": cell[at[s]],
                    "first": first[s].astype(np.int32),
                    "second": second[s].astype(np.int32),
                    "fp": signed[row[at[s]]],
                }
            )


def links_within(key: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever lies within ``distance`` and has the same key; both arrays sorted by key."""
    left, right = [], []
    edges = np.flatnonzero(np.diff(key)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(key)]])
    sizes = ends - starts
    small = np.repeat(sizes <= SMALL, sizes)
    k, f = key[small], fps[small]
    for step in range(1, SMALL):
        if len(k) <= step:
            break
        a, b = f[:-step], f[step:]
        hit = (k[:-step] == k[step:]) & (np.bitwise_count(a ^ b) <= distance)
        left.append(a[hit])
        right.append(b[hit])
    for s, e in zip(starts[sizes > SMALL], ends[sizes > SMALL], strict=True):
        free = np.unique(fps[s:e])
        while len(free):
            queue, free = [free[:1]], free[1:]
            while queue and len(free):
                for node in queue.pop():
                    hit = np.bitwise_count(free ^ node) <= distance
                    found, free = free[hit], free[~hit]
                    if len(found):
                        left.append(np.full(len(found), node))
                        right.append(found)
                        queue.append(found)
                    if not len(free):
                        break
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(fps: DataFrame, distance: int = DISTANCE, parts: int | None = None, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that connect all those within ``distance`` of each other.

    Not every pair is listed: what several links of one task connect already gets no further link.
    """
    spark = fps.sparkSession
    total = fps.count()
    if parts is None:
        # Sixteen bits tell a few million fingerprints apart; more of them need longer parts.
        parts = max(distance + 1, 1) if total <= 1 << 22 else max(distance, 1)
    groups = bit_groups(fps, parts)
    exact = part_counts(fps, groups)
    model = spark.sparkContext.broadcast((groups, exact, [near_counts(c) for c in exact]))

    def probe(batches):
        g, same, close = model.value
        for batch in batches:
            yield from probe_rows(batch.column(0).to_numpy().view(np.uint64), g, same, close, distance, block)

    schema = "part int, cell long, first int, second int, fp long"
    rows = fps.select("fp").mapInArrow(probe, schema)

    def compare(batches):
        tables = [b for b in batches if len(b)]
        if not tables:
            return
        table = pa.Table.from_batches(tables)
        part, cell, first, second = (table[c].to_numpy() for c in ("part", "cell", "first", "second"))
        values = table["fp"].to_numpy().view(np.uint64)
        order = np.lexsort((values, second, first, cell, part))
        changed = np.zeros(len(order), bool)
        for column in (part, cell, first, second):
            c = column[order]
            changed[1:] |= c[1:] != c[:-1]
        a, b = links_within(np.cumsum(changed), values[order], distance)
        for k in range(0, len(a), 1 << 18):
            s = slice(k, k + (1 << 18))
            yield pa.RecordBatch.from_pydict({"a": a[s].view(np.int64), "b": b[s].view(np.int64)})

    # Where thresholds must exceed 0, a fingerprint probes the neighbours of about one part as well.
    visits = parts + (BITS // parts if parts <= distance else 0)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total * visits // TASK_ROWS)
    found = rows.repartition(tasks, "part", "cell", "first", "second").mapInArrow(compare, "a long, b long")
    return found.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest key that links reach."""
    prints = materialize(fingerprints(docs, key, text, shingle, seed), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min(key).alias("_first")), "distinct-fingerprints")
    roots = materialize(components(links(distinct.select("fp"), distance)), "roots")
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "_first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("_first").alias("component_id"))
    classes = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    # Exact copies may hold a third of the rows: this join has one row per fingerprint on its other side, so
    # Spark can split the copies of one fingerprint over many tasks.
    return prints.join(classes, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
