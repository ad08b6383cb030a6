"""Exact top-k inner products by no-random-access aggregation over sorted lists.

In a chunk of candidates each dimension is a list sorted by component; a query reads it from the top where its own component is
positive and from the bottom where it is negative. Lists are read in slices; a slice adds what is new in it to what was read
before. After each slice a candidate has a lower bound (what was read, the list's far end elsewhere) and an upper bound (the last
value read elsewhere). A query stops in a chunk when no candidate outside the best k can still reach the k-th lower bound, or
none at all the best k known from other chunks; those that can still be among the best get their full score.

Candidates are searched in strata that grow by ``GROWTH``. The k best of the strata so far give every query a floor for the next,
so a stratum returns about ``k * GROWTH`` rows for a query, however large it is. Each vector is kept and searched once for
each block of queries; queries go to the tasks in blocks of about ``BLOCK_BYTES`` or ``QUERY_BLOCK`` at most. Within a task floors rise as it goes.

Scores are whole numbers of 64 bits. Bounds are doubles, widened by more than their rounding; final scores are computed in whole
numbers, in Python's where 64 bits may not do for the steps. A score or component beyond 64 bits raises.

Nulls: vectors that are null, or hold null or non-finite components, and rows without an id take no part, as query or candidate; a
candidate of another dimension than the query is none. Empty vectors score 0. Ties go to the smaller id. A query meets all
candidates but those with its own id; rows that repeat an id are candidates each, and queries each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SCALE = 1024
CHUNK = 2048
#: Bytes and number of the queries that are sent to the tasks at a time.
BLOCK_BYTES = 16 << 20
QUERY_BLOCK = 65_536
#: Queries of a block that are read together.
TOGETHER = 256
GROWTH = 16
#: Parts of a list after which bounds are looked at.
DEPTHS = (1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0)
STRATA = 1 << 30


def quantised(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """Whole-numbered vectors, without those that are null or hold null or non-finite components, or have no id."""
    values = F.col(vector).cast("array<double>")
    usable = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    floors = F.transform(values, lambda x: F.floor(x * scale).cast("long"))
    return vectors.filter(usable).select(F.col(key).alias("vec_id"), floors.alias("vector"))


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers."""
    if not vectors.size:
        return np.zeros(len(vectors), np.int64)
    largest = float(np.abs(vectors.astype(np.float64)).max()) * float(np.abs(query.astype(np.float64)).sum())
    if largest < 2.0**62:
        return (vectors @ query).astype(np.int64)
    scores = [sum(int(a) * int(b) for a, b in zip(v, query, strict=True)) for v in vectors]
    if any(abs(s) >= 2**63 for s in scores):
        raise OverflowError("a score needs more than 64 bits")
    return np.array(scores, np.int64)


class SortedLists:
    """The lists of one chunk: per dimension the places of the vectors in the order of their components."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.whole, self.vectors = ids, vectors, vectors.astype(np.float64)
        self.order = self.vectors.argsort(axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)
        #: List entries that all queries together have read.
        self.read = 0

    def best(
        self, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray | None = None
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query row its at most k best (ids, scores) among the vectors whose id is not the query's.

        ``floors`` are scores that a vector has to reach to be of use.
        """
        n, dims = self.vectors.shape
        floors = np.full(len(queries), -np.inf) if floors is None else floors
        up, down = np.maximum(queries, 0).astype(np.float64).T, np.minimum(queries, 0).astype(np.float64).T
        # More than the rounding of any sum of these products.
        reach = np.abs(self.vectors).max(axis=0, initial=0.0) if n else np.zeros(dims)
        slack = (reach @ (up - down)) * (dims + 4) * 2.0**-50 + 2.0**-1000
        got = np.zeros((n, len(queries)))
        unread_top, unread_bottom = np.ones((n, dims)), np.ones((n, dims))
        active, depth = np.arange(len(queries)), 0
        for part in DEPTHS:
            until = n if part == 1.0 else min(n, max(depth + 1, int(n * part)))
            for j in range(dims):
                for rows, weights, unread in (
                    (self.order[n - until : n - depth, j], up[j, active], unread_top),
                    (self.order[depth:until, j], down[j, active], unread_bottom),
                ):
                    unread[rows, j] = 0.0
                    used = np.flatnonzero(weights)
                    if len(used):
                        got[np.ix_(rows, active[used])] += self.vectors[rows, j][:, None] * weights[used]
                        self.read += len(rows) * len(used)
            depth = until
            u, d, read = up[:, active], down[:, active], got[:, active]
            # What has not been read lies between the last value read and the list's far end.
            near_u, near_d = self.sorted[n - depth][:, None] * u, self.sorted[depth - 1][:, None] * d
            far_u, far_d = self.sorted[0][:, None] * u, self.sorted[-1][:, None] * d
            upper = read + unread_top @ near_u + unread_bottom @ near_d + slack[active]
            lower = read + unread_top @ far_u + unread_bottom @ far_d - slack[active]
            mine = self.ids[:, None] == own[active][None, :]
            upper[mine] = lower[mine] = -np.inf
            left = []
            for c, q in enumerate(active):
                floor = max(floors[q], np.partition(lower[:, c], n - k)[n - k] if n > k else -np.inf)
                rivals = np.flatnonzero((upper[:, c] >= floor) & ~mine[:, c])
                # Reading on pays only while outsiders can qualify in number.
                if part == 1.0 or len(rivals) <= 4 * k:
                    scores = exact_scores(self.whole[rivals], queries[q])
                    top = np.lexsort((self.ids[rivals], -scores))[:k]
                    yield q, self.ids[rivals][top], scores[top]
                else:
                    left.append(q)
            active = np.array(left, int)
            if not active.size:
                return


def at_most(score: int) -> float:
    """A double at or below the score, so that no tie is lost."""
    return float(np.nextafter(float(score), -np.inf))


class Found:
    """The k best of every query that a task has seen so far."""

    def __init__(self, own: np.ndarray, vectors: np.ndarray, floors: np.ndarray, k: int):
        self.own, self.vectors, self.floors, self.k = own, vectors, floors.copy(), k
        self.best: list[list[tuple[int, int]]] = [[] for _ in own]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for start in range(0, len(ids), CHUNK):
            lists = SortedLists(ids[start : start + CHUNK], vectors[start : start + CHUNK])
            for first in range(0, len(self.own), TOGETHER):
                part = slice(first, first + TOGETHER)
                for q, found, scores in lists.best(self.vectors[part], self.own[part], self.k, self.floors[part]):
                    best = self.best[first + q]
                    best += [(-s, i) for s, i in zip(scores.tolist(), found.tolist(), strict=True) if s >= self.floors[first + q]]
                    best.sort()
                    del best[self.k :]
                    if len(best) == self.k:
                        self.floors[first + q] = max(self.floors[first + q], at_most(-best[-1][0]))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of one length as a matrix of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _search(candidates: DataFrame, block: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], floors: dict[int, float], k: int) -> DataFrame:
    """``query, vec_id, score``: at most k rows of each task for each query row, none below the query's floor."""
    shared = candidates.sparkSession.sparkContext.broadcast((block, floors))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, low = shared.value
        found = {
            size: Found(own, vectors, np.array([low.get(int(r), -np.inf) for r in rows]), k) for size, (rows, own, vectors) in queries.items()
        }
        for batch in batches:
            lengths = np.diff(batch.column("vector").offsets.to_numpy())
            for size in np.unique(lengths).tolist():
                if size in found:
                    own = batch.filter(pa.array(lengths == size))
                    found[size].add(own.column("vec_id").to_numpy(), _matrix(own.column("vector")))
        for size, state in found.items():
            rows = [(int(queries[size][0][q]), i, -s) for q, best in enumerate(state.best) for s, i in best]
            columns = zip(("query", "vec_id", "score"), zip(*rows, strict=True), strict=True) if rows else ()
            if rows:
                yield pa.RecordBatch.from_pydict({name: pa.array(values, pa.int64()) for name, values in columns})

    return candidates.select("vec_id", "vector").mapInArrow(search, "query long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query. Tasks hand over k rows at most, and a query's are cut in sixteen parts before they meet."""
    row = F.struct((-F.col("score")).alias("low"), "vec_id")
    cut = F.slice(F.array_sort(F.collect_list(row)), 1, k).alias("best")
    parts = found.groupBy("query", F.pmod(F.xxhash64("vec_id"), F.lit(16)).alias("part")).agg(cut)
    whole = parts.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return whole.select("query", F.posexplode("best").alias("at", "row")).select(
        "query", (F.col("at") + 1).alias("rank"), F.col("row.vec_id").alias("vec_id"), (-F.col("row.low")).alias("score")
    )


def strata(candidates: int, chunk: int = CHUNK) -> list[float]:
    """Upper ends of the strata as shares of all candidates; the first holds about a chunk."""
    ends = [1.0]
    while candidates * ends[0] > chunk * GROWTH:
        ends.insert(0, ends[0] / GROWTH)
    return ends


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, chunk: int = CHUNK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k best candidates; both sides from :func:`quantised`.

    Rows are told apart by a number given when they are written, so repeated ids spread like any others.
    """
    numbered = F.monotonically_increasing_id()
    asked = materialize(queries.select(numbered.alias("query"), F.col("vec_id").alias("query_id"), "vector"), "queries")
    spread = F.pmod(F.xxhash64("_row"), F.lit(STRATA))
    vectors = materialize(candidates.withColumn("_row", numbered).select("vec_id", "vector", spread.alias("_at")), "candidates")
    count, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(8 * F.size("vector") + 16), F.lit(0))).first()
    blocks, ends = max(1, -(-size // BLOCK_BYTES), -(-count // query_block)), strata(vectors.count(), chunk)
    answers = None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).toArrow().combine_chunks()
        lengths = np.array([len(v) for v in rows["vector"]], int)
        known = {}
        for dims in np.unique(lengths).tolist():
            part = rows.filter(pa.array(lengths == dims))
            flat = part["vector"].combine_chunks()
            known[dims] = (part["query"].to_numpy(), part["query_id"].to_numpy(), _matrix(flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat))
        floors: dict[int, float] = {}
        best, begin = None, 0.0
        for end in ends:
            stratum = vectors.filter((F.col("_at") >= int(begin * STRATA)) & (F.col("_at") < int(end * STRATA)))
            hits = _search(stratum, known, floors, k)
            hits = hits if best is None else hits.unionByName(best.drop("rank"))
            best, begin = materialize(_best(hits, k), "best"), end
            if end < 1.0:
                found = best.filter(F.col("rank") == k).select("query", "score").toArrow()
                floors = {q: at_most(s) for q, s in zip(found["query"].to_pylist(), found["score"].to_pylist(), strict=True)}
        answers = best if answers is None else answers.unionByName(best)
    return answers.join(asked.select("query", "query_id"), "query").select("query_id", "rank", "vec_id", "score")
