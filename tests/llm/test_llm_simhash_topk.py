import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from roomtide.llm import graph, simhash, topk


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, distance):
    roots = {f: f for f in fps}
    values = np.array(fps, np.uint64)

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance):
            a, b = find(f), find(fps[i + 1 + j])
            roots[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def clustered(rng, centres, members, flips):
    fps = set()
    for _ in range(centres):
        centre = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(members):
            fps.add(centre ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, flips + 1)).tolist())))
    return sorted(fps)


@pytest.mark.parametrize(("parts", "block", "distance"), [(4, 512, 3), (3, 512, 3), (4, 8, 3), (3, 8, 2), (5, 64, 3)])
def test_links_connect_what_lies_within_the_distance(spark, parts, block, distance):
    rng = np.random.default_rng(parts * block)
    fps = clustered(rng, 30, 25, 5) + clustered(rng, 1, 300, 4) + [int(x) for x in rng.integers(0, 2**64, 500, dtype=np.uint64)]
    fps = sorted(set(fps))
    frame = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    links = simhash.links(frame, distance, parts, block)
    for r in links.collect():
        assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= distance
    roots = {r.node % 2**64: r.root % 2**64 for r in graph.components(links).collect()}
    expected = brute_roots(fps, distance)
    groups, found = {}, {}
    for f in fps:
        groups.setdefault(expected[f], set()).add(f)
        found.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_thresholds_add_up_and_skip_crowded_parts():
    exact = [np.zeros(1 << 16, np.int64) for _ in range(4)]
    exact[0][:] = 5000
    near = [simhash.near_counts(c) for c in exact]
    found = simhash.thresholds(np.zeros((7, 4), np.int64), exact, near, 3)
    assert (found.sum(1) == 0).all() and (found[:, 0] == -1).all()
    assert near[0][3] == 16 * 5000


def test_documents(spark):
    rows = [(3, "A b c d"), (1, "a B c d"), (7, None), (8, ""), (9, " \t"), (4, "one two"), (5, "ONE two"), (6, "x"), (6, "x"), (None, "x"), (2, "w " * 200_000), (11, "é é é é")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert int(r.fingerprint, 16) == brute_fingerprint(dict(rows)[r.doc_id]) and len(r.fingerprint) == 16
    component = {r.doc_id: r.component_id for r in got}
    assert component[3] == component[1] == 1 and component[8] == component[9] == component[7] == 7
    assert component[5] == 4 and component[None] == component[6] == 6 and component[2] == 2
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {k: brute_fingerprint(t) for k, t in texts.items()}
    roots = brute_roots(sorted(set(prints.values())), 3)
    least = {}
    for k, f in sorted(prints.items()):
        least.setdefault(roots[f], k)
    for r in simhash.near_duplicates(docs).collect():
        assert (int(r.fingerprint, 16), r.component_id) == (prints[r.doc_id], least[roots[prints[r.doc_id]]])


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5), (2001, 2000)]
    frame = spark.createDataFrame(edges, "a long, b long")
    roots = {r.node: r.root for r in graph.components(frame).collect()}
    assert all(roots[i] == 0 for i in range(301)) and all(roots[i] == 1000 for i in range(1000, 1400)) and roots[2001] == 2000
    assert graph.components(frame.limit(0)).count() == 0


def brute_top(rows, queries, k):
    whole = {}
    for i, (key, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = (key, [int(np.floor(1024 * float(x))) for x in v])
    found = []
    for key, v in whole.values():
        if key in queries:
            scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), o) for o, w in whole.values() if o != key and len(w) == len(v)]
            found += [(key, n + 1, o, -s) for n, (s, o) in enumerate(sorted(scored)[:k])]
    return sorted(found)


@pytest.mark.parametrize(("chunk", "block"), [(10_000, 256), (37, 5)])
def test_top_k(spark, chunk, block):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.round(rng.normal(size=(260, 8)), 2))]
    rows += [(300 + i, rows[7][1]) for i in range(30)]  # one common vector
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (404, [1.0] * 3), (405, [2.0] * 3), (406, []), (407, [])]
    frame = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<float>, score int")
    as_floats = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    asked = {0, 7, 20, 100, 305, 400, 402, 404, 406}
    vectors = topk.quantised(frame)
    got = topk.top_k(vectors.filter(F.col("vec_id").isin(list(asked))), vectors, 10, chunk, block)
    assert sorted(map(tuple, got.collect())) == brute_top(as_floats, asked, 10)
    assert topk.top_k(vectors.limit(0), vectors).count() == 0 and topk.top_k(vectors, vectors.limit(0)).count() == 0


def test_lists_stop_early_with_right_results():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-50, 50, (4000, 3))
    vectors[::400] *= 30
    lists = topk.SortedLists(np.arange(4000), vectors)
    queries = vectors[::800].astype(float)
    for q, ids, scores in lists.best(queries, np.arange(0, 4000, 800), 5):
        full = pd.Series(vectors @ queries[q]).drop(q * 800)
        assert sorted(zip(-scores, ids, strict=True)) == sorted(zip(-full, full.index, strict=True))[:5]


@pytest.mark.parametrize("chunk", [8, 2048])
def test_scores_beyond_53_bits_are_exact(spark, chunk):
    """Components of 10^8 and more: doubles could not tell these scores apart."""
    rows = [(0, [10**8, 3, 10**8]), *[(i, [10**8 + i % 3, 10**7 + i, 10**8 - i % 2]) for i in range(1, 60)], (90, [2**33, 2**33, 1])]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = topk.top_k(frame.filter("vec_id IN (0, 5, 90)"), frame, 12, chunk)
    expected = []
    for q, v in rows:
        if q in (0, 5, 90):
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)[:12]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    with pytest.raises(Exception, match="64 bits"):
        wide = spark.createDataFrame([(1, [2**40] * 3), (2, [2**40] * 3)], "vec_id long, vector array<long>")
        topk.top_k(wide, wide).collect()


def test_ids_that_are_null_repeated_or_large(spark):
    big = 2**53 + 1
    rows = [(None, [1.0, 0.0]), (big, [2.0, 0.0]), (big + 1, [2.0, 0.0]), (-(2**62), [0.5, 1.0]), (7, [1.0, 1.0])] + [(3, [1.5, 0.0])] * 40
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.quantised(frame)
    assert vectors.count() == len(rows) - 1
    got = topk.top_k(vectors.filter("vec_id IN (7, 9007199254740993)"), vectors, 4, 16, 1)
    assert sorted(map(tuple, got.collect())) == [
        (7, 1, big, 2 * 1024**2), (7, 2, big + 1, 2 * 1024**2), (7, 3, -(2**62), 1536 * 1024), (7, 4, 3, 1536 * 1024),
        (big, 1, big + 1, 4 * 1024**2), (big, 2, 3, 3 * 1024**2), (big, 3, 3, 3 * 1024**2), (big, 4, 3, 3 * 1024**2),
    ]


def test_a_hot_id_spreads_over_the_strata(spark):
    frame = spark.range(3000).select(F.lit(5).cast("long").alias("vec_id"), F.array(F.col("id"), F.lit(1).cast("long")).alias("vector"))
    ends = topk.strata(3000, 64)
    assert len(ends) == 2 and ends[0] * 3000 < 64 * topk.GROWTH
    asked = spark.createDataFrame([(1, [1, 0])], "vec_id long, vector array<long>")
    got = topk.top_k(asked, frame, 3, 64).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 5, 2999), (2, 5, 2998), (3, 5, 2997)]


def test_floors_and_slices_save_reading():
    rng = np.random.default_rng(6)
    vectors = rng.integers(-20, 20, (4096, 6))
    vectors[::100] *= 40
    queries = vectors[::400].astype(np.int64)
    lists = topk.SortedLists(np.arange(4096), vectors)
    found = {q: scores for q, _, scores in lists.best(queries, np.arange(0, 4096, 400), 5)}
    whole = 4096 * 6 * len(queries)
    assert lists.read < 0.5 * whole
    # A floor that only the best reach stops the reading sooner, and what it keeps is right.
    again = topk.SortedLists(np.arange(4096), vectors)
    floors = np.array([topk.at_most(int(found[q][0])) for q in range(len(queries))])
    kept = {q: [s for s in scores if s > floors[q]] for q, _, scores in again.best(queries, np.arange(0, 4096, 400), 5, floors)}
    assert again.read <= lists.read and all(kept[q][0] == found[q][0] for q in kept)


def test_rows_out_of_the_search_do_not_grow_with_the_candidates(spark):
    def rows(n):
        rng = np.random.default_rng(7)
        vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.integers(-99, 99, (n, 4)))], "vec_id long, vector array<long>")
        seen, real = [], topk._search
        topk._search = lambda *a: seen.append(real(*a)) or seen[-1]
        try:
            topk.top_k(vectors.filter("vec_id < 4"), vectors, 5, 64)
        finally:
            topk._search = real
        return max(s.count() for s in seen)

    assert rows(8000) < 2 * rows(2000) + 4 * 5 * topk.GROWTH
