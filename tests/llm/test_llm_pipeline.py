import zlib
from collections import Counter

import numpy as np
import pytest
from test_llm_packing_lm import tokens
from test_llm_simhash_topk import brute_fingerprint, brute_roots

import corpus_pipeline
from checks.compare import connect, difference
from roomtide.llm import mixing, quality
from roomtide.llm.queries import ORACLES, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(name, spark, sf_dir):
    assert difference(QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(ORACLES[name]).df()) is None


def test_registered_queries():
    import __spark_entry__ as entry

    assert [sum(n.startswith(f"op{i}_") for n in QUERIES) for i in range(1, 11)] == [1] * 10
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


def stages(spark, docs, sf_dir, folder):
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], sf_dir).write.parquet(f"{folder}/{name}")
        tables.append(spark.read.parquet(f"{folder}/{name}"))
    return tables


def test_stages_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start, known, good, single, mixed, packed = stages(spark, docs, sf_dir, tmp_path)
    assert all(t.columns == COLUMNS for t in (known, good, single, mixed))
    rows = {r.doc_id: r for r in start.collect()}
    ids = lambda t: Counter(r.doc_id for r in t.select("doc_id").collect())
    assert all(any(map(str.isalpha, rows[k].text)) for k in ids(known)) and len(ids(known)) >= 0.99 * len(rows)
    verdicts = {r.doc_id: r.kept for r in quality.judge(known, quality.fit(known, spark.read.parquet(f"{sf_dir}/labels.parquet"))).collect()}
    assert ids(good) == Counter(k for k in ids(known) if verdicts[k])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = [k for k in ids(known) if labels.get(k) == 1 and not quality_base_fails(rows[k].text)]
    assert np.mean([k in ids(good) for k in clean]) > 0.99
    prints = {k: brute_fingerprint(rows[k].text) for k in ids(good)}
    roots = brute_roots(sorted(set(prints.values())), 3)
    first = {}
    for k in sorted(prints):
        first.setdefault(roots[prints[k]], k)
    assert ids(single) == Counter(first.values())
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.mix(single).collect()}
    assert ids(mixed) == Counter({k: n for k, n in taken.items() if n})
    covered = {}
    for r in packed.collect():
        ids_of = tokens(rows[r.doc_id].text)
        assert r.doc_tokens == len(ids_of) and zlib.crc32(ids_of[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        covered.setdefault(r.doc_id, np.zeros(len(ids_of), int))[r.start : r.start + r.length] += 1
    assert all((n == taken[k]).all() for k, n in covered.items()) and set(covered) == set(ids(mixed))


def quality_base_fails(text):
    counts = quality.statistics(text)[0]
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


def test_edges(spark, sf_dir, tmp_path):
    plain = " ".join(f"the weather and word{i} of that" for i in range(30))
    rows = [
        (1, plain, "en", "s", 1, "x", 2), (2, plain, "en", "s", 1, "x", 2), (2, plain, "en", "s", 1, "x", 2), (3, None, "en", "s", 1, "x", 2),
        (4, "", None, None, None, "x", 2), (5, "12 34", None, None, None, "x", 2), (None, plain[::-1], None, None, 1, "x", 2),
        (6, "das ist " + plain[40:], None, None, 1, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, size int")
    tables = stages(spark, docs, sf_dir, tmp_path / "a")
    assert all(t.columns == docs.columns for t in tables[:5])
    kept = {r.doc_id for r in tables[3].collect()}
    assert 2 not in kept and 3 not in kept and 4 not in kept and 5 not in kept and 1 in kept
    assert tables[3].filter("doc_id = 1").first()["size"] == 2
    empty = stages(spark, docs.limit(0), sf_dir, tmp_path / "b")
    assert [t.count() for t in empty] == [0] * 6


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_near_duplicates_without_unique_ids(spark, sf_dir):
    texts = [" ".join(f"{c}word{i * i % 97}x{i}" for i in range(120)) for c in "abcde"]
    a, b, c, d, e = texts
    # Five texts; two null ids of their own texts, a null copy of a text with an id, and id 7 twice with different texts.
    rows = [(None, a), (None, b), (None, a), (None, c), (9, c), (7, d), (7, e), (8, d), (7, d)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for tasks in (1, 5):
        kept = corpus_pipeline.remove_near_duplicates(spark, docs.repartition(tasks), sf_dir).collect()
        assert sorted((r.text, r.doc_id or 0) for r in kept) == [(a, 0), (b, 0), (c, 9), (d, 7), (e, 7)]
