import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.llm import queries, variants

LETTERS = [chr(c) for c in variants.ALPHABET]


def around(word):
    """All words one edit away, by trying them."""
    less = {word[:i] + word[i + 1 :] for i in range(len(word))}
    other = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in LETTERS}
    more = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in LETTERS}
    return (less | other | more) - {word}


def brute(counts):
    form = {}
    found = {}
    for word, n in counts.items():
        near = [w for w in around(word) if w in counts]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= 5 * n:
            form[word] = best
        found[word] = len(near)
    rows = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        f = form.get(word)
        rows.append((word, n, found[word], f, counts[f] if f else None, root))
    return sorted(rows)


def result(spark, counts, **how):
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = variants.group(frame, **how).select("word", "n", "n_near", "form", "form_n", "root").collect()
    return sorted(map(tuple, rows))


def crowded(seed, words, letters="abcé", length=(6, 9)):
    draw = random.Random(seed)
    return {"".join(draw.choices(letters, k=draw.randint(*length))): 5 * 5 ** draw.randint(0, 5) + draw.randint(0, 2) for _ in range(words)}


def test_crowded_words_match_brute_force(spark):
    counts = crowded(1, 1500)
    expected = brute(counts)
    assert result(spark, counts) == expected
    assert max(r[2] for r in expected) > 5 and sum(r[3] != r[5] for r in expected if r[3]) > 10


def test_many_passes_over_cut_filters_give_the_same(spark):
    counts = crowded(2, 600)
    sizes = {}
    for w in counts:
        sizes[len(w)] = sizes.get(len(w), 0) + 1
    parts = variants.passes(sizes, 512)
    assert len(parts) > 2 and all(sum(b - a for a, b in p.values()) * 32 <= 512 for p in parts)
    assert any(a > 0 for p in parts for a, _ in p.values())
    assert result(spark, counts, most_bytes=512) == brute(counts)


def test_false_positives_are_removed(spark, monkeypatch):
    monkeypatch.setattr(variants, "blocks_for", lambda length, words: 1)
    words = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}qqq" for i in range(600)]
    letters = variants.codes(words)
    lanes = np.zeros((1, 8), np.uint32)
    _, bits = variants.block_and_bits(variants.hashes(letters), 1)
    for i in range(8):
        lanes[0, i] = np.bitwise_or.reduce(np.uint32(1) << ((bits >> np.uint64(5 * i)).astype(np.uint32) & np.uint32(31)))
    hits = list(variants.edits(words[:3], {6: (lanes, 0, 1)}))
    assert len(hits) > 3 * 6 * 40
    joined = {(words[i], e) for i, e in hits if e in set(words)}
    assert joined == {(w, e) for w in words[:3] for e in around(w) & set(words) if e > w}


def test_hashes_of_edits_are_those_of_the_edited_words():
    words = ["aabbcc", "zéàéàz", "ÿÿÿÿÿa"]
    every = {s: (np.full((1, 8), 0xFFFFFFFF, np.uint32), 0, 1) for s in (5, 6)}
    for i, word in enumerate(words):
        found = [e for at, e in variants.edits(words, every) if at == i]
        expected = {e for e in around(word) if len(e) == 5 or (len(e) == 6 and e > word)}
        assert sorted(found) == sorted(expected)
    lanes = np.zeros((64, 8), np.uint32)
    target = variants.hashes(variants.codes(["aabcc"]))
    block, bits = variants.block_and_bits(target, 64)
    for i in range(8):
        lanes[int(block[0]), i] = np.uint32(1) << np.uint32(int(bits[0] >> np.uint64(5 * i)) & 31)
    assert [e for _, e in variants.edits(["aabbcc"], {5: (lanes, 0, 64)})] == ["aabcc"]


def test_very_long_words(spark):
    word = "ab" * 20_000
    counts = {word: 100, word[:-1]: 10, word[:500] + "z" + word[501:]: 5, "x" + word: 500}
    rows = {r[0]: r for r in result(spark, counts)}
    assert rows[word][2:] == (3, "x" + word, 500, "x" + word)
    assert rows[word[:-1]][3:] == (word, 100, "x" + word)


def test_words_of_texts(spark):
    draw = ["Straße", "straße", "ÉCOLES", "x1y2z3", "abcde", "don't wishing", "aaaaaa×÷", None, "", "word" * 50_000, "日本語 letters", "e\u0301tudes"]
    docs = spark.createDataFrame([(i, t, "w") for i, t in enumerate(draw)], "doc_id long, text string, word string")
    words = docs.select("doc_id", F.explode(variants.runs()).alias("run"))
    got = sorted(r.run for r in words.collect())
    assert got == sorted(["straße", "straße", "Écoles", "wishing", "aaaaaa×÷", "word" * 50_000, "letters"])


def test_counts_slips_and_edges(spark):
    rows = [(i, " ".join(["Neighbour neighbour", "common"] * 3)) for i in range(400)] + [(None, "neighbour " * 50), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = docs.select("doc_id", F.explode(variants.runs()).alias("run")).select(queries.with_slip(F.col("run")).alias("word"))
    counts = {}
    for doc_id, text in rows:
        for run in (text or "").lower().split():
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            w = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run
            counts[w] = counts.get(w, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    found = variants.group(variants.vocabulary(words)).collect()
    assert len(counts) > 2 and sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found) == brute(counts)
    empty = variants.group(variants.vocabulary(words.limit(0)))
    assert empty.count() == 0 and set(empty.columns) == {"word", "n", "n_near", "form", "form_n", "root"}


def test_chains_end_at_the_last_form(spark):
    counts = {"aaaaaa" + "b" * i: 5**i for i in range(1, 13)}
    rows = {r[0]: r for r in result(spark, counts)}
    assert {r[5] for r in rows.values()} == {"aaaaaa" + "b" * 12}
    assert rows["aaaaaab"][3] == "aaaaaabb"


@pytest.mark.parametrize("words", [{}, {"single": 5}])
def test_nothing_to_compare(spark, words):
    assert result(spark, words) == [(w, n, 0, None, None, w) for w, n in words.items()]
