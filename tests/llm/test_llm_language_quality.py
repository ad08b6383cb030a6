import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.llm import language, quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ENGLISH = "the other thing that they thought was nothing but the weather " * 20
GERMAN = "der andere schöne tag war nicht über die straße zu sehen und ging " * 20


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, ENGLISH[i:], "en") for i in range(20)] + [(i + 50, GERMAN[i:], "de") for i in range(20)]
    rows += [(90, None, "en"), (91, "", "de"), (92, "123 !?", "en"), (93, "the weather", None), (93, "the weather", None), (None, "die straße", None)]
    rows += [(94, "thing " * 600_000, None)]
    return spark.createDataFrame([(*r, "clash", 2.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")


def test_languages(texts):
    model = language.fit(texts, F.lit(True))
    rows = language.identify(texts, model).collect()
    assert len(rows) == texts.count()
    found = {r.doc_id: r for r in rows}
    assert all(found[i].lang_pred == "en" and found[i + 50].lang_pred == "de" for i in range(20))
    assert [found[i].lang_pred for i in (90, 91, 92)] == ["und"] * 3 and found[90].score == 0
    assert found[93].lang_pred == found[94].lang_pred == "en" and found[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in rows)
    # Every context gives a distribution over the 256 bytes.
    per_symbol = np.bincount(model.symbols, minlength=model.width)
    p = np.exp2(-model.table.reshape(-1, model.width, 2).astype(float)) * per_symbol[None, :, None]
    assert p.sum(1) == pytest.approx(np.ones((model.width**3, 2)), rel=1e-3)
    # The cost of a text is the sum of its bytes' costs, also beyond one stretch.
    text = ("the thing " * 300_000).encode()
    whole = model.code_lengths([text])[0]
    context, total = [model.symbols[32]] * 3, np.zeros(2)
    part = text[:2000]
    for b in part:
        s = model.symbols[b]
        a, bb, c = context
        total += model.table[((a * model.width + bb) * model.width + c) * model.width + s]
        context = [bb, c, s]
    assert model.code_lengths([part])[0] == pytest.approx(total, rel=1e-5)
    assert whole == pytest.approx(total * len(text) / len(part), rel=0.01)


def brute_bits(body, context, byte):
    """Bits of a byte after three, by counting in the training bytes."""
    p = np.full(256, 1 / 256)
    padded = language.START + body
    for order in range(4):
        own = context[3 - order :]
        n = np.zeros(256)
        for i in range(3, len(padded)):
            n[padded[i]] += padded[i - order : i] == own
        if n.sum():
            kinds, left = (n > 0).sum(), p[n == 0].sum()
            p = np.where(n > 0, n / (n.sum() + kinds), p * kinds / (n.sum() + kinds) / left)
    return -np.log2(p[byte])


def test_all_bytes_are_symbols_with_many_languages(spark):
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in range(0x430, 0x450)] + [chr(c) for c in range(0x3B1, 0x3C9)] + [chr(c) for c in range(0x4E00, 0x4E40)]
    words = [["".join(rng.choice(letters, 3)) for _ in range(15)] for _ in range(24)]
    speak = lambda k, n: " ".join(rng.choice(words[k], n))
    rows = [(k * 10 + i, speak(k, 60), f"l{k:02}") for k in range(24) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True))
    texts = [speak(k, 30) for k in range(24)]
    costs = model.code_lengths([t.encode() for t in texts])
    assert costs.argmin(1).tolist() == list(range(24))
    # More languages change nothing for those that were there.
    few = language.fit(docs, F.col("lang") < "l03").code_lengths([t.encode() for t in texts])
    assert costs[:, :3] == pytest.approx(few, rel=1e-6)


def test_code_lengths_against_brute_force(spark):
    text = "straße, да 漢字 " * 3 + "the weather"
    model = language.fit(spark.createDataFrame([(text, "x"), ("zzz", "y")], "text string, lang string"), F.lit(True))
    probe = "the да字\x01é straßen".encode()
    padded = language.START + probe
    expected = [sum(brute_bits(t.encode(), padded[i - 3 : i], padded[i]) for i in range(3, len(padded))) for t in (text, "zzz")]
    assert model.code_lengths([probe])[0] == pytest.approx(expected, rel=1e-5)


def test_a_model_in_many_parts_says_the_same(spark, texts):
    """Fifty languages of text with many letters, whose tables are sent in pieces of a few hundred runs."""
    rng = np.random.default_rng(8)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    words = [["".join(rng.choice(letters, 2)) for _ in range(30)] for _ in range(50)]
    rows = [(k * 10 + i, " ".join(rng.choice(words[k], 25)), f"l{k:02}", "x", 1.0) for k in range(50) for i in range(2)]
    docs = spark.createDataFrame(rows, texts.schema).unionByName(texts)
    whole, cut = language.fit(docs, F.lit(True)), language.fit(docs, F.lit(True), part_runs=1500)
    assert len(whole.parts) == 1 and len(cut.parts) > 7
    assert all(len(t.counts[0][0]) <= 1500 for t in (cut.trees(p) for p in cut.parts[:5]))
    assert sum(sum(len(k) for k, _ in cut.trees(p).counts) for p in cut.parts) == whole.runs.count() == cut.runs.count()
    key = ["doc_id", "lang", "lang_pred", "bits_per_byte", "score"]
    found = [sorted(map(tuple, language.identify(docs, m).select(*key).collect()), key=repr) for m in (whole, cut)]
    assert [r[:3] for r in found[0]] == [r[:3] for r in found[1]] and len(found[0]) == docs.count()
    assert [r[3:] for r in found[1]] == [pytest.approx(r[3:], rel=1e-4, abs=1e-4) for r in found[0]]
    probe = [r[1].encode() for r in rows[::30]]
    assert cut.code_lengths(probe) == pytest.approx(whole.code_lengths(probe), rel=1e-5)


def test_a_part_is_never_larger_than_it_may_be():
    sizes = {(j, x): 10 * (j + 1) for j in range(20) for x in range(0, 256, 3)}
    for most in (50, 400, 3000, 10**6):
        parts = language.cut(sizes, 20, most)
        held = [sum(sizes.get((j, x), 0) for j in range(20)[p] for x in np.flatnonzero(a)) for p, a in parts]
        assert sum(held) == sum(sizes.values()) and all(h <= max(most, 200) for h in held)
        assert all(sum(a[x] for p, a in parts if j in range(20)[p]) == 1 for j in (0, 7, 19) for x in (0, 1, 255))


def test_no_languages(texts, spark):
    none = language.fit(texts.filter("lang IS NULL"), F.lit(True))
    assert {r.lang_pred for r in language.identify(texts, none).collect()} == {"und"}
    assert language.identify(texts.limit(0), none).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(docs, F.col("doc_id") % 5 != 0)
    rows = language.identify(docs, model).filter("doc_id % 5 = 0").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95


def brute(text):
    words = WORDS.findall(text or "")
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return [len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)]


NASTY = [None, "", " \t", " ", "a b c d e f g h " * 3, "x\ny\nx\n \n \nx", "é<>&|" * 30, "w " * 30, "a b c d e f g h i a b c d e f g h", "word\r\n" * 9, "\x1c\x1f\x85"]


def test_statistics_match_brute_force(spark, sf_dir):
    texts = NASTY + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for text in texts:
        assert quality.statistics(text)[0] == brute(text)


def test_trees_respect_constraints():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + 0.2 * x[:, 6] + rng.normal(0, 0.1, 3000)) < 0.7).astype(float)
    trees = quality.boost(x, y)
    assert ((trees.probability(x) > 0.5) == y).mean() > 0.9
    base = rng.random((50, x.shape[1]))
    for j, sign in enumerate(quality.MONOTONE):
        if sign:
            grid = np.repeat(base, 40, axis=0)
            grid[:, j] = np.tile(np.linspace(0, 1, 40), 50)
            steps = np.diff(trees.probability(grid).reshape(50, 40), axis=1)
            assert (sign * steps >= -1e-12).all()


def test_flat_trees_walk_like_nodes():
    rng = np.random.default_rng(1)
    x = rng.random((400, len(quality.FEATURES)))
    trees = quality.boost(x, (x[:, 5] > 0.4).astype(float), trees=5)

    def walk(row, node):
        while trees.feature[node] >= 0:
            node = trees.left[node] if row[trees.feature[node]] <= trees.cut[node] else trees.right[node]
        return trees.value[node]

    expected = [trees.start + sum(walk(row, r) for r in trees.roots) for row in x]
    assert trees.probability(x) == pytest.approx(1 / (1 + np.exp(-np.array(expected))))


def test_verdicts(spark):
    good = [(i, "Plain words make up a text of some length here, and more words follow. " * 1 + f"So number {i} ends with other words " + " ".join(f"w{i}x{k}" for k in range(20)), 1) for i in range(40)]
    bad = [(100 + i, " ".join(f"w{i}y{k}###" for k in range(40)), 0) for i in range(40)]
    odd = [(200, None, 1), (201, "too short", 1), (202, "one two three four five six seven eight nine ten " * 5, 1), (None, good[0][1], 1), (0, good[0][1], 1)]
    docs = spark.createDataFrame([(a, b, 0.5, "x") for a, b, _ in good + bad + odd], "doc_id long, text string, probability double, kept string")
    labels = spark.createDataFrame([(a, c) for a, _, c in good + bad] + [(0, 1), (5, None), (6, 7)], "doc_id long, quality int")
    trees = quality.fit(docs, labels)
    rows = quality.judge(docs, trees).collect()
    assert len(rows) == docs.count()
    kept = {r.doc_id: r.kept for r in rows}
    assert all(kept[i] for i in range(40)) and not any(kept[100 + i] for i in range(40))
    assert not kept[200] and not kept[201] and not kept[202] and kept[None]
    assert [r.base_failed for r in rows if r.doc_id in (200, 201, 202)] == [True] * 3
    only = quality.fit(docs, labels.filter("quality = 1"))
    assert only is None and sum(r.kept for r in quality.judge(docs, only).collect()) == 82
    assert quality.judge(docs.limit(0), trees).count() == 0
    assert quality.fit(docs.limit(0), labels) is None and quality.fit(docs, labels.limit(0)) is None


def test_a_repeated_id_is_one_labelled_document(spark):
    docs = spark.range(500).select(F.greatest(F.lit(0), F.col("id") - 490).alias("doc_id"), F.concat(F.lit("text of "), F.col("id") % 13).alias("text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    x, y = quality.labelled_sample(docs.repartition(4), labels, "doc_id", "text", "quality", 5)
    assert len(x) == len(y) == 5
    again = quality.labelled_sample(docs.coalesce(1), labels, "doc_id", "text", "quality", 5)
    assert sorted(map(tuple, x)) == sorted(map(tuple, again[0]))
