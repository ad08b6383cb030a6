import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from roomtide.llm import attention, lm, packing
from roomtide.llm.queries import PACKING_TOKENIZER, SUBWORDS

TEXTS = [
    (1, "Hello, World! it's a <|endoftext|> test"), (2, None), (3, ""), (4, "  \t "), (5, "<|ENDOFTEXT|> <|startoftext|>x"), (6, "H̱ ẖ Å İİ ΣΑΣ ﬁ ½ Ⅷ"),
    (7, "word " * 30_000), (8, "a b c\x1cd\x85e"), (9, "漢字 かな 😀👍🏽 ‍"), (9, "same id"), (10, "same text"), (11, "same text"), (None, "no id"),
    (12, "don't DON'T we're x'S ''' a.b,c!!"), (13, "été ÉTÉ naïve."), (14, "x" * 5000),
]


def tokens(text):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder = tokens.__dict__.setdefault("encoder", Tokenizer.from_file(PACKING_TOKENIZER))
    return np.array([*encoder.encode(text or "", add_special_tokens=False).ids, packing.END_ID], np.uint32)


def check_pieces(rows, texts, window=4096):
    """All pieces hold their documents' ids, once and in order, and sequences have no gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    expected = Counter()
    for key, text in texts:
        expected[(key, tokens(text).tobytes())] += 1
    found = Counter()
    for (key, total), pieces in by_doc.items():
        pieces.sort(key=lambda r: (r.start, r.sequence_id))
        ids = b"".join(bytes(p.ids) for p in pieces)
        assert len(ids) % (4 * total) == 0 and all(len(p.ids) == 4 * p.length for p in pieces)
        if len(ids) == 4 * total:
            found[(key, ids)] += 1
        else:  # repeated rows, none of them cut
            assert all(p.length == total for p in pieces)
            found.update((key, bytes(p.ids)) for p in pieces)
    assert found == expected
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
        assert sum(p.length for p in pieces) <= window
    return 1 - sum(r.length for r in rows) / (window * len(by_sequence))


def test_pieces(spark):
    docs = spark.createDataFrame([(*r, "clash") for r in TEXTS], "doc_id long, text string, ids string").repartition(5)
    pieces = packing.pack(docs, PACKING_TOKENIZER)
    check_pieces(pieces.collect(), TEXTS)
    whole = packing.sequences(pieces).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(len(tokens(t)) for _, t in TEXTS)
    assert packing.pack(docs.limit(0), PACKING_TOKENIZER).count() == 0


def test_whole_table_in_many_tasks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    padding = check_pieces(packing.pack(docs.repartition(40), PACKING_TOKENIZER).collect(), texts)
    assert padding < 0.03
    check_pieces(packing.pack(docs, PACKING_TOKENIZER, window=512, most_open=3).collect(), texts, 512)


def test_words_have_the_ids_of_the_tokenizer(spark, sf_dir):
    known = packing.word_ids(PACKING_TOKENIZER)
    for text in [t for _, t in TEXTS] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]:
        ids = known.ids(known.numbers([*packing.words_of(text), b" "]))
        assert ids.tolist() == tokens(text).tolist()


def test_subwords_of_words_are_those_of_the_text(spark, sf_dir):
    import base64

    import tiktoken

    with open(SUBWORDS.path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    known = lm.word_ids(SUBWORDS)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect():
        words = r.text.encode().lower().split()
        assert known.ids(known.numbers(words)).tolist() == encoder.encode_ordinary(" " + b" ".join(words).decode())


def small_model(symbols=128):
    rng = np.random.default_rng(0)
    pairs = attention.Pairs.of(rng.poisson(0.3, (symbols, symbols)).astype(np.float32))
    prior = attention.PairPrior.of(pairs, attention.class_order(pairs, 16), classes=16)
    p = attention.fresh(symbols, 16)
    for k in p:
        p[k] = p[k] + rng.normal(0, 0.1, p[k].shape).astype(np.float32)
    return p, prior


def test_probabilities_add_up_to_one():
    p, prior = small_model()
    here, before = np.full((1, attention.WINDOW), 5, np.uint16), np.full((1, attention.WINDOW), 9, np.uint16)
    here[0, ::3] = 77
    total = sum(np.exp(attention.forward(p, prior, here, before, np.full((1, attention.SCORED), s, np.uint16))) for s in range(128))
    assert total == pytest.approx(np.ones(attention.SCORED), rel=1e-4)


@pytest.mark.parametrize("listed", [1.0, 0.3, 0.0])
def test_probabilities_of_the_whole_vocabulary_add_up_to_one(listed):
    """Every id of the tokenizer has a probability of its own, whichever pairs are listed."""
    size, rng = SUBWORDS.size, np.random.default_rng(1)
    before, after = rng.zipf(1.3, 60_000) % size, rng.zipf(1.2, 60_000) * 7919 % size
    keys, n = np.unique(before * size + after, return_counts=True)
    total, follows = np.bincount(keys // size, n, size), np.bincount(keys % size, minlength=size).astype(float)
    kept = rng.random(len(keys)) < listed
    pairs = attention.Pairs(size, keys[kept], n[kept].astype(np.float32), total, follows)
    class_of = attention.class_order(pairs)
    assert class_of.shape == (size,) and set(class_of) == set(range(attention.CLASSES))
    prior, p = attention.PairPrior.of(pairs, class_of), attention.fresh(size)
    here = np.full((1, attention.WINDOW), int(before[0]), np.uint16)
    here[0, -5:] = [1, 0, int(before[1]), 49_000, SUBWORDS.end_id]
    logs = np.zeros((size, attention.SCORED), np.float32)
    for i in range(0, size, 512):
        ids = np.arange(i, min(i + 512, size), dtype=np.uint16)
        windows = np.repeat(here, len(ids), 0)
        logs[ids] = attention.forward(p, prior, windows, windows, np.repeat(ids[:, None], attention.SCORED, 1)).reshape(len(ids), -1)
    assert np.isfinite(logs).all()
    assert np.exp(logs.astype(float)).sum(0) == pytest.approx(np.ones(attention.SCORED), rel=1e-3)


def test_only_the_ids_at_hand_move_and_each_has_its_own_row():
    p, prior = small_model()
    windows = attention.windows_of(np.array([3, 4, 5, 3, 4] * 20, np.uint16), np.array([100]), 0)
    found = attention.train(p, prior, windows, 0.02, 0.5, 1, batch=2)
    for name in ("here", "before"):
        moved = np.flatnonzero((found[name] != p[name]).any(1)).tolist()
        assert moved and set(moved) <= {0, 3, 4, 5}
    assert len({r.tobytes() for r in found["here"][[3, 4, 5]]}) == 3


def test_rows_are_averaged_by_how_often_they_were_seen():
    a = {"at": np.array([1, 4]).tobytes(), "steps": np.array([[2.0, 4.0], [3.0, 3.0]]).tobytes(), "weights": np.array([2.0, 3.0]).tobytes()}
    b = {"at": np.array([4, 9]).tobytes(), "steps": np.array([[1.0, 5.0], [1.0, 0.0]]).tobytes(), "weights": np.array([1.0, 1.0]).tobytes()}
    at, steps, weights = lm._merged([a, b])
    assert at.tolist() == [1, 4, 9] and weights.tolist() == [2, 4, 1] and steps.tolist() == [[2, 4], [4, 8], [1, 0]]


def test_rare_pairs_are_left_to_the_totals(spark):
    rows = [(i * 300 + j, 1 + (i * j) % 40) for i in range(50) for j in range(30)]
    frame = spark.createDataFrame(rows, "pair long, n long")
    tiny = lm.Subwords("", "", 299)
    whole, cut = lm.id_pairs(frame, tiny), lm.id_pairs(frame, tiny, 200)
    assert len(whole.keys) == 1500 and 0 < len(cut.keys) <= 200 and cut.n.min() > whole.n.min()
    assert cut.total.tolist() == whole.total.tolist() and cut.follows.tolist() == whole.follows.tolist()
    assert whole.total[1] == sum(n for p, n in rows if p // 300 == 1) and whole.follows[29] == 50


def test_later_symbols_do_not_matter():
    p, prior = small_model()
    rng = np.random.default_rng(3)
    text = rng.integers(0, 128, 60).astype(np.uint16)

    def logs(symbols):
        here, before, targets, real, _ = attention.windows_of(symbols, np.array([len(symbols)]), 0)
        return attention.forward(p, prior, here, before, targets)[real.ravel()]

    changed = text.copy()
    changed[40:] = 3
    assert logs(text)[:40] == pytest.approx(logs(changed)[:40], abs=1e-5)
    assert len(logs(text)) == 60


def test_windows_score_each_symbol_once_and_keep_texts_apart():
    lengths = np.array([1, attention.SCORED, 100, 1, 0, 25])
    symbols = np.arange(1, lengths.sum() + 1).astype(np.uint16)
    here, before, targets, real, text = attention.windows_of(symbols, lengths, 0)
    assert sorted(targets[real].tolist()) == symbols.tolist()
    starts = np.cumsum(lengths) - lengths + 1
    for w in range(len(here)):
        seen = here[w][here[w] > 0]
        assert ((seen >= starts[text[w]]) & (seen < starts[text[w]] + lengths[text[w]])).all()
        for j in range(attention.SCORED):
            if real[w, j]:
                own = targets[w, j] == starts[text[w]]
                assert here[w, attention.CONTEXT + j] == (0 if own else targets[w, j] - 1)


def test_gradients_match_differences():
    p, prior = small_model()
    rng = np.random.default_rng(4)
    lengths = np.array([50, 31])
    here, before, targets, real, _ = attention.windows_of(rng.integers(0, 128, 81).astype(np.uint16), lengths, 0)
    p = {k: v.astype(np.float64) for k, v in p.items()}

    def loss():
        return -(attention.forward(p, prior, here, before, targets) * real.ravel()).sum() / real.sum()

    g = attention.gradients(p, prior, here, before, targets, real)
    for name, values in p.items():
        dense = g[name].dense(len(values)) if isinstance(g[name], attention.Rows) else g[name]
        flat, grad = values.reshape(-1), dense.reshape(-1)
        for i in np.argsort(-np.abs(grad))[:3]:
            old, eps = flat[i], 1e-3
            flat[i] = old + eps
            up = loss()
            flat[i] = old - eps
            down = loss()
            flat[i] = old
            assert grad[i] == pytest.approx((up - down) / (2 * eps), rel=0.03, abs=1e-5), name


def plain_logs(p, prior, here, before, targets):
    """The model written out place by place: every place asks, weights are divided, and parameters meet the places one by one."""
    x = p["here"][here]
    weights = (x @ p["query"]) @ (x @ p["key"]).transpose(0, 2, 1) / attention.WIDTH**0.5
    back = np.subtract.outer(np.arange(attention.WINDOW), np.arange(attention.WINDOW))
    weights = np.exp(weights + p["distance"][np.maximum(back, 0)]) * (back >= 0)
    attended = weights / weights.sum(-1, keepdims=True) @ (x @ p["value"])
    hidden = np.maximum(np.concatenate([x + p["before"][before], attended], 2) @ p["mix"] + p["bias"], 0)[:, attention.CONTEXT :]
    logits = hidden @ p["to_class"] + prior.by_class[here[:, attention.CONTEXT :]]
    logs = logits - np.log(np.exp(logits).sum(-1, keepdims=True))
    logs = np.take_along_axis(logs, prior.class_of[targets][..., None].astype(int), 2)[..., 0]
    return (logs + prior.in_class(here[:, attention.CONTEXT :], targets)).ravel()


def test_batches_that_share_their_arrays_give_the_plain_model():
    p, prior = small_model()
    rng, space = np.random.default_rng(5), attention.Space()
    for windows in (7, 40, 3, 1):
        here, before = rng.integers(0, 128, (2, windows, attention.WINDOW)).astype(np.uint16)
        targets, real = rng.integers(0, 128, (windows, attention.SCORED)).astype(np.uint16), rng.random((windows, attention.SCORED)) < 0.9
        plain = plain_logs({k: v.astype(float) for k, v in p.items()}, prior, here, before, targets)
        assert attention.forward(p, prior, here, before, targets, space=space) == pytest.approx(plain, abs=1e-4)
        within = prior.in_class(here[:, attention.CONTEXT :], targets)
        assert attention.forward(p, prior, here, before, targets, space=space, within=within) == pytest.approx(plain, abs=1e-4)
        alone, shared = (attention.gradients(p, prior, here, before, targets, real, s) for s in (None, space))
        for name, g in alone.items():
            a, b = ([x.at, x.values] if isinstance(x, attention.Rows) else [x] for x in (g, shared[name]))
            assert all((x == y).all() for x, y in zip(a, b, strict=True)), name


@pytest.mark.parametrize("listed", [0, 1, 5, 20_000])
def test_listed_pairs_are_found_among_others(listed):
    size, rng = 1000, np.random.default_rng(6)
    # Pairs in a row, and of one id, as well as scattered ones.
    keys = np.unique(np.concatenate([np.arange(listed // 2), np.arange(listed // 4) * size, rng.integers(0, size**2, listed)]))[:listed]
    total, follows = np.bincount(keys // size, minlength=size) * 2.0, np.bincount(keys % size, minlength=size).astype(float)
    pairs = attention.Pairs(size, keys, rng.integers(1, 4, len(keys)).astype(np.float32), total, follows)
    prior = attention.PairPrior.of(pairs, (np.arange(size) % attention.CLASSES).astype(np.uint8))
    asked = rng.permutation(np.concatenate([keys, rng.integers(0, size**2, 5000), [0, size**2 - 1]]))
    assert (prior.unlisted(asked) == ~np.isin(asked, keys)).all()
    p = dict(zip(keys.tolist(), prior.listed.tolist(), strict=True))
    before, target = np.divmod(asked, size)
    expected = np.log([p.get(k, 0) + prior.rest[b] * prior.share[t] for k, b, t in zip(asked.tolist(), before, target, strict=True)])
    expected -= prior.by_class[before, prior.class_of[target]]
    assert prior.in_class(before.astype(np.uint16), target.astype(np.uint16)) == pytest.approx(expected, abs=1e-5)


def test_scores_do_not_depend_on_how_many_pairs_are_listed(spark, monkeypatch):
    texts = [" ".join(f"{'abcdefgh'[i * k % 8]}{'pqrstuvwxyz'[(i + k * k) % 11]} w{(i * k) % 90}" for k in range(60)) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found, classes = [], []
    for most in (lm.MOST_PAIRS, 150, 0):
        monkeypatch.setattr(lm, "MOST_PAIRS", most)
        model, words = lm.fit(docs, F.col("doc_id") % 5 > 0, SUBWORDS)
        assert len(model.corpus.pairs.keys) <= most and (model.rare is None) == (most > 150)
        classes.append(model.corpus.class_of)
        found.append({r.doc_id: r for r in lm.score(docs, model, words).collect()})
    for other, class_of in zip(found[1:], classes[1:], strict=True):
        assert (class_of == classes[0]).all() and len(other) == 120
        for k, r in found[0].items():
            assert other[k].score == pytest.approx(r.score, rel=1e-3)
            assert (other[k].n_known, other[k].base_score) == (r.n_known, pytest.approx(r.base_score))


def test_all_pairs_make_the_classes(spark):
    size, rng = 900, np.random.default_rng(3)
    table = np.bincount(rng.zipf(1.3, 40_000) % size * size + rng.zipf(1.2, 40_000) * 7919 % size, minlength=size * size).reshape(size, size)
    pairs = attention.Pairs.of(table)
    frame = spark.createDataFrame([(int(k), int(n)) for k, n in zip(pairs.keys, pairs.n, strict=True)], "pair long, n long").repartition(3)
    listed = lm.id_pairs(frame, lm.Subwords("", "", size - 1), 200)
    rare = lm.rare_pairs(frame, listed)
    assert 0 < len(listed.keys) <= 200 and rare.count() == len(pairs.keys) - len(listed.keys)
    used = np.flatnonzero((table.sum(0) > 0) | (table.sum(1) > 0))
    scales = [1 / np.sqrt(np.maximum(table.sum(axis)[used], 1)) for axis in (1, 0)]
    scaled = table[np.ix_(used, used)] * scales[0][:, None] * scales[1]
    times, x = lm.pair_product(frame, size)(used, *scales), rng.standard_normal((len(used), 5))
    assert times(x, False) == pytest.approx(scaled @ x, abs=1e-6) and times(x, True) == pytest.approx(scaled.T @ x, abs=1e-6)
    class_of = attention.class_order(listed, product=lm.pair_product(frame, size))
    assert np.mean(class_of == attention.class_order(pairs)) > 0.9
    # With them, probabilities are those of the full list, but for the share in a class of what is looked up.
    whole = attention.PairPrior.of(pairs, class_of)
    part = attention.PairPrior.of(listed, class_of, rare=lm.rare_sums(rare, size, class_of))
    assert part.by_class == pytest.approx(whole.by_class, abs=1e-4) and part.rest == pytest.approx(whole.rest, abs=1e-5)


def words_of(text):
    return (text or "").encode().lower().split() + [b"\n"]


def test_scores_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    model, words = lm.fit(docs, ~held_out, SUBWORDS)
    rows = lm.score(docs.repartition(3), model, words).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = {k for k in texts if zlib.crc32(str(k).encode()) % 7 == 2}
    counts = Counter(w for k, t in texts.items() if k not in held for w in words_of(t))
    total, kinds = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        own = words_of(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in counts for w in own), total)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (total + kinds + 1)) for w in own))
        assert r.score < 0
    # Rare words meet their counts in the join; few or many frequent words give the same sums.
    model.corpus.frequent.clear()
    model.shared = spark.sparkContext.broadcast(model.corpus)
    again = {r.doc_id: r for r in lm.score(docs, model, words).collect()}
    assert all(again[r.doc_id].n_known == r.n_known and again[r.doc_id].base_score == pytest.approx(r.base_score) for r in rows)
    assert all(again[r.doc_id].score == pytest.approx(r.score, rel=1e-4) for r in rows)
    trained = np.mean([r.score / r.n_tokens for r in rows if r.doc_id in held])
    untrained = lm.Model(model.corpus, model.shared, attention.fresh(SUBWORDS.size))
    plain = np.mean([r.score / r.n_tokens for r in lm.score(docs, untrained, words).collect() if r.doc_id in held])
    assert trained > plain


def test_scoring_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b a"), (3, "a b a"), (None, "b"), (4, "😀 漢 \x00"), (5, "a " * 100_000)]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, n_tokens int")
    model, words = lm.fit(docs, F.col("doc_id") <= 3, SUBWORDS)
    got = lm.score(docs, model, words).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known) for r in got) == [(0, 2, 2), (1, 1, 1), (2, 1, 1), (3, 4, 4), (3, 4, 4), (4, 4, 1), (5, 100_001, 100_001)]
    assert {r.train_tokens for r in got} == {10} and all(np.isfinite(r.score) and r.score < 0 for r in got)
    empty, none = lm.fit(docs.limit(0), F.lit(True), SUBWORDS)
    assert lm.score(docs.limit(0), empty, none).count() == 0
    assert {r.n_known for r in lm.score(docs, empty, none).collect()} == {0}


def test_every_training_text_takes_gradient_steps(spark, monkeypatch):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of word"), F.col("id") % 7).alias("text"))
    seen = []
    monkeypatch.setattr(lm, "train", lambda rows, model, *_: seen.append(rows.count()) or model)
    lm.fit(docs, F.col("doc_id") % 3 > 0, SUBWORDS)
    assert seen == [6000]


def test_texts_of_one_key_are_dealt_apart(spark):
    docs = spark.range(400).select(F.expr("nullif(id % 2, 0)").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    corpus = lm.fit(docs, F.lit(True), SUBWORDS)[0].shared
    deals = lm._symbol_texts(docs, corpus, "doc_id", "text").select("deal")
    assert deals.distinct().count() == 400
    assert deals.select(F.pmod("deal", F.lit(lm.ROUNDS))).distinct().count() == lm.ROUNDS
