import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roomtide.llm import mixing, sharding, slices

DOCS = "doc_id long, text string, source string, size long, shard string, taken int"
ROWS = [
    (1, "a b c", "s1", 7, "x", 1),
    (2, None, "s1", 7, "x", 1),
    (3, "", None, 7, "x", 1),
    (4, "é " * 50_000, "s2", 7, "x", 1),
    (5, "a b c", "s2", 7, "x", 1),
    (5, "a b c", "s2", 7, "x", 1),
    (None, "one two", None, 7, "x", 1),
    (7, "  \t\n", "s3", 7, "x", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


def jump_one(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_matches_the_scalar_form_and_moves_rows_only_into_new_shards():
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    before, after = sharding.jump(keys, 8), sharding.jump(keys, 9)
    assert before.tolist() == [jump_one(int(k), 8) for k in keys]
    assert set(after[before != after]) == {8}
    assert abs((before != after).mean() - 1 / 9) < 0.03
    assert np.bincount(before).min() > 300
    with pytest.raises(ValueError):
        sharding.jump(keys, 0)


def test_slots(docs):
    rows = sharding.shard_slots(docs, 3).collect()
    assert len(rows) == len(ROWS)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2]["size"] == 1 and by_id[4]["size"] == 150_001
    assert by_id[1].text_crc32 == zlib.crc32(b"a b c") and by_id[None].law == "key"
    assert all(r.grown_shard in (r.shard, 3) for r in rows)
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1
    assert sharding.shard_slots(docs.limit(0), 3).count() == 0


def test_written_shards(docs, spark, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "s"), 3, files=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(ROWS) and back.columns.count("shard") == 1
    assert sharding.moved(docs, 3, 4).filter("shard_after <> 3").count() == 0


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()) * share, {}, set(names)
    while open_:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not full:
            return {**target, **{s: weight[s] * level for s in open_}}
        target.update({s: most * sizes[s] for s in full})
        open_ -= full
    return target


def test_targets_and_taken_words(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), " ".join("w" * int(rng.integers(1, 60))), str(rng.choice(["a", "b", "c", "é", "z"], p=[0.6, 0.1, 0.1, 0.1, 0.1]))) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame).collect()
    sizes = {}
    for r in got:
        assert r["size"] == len(r.text.split())
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    expected = brute_targets(sizes)
    for source in sizes:
        own = [r for r in got if r.source == source]
        assert own[0].source_size == sizes[source]
        assert own[0].target == pytest.approx(expected[source])
        assert abs(sum(r.taken for r in own) - expected[source]) <= max(r["size"] for r in own)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) and len(r.positions) * r["size"] == r.taken for r in got)
    assert all(0 <= p <= 1 for r in got for p in r.positions)
    again = {r.doc_id: (r.taken, r.positions) for r in mixing.mix(frame.repartition(7)).collect()}
    assert again == {r.doc_id: (r.taken, r.positions) for r in got}


def test_progress_inverts_the_integral(spark):
    for knots in mixing.SCHEDULES:
        frame = spark.range(101).select((F.col("id") / 100).alias("part"))
        for r in frame.select("part", mixing.progress(F.col("part"), knots).alias("u")).collect():
            xs = np.linspace(0, r.u, 2001)
            ys = np.interp(xs, [k for k, _ in knots], [w for _, w in knots])
            assert np.trapezoid(ys, xs) == pytest.approx(r.part * mixing.integral(knots), abs=1e-6)


def test_mix_edges(docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2]["size"] == 0 and by_id[2].taken == 0 and by_id[2].positions == []
    assert by_id[7]["size"] == 1  # a no-break space is a word
    assert by_id[4]["size"] == 50_000 and by_id[None].source is None
    order = mixing.training_order(docs)
    assert order.columns == docs.columns
    assert {(r["size"], r.taken) for r in order.collect()} == {(7, 1)}  # the input's own columns
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.training_order(docs.limit(0)).count() == 0
    none = docs.filter("doc_id IN (2, 3)")
    assert [r.taken for r in mixing.mix(none).collect()] == [0, 0]


@pytest.mark.parametrize("key", [None, 5])
def test_a_third_of_the_rows_under_one_id_is_spread(spark, key, monkeypatch):
    rows = [(key, "a b", "s", 0, "x", 0)] * 2000 + [(10 + i, "a b c", "st"[i % 2], 0, "x", 0) for i in range(4000)]
    docs = spark.createDataFrame(rows, DOCS)
    seen, real = [], slices.RowOrder.attach
    monkeypatch.setattr(slices.RowOrder, "attach", lambda self, df: seen.append(real(self, df)) or seen[-1])
    mixed = mixing.mix(docs)
    shards = sharding.shard_slots(docs, 1).collect()
    for frame in seen:
        if "_number" in frame.columns:
            assert frame.groupBy(slices.BUCKET).count().agg(F.max("count")).first()[0] < 600
    assert sorted(r.slot for r in shards) == list(range(6000))
    taken = {r.source: r.t for r in mixed.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    targets = {r.source: r.target for r in mixed.select("source", "target").distinct().collect()}
    assert all(abs(taken[s] - targets[s]) <= 3 for s in "st")
