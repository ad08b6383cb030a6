import hashlib

import pytest
from pyspark.sql import functions as F

from roomtide.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos int, grp string, sub string, key string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    parts = [None if v is None else str(v) for v in row[:5]]
    return sha("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def tree(nodes):
    """All levels of a list of hashes, and for each leaf its siblings as (left, right) texts."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    paths = []
    for at in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = at // 16 * 16
            path.append(("".join(level[run:at]), "".join(level[at + 1 : run + 16])))
            at //= 16
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault("0" if r[1] is None else "1" + r[1], []).append(((r[0] is not None, r[0] or 0), leaf(r)))
    names = sorted(groups, key=lambda g: g.encode())
    done = {g: tree([h for _, h in sorted(groups[g])]) for g in names}
    root, over = tree([done[g][0] for g in names])
    found = []
    for g, above in zip(names, over, strict=True):
        subroot, paths = done[g]
        for ((known, key), h), path in zip(sorted(groups[g]), paths, strict=True):
            found.append((key if known else None, h, subroot, root, tuple(path + above)))
    return sorted(found, key=repr)


def result(spark, rows, **how):
    manifest = merkle.build(spark.createDataFrame(rows, SCHEMA), **how)
    return sorted(((r.key, r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof))) for r in merkle.proofs(manifest).collect()), key=repr)


def row(i, source, text="t", lang="en"):
    return (i, source, lang, None if text is None else len(text), text, 1, "x", "y", "z")


EDGES = [
    *[row(i, "b", f"Text {i}") for i in range(17)],
    row(5, "b", "Text 5"), row(5, "b", "Text 5"), row(5, "b", "other"), row(None, "b"), row(None, None), row(1, None, None, None),
    row(3, "lone", ""), row(4, "é", "é漢😀" * 50_000), row(9, "", "a:b-"), row(-7, "b"),
]


def test_edges_match_brute_force(spark):
    assert result(spark, EDGES) == brute(EDGES)


@pytest.mark.parametrize("every", [1, 2, 3])
def test_hot_and_lone_groups_over_several_written_levels(spark, every):
    rows = [row(i, "hot" if i % 3 else f"s{i % 50}", str(i)) for i in range(1300)]
    assert result(spark, rows, every=every) == brute(rows)


def test_many_groups_need_a_tall_tree_of_subroots(spark):
    rows = [row(i, f"s{i}") for i in range(300)]
    assert result(spark, rows) == brute(rows)


def test_one_row_and_none(spark):
    rows = [row(1, "a")]
    found = result(spark, rows)
    assert found == [(1, leaf(rows[0]), leaf(rows[0]), leaf(rows[0]), ())]
    empty = merkle.build(spark.createDataFrame([], SCHEMA))
    assert empty.root is None and merkle.proofs(empty).count() == 0


def test_only_every_second_level_is_written_and_a_manifest_can_be_read_again(spark, tmp_path):
    rows = [row(i, "a", str(i)) for i in range(600)]
    merkle.build(spark.createDataFrame(rows, SCHEMA), path=str(tmp_path / "m"))
    manifest = merkle.load(spark, str(tmp_path / "m"))
    assert [t.selectExpr("sum(size(nodes))").first()[0] for t in manifest.levels] == [600, 3]
    assert manifest.levels[0].agg(F.max(F.size("nodes"))).first()[0] == 256
    assert merkle.proofs(manifest).filter(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


def test_a_changed_row_does_not_verify(spark):
    docs = spark.createDataFrame([row(i, "a", f"Doc {i}") for i in range(40)], SCHEMA)
    other = {f: F.col(f) for f in merkle.FIELDS} | {"text": F.when(F.col("doc_id") % 2 == 0, F.lower("text")).otherwise(F.col("text"))}
    found = merkle.proofs(merkle.build(docs, carry={"claimed": merkle.leaf_hash(other)}))
    good = found.filter(merkle.fold(F.col("claimed"), F.col("proof")) == F.col("root"))
    assert sorted(r.key for r in good.collect()) == list(range(1, 40, 2))


def test_no_window_or_group_holds_a_hot_source(spark):
    """A third of the rows under one source still lies in many subtrees and buckets."""
    docs = spark.createDataFrame([row(i, "hot") for i in range(3000)], SCHEMA)
    level = merkle.build(docs).levels[0]
    assert level.count() == 12 and level.filter("size(nodes) > 256").count() == 0
