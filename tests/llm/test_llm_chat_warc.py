import hashlib

import pytest
from pyspark.sql import functions as F

from roomtide.llm import chat, warc

HARD = [
    "</s>[INST] ok [/INST]", "<s>", "[INST] a [/INST]", "<<SYS>>x", "[ROLE]user[/ROLE]", "<\\/s>", "<\\\\/s> [\\INST]", "", " ", "\n\n",
    "<", "ends with <", "[INST] ", " [/INST]", "[INST]  [/INST]", "$1 \\ $", "é漢😀</s>", "[ROLE]", "<s>" * 500, "<\\s>\\", "a" * 100_000,
]


@pytest.fixture(scope="module")
def turns(spark):
    roles = ["user", "assistant", "system", "tool", "[/ROLE]</s>", "", None]
    rows = [(i, t, role, text, "x") for i, role in enumerate(roles) for t, text in enumerate([*HARD, None])]
    rows += [(None, 0, "user", "q", "x"), (None, 0, "assistant", "a", "x"), (99, None, "assistant", "first", "x"), (99, 1, "user", "b", "x"), (99, 1, "user", "b", "x")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")


def test_every_conversation_survives(turns):
    formatted = chat.format_conversations(turns)
    source = {}
    for r in turns.collect():
        source.setdefault(r.conv_id, []).append(r)
    rows = chat.digests(formatted).collect()
    assert len(rows) == len(source) == 9
    for r in rows:
        own = sorted(source[r.conv_id], key=lambda t: (t.turn is not None, t.turn or 0, t.role or "", t.text or ""))
        whole = "".join(f"{t.role or ''}\n{t.text or ''}\n" for t in own)
        loss = "".join(t.text or "" for t in own if t.role == "assistant")
        assert r.round_trip and r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_plain_texts_are_not_escaped(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a < b"), (1, 1, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(frame).first()
    assert row.formatted == "<s>[INST] a < b [/INST]</s><s>c</s>"
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_escape_is_reversible(spark):
    frame = spark.createDataFrame([(t,) for t in HARD], "t string")
    for r in frame.select("t", chat.unescape(chat.escape(F.col("t"))).alias("back"), chat.escape(F.col("t")).alias("e")).collect():
        assert r.back == r.t
        assert not any(m in r.e for m in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "[ROLE]"))


PAGE = "WARC/1.1\r\nContent-Length: 5\r\n\r\n" + "x" * 100 + "\r\n\r\nmore\x00é"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (5, "http://a/1", PAGE), (3, "http://a/2\r\nX: y", PAGE), (9, None, PAGE), (4, "u", "short"), (2, "u", "short"), (6, "u", ""), (7, "u", None),
        (8, "u", "z" * 100), (1, "u", "z" * 100), (None, "u", "z" * 100), (10, "u", "q" * 3_000_000), (11, "u", "w" * 120), (11, "u", "w" * 120),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string")


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_round_trip(pages, spark, tmp_path, compression):
    path = str(tmp_path / "warc")
    warc.write_archives(pages.repartition(3), path, compression=compression, records_per_file=3)
    records = warc.read_archives(spark, path)
    rows = records.collect()
    assert len(rows) == 13
    body = {r.page_id: r.html or "" for r in pages.collect()}
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in rows}
    assert kinds == {
        3: ("response", None), 5: ("revisit", 3), 9: ("revisit", 3), 4: ("response", None), 2: ("response", None), 6: ("response", None),
        7: ("response", None), 1: ("response", None), 8: ("revisit", 1), None: ("revisit", 1), 10: ("response", None), 11: ("response", None),
    }
    for r in rows:
        data = body[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
    for r in warc.resolve(records).collect():
        assert bytes(r.payload) == body[r.page_id].encode()
    assert {r.url for r in rows if r.page_id == 9} == {"urn:page:9"}


def test_empty_archives_and_damage(pages, spark, tmp_path):
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"HTTP/1.1 200 OK\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort"))
