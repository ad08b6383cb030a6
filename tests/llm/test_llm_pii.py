import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from roomtide.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def brute(text):
    """The base spans, by the patterns as they are stated."""
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), order, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def base(text):
    return [f"{kind}:{a}:{b}" for kind, a, b, disguised in pii.spans(text) if not disguised]


def test_base_spans_match_the_stated_patterns():
    draw = random.Random(7)
    pieces = ["a", "b.c", "@", "@x", ".", "-", " ", "+", "(", ")", "1", "23", "255", "256", "0007", "4111 1111 1111 1111", "é", "\n", "_%", "x@y.z", "1.2.3.4", "漢"]
    for _ in range(4000):
        text = "".join(draw.choices(pieces, k=draw.randint(0, 25)))
        assert base(text) == brute(text), text


# Text before, disguised identifier, text after; the kind that has to be found there.
DISGUISED = [
    ("email", "jane(at)mail(dot)com"),
    ("email", "jane [at] mail [dot] example [dot] org"),
    ("email", "jane at mail dot example dot com"),
    ("email", "JANE AT MAIL DOT COM"),
    ("email", "jane.doe at example.com"),
    ("email", "jane_at_mail_dot_com"),
    ("email", "jane @ example.com"),
    ("email", "jane{at}example.com"),
    ("email", "jаne@exаmple.cоm"),
    ("email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("email", "ja­ne@mail​.com"),
    ("ip", "10[.]20[.]30[.]40"),
    ("ip", "10 dot 20 dot 30 dot 40"),
    ("ip", "one nine two dot one six eight dot zero dot one"),
    ("ip", "１９２．１６８．０．１"),
    ("ip", "10。20。30。40"),
    ("card", "four one one one one one one one one one one one one one one one"),
    ("card", "Four-One, One-One 1111 1111 1111"),
    ("card", "quatre un un un un un un un un un un un un un un un"),
    ("card", "41ll 1111 1111 1ll1"),
    ("card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ("card", "4111 1111‑1111 1111"),
    ("card", "𝟒𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏"),
    ("phone", "plus four four two zero seven nine four six zero nine five eight"),
    ("phone", "+1 (nine eight eight) five five five 2485"),
    ("phone", "＋1 988 555 2485"),
    ("phone", "plus one double five five 988 555 24"),
]


@pytest.mark.parametrize(("kind", "written"), DISGUISED)
def test_disguises_are_found_at_their_place_in_the_source(kind, written):
    for before, after in (("", ""), ("Écrivez 😀 ", " ok."), ("vier\n", "\n"), ("а б ", " в")):
        text = before + written + after
        assert (kind, len(before), len(before) + len(written), True) in pii.spans(text), pii.spans(text)
        assert base(text) == brute(text)


CLEAN = [
    "Look at polka dot dresses at the shop. It is one of two.",
    "See you at example.com or @ home.", "Ten apples @ 2.50 each", "meet at 5.30 pm", "un deux trois, one dot two",
    "Das ist eins. Zwei Leute kamen an.", "at the end.The", "Привет, как дела? Почта и телефон", "plus one more", "10²³ and ½",
    "versions 1.2.3 and 2.0", "", " ", "@", "+", "(at)", "[.]", "a(at)", "O1l " * 3,
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_prose_stays_clean(text):
    assert pii.spans(text) == []


def test_base_spans_stay_and_a_longer_disguise_is_added():
    text = "jоhn@example.com"
    assert pii.spans(text) == [("email", 0, len(text), True), ("email", 2, len(text), False)]
    assert pii.redacted(f"to {text}, thanks", pii.spans(f"to {text}, thanks")) == "to [email], thanks"


@pytest.mark.parametrize("piece", ["1", "a", "a@", "1.", "+1", "+1 ( ", "1 ", " at ", "one ", "O1", "а", "​", "a.b@", "plus ", "dot ", "[.]", "а@б."])
def test_cost_is_linear_in_long_texts(piece):
    text = piece * (400_000 // len(piece))
    start = time.perf_counter()
    assert all(b <= len(text) for _, _, b, _ in pii.spans(text))
    assert time.perf_counter() - start < 20


def test_find_covers_edges(spark):
    rows = [(1, "a@b.cd and jane at mail dot com", "x"), (None, None, "x"), (3, "", "x"), (4, "+1 (988) 555-2485 " * 30_000, "x"), (1, "a@b.cd and jane at mail dot com", "x"), (None, "10[.]0[.]0[.]1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = sorted(pii.find(docs).collect(), key=lambda r: (r.doc_id or 0, r.spans))
    assert len(found) == len(rows)
    nothing = hashlib.sha256(b"").hexdigest()
    assert [(r.doc_id, r.n_ip, r.n_disguised, r.base_sha256, r.spans) for r in found[:2]] == [
        (None, 0, 0, nothing, ""),
        (None, 0, 1, nothing, "ip:0:14"),
    ]
    assert found[2] == found[3] and found[2].spans == "email:0:6,email:11:31" and found[2].n_email == 1
    assert found[5].n_phone == 30_000
    assert pii.find(docs.limit(0)).count() == 0
    assert [r.text for r in pii.redact(docs).filter("doc_id = 1 OR text IS NULL").collect()] == ["[email] and [email]", None, "[email] and [email]"]


def test_query_matches_the_stated_patterns(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_deobfuscated_pii"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        expected = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(e.startswith(k) for e in expected) for k in pii.KINDS]
        assert set(expected) <= set(filter(None, r.spans.split(",")))


def test_planted_disguises_are_found_in_a_table(spark):
    rows = [(i, f"text {i} vor {w} nach") for i, (_, w) in enumerate(DISGUISED)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", F.explode("found").alias("s"))
    got = {(r.doc_id, r.s.kind, r.s.start, r.s.end) for r in found.collect()}
    for i, (kind, w) in enumerate(DISGUISED):
        start = len(f"text {i} vor ")
        assert (i, kind, start, start + len(w)) in got
