"""Personal data in whole texts, also when it is disguised, at places in the text as it was written.

Plain patterns (``KINDS``) give the base spans. On top of that a text passes three transducers, each a function from a text to
a text that keeps, for every character it writes, the source characters it stands for:

1. ``homoglyphs``: look-alike letters, full-width and mathematical forms, digits of other scripts, odd spaces, dots and hyphens
   become ASCII; invisible characters go.
2. ``spelled_digits``: words for digits in four languages, ``double`` and ``triple``, ``plus``; letters O, I and l among digits.
3. ``at_and_dot``: ``(at)``, ``[dot]``, ``user at host dot com``, ``10[.]0[.]0[.]1`` and their like become ``@`` and ``.``.

The patterns then run over what comes out, and the ends of each match are looked up in the source. A match is added if it holds a
rewritten character and is not already a base span; base spans always stay. Added addresses must end in letters, and where
only the bare words ``at`` and ``dot`` make an address, its last label must be one of ``TOP_LEVEL``, so that prose stays clean.

Every step is linear in the text: patterns cannot backtrack over a run twice, and texts are never cut. Texts are judged one by
one where they lie; nothing is shuffled.

Nulls: a null text is empty and has no spans. Repeated rows give repeated results, an empty table an empty one. ``find`` returns
the key columns asked for beside its own, whatever else the table holds.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches

KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<kind:string,start:int,end:int,disguised:boolean>"

# Look-alikes of ASCII letters in Cyrillic and Greek that no normal form relates to them.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѐ": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S",
    "Т": "T", "Х": "X", "У": "Y", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "L", "օ": "o", "ѡ": "w",
}
# Punctuation and blanks that stand for an ASCII sign.
SIGNS = {
    ".": "·•․∙⋅。．｡",
    "-": "‐‑‒–—―−﹣－",
    "+": "⁺﹢＋",
    "@": "﹫＠",
    "_": "＿",
    " ": "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000",
}
#: Characters that print nothing: soft hyphen, zero-width characters and joiners, direction marks.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
# Words for digits.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8",
    "nine": "9", "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8",
    "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8",
    "nueve": "9",
}
TIMES = {"double": 2, "triple": 3}
#: Last labels that make an address of bare words.
TOP_LEVEL = frozenset(
    "com net org edu gov mil int info biz name io co ai app dev me tv cc us uk ca au nz ie de at ch fr be nl lu es pt it pl cz se no dk"
    " fi is ru ua tr gr hu ro br mx ar cl jp cn kr in za il eu example test local".split()
)

CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
NOT_DIGITS = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of an address: a sign whose host fits, back over the local part before it.

    The local part holds no ``@``, so each sign belongs to one match at most and every character is looked at once.
    """
    free = 0
    for m in HOST.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            free = m.end()
            yield start, free


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers after each other, counted from the start of each chain of numbers and dots."""
    for m in NUMBERS.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) < 256 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 10 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
            yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


@dataclass
class Traced:
    """A text and, for each of its characters, the source characters it stands for and whether it was rewritten.

    ``start`` and ``end`` are None while the text is its own source.
    """

    text: str
    start: np.ndarray | None = None
    end: np.ndarray | None = None
    changed: np.ndarray | None = None

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.start is None:
            n = np.arange(len(self.text) + 1, dtype=np.int32)
            self.start, self.end, self.changed = n[:-1], n[1:], np.zeros(len(self.text), bool)
        return self.start, self.end, self.changed

    def rewritten(self, edits: Sequence[tuple[int, int, str]]) -> Traced:
        """The text with each ``(start, end, replacement)`` carried out; edits are in order and do not overlap."""
        if not edits:
            return self
        start, end, changed = self.places()
        texts, starts, ends, marks, at = [], [], [], [], 0
        for a, b, new in edits:
            texts += [self.text[at:a], new]
            starts += [start[at:a], np.full(len(new), start[a], np.int32)]
            ends += [end[at:a], np.full(len(new), end[b - 1], np.int32)]
            marks += [changed[at:a], np.ones(len(new), bool)]
            at = b
        texts.append(self.text[at:])
        return Traced("".join(texts), *[np.concatenate([*parts, whole[at:]]) for parts, whole in ((starts, start), (ends, end), (marks, changed))])


@cache
def glyph_table() -> np.ndarray:
    """For each code point the one it is read as, and -1 for invisible ones.

    Compatibility forms, accents aside, and digits of all scripts follow from the Unicode database.
    """
    table = np.arange(0x110000, dtype=np.int32)
    for point in range(0x80, 0x20000):
        ch = chr(point)
        digit = unicodedata.decimal(ch, None)
        form = str(digit) if digit is not None else unicodedata.normalize("NFKC", ch)
        if len(form) == 1 and "!" <= form <= "~":
            table[point] = ord(form)
    for ch, plain in LOOK_ALIKES.items():
        table[ord(ch)] = ord(plain)
    for plain, signs in SIGNS.items():
        table[[ord(ch) for ch in signs]] = ord(plain)
    table[[ord(ch) for ch in INVISIBLE]] = -1
    return table


def homoglyphs(traced: Traced) -> Traced:
    if traced.text.isascii():
        return traced
    points = np.frombuffer(traced.text.encode("utf-32-le"), np.int32)
    read = glyph_table()[points]
    if (read == points).all():
        return traced
    # What is left or goes next to a dropped character counts as rewritten, as its neighbours join.
    start, end, changed = traced.places()
    gone = read < 0
    marked = changed | (read != points)
    marked[1:] |= gone[:-1]
    kept = ~gone
    return Traced(read[kept].astype("<i4").tobytes().decode("utf-32-le"), start[kept], end[kept], marked[kept])


_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
SPELLED = re.compile(
    rf"(?<![^\W_])(?:(?:(?P<times>{'|'.join(TIMES)})[\s-]+)?(?P<word>{_WORD})(?![^\W_])|plus\s+(?=(?:{_WORD}|[0-9]+)(?![^\W_])))"
)
#: What may stand between two spelled digits of one number; as in the base patterns, a line break ends it.
GAP = re.compile(r"[\x20\t,-]{1,3}")
#: Beside a lone digit word: signs that it is part of something longer.
BESIDE = re.compile(r"[0-9+(\[{.]|dot|punkt|point|punto")
#: A word of digits and letters that look like them.
MIXED = re.compile(r"(?<![^\W_])[0-9OoIl]++(?![^\W_])")
NEXT_TO_DIGIT = re.compile("[0-9][OoIl]|[OoIl][0-9]")
AMONG = re.compile("[OoIl]")


def small(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def spelled_digits(traced: Traced) -> Traced:
    """Digits for digit words, run together; blanks, commas and hyphens between two spelled digits go with the second."""
    text = small(traced.text)
    words = [(m.start(), m.end(), m["word"], m["times"]) for m in SPELLED.finditer(text)]
    joined = [False, *[GAP.fullmatch(text, a[1], b[0]) is not None or a[2] is None for a, b in zip(words, words[1:])], False]
    edits = []
    for i, (a, b, word, times) in enumerate(words):
        if word is None:
            edits.append((a, b, "+"))
        elif joined[i] or joined[i + 1] or BESIDE.search(text[max(0, a - 8) : a] + " " + text[b : b + 8]):
            first = words[i - 1][1] if joined[i] else a
            edits.append((first, b, DIGIT_WORDS[word] * TIMES.get(times, 1)))
    traced = traced.rewritten(edits)
    if not NEXT_TO_DIGIT.search(traced.text):
        return traced
    edits = []
    for m in MIXED.finditer(traced.text):
        letters = list(AMONG.finditer(m.group()))
        if 2 * len(letters) <= m.end() - m.start():
            edits += [(m.start() + x.start(), m.start() + x.end(), "0" if x.group() in "Oo" else "1") for x in letters]
    return traced.rewritten(edits)


_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
DOTS = re.compile(
    rf"(?i)(?<=[A-Za-z0-9])(?:\s?{_OPEN}\s?(?:dot|punkt|point|punto|\.)\s?{_CLOSE}\s?|\s{{1,3}}[_-]?dot[_-]?\s{{1,3}}|_dot_)(?=[A-Za-z0-9])"
)
DOT_WORD = re.compile(rf"(?i)dot|{_OPEN}\s?(?:punkt|point|punto|\.)")
AT = re.compile(
    rf"(?i)(?<=[A-Za-z0-9_])(?:(?P<sure>\s?{_OPEN}\s?(?:at|arroba|@)\s?{_CLOSE}\s?|_at_|\s[_-]at[_-]\s)"
    r"|\s{1,3}(?P<bare>at)\s{1,3}|\s{1,3}@\s{0,3}|@\s{1,3})(?=[A-Za-z0-9-])"
)
HOST_AFTER = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LAST_LABEL = re.compile(r"\.([A-Za-z]{2,24})\Z")
#: A dot inside a word: without one there is no host.
INNER_DOT = re.compile(r"\.(?<=[A-Za-z0-9-]\.)[A-Za-z]{2}")
BEFORE = re.compile(r"[A-Za-z0-9._%+-]+\Z")


def at_and_dot(traced: Traced) -> Traced:
    """Dots first; an ``at`` counts only before a host that ends in letters.

    Blanks beside a bare word or sign, which are common in prose, need more: a known last label, and for the word a
    disguised dot in the host or a local part that no word of prose looks like.
    """
    dots = [(m.start(), m.end(), ".") for m in DOTS.finditer(traced.text)] if DOT_WORD.search(traced.text) else []
    traced = traced.rewritten(dots)
    text, edits = traced.text, []
    if not INNER_DOT.search(text):
        return traced
    shrunk, places = 0, []
    for a, b, _ in dots:
        places.append(a - shrunk)
        shrunk += b - a - 1
    for m in AT.finditer(text):
        host = HOST_AFTER.match(text, m.end())
        top = LAST_LABEL.search(host.group()) if host else None
        if top is None:
            continue
        if m["sure"] is None:
            if top[1].lower() not in TOP_LEVEL:
                continue
            if m["bare"]:
                i = bisect_left(places, m.end())
                hidden = i < len(places) and places[i] < host.end()
                local = BEFORE.search(text, max(0, m.start() - 64), m.start())
                if not hidden and not (re.search("[A-Za-z]", local.group()) and re.search("[._%+0-9-]", local.group())):
                    continue
        edits.append((m.start(), m.end(), "@"))
    return traced.rewritten(edits)


TRANSDUCERS: tuple[Callable[[Traced], Traced], ...] = (homoglyphs, spelled_digits, at_and_dot)


def normalised(text: str) -> Traced:
    traced = Traced(text)
    for transducer in TRANSDUCERS:
        traced = transducer(traced)
    return traced


def spans(text: str) -> list[tuple[str, int, int, bool]]:
    """``(kind, start, end, disguised)`` in code points of the text as given, by start, then kind, then end."""
    base = {kind: list(find(text)) for kind, find in FINDERS.items()}
    found = [(kind, a, b, False) for kind in KINDS for a, b in base[kind]]
    traced = normalised(text)
    if traced.start is not None:
        for kind, find in FINDERS.items():
            known = set(base[kind])
            for a, b in find(traced.text):
                own = int(traced.start[a]), int(traced.end[b - 1])
                if traced.changed[a:b].any() and own not in known and not any(x <= own[0] and own[1] <= y for x, y in known):
                    if kind != "email" or re.search(r"\.[A-Za-z]{2,24}\Z", traced.text[a:b]):
                        found.append((kind, *own, True))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(found: Sequence[tuple[str, int, int, bool]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b, _ in found)


FOUND = ", ".join([*[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string", "n_disguised long", f"found array<{SPAN}>"])


def find(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The key columns and, per row, base counts, the digest of the base spans, all spans as text and as an array."""
    small_batches(docs.sparkSession)
    narrow = docs.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], F.col(f"`{text}`").alias("body"))
    schema = ", ".join([*[f"k{i} {narrow.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys))], FOUND])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("disguised", pa.bool_())]))
        for batch in batches:
            rows = [spans(t or "") for t in batch.column("body").to_pylist()]
            base = [[s for s in r if not s[3]] for r in rows]
            columns = {f"k{i}": batch.column(f"k{i}") for i in range(len(keys))}
            columns |= {f"n_{k}": pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS}
            columns["base_sha256"] = pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string())
            columns["spans"] = pa.array([listed(r) for r in rows], pa.string())
            columns["n_disguised"] = pa.array([len(r) - len(b) for r, b in zip(rows, base, strict=True)], pa.int64())
            names = ("kind", "start", "end", "disguised")
            columns["found"] = pa.array([[dict(zip(names, s, strict=True)) for s in r] for r in rows], kind)
            yield pa.RecordBatch.from_pydict(columns)

    return narrow.mapInArrow(judge, schema).withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


def redacted(text: str, found: Sequence[tuple[str, int, int, bool]]) -> str:
    """The text with every stretch of overlapping spans replaced by the kind of its first."""
    parts, at = [], 0
    for kind, a, b, _ in found:
        if a >= at:
            parts += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all spans of the text replaced; a null text stays null."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def replace(texts):
        return texts.map(lambda t: t if t is None else redacted(t, spans(t)))

    return docs.withColumn(text, replace(F.col(f"`{text}`")))
