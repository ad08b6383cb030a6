"""Bounded-space online packing of tokenised documents into windows of a fixed length.

Every task keeps at most ``OPEN`` windows open. A document goes into the window that it fills best; where none has room, the
fullest window is emitted and a new one opened. A document longer than a window is cut into whole windows and a
rest, and a gap of at least ``LEAST_CUT`` ids in a window about to be emitted takes the head of the document that did
not fit. What is open at the end of a task is a leftover; leftovers of ``FAN_IN`` tasks meet in one, in rounds, until
one task's are left. A round's tasks read a bounded number of windows however many tasks there were.

Documents stay where they are read: only leftovers are shuffled. Every round is written to the shared folder.

Nulls: a null text is empty; an empty document is its end id alone. Repeated rows are packed separately, null
ids are kept. A text may be of any length that Spark holds; its ids are cut in one task. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import os
import string
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .batches import small_batches
from .wordpieces import WordIds, batches_of, in_a_row

WINDOW = 4096
OPEN = 16
LEAST_CUT = 64
FAN_IN = 8
END_ID = 2
#: Text bytes that are tokenised together.
BATCH_BYTES = 1 << 21
#: Marks that the tokenizer parts from letters before them; the apostrophe may join.
MARKS = string.punctuation.replace("'", "").encode()
#: Byte-level tokenizers spell a byte that does not print as a letter from 256 on, in order.
_PRINTING = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTING)}
#: Bits of a sequence number below the task number, and below the round number.
TASK_SHIFT, ROUND_SHIFT = 32, 56


@lru_cache(maxsize=2)
def word_ids(tokenizer: str) -> WordIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer)
    merges = encoder.model
    marks: dict[bytes, list[int]] = {b"": []}

    def merged(word: bytes) -> list[int] | None:
        """Ids by the merges alone, for small letters with any marks behind, which the tokenizer's own
        normalisation would pass on as they are and its splitting would part; None for anything else."""
        letters = word.rstrip(MARKS)
        mark = word[len(letters) :]
        if mark not in marks:
            if b"<|" in mark or len(marks) > 10_000:
                return None
            marks[mark] = encoder.encode(mark.decode(), add_special_tokens=False).ids
        if letters.isascii():
            if not (letters.isalpha() and letters.islower()):
                return None
            spelled = letters.decode()
        else:
            text = letters.decode()
            if not text.isalpha() or text != text.lower() or not unicodedata.is_normalized("NFC", text):
                return None
            spelled = letters.decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in merges.tokenize(spelled)] + marks[mark]

    def encode(words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        found = [merged(w) for w in words]
        others = [i for i, ids in enumerate(found) if ids is None]
        for i, whole in zip(others, encoder.encode_batch_fast([words[i].decode() for i in others], add_special_tokens=False), strict=True):
            found[i] = whole.ids
        return in_a_row(words, found)

    # White space is never a word, so the end of a document can go by it.
    return WordIds(encode, {b" ": [END_ID]})


def words_of(text: str | None) -> list[bytes]:
    """The text's words. The tokenizer lower-cases anyway; doing so here makes fewer words differ.

    Left alone are control strings, which count only as written, and texts with combining marks, which
    may join small letters otherwise than capitals.
    """
    data = (text or "").encode()
    return (data if b"<|" in data or b"\xcc" in data else data.lower()).split()


class Windows:
    """Open windows of one task; closed ones and pieces go to ``rows``."""

    def __init__(self, first: int, window: int, most: int, least_cut: int):
        self.next, self.window, self.most, self.least_cut = first, window, most, least_cut
        self.open: list[tuple[int, list]] = []  # free space, pieces
        self.rows: list[tuple] = []

    def emit(self, pieces: list, leftover: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), ids.tobytes(), total, self.next, offset, leftover))
            offset += len(ids)
        self.next += 1

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        """Place one document or piece of one."""
        while len(ids) >= self.window:
            self.emit([(doc, start, ids[: self.window], total)])
            start, ids = start + self.window, ids[self.window :]
        if not len(ids):
            return
        best = min((i for i, (free, _) in enumerate(self.open) if free >= len(ids)), key=lambda i: self.open[i][0], default=None)
        if best is None and len(self.open) >= self.most:
            free, pieces = self.open.pop(min(range(len(self.open)), key=lambda i: self.open[i][0]))
            if free >= self.least_cut:
                pieces.append((doc, start, ids[:free], total))
                start, ids = start + free, ids[free:]
            self.emit(pieces)
            self.add(doc, start, ids, total)
            return
        if best is None:
            self.open.append((self.window, []))
            best = len(self.open) - 1
        free, pieces = self.open[best]
        pieces.append((doc, start, ids, total))
        self.open[best] = (free - len(ids), pieces)
        if free == len(ids):
            self.emit(self.open.pop(best)[1])

    def close(self, leftover: bool) -> None:
        for _, pieces in self.open:
            self.emit(pieces, leftover)
        self.open = []

    def taken(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [()] * len(schema)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _schema(key: T.StructField) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField(key.name, key.dataType)])
    for name, kind in (("start", "long"), ("length", "long"), ("ids", "binary"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"), ("leftover", "boolean")):
        schema = schema.add(name, kind)
    return schema, to_arrow_schema(schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    most_open: int = OPEN,
    least_cut: int = LEAST_CUT,
) -> DataFrame:
    """One row per piece: key, ``start``, ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``."""
    small_batches(docs.sparkSession)
    narrow = docs.select(key, text)
    schema, arrow = _schema(narrow.schema[0])

    def first_pass(batches):
        windows = Windows(TaskContext.get().partitionId() << TASK_SHIFT, window, most_open, least_cut)
        known = word_ids(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for run in batches_of([len(t.as_buffer()) if t.is_valid else 0 for t in texts], BATCH_BYTES):
                words, counts = [], []
                for i in run:
                    own = words_of(texts[i].as_py())
                    words += own
                    words.append(b" ")
                    counts.append(len(own) + 1)
                if known.full():
                    known.reset()
                numbers = known.numbers(words)
                ids = known.ids(numbers)
                ends = np.cumsum(np.add.reduceat(known.lengths[numbers], np.cumsum(counts) - counts))
                begin = 0
                for i, end in zip(run, ends.tolist(), strict=True):
                    windows.add(keys[i], 0, ids[begin:end], end - begin)
                    begin = end
                yield windows.taken(arrow)
        windows.close(leftover=True)
        yield windows.taken(arrow)

    pieces = materialize(narrow.mapInArrow(first_pass, schema), "pieces")
    done = [pieces.filter("NOT leftover")]
    left, turn = pieces.filter("leftover"), 0
    tasks = 1 + (left.agg(F.max(F.shiftright("sequence_id", TASK_SHIFT))).first()[0] or 0)
    while True:
        turn, tasks = turn + 1, -(-tasks // FAN_IN)
        pieces = _merge(left, turn, tasks == 1, schema, arrow, window, least_cut)
        if tasks == 1:
            done.append(pieces)
            break
        pieces = materialize(pieces, "pieces")
        done.append(pieces.filter("NOT leftover"))
        left = pieces.filter("leftover")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.drop("leftover")


def _merge(left: DataFrame, turn: int, last: bool, schema: T.StructType, arrow: pa.Schema, window: int, least_cut: int) -> DataFrame:
    """Pack the leftovers of ``FAN_IN`` tasks together: best fit by size first, then gaps are filled by cutting."""
    task = F.shiftright(F.col("sequence_id").bitwiseAND((1 << ROUND_SHIFT) - 1), TASK_SHIFT)
    group = F.floor(task / FAN_IN).cast("long").alias("_group")

    def merge(keys: tuple, table: pa.Table) -> pa.Table:
        first = (turn << ROUND_SHIFT) | (keys[0].as_py() << TASK_SHIFT)
        by_window: dict[int, list] = {}
        columns = [table[c].to_pylist() for c in (schema[0].name, "start", "ids", "doc_tokens", "sequence_id", "offset")]
        for doc, start, ids, total, sequence, offset in sorted(zip(*columns, strict=True), key=lambda r: (r[4], r[5])):
            by_window.setdefault(sequence, []).append((doc, start, np.frombuffer(ids, np.int32), total))
        items = sorted(by_window.values(), key=lambda pieces: (-sum(len(p[2]) for p in pieces),))
        # Whole leftover windows first, each to the window that it fills best.
        fits: list[tuple[int, list]] = []
        for pieces in items:
            size = sum(len(p[2]) for p in pieces)
            best = min((i for i, (free, _) in enumerate(fits) if free >= size), key=lambda i: fits[i][0], default=None)
            if best is None:
                fits.append((window - size, list(pieces)))
            else:
                fits[best] = (fits[best][0] - size, fits[best][1] + pieces)
        result = Windows(first, window, 1, least_cut)
        rest = []
        for free, pieces in fits:
            if free < least_cut:
                result.emit(pieces)
            else:
                rest += pieces
        for piece in rest:
            result.add(*piece)
        result.close(leftover=not last)
        return pa.Table.from_batches([result.taken(arrow)])

    return left.withColumn("_group", group).groupBy("_group").applyInArrow(merge, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: every packed sequence in one row, at most a window long."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_parts"))
    joined = F.aggregate("_parts", F.lit(b""), lambda done, part: F.concat(done, part.ids))
    return whole.select("sequence_id", "length", joined.alias("ids"))
