"""Subword ids of many texts at once, with every distinct word encoded once per worker.

Texts are cut at ASCII white space, which the tokenizers used here never join across, so the ids of a text are those
of its words in order. A worker remembers the ids of the words it has met; whoever uses
them resets them once they are ``full``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import repeat

import numpy as np

#: Words remembered by a worker.
REMEMBERED = 300_000


class WordIds:
    """Ids of words as numpy arrays: word number, then ``starts`` and ``lengths`` in ``flat``.

    ``encode`` gives the words in an order of its choice, all their ids in a row, and how many each word has.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[list[bytes], np.ndarray, np.ndarray]], marks: dict[bytes, list[int]], limit: int = REMEMBERED):
        self.encode, self.marks, self.limit = encode, marks, limit
        self.resets = 0
        self.reset()

    def full(self) -> bool:
        return len(self.index) > self.limit

    def reset(self) -> None:
        """Forget all words; their numbers start anew."""
        self.resets += 1
        self.index: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.starts, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self._add(*in_a_row(list(self.marks), list(self.marks.values())))

    def _add(self, words: list[bytes], flat: np.ndarray, lengths: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.words += words
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words)), strict=True))
        self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of every word; words not met before are encoded together."""
        found = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = list(dict.fromkeys([words[i] for i in missing.tolist()]))
            self._add(*self.encode(new))
            found[missing] = np.fromiter(map(self.index.__getitem__, map(words.__getitem__, missing.tolist())), np.int64, len(missing))
        return found

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """All ids of the numbered words in a row."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at + np.repeat(self.starts[numbers] - ends + lengths, lengths)]


def in_a_row(words: list[bytes], ids: Sequence[Sequence[int]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Separate lists of ids in the form that :class:`WordIds` takes."""
    return words, np.array([i for w in ids for i in w], np.int32), np.fromiter(map(len, ids), np.int64, len(ids))


def batches_of(sizes: Sequence[int], most: int) -> list[range]:
    """Runs of neighbouring items whose sizes add up to about ``most``."""
    runs, start, total = [], 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            runs.append(range(start, i))
            start, total = i, 0
        total += size
    if start < len(sizes):
        runs.append(range(start, len(sizes)))
    return runs
