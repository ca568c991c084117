"""A bidirectional FM-index over word ids, ordered as deep as the phrases that are asked for.

Id 0 ends a piece and is part of no phrase. Rows of the index stand for positions of the text,
ordered by the next ``depth`` words; the mirror index does the same for the text read backwards.
A phrase is an interval of rows in either. It is extended by a word on one side by reading the
words before its rows in the index of that direction, and both intervals follow.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from txnstar.llm.words import ranges


def _order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions by their next ``depth`` ids; beyond the end stands 0."""
    bits = max(1, int(ids.max(initial=0)).bit_length())
    columns = [np.concatenate([ids[d:], np.zeros(min(d, len(ids)), ids.dtype)]) for d in range(depth)]
    packed = []
    for start in range(0, depth, 63 // bits):
        key = np.zeros(len(ids), np.uint64)
        for column in columns[start : start + 63 // bits]:
            key = (key << np.uint64(bits)) | column.astype(np.uint64)
        packed.append(key)
    return np.argsort(packed[0]) if len(packed) == 1 else np.lexsort(packed[::-1])


class _Side:
    """One direction: the word before each row, and where the rows it leads to stand."""

    def __init__(self, ids: np.ndarray, depth: int):
        order = _order(ids, depth)
        self.before = ids[order - 1]  # the word before the first is the last, which is 0
        self._leads: np.ndarray | None = None

    def leads(self, starts: np.ndarray) -> np.ndarray:
        """For each row, the row of its text with the word before it in front."""
        if self._leads is None:
            by_word = np.argsort(self.before, kind="stable")
            self._leads = np.empty(len(by_word), np.int64)
            self._leads[by_word] = np.arange(len(by_word))
        return self._leads[starts]


@dataclass
class Phrases:
    """Equally long phrases: their words, counts, and intervals in both indexes."""

    words: np.ndarray
    count: np.ndarray
    low: np.ndarray
    mirrored: np.ndarray

    def __len__(self) -> int:
        return len(self.count)

    def where(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.words[keep], self.count[keep], self.low[keep], self.mirrored[keep])


class FmIndex:
    """Index of ``ids``, which end with 0, for phrases of at most ``depth`` words."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, self.depth = ids, depth
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids))])
        self._sides: dict[bool, _Side] = {}

    def _side(self, right: bool) -> _Side:
        """Phrases grow to the left in the index itself, to the right in its mirror."""
        if right not in self._sides:
            # The mirror also ends with 0, so that a piece end stands before its first word.
            ids = np.concatenate([self.ids[-2::-1], self.ids[:0], [0]]) if right else self.ids
            self._sides[right] = _Side(ids.astype(self.ids.dtype), self.depth)
        return self._sides[right]

    def single(self) -> Phrases:
        """Every word."""
        words = np.arange(1, len(self.first) - 1)
        low = self.first[1:-1]
        found = Phrases(words[:, None], np.diff(self.first)[1:], low, low)
        return found.where(found.count > 0)

    def extended(self, phrases: Phrases, right: bool = True) -> Phrases:
        """All phrases one word longer on one side, with their counts."""
        side = self._side(right)
        near, far = (phrases.mirrored, phrases.low) if right else (phrases.low, phrases.mirrored)
        rows = np.repeat(near, phrases.count) + ranges(phrases.count)
        owner = np.repeat(np.arange(len(phrases), dtype=np.int64), phrases.count)
        key = owner * len(self.first) + side.before[rows]
        by_key = np.argsort(key, kind="stable")
        sorted_key = key[by_key]
        start = np.flatnonzero(np.diff(sorted_key, prepend=-1))
        count = np.diff(np.append(start, len(key)))
        owner, word = np.divmod(sorted_key[start], len(self.first))
        # Rows before which smaller words stand come first in the other index's interval.
        begin = np.searchsorted(owner, np.arange(len(phrases)))
        offset = start - (start[begin[owner]] if len(owner) else start)
        keep = word > 0
        grown = side.leads(rows[by_key[start[keep]]])
        other = far[owner[keep]] + offset[keep]
        own, new = phrases.words[owner[keep]], word[keep][:, None]
        words = np.concatenate([own, new] if right else [new, own], axis=1)
        low, mirrored = (other, grown) if right else (grown, other)
        return Phrases(words, count[keep], low, mirrored)
