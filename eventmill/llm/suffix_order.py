"""Order of many fixed-length strings of one block of text, by a difference cover of its suffixes.

Suffixes whose place modulo V lies in a difference cover D are ranked beforehand, by doubling: ranks of
V bytes give ranks of 2V, and so on. For any two places there is a distance below V at which both reach a
ranked suffix. Two strings are thus compared in a constant number of steps, however long their common
part: the first V bytes, two ranks, and the last V bytes. Sorting is by ternary partitions around pivots,
all open partitions of all buckets in one pass of array operations.
"""

from __future__ import annotations

from itertools import count

import numpy as np

_WIDE = 8


def difference_cover(v: int) -> np.ndarray:
    """Residues such that every difference modulo ``v`` is one of two of them; smallest first, greedily."""
    cover, missing = {0}, set(range(1, v))
    while missing:
        gains = {x: len({(x - c) % v for c in cover} & missing | {(c - x) % v for c in cover} & missing) for x in range(v) if x not in cover}
        best = max(gains, key=lambda x: (gains[x], -x))
        cover.add(best)
        missing -= {(a - b) % v for a in cover for b in cover}
    return np.array(sorted(cover))


class Cover:
    def __init__(self, length: int):
        self.v = 32 if length >= 64 else 8
        if length < 2 * self.v - 1:
            raise ValueError(f"strings of {length} bytes are too short")
        self.residues = difference_cover(self.v)
        inside = np.isin(np.arange(self.v), self.residues)
        place = np.arange(self.v)
        both = inside[(place[:, None, None] + place) % self.v] & inside[(place[None, :, None] + place) % self.v]
        #: The distance at which two places, by their residues, both reach a ranked suffix.
        self.reach = both.argmax(axis=2)
        self.block = self.v
        while 2 * self.block + self.v - 1 <= length:
            self.block *= 2


def _dense(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks from 1, equal keys alike; the first key counts most."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(new) + 1
    return ranks


class SuffixBlock:
    """A text and the ranks of its cover suffixes. Memory: some twenty bytes for each of text."""

    def __init__(self, text: bytes, length: int, cover: Cover):
        v = cover.v
        self._length, self._cover = length, cover
        padded = text + bytes(2 * v + length)
        self._words = np.ndarray(len(padded) - _WIDE + 1, dtype=">u8", buffer=padded, strides=(1,))
        slots = np.full(v, -1)
        slots[cover.residues] = np.arange(len(cover.residues))
        self._slots = slots
        rows = len(text) // v + 1
        places = (np.arange(rows)[:, None] * v + cover.residues).ravel()
        ranks = _dense([self._word(places + at) for at in range(0, v, _WIDE)])
        size, step = v, len(cover.residues)
        while size < cover.block:  # the rank of twice the bytes, from two ranks; beyond the text: 0
            ahead = np.zeros_like(ranks)
            jump = size // v * step
            ahead[:-jump] = ranks[jump:]
            ranks = _dense([ranks * (len(ranks) + 2) + ahead])
            size *= 2
        self._ranks = ranks

    def _word(self, places: np.ndarray) -> np.ndarray:
        return self._words[places].astype(np.uint64)

    def _rank(self, places: np.ndarray) -> np.ndarray:
        row = places // self._cover.v
        at = row * len(self._cover.residues) + self._slots[places % self._cover.v]
        return self._ranks[np.minimum(at, len(self._ranks) - 1)]

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for the strings at places ``a`` against those at ``b``."""
        v, length, block = self._cover.v, self._length, self._cover.block
        out = np.zeros(len(a), dtype=np.int8)
        tied = np.arange(len(a))

        def decide(x: np.ndarray, y: np.ndarray) -> None:
            nonlocal tied
            out[tied] = (x > y).astype(np.int8) - (x < y)
            tied = tied[x == y]

        for at in range(0, v, _WIDE):
            decide(self._word(a[tied] + at), self._word(b[tied] + at))
        reach = self._cover.reach[a[tied] % v, b[tied] % v]
        last = reach + (length - reach - block) // v * v
        reach = np.stack([reach, last])
        for row in (0, 1):
            keep = tied
            decide(self._rank(a[tied] + reach[row]), self._rank(b[tied] + reach[row]))
            reach = reach[:, np.isin(keep, tied, assume_unique=True)]
        for at in range(length - v, length, _WIDE):
            decide(self._word(a[tied] + at), self._word(b[tied] + at))
        return out

    def classes(self, places: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Numbers that are equal for equal strings of a bucket, and ascend with them within each bucket."""
        order = np.argsort(buckets, kind="stable")
        out = np.zeros(len(places), dtype=np.int64)
        ordered = buckets[order]
        head = np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.zeros(0, bool)
        # Each open partition is a stretch of ``order`` that starts at its number.
        starts = np.flatnonzero(head)
        part = np.repeat(starts, np.diff(starts, append=len(order)))
        for turn in count():
            sizes = np.diff(np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])) if len(part) else np.zeros(0, np.int64)
            if not len(sizes):
                return out
            firsts = np.cumsum(sizes) - sizes
            pivot = firsts + (sizes // 2 if turn % 2 == 0 else (sizes * 7 // 11))
            versus = np.repeat(order[pivot], sizes)
            verdict = self.compare(places[order], places[versus])
            again = np.lexsort((verdict, part))
            order, part, verdict = order[again], part[again], verdict[again]
            new = np.r_[True, (part[1:] != part[:-1]) | (verdict[1:] != verdict[:-1])]
            begin = np.flatnonzero(new)
            # A part keeps its first number; what is larger starts as far on as there are smaller ones.
            offset = np.arange(len(part)) - np.repeat(firsts, sizes)
            number = part + np.repeat(offset[begin], np.diff(begin, append=len(part)))
            alone = np.repeat(np.diff(begin, append=len(part)), np.diff(begin, append=len(part))) == 1
            done = (verdict == 0) | alone
            out[order[done]] = number[done]
            order, part = order[~done], number[~done]
