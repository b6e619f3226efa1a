"""Content-defined anchors of fixed-length windows, shared by the two repeat finders.

Every window of ``length`` units (words or bytes, as 64-bit hashes) has one anchor: the k-gram with the
smallest hash in it, the leftmost of equal ones. The choice depends on the window's units alone, so equal
windows have equal anchors at equal offsets wherever they stand. Neighbouring windows mostly share their
anchor: there are about 2 in (length - k + 2) units, and each stands for a run of windows, its context.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from .hashing import BASES, CHUNK, Rolling, mix

#: A spot packs an anchor's first window, the anchor's offset in it, the number of windows, and a tag.
_WIDE, _TAG = 10, 12
MOST_LENGTH = 1 << _WIDE


class Spots(NamedTuple):
    first: np.ndarray
    offset: np.ndarray
    count: np.ndarray
    tag: np.ndarray


def pack(first: np.ndarray, offset: np.ndarray, count: np.ndarray, tag: np.ndarray) -> np.ndarray:
    low = (offset.astype(np.int64) << _WIDE) | count
    return (first.astype(np.int64) << (2 * _WIDE + _TAG)) | (low << _TAG) | tag


def unpack(spots: np.ndarray) -> Spots:
    low = spots >> _TAG
    most = MOST_LENGTH - 1
    return Spots(spots >> (2 * _WIDE + _TAG), (low >> _WIDE) & most, low & most, spots & ((1 << _TAG) - 1))


def tag_of(text: bytes) -> int:
    """Tells apart the spots of rows that share an id but not their text."""
    import zlib

    return zlib.crc32(text) & ((1 << _TAG) - 1)


class Anchors(NamedTuple):
    """One entry an anchor: its text's number, the first window it stands for (counted from the text's
    start), the anchor's offset in that window, the number of windows, the hash of its k-gram, and the hash
    of its context (all units of its windows)."""

    text: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    count: np.ndarray
    gram: np.ndarray
    context: np.ndarray


def _pieces(ends: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of units to scan: start, end, and of each piece in it its text, end and place in the text.

    Short texts are taken together. One that is longer than half a chunk is cut into pieces that overlap by
    a window less one unit, so that every window lies within exactly one piece.
    """
    half = CHUNK // 2
    starts = np.r_[0, ends[:-1]]
    sizes = ends - starts
    begin = 0
    while begin < len(ends):
        if sizes[begin] > half:
            for at in range(0, int(sizes[begin]) - length + 1, half):
                low = int(starts[begin]) + at
                high = min(low + half + length - 1, int(ends[begin]))
                yield low, high, np.array([begin]), np.array([high - low]), np.array([at])
            begin += 1
            continue
        low = int(starts[begin])
        upto = begin + 1
        while upto < len(ends) and sizes[upto] <= half and ends[upto] - low <= half:
            upto += 1
        texts = np.arange(begin, upto)
        yield low, int(ends[upto - 1]), texts, ends[begin:upto] - low, np.zeros(upto - begin, dtype=np.int64)
        begin = upto


def scan(units: np.ndarray, ends: np.ndarray, length: int, k: int) -> Iterator[Anchors]:
    """The anchors of all windows of the texts that lie end to end in ``units``."""
    if not k <= length < MOST_LENGTH:
        raise ValueError(f"windows of {length} units with anchors of {k}")
    place_mask = np.uint64(CHUNK - 1)
    for low, high, texts, piece_ends, bases in _pieces(ends, length):
        n = high - low
        if n < length:
            continue
        part = units[low:high]
        grams = Rolling(part, BASES[0]).grams(k)
        least = (grams & ~place_mask) | np.arange(len(grams), dtype=np.uint64)
        reach, width = 1, length - k + 1
        while reach < width:  # the least of twice as many, until it is the least of a window's k-grams
            step = min(reach, width - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        piece_starts = np.r_[0, piece_ends[:-1]]
        piece = np.repeat(np.arange(len(texts)), piece_ends - piece_starts)[: len(least)]
        windows = np.flatnonzero(np.arange(length, len(least) + length) <= piece_ends[piece])
        if not len(windows):
            continue
        place = (least[windows] & place_mask).astype(np.int64)
        new = np.empty(len(windows), dtype=bool)
        new[0] = True
        new[1:] = (place[1:] != place[:-1]) | (windows[1:] - windows[:-1] != 1)
        head = np.flatnonzero(new)
        first, last = windows[head], windows[np.r_[head[1:] - 1, len(windows) - 1]]
        place, of = place[head], piece[first]
        offset, count = place - first, last - first + 1
        context = Rolling(part, BASES[1]).of(first, last + length)
        context = mix(context + ((offset << _WIDE) | count).astype(np.uint64))
        yield Anchors(texts[of], first - piece_starts[of] + bases[of], offset, count, grams[place], context)


def covered(repeated: np.ndarray, length: int) -> np.ndarray:
    """Which units lie in a repeated window; ``repeated``: a flag for each window start."""
    change = np.zeros(len(repeated) + length, dtype=np.int32)
    change[: len(repeated)] += repeated
    change[length:] -= repeated
    return np.cumsum(change[:-1]) > 0
