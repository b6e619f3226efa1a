"""Vectorised hashing of byte runs, for the operators that work inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers of the polynomial hashes, and of the finisher.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

#: Units (bytes or words) handled at once. It bounds a task's memory to some ten arrays of this size.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no visible structure."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(_MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(_MIX[1])
    x ^= x >> np.uint64(31)
    return x


#: A random-looking 64-bit number for each byte.
BYTE_UNITS = mix(np.arange(1, 257, dtype=np.uint64))

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        size = max(n, CHUNK + 1)
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit units, from one running sum."""

    def __init__(self, units: np.ndarray, base: int):
        n = len(units)
        self._sum = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(units * powers(base, n), out=self._sum[1:])
        self._back = powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sum[end] - self._sum[start]) * self._back[start])

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k units from each place on."""
        n = max(0, len(self._sum) - k)
        return mix((self._sum[k:] - self._sum[:n]) * self._back[:n])


#: 1 for the bytes that separate words: space, and tab to carriage return.
SPACE = np.zeros(256, dtype=np.int8)
SPACE[[0x20, *range(0x09, 0x0E)]] = 1


def runs(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each stretch of zeros."""
    edges = np.flatnonzero(np.diff(gap, prepend=np.int8(1), append=np.int8(1)))
    return edges[0::2], edges[1::2]


class Words:
    """The words of some texts, end to end: their byte spans, hashes, and each text's end among them."""

    def __init__(self, texts: list[bytes], separators: np.ndarray = SPACE):
        data = b"\n".join(texts)
        self.data = np.frombuffer(data, dtype=np.uint8)
        self.starts, self.ends = runs(separators[self.data]) if len(data) else (np.zeros(0, np.int64),) * 2
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        self.text_ends = np.searchsorted(self.starts, text_ends)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(out):  # by stretches of whole words, so that no array is longer than the longest of them
            begin = int(self.starts[at])
            upto = max(at + 1, int(np.searchsorted(self.ends, begin + CHUNK, side="right")))
            stop = int(self.ends[upto - 1])
            rolling = Rolling(BYTE_UNITS[self.data[begin:stop]], BASES[0])
            out[at:upto] = rolling.of(self.starts[at:upto] - begin, self.ends[at:upto] - begin)
            at = upto
        return out


def groups(sizes: list[int], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to ``most`` at most, or that are single."""
    begin, total = 0, 0
    for at, size in enumerate(sizes):
        if at > begin and total + size > most:
            yield begin, at
            begin, total = at, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
