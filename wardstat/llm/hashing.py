"""Vectorised hashes of words and word windows over a batch of UTF-8 texts.

A word is a maximal run of bytes outside space and \\t..\\r. Equal words have equal hashes in every process: the constants
are fixed and no seeded ``hash()`` is used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text that are hashed at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = [mix(np.arange(256, dtype=np.uint64) + np.uint64(1000 * (i + 1))) for i in range(2)]


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of a slice of texts, in order. ``doc`` counts from ``first``, the slice's first row in the batch."""

    first: int
    docs: int
    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def hashes(self, which: int = 0, lower: bool = False) -> np.ndarray:
        """One 64-bit polynomial hash a word; ``which`` picks one of two independent families."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        data = LOWER[self.data] if lower else self.data
        length = self.end - self.start
        head = np.zeros(len(data), np.int64)
        head[self.start[1:]] = np.diff(self.start)
        head[self.start[0]] = self.start[0]
        place = np.arange(len(data)) - np.cumsum(head)
        place[SPACE[data]] = 0
        place[: self.start[0]] = 0
        code = _BYTE_CODE[which][data] * _powers(int(length.max()), _BASES[which])[place]
        code[SPACE[data]] = 0
        return mix(np.add.reduceat(code, self.start) + length.astype(np.uint64))

    def windows(self, hashes: np.ndarray, size: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every ``size`` consecutive words of one text."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        acc = hashes[:n].copy()
        for j in range(1, size):
            acc = acc * _BASES[which] + hashes[j : j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return at, mix(acc[at])

    def counts(self) -> np.ndarray:
        """Words of each text of the slice."""
        return np.bincount(self.doc, minlength=self.docs)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a batch of texts, about ``limit`` bytes at a time; whole texts always. Nulls have no words."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if not len(texts):
        return
    _, off_buf, data_buf = texts.buffers()
    off = np.frombuffer(off_buf, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    valid = np.asarray(texts.is_valid())
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(off, off[first] + limit, side="right")) - 1)
        part = data[off[first] : off[last]]
        cuts = off[first : last + 1] - off[first]
        letter = ~SPACE[part]
        for i in np.flatnonzero(~valid[first:last]):
            letter[cuts[i] : cuts[i + 1]] = False
        before, after = np.zeros_like(letter), np.zeros_like(letter)
        before[1:], after[:-1] = letter[:-1], letter[1:]
        inner = cuts[1:-1]
        before[inner[inner < len(part)]] = False
        ends_here = inner - 1
        after[ends_here[(ends_here >= 0) & (ends_here < len(part))]] = False
        start, end = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
        yield Words(first, last - first, part, np.searchsorted(cuts, start, side="right") - 1, start, end)
        first = last


def grouped(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each owner, sorted, and the n + 1 offsets where each owner's values begin."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    v, o = v[new], o[new]
    return v, np.searchsorted(o, np.arange(n + 1))
