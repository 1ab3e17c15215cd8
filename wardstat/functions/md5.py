"""MD5 of many short texts at once: one text per array element, for work that hashes a text thousands of times."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_LOW = 0xFFFFFFFF


def _rounds(state: list[np.ndarray], words: list, since: int, upto: int) -> list[np.ndarray]:
    """Rounds ``since`` to ``upto`` of one block; a word is an array, or a number where it is the same in all texts."""
    a, b, c, d = (s.copy() for s in state)
    f, t = np.empty_like(a), np.empty_like(a)
    for i in range(since, upto):
        if i < 16:
            g = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            g = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            g = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            g = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        if isinstance(words[g], int):
            np.add(f, np.uint32((_SINES[i] + words[g]) & _LOW), out=f)
        else:
            np.add(f, np.uint32(_SINES[i]), out=f)
            np.add(f, words[g], out=f)
        turn = _TURNS[i // 16][i % 4]
        np.left_shift(f, np.uint32(turn), out=t)
        np.right_shift(f, np.uint32(32 - turn), out=f)
        np.bitwise_or(t, f, out=t)
        np.add(t, b, out=t)
        a, b, c, d, t = d, t, b, c, a
    return [a, b, c, d]


def _block(state: list[np.ndarray], words: list, begun: list[np.ndarray] | None = None, since: int = 0) -> list[np.ndarray]:
    return [s + r for s, r in zip(state, _rounds(begun or state, words, since, 64))]


def _bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sixteen little-endian words of each text: its ``size`` bytes from ``start``, then zeros."""
    at = np.arange(64)
    held = np.where(at < size[:, None], data.take(start[:, None] + at, mode="clip"), 0).astype(np.uint8)
    return np.ascontiguousarray(held.view("<u4").T.astype(np.uint32))


class _Ends:
    """Texts whose last bytes and number of ``digits`` digits fill ``blocks`` blocks."""

    def __init__(self, state, words, rest, sizes, digits: int, blocks: int):
        self.base, self.state, self.blocks = words, state, blocks
        self.words = np.concatenate([words, np.zeros_like(words)])[:16 * blocks]
        bits = (sizes + digits) * 8
        self.words[-2], self.words[-1] = (bits & _LOW).astype(np.uint32), (bits >> 32).astype(np.uint32)
        cuts = [*np.flatnonzero(np.diff(rest, prepend=-1)), len(rest)]
        self.runs = [(int(rest[s]), slice(s, e)) for s, e in zip(cuts, cuts[1:])]
        turned = {j for r, _ in self.runs for j in range(r // 4, (r + digits) // 4 + 1)}
        self.given = [w if j in turned or (w != w[0]).any() else int(w[0]) for j, w in enumerate(self.words)]
        self.since = min(turned | {15})                     # rounds before the first digit are the same for all numbers
        self.begun = _rounds(state, self.given, 0, self.since)

    def digest(self, number: int) -> list[np.ndarray]:
        end = int.from_bytes(str(number).encode() + b"\x80", "little")
        for rest, run in self.runs:
            put, j = end << 8 * (rest % 4), rest // 4
            while put:
                np.add(self.base[j, run] if j < 16 else np.uint32(0), np.uint32(put & _LOW), out=self.words[j, run])
                put, j = put >> 32, j + 1
        out = _block(self.state, self.given[:16], self.begun, self.since)
        return out if self.blocks == 1 else _block(out, self.given[16:])


def numbered_md5(texts: pa.Array, count: int) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]:
    """MD5 of each text followed by each number from 0 to ``count`` - 1 in decimal.

    Returns an order of the texts, and for each number the digests in that order: four rows of 32-bit numbers, the first
    eight hexadecimal digits of a digest being the first. Texts are of any length; blocks before the last are hashed once.
    """
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.append(np.frombuffer(texts.buffers()[2] or b"", np.uint8), np.uint8(0))
    sizes = np.diff(ends)
    order = np.argsort(sizes % 64, kind="stable")           # texts that end at one place of a block stand together
    start, sizes = ends[:-1][order], sizes[order]
    rest, whole = sizes % 64, sizes // 64
    state = [np.full(len(texts), s, np.uint32) for s in _START]
    for k in range(int(whole.max(initial=0))):
        more = np.flatnonzero(whole > k)
        done = _block([s[more] for s in state], list(_bytes(data, start[more] + 64 * k, np.full(len(more), 64))))
        for s, r in zip(state, done):
            s[more] = r
    words = _bytes(data, start + 64 * whole, rest)

    def digests() -> Iterator[tuple[int, np.ndarray]]:
        for digits in range(1, len(str(max(0, count - 1))) + 1):
            one = int(np.searchsorted(rest, 64 - 9 - digits, side="right"))
            parts = [(p, _Ends([s[p] for s in state], words[:, p], rest[p], sizes[p], digits, blocks))
                     for p, blocks in ((slice(0, one), 1), (slice(one, None), 2)) if len(rest[p])]
            out = np.empty((4, len(rest)), np.uint32)
            for number in range(10 ** (digits - 1) if digits > 1 else 0, min(10**digits, count)):
                for p, ending in parts:
                    for row, word in zip(out, ending.digest(number)):
                        row[p] = word.byteswap()
                yield number, out

    return order, digests()
