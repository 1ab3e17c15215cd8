"""Benchmark decontamination: documents that hold a benchmark item up to a fifth of its words edited.

Words are runs of letters and digits, lower-cased. An item of n words is found in a document if some run of the document's
words is at word edit distance n // 5 or less. Item-sized windows are embedded by the CGK random walk, under which a small
edit distance becomes a small Hamming distance, and looked up by bit sampling; for items of each length, rounds repeat
until simulated edits of the benchmark's own items of that length reach ``recall``. Every hit is then verified by the exact
edit distance. Where ``MOST_ROUNDS`` are not enough for a length, as for all over ``LOOKED_UP`` words, none of its windows
is dropped by the lookup: all that the filter below leaves are verified, so recall is not lost with length.

Before that a lossless filter drops windows: e edits touch at most 2e of an item's n - 1 word pairs, so one of any 2e + 1
of them is left in a match, about where the item has it, and n - 1 - 2e pairs of the benchmark are. Only windows that
begin where one of an item's 2e + 1 rarest pairs puts it are looked up. Documents are scanned once without a shuffle; the benchmark is sent to the
workers in parts of at most ``PART_BYTES`` of text, up to ``PARTS_A_SCAN`` parts in one scan.

Items with fewer than ``min_words`` words are no evidence and are never found. Null texts have no words; every row is
judged by itself, repeated or without an id; an empty documents or benchmark table gives no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.llm.hashing import mix, slices

PART_BYTES, PARTS_A_SCAN = 8 << 20, 4
#: Positions of the embedding that one lookup compares, and the most rounds of lookups.
SAMPLED, MOST_ROUNDS = 2, 64
#: Longest items whose windows are looked up; lengths are calibrated in steps of ``LENGTH_STEP``.
LOOKED_UP, LENGTH_STEP = 240, 8
_PAD = np.uint64(0x5EED)
_SPLIT = r"[^\p{L}\p{N}]+"


def allowed(n: int) -> int:
    """Edits that an item of n words may have."""
    return n // 5


def plain(texts: pa.Array) -> pa.Array:
    """Lower-case words between spaces."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), pattern=_SPLIT, replacement=" ")


def embed(windows: np.ndarray, seed: int, steps: int) -> np.ndarray:
    """CGK: copy the word at a pointer that moves on by one random bit of the word, step by step; past the end a pad."""
    rows, n = np.arange(len(windows)), windows.shape[1]
    padded = np.concatenate([windows, np.full((len(windows), 1), _PAD)], 1)
    at, out = np.zeros(len(windows), np.int64), np.empty((len(windows), steps), np.uint64)
    for j in range(steps):
        word = padded[rows, np.minimum(at, n)]
        out[:, j] = word
        at += (mix(word ^ np.uint64(1_000_003 * (seed + 1) + j)) & np.uint64(1)).astype(np.int64)
    return out


def _steps(n: int) -> int:
    return n + n // 2                       # beyond, walks run past the end and agree for nothing


def _sampled(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([n, seed]).choice(_steps(n), min(SAMPLED, _steps(n)), replace=False)


def _keys(windows: np.ndarray, seed: int) -> np.ndarray:
    n = windows.shape[1]
    at = _sampled(n, seed)
    out = embed(windows, seed, int(at.max()) + 1)[:, at]
    key = np.zeros(len(windows), np.uint64)
    for j in range(out.shape[1]):
        key = mix(key ^ out[:, j])
    return key


def rounds_for(items: list[np.ndarray], recall: float, trials: int = 1200) -> int | None:
    """Rounds of lookups after which these items with all allowed, random, edits are found with probability ``recall``.

    None if ``MOST_ROUNDS`` don't reach it. ``trials`` edits in all are simulated.
    """
    rng, hits = np.random.default_rng(5), []
    chosen = items[:: max(1, len(items) // 12)]
    for words in chosen:
        n, block = len(words), [words]
        for _ in range(-(-trials // len(chosen))):
            edited = list(words)
            for _ in range(allowed(n)):
                p, kind = int(rng.integers(len(edited))), int(rng.integers(3))
                edited[p : p + (kind != 1)] = [] if kind == 2 else [np.uint64(rng.integers(1 << 62))]
            block.append(np.array((edited + [_PAD] * n)[:n], np.uint64))
        block = np.stack(block)
        hits.append(np.stack([(k := _keys(block, s))[1:] == k[0] for s in range(MOST_ROUNDS)]))
    if not hits:
        return 1
    found = np.maximum.accumulate(np.concatenate(hits, 1), 0).mean(1)
    enough = np.flatnonzero(found >= recall)
    return int(enough[0]) + 1 if len(enough) else None


def rounds_by_length(items: list[np.ndarray], recall: float) -> dict[int, int | None]:
    """``rounds_for`` of each step of lengths; None beyond ``LOOKED_UP`` words."""
    steps: dict[int, list[np.ndarray]] = {}
    for words in items:
        steps.setdefault(len(words) // LENGTH_STEP, []).append(words)
    return {k: rounds_for(sorted(own, key=len), recall) if (k + 1) * LENGTH_STEP <= LOOKED_UP else None for k, own in steps.items()}


def nearest(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the run of ``words`` nearest to ``item``; the first of the shortest on ties."""
    n, m = len(item), len(words)
    cost = np.zeros(m + 1, np.int64)
    start = np.arange(m + 1)
    for i in range(1, n + 1):
        above = np.minimum(cost[:-1] + (words != item[i - 1]), cost[1:] + 1)
        from_left = np.where(cost[:-1] + (words != item[i - 1]) <= cost[1:] + 1, start[:-1], start[1:])
        new = np.concatenate([[i], above])
        # a gap in the item: the least of new[j'] + (j - j') over j' <= j
        level = new - np.arange(m + 1)
        least = np.minimum.accumulate(level)
        came = np.maximum.accumulate(np.where(level == least, np.arange(m + 1), 0))
        cost, start = least + np.arange(m + 1), np.concatenate([[0], from_left])[came]
    end = int(np.lexsort((np.arange(m + 1) - start, cost))[0])
    return int(cost[end]), int(start[end]), end


def word_pairs(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(31) + words[1:])


class Items:
    """A part of the benchmark, ready for lookups."""

    def __init__(self, ids: list, words: list[np.ndarray], rounds: dict[int, int | None]):
        self.ids, self.words = ids, words
        self.size = np.array([len(w) for w in words])
        self.slack = np.array([allowed(len(w)) for w in words])
        own = [word_pairs(w) for w in words]
        self.pairs, known = np.unique(np.concatenate(own), return_inverse=True)
        vocabulary, times = np.unique(np.concatenate(words), return_counts=True)
        common = [times[np.searchsorted(vocabulary, w)] for w in words]
        spots = []
        for i, c in enumerate(common):
            # the pairs whose rarer word is rarest in the benchmark, then whose other word is
            rank = np.lexsort((np.maximum(c[:-1], c[1:]), np.minimum(c[:-1], c[1:])))[: 2 * self.slack[i] + 1]
            spots += [(own[i][o], i, o) for o in rank]
        spots.sort(key=lambda x: x[0])
        self.seed = np.array([x[0] for x in spots], np.uint64)
        self.seed_item, self.seed_at = np.array([x[1] for x in spots]), np.array([x[2] for x in spots])
        self.rounds = {int(n): rounds[int(n) // LENGTH_STEP] for n in np.unique(self.size)}
        self.keys = np.zeros((max((r or 0 for r in self.rounds.values()), default=0), len(words)), np.uint64)
        for n in np.unique(self.size):
            at = np.flatnonzero(self.size == n)
            for r in range(self.rounds[int(n)] or 0):
                self.keys[r, at] = _keys(np.stack([words[i] for i in at]), r)

    def begins(self, w, pair: np.ndarray, flags: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, first word) of every window of a slice of texts that the lossless filter leaves."""
        a, b = np.searchsorted(self.seed, pair, "left"), np.searchsorted(self.seed, pair, "right")
        hit = np.flatnonzero((b > a) & flags)
        n = (b - a)[hit]
        at = np.repeat(hit, n)
        seed = np.repeat(a[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = self.seed_item[seed]
        width = 2 * self.slack[item] + 1
        move = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        at, item, offset = np.repeat(at, width), np.repeat(item, width), np.repeat(self.seed_at[seed] + self.slack[item], width)
        first = np.maximum(at - offset + move, low[w.doc[at]])
        inside = first < high[w.doc[at]]                    # a pair near its text's end puts starts beyond it
        item, first = item[inside], first[inside]
        both = np.unique(np.stack([item, first], 1), axis=0)
        item, first = both[:, 0], both[:, 1]
        sums, k, doc = np.concatenate([[0], np.cumsum(flags)]), self.slack[item], w.doc[first]
        held = sums[np.clip(first + self.size[item] + k, None, high[doc] - 1)] - sums[np.maximum(first - k, low[doc])]
        ok = held >= self.size[item] - 1 - 2 * k
        return item[ok], first[ok]

    def looked_up(self, hashes: np.ndarray, item: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which windows share a key with their item in some round; ``end`` is where the window's text ends."""
        found = np.zeros(len(item), bool)
        for n in np.unique(self.size[item]):
            own = np.flatnonzero(self.size[item] == n)
            if self.rounds[int(n)] is None:                 # lookups would lose some of these: all go on to be verified
                found[own] = True
                continue
            start, back = np.unique(first[own], return_inverse=True)
            stop = np.zeros(len(start), np.int64)
            stop[back] = end[own]
            for lo in range(0, len(start), 1 << 16):
                at = start[lo : lo + (1 << 16), None] + np.arange(n)
                windows = np.where(at < stop[lo : lo + (1 << 16), None], hashes[np.minimum(at, len(hashes) - 1)], _PAD)
                part = own[(back >= lo) & (back < lo + (1 << 16))]
                row = back[(back >= lo) & (back < lo + (1 << 16))] - lo
                for r in range(self.rounds[int(n)]):
                    left = ~found[part]
                    if not left.any():
                        break
                    part, row = part[left], row[left]
                    need, row_of = np.unique(row, return_inverse=True)
                    found[part] = _keys(windows[need], r)[row_of] == self.keys[r, item[part]]
        return found


def _regions(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """Runs of starts that lie within ``gap`` of each other."""
    low = last = starts[0]
    for s in starts[1:]:
        if s - last > gap:
            yield low, last
            low = s
        last = s
    yield low, last


def benchmark_parts(benchmark: DataFrame, min_words: int, recall: float, id_col: str, text_col: str) -> Iterator[Items]:
    """The benchmark in parts of bounded size, read to the driver one at a time."""
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).distinct()
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = -(-size // PART_BYTES)
    for p in range(parts):
        got = rows.filter(F.pmod(F.xxhash64("t"), F.lit(parts)) == p).orderBy("i", "t").toArrow()
        ids, words = [], []
        texts = plain(got["t"].combine_chunks())
        for w in slices(texts):
            h = w.hashes()
            for d, run in enumerate(np.split(h, np.cumsum(w.counts())[:-1])):
                if len(run) >= min_words:
                    ids.append(got["i"][w.first + d].as_py())
                    words.append(run)
        if words:
            yield Items(ids, words, rounds_by_length(words, recall))


def _scan(items: Items, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, int, int]]]]:
    """(row, [(item, distance, start, end), ...]) of the texts that hold an item."""
    small = np.zeros(1 << 20, bool)
    small[items.pairs >> np.uint64(44)] = True
    held: list[np.ndarray] = []                 # words of the texts that the filter leaves, to be looked up together
    base, owner, places = [0], [], []
    for w in slices(plain(texts)):
        h = w.hashes()
        if len(h) < 2:
            continue
        pair = word_pairs(h)
        maybe = np.flatnonzero(small[pair >> np.uint64(44)] & (w.doc[:-1] == w.doc[1:]))
        flags = np.zeros(len(pair), bool)
        flags[maybe] = items.pairs[np.minimum(np.searchsorted(items.pairs, pair[maybe]), len(items.pairs) - 1)] == pair[maybe]
        bounds = np.searchsorted(w.doc, np.arange(w.docs + 1))
        item, first = items.begins(w, pair, flags, bounds[:-1], bounds[1:])
        docs, of = np.unique(w.doc[first], return_inverse=True)
        places.append(np.stack([item, first - bounds[docs][of], of + len(owner)]))
        for d in docs:
            held.append(h[bounds[d] : bounds[d + 1]])
            base.append(base[-1] + len(held[-1]))
            owner.append(w.first + int(d))
    if not owner:
        return
    item, at, of = np.concatenate(places, 1)
    start = np.array(base)
    ok = items.looked_up(np.concatenate(held), item, at + start[of], start[of + 1])
    near: dict[int, dict[int, list[int]]] = {}
    for d, i, x in zip(of[ok].tolist(), item[ok].tolist(), at[ok].tolist()):
        near.setdefault(d, {}).setdefault(i, []).append(x)
    for d in sorted(near):
        leaks = []
        for i, at in near[d].items():
            n, k, best = int(items.size[i]), int(items.slack[i]), None
            for low, high in _regions(sorted(at), n + k):
                low, high = max(0, low - 2 * k), min(len(held[d]), high + n + 2 * k)
                gap, x, y = nearest(items.words[i], held[d][low:high])
                if gap <= k and (best is None or gap < best[0]):
                    best = (gap, int(x + low), int(y + low))
            if best:
                leaks.append((i, *best))
        if leaks:
            yield owner[d], leaks


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_words: int = 5, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc id, item id, start, end, distance): each item that a document holds, at its nearest run of words [start, end)."""
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    schema = f"id {kind}, item {item_kind}, start long, end long, distance long"

    def scan(parts: tuple[Items, ...]):
        def run(batches):
            for b in batches:
                found = [(b.column("id")[r].as_py(), items.ids[i], x, y, d) for items in parts for r, leaks in _scan(items, b.column("t")) for i, d, x, y in leaks]
                cols = list(zip(*found)) if found else [[]] * 5
                types = [b.schema.field("id").type, pa.from_numpy_dtype(np.int64) if item_kind == "bigint" else None, pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) if t else pa.array(c) for c, t in zip(cols, types)], ["id", "item", "start", "end", "distance"])

        return rows.mapInArrow(run, schema)

    out = docs.sparkSession.createDataFrame([], schema)
    for parts in batched(benchmark_parts(benchmark, min_words, recall, item_col, item_text_col), PARTS_A_SCAN):
        out = out.union(scan(parts))
    return out.groupBy("id", "item").agg(F.min(F.struct("distance", "start", "end")).alias("m")).select(F.col("id").alias(id_col), F.col("item").alias(item_col), "m.start", "m.end", "m.distance")


def remove_leaking(docs: DataFrame, benchmark: DataFrame, min_words: int = 5, recall: float = 0.999, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they were."""
    place, out = docs.columns.index(text_col), docs

    def without(parts: tuple[Items, ...]):
        def run(batches):
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for items in parts:
                    keep[[r for r, _ in _scan(items, b.column(place))]] = False
                yield b.filter(pa.array(keep))

        return run

    for parts in batched(benchmark_parts(benchmark, min_words, recall, item_col, item_text_col), PARTS_A_SCAN):
        out = out.mapInArrow(without(parts), docs.schema)
    return out
