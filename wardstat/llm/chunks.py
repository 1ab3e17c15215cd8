"""Questions from pieces of a corpus to hash-partitioned buckets, and answers back to the pieces.

Documents are cut into chunks of about ``chunk_bytes`` of text by ranges of their integer id. A chunk sends each bucket the
distinct 64-bit keys it has there, sorted and packed; a bucket sees every chunk that holds a key and answers each chunk
with one value a key, in key order. A chunk's keys are distinct, so the number of rows of a bucket is bounded by the number
of chunks, however common one key is. The text itself is shuffled once, to meet the answers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.session import cut_lineage

#: Intervals of ids that have bounds of their own; beyond, each is cut evenly as often as the amount of text asks for.
MOST_EDGES = 2048
#: Intervals that a pass over the ids adds up text in.
BINS = 1 << 16


@dataclass(frozen=True)
class Layout:
    """How ids map to chunks and keys to buckets."""

    edges: tuple[int, ...]
    slices: int
    buckets: int
    total_bytes: int = 0

    @property
    def chunks(self) -> int:
        return (len(self.edges) - 1) * self.slices

    def chunk_column(self, id_col: str, other: Column) -> Column:
        """The chunk of each row, ascending with the id; rows without an id are spread by ``other`` below zero."""
        if not self.edges:
            return F.lit(0)
        edges = F.array(*(F.lit(e) for e in self.edges))
        at = F.least(F.greatest(F.size(F.filter(edges, lambda e: e <= F.col(id_col))) - 1, F.lit(0)), F.lit(len(self.edges) - 2))
        part = F.lit(0)
        if self.slices > 1:
            low, high = (F.element_at(edges, at + i).cast("double") for i in (1, 2))
            part = F.floor((F.col(id_col) - low) * self.slices / F.greatest(high - low, F.lit(1.0)))
            part = F.least(F.greatest(part, F.lit(0)), F.lit(self.slices - 1))
        return F.coalesce((at * self.slices + part).cast("int"), (-1 - F.pmod(other, F.lit(max(1, self.chunks)))).cast("int"))

    def bucket_starts(self) -> np.ndarray:
        return (np.arange(self.buckets, dtype=np.float64) * (2.0**64 / self.buckets)).astype(np.uint64)

    def bucket_runs(self, keys: np.ndarray) -> list[tuple[int, int, int]]:
        """(bucket, first, end) of each bucket that some of the sorted keys fall into."""
        if not len(keys):
            return []
        of = np.searchsorted(self.bucket_starts(), keys, side="right") - 1
        first = np.flatnonzero(np.diff(of, prepend=-1))
        return list(zip(of[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)]))


def _text_between(sizes: DataFrame, starts: list[int]) -> np.ndarray:
    """Bytes of text from each of the sorted starts to the next."""
    starts = np.array(starts, np.int64)

    def run(batches):
        total = np.zeros(len(starts), np.int64)
        for b in batches:
            np.add.at(total, np.searchsorted(starts, b["id"].to_numpy(), side="right") - 1, b["n"].to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bin", "n"])

    out = np.zeros(len(starts), np.int64)
    for r in sizes.mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.bin] = r.n
    return out


def id_edges(sizes: DataFrame, low: int, high: int, total: int, n: int) -> list[int]:
    """Bounds of about ``n`` ranges of ids from ``low`` to ``high`` with equal amounts of text.

    Text is added up in ``BINS`` even intervals; those that hold much more than their share are divided in proportion to
    it and added up again, until none is or it is a single id. Clustered ids thus get fine intervals where they are.
    """
    starts = sorted({low + (high - low + 1) * i // BINS for i in range(BINS)})
    while True:
        held = _text_between(sizes, starts)
        ends = [*starts[1:], high + 1]
        heavy = [i for i in np.flatnonzero(held > max(4 * total // BINS, total // (8 * n))) if ends[i] - starts[i] > 1]
        if not heavy:
            break
        more = set()
        for i in heavy:
            parts = min(ends[i] - starts[i], max(2, int(held[i]) * BINS // total))
            more |= {starts[i] + (ends[i] - starts[i]) * j // parts for j in range(1, parts)}
        starts = sorted(more | {x for x, h in zip(starts, held) if h} | {low})
    share = (np.cumsum(held) - held) * n // max(1, total)
    first = np.flatnonzero(np.diff(share, prepend=-1))
    return [low, *(starts[i] for i in first if starts[i] > low), high + 1]


def layout(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = 8 << 20, bucket_bytes: int = 16 << 20) -> Layout:
    """A layout for the amount of text there is: one pass over the texts for their lengths, a few over ids and lengths.

    Chunks hold about ``chunk_bytes`` however the ids lie; only one id that is repeated can't be divided.
    """
    sizes = cut_lineage(docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n")))
    row = sizes.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("id").isNotNull(), F.col("n"))).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).first()
    buckets = max(1, math.ceil((row.all or 0) / bucket_bytes))
    if row.a is None:
        return Layout((), 1, buckets, row.all or 0)
    n = max(1, math.ceil(row.n / chunk_bytes))
    edges = id_edges(sizes.filter("id is not null"), row.a, row.b, row.n, min(n, MOST_EDGES)) if n > 1 else [row.a, row.b + 1]
    edges[-1] = min(edges[-1], 2**63 - 1)
    return Layout(tuple(edges), max(1, math.ceil(n / MOST_EDGES)), buckets, row.all)


def pack(keys: np.ndarray, start: np.uint64) -> bytes:
    """Sorted distinct keys as fixed-width differences from ``start``; the width in bytes comes first."""
    if not len(keys):
        return b""
    gaps = np.diff(keys, prepend=start)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    return bytes([width]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes, start: np.uint64) -> np.ndarray:
    if not len(data):
        return np.zeros(0, np.uint64)
    gaps = np.zeros(((len(data) - 1) // data[0], 8), np.uint8)
    gaps[:, : data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, data[0])
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64) + start


def pieces(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, pa.Table]]:
    """(chunk, rows) of what one task reads, about ``limit`` bytes of text at a time. Columns: chunk, id, text, ..."""
    held: list[pa.RecordBatch] = []
    size = 0

    def cut() -> Iterator[tuple[int, pa.Table]]:
        t = pa.Table.from_batches(held)
        chunk = t["chunk"].to_numpy()
        order = np.argsort(chunk, kind="stable")
        bounds = np.flatnonzero(np.diff(chunk[order], prepend=chunk[order[0]] - 1))
        for a, b in zip(bounds, [*bounds[1:], len(order)]):
            yield int(chunk[order[a]]), t.take(pa.array(order[a:b]))

    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            held.append(part)
            size += part.nbytes
            if size >= limit:
                yield from cut()
                held, size = [], 0
    if any(b.num_rows for b in held):
        yield from cut()


def questions(chunk: int, keys: np.ndarray, plan: Layout, counts: np.ndarray | None = None, kind: int = 0) -> pa.RecordBatch:
    """Rows (bucket, chunk, keys, counts) for one piece's sorted distinct keys; each kind has buckets of its own."""
    starts, runs = plan.bucket_starts(), plan.bucket_runs(keys)
    used = np.array([b for b, _, _ in runs], np.int64)
    packed = [pack(keys[x:y], starts[b]) for b, x, y in runs]
    extra = [None if counts is None else counts[x:y].astype("<u4").tobytes() for _, x, y in runs]
    return pa.RecordBatch.from_pydict({"bucket": pa.array(used + kind * plan.buckets, pa.int32()), "chunk": pa.array(np.full(len(used), chunk), pa.int32()), "keys": pa.array(packed, pa.binary()), "counts": pa.array(extra, pa.binary())})


QUESTION = "bucket int, chunk int, keys binary, counts binary"


def gathered(table: pa.Table, plan: Layout) -> tuple[int, np.ndarray, np.ndarray, np.ndarray | None]:
    """(bucket, keys, chunks, counts) of all questions to one bucket, ordered by key, then chunk; one entry for each."""
    bucket = table["bucket"][0].as_py()
    start = plan.bucket_starts()[bucket % plan.buckets]
    rows = sorted(zip(table["chunk"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist()), key=lambda r: r[0])
    parts = [unpack(k, start) for _, k, _ in rows]
    keys, chunks = np.concatenate(parts), np.repeat(np.array([c for c, _, _ in rows], np.int32), [len(p) for p in parts])
    counts = None if rows[0][2] is None else np.concatenate([np.frombuffer(c, "<u4") for _, _, c in rows]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, chunks = keys[order], chunks[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (chunks[1:] != chunks[:-1])
    if counts is not None:
        counts = np.add.reduceat(counts[order], np.flatnonzero(new))
    return bucket, keys[new], chunks[new], counts


def answers(bucket: int, chunks: np.ndarray, values: np.ndarray, encode: Callable[[np.ndarray], bytes]) -> dict[str, list]:
    """Rows (chunk, bucket, answer): each chunk's values in key order."""
    order = np.argsort(chunks, kind="stable")
    bounds = np.flatnonzero(np.diff(chunks[order], prepend=chunks[order[0]] - 1))
    spans = list(zip(bounds, [*bounds[1:], len(order)]))
    return {"chunk": [int(chunks[order[a]]) for a, _ in spans], "bucket": [bucket] * len(spans), "answer": [encode(values[order[a:b]]) for a, b in spans]}
