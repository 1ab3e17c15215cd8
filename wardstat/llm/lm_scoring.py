"""Scores of a bigram model held in a log-frequency Bloom filter.

Training tokens and bigrams are added up over all texts: chunks of documents send their distinct ones, with counts, to
hash-partitioned buckets (see ``chunks``). A bucket's bigrams become a share of the filter: a bigram of count c is entered
for each level 1 .. 1 + floor(log2 c), and asking a bigram means probing level after level until one is absent; 2 to the
power of the last, less one, never exceeds the count of a bigram that was entered. A share has a fixed number of bits for
each entry it holds, so no bigram is dropped and the error is the same, at any corpus size: an unseen bigram is taken for a
seen one with probability 2^-``PROBES``.

The filter is broadcast to the workers while it is proven to be small: texts of ``BROADCAST_BYTES`` in all. Beyond that a
share stays where it was made, the chunks' bigrams come to it and their levels go back in a byte each; broadcasting the
filter in groups would read the texts once for each group, the square of the corpus. Both ways probe the same shares.
Unigram counts are exact and are always answered to the chunks.

A token's probability mixes the bigram estimate with the add-one unigram estimate. The weight of the bigrams is not
fitted: a text's probability is the mean over the fixed ``WEIGHTS``, so it follows how much of the text is known.

Words lose A-Z case; each text ends with one end token. Null text is empty. Rows that are not ``train`` (or where that is
null) teach nothing; every row is scored, also repeated ones and those without an id. Ids must be integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.llm import chunks
from wardstat.llm.hashing import mix, slices
from wardstat.session import scratch_path, stored

PROBES = 10
#: Bytes of text whose filter may be broadcast: at most a byte and a half of filter for each byte of text, in fact a sixth.
BROADCAST_BYTES = 256 << 20
WEIGHTS = (0.0, 0.03, 0.1, 0.3, 0.6, 0.9)
END, START = np.uint64(0xE0D), np.uint64(0x57A127)


def tokens(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all texts, each text's end token included; offsets of the texts)."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    out, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for w in slices(texts):
        n = w.counts()
        own = np.full(len(w.start) + w.docs, END, np.uint64)
        own[np.arange(len(w.start)) + w.doc] = w.hashes(lower=True)
        out.append(own)
        sizes.append(n + 1)
    return np.concatenate(out), np.cumsum(np.concatenate(sizes))


def before(stream: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The token before each one; the start mark before a text's first."""
    prev = np.empty_like(stream)
    prev[1:] = stream[:-1]
    prev[offsets[:-1]] = START
    return prev


def bigrams(prev: np.ndarray, stream: np.ndarray) -> np.ndarray:
    return mix(prev * np.uint64(0x9E3779B97F4A7C15) + stream)


def _places(keys: np.ndarray, level: int, probe: int, size: np.ndarray | np.uint64) -> np.ndarray:
    return (mix(keys + np.uint64(0x1000193 * level + 0x51ED27 * probe)) % size).astype(np.int64)


def build_share(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits of one share, eight to a byte: all levels of all keys, ``PROBES`` / ln 2 bits an entry."""
    levels = quantised(counts).astype(np.int64)
    size = 64 * max(1, math.ceil(float(levels.sum()) * PROBES / math.log(2) / 64))
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        some = keys[levels >= level]
        for probe in range(PROBES):
            bits[_places(some, level, probe, np.uint64(size))] = True
    return np.packbits(bits, bitorder="little")


class Filter:
    """Shares one after the other; ``starts`` are the least keys of each."""

    def __init__(self, shares: list[np.ndarray], starts: np.ndarray):
        self.bits = np.concatenate(shares)
        self.size = np.array([8 * len(s) for s in shares], np.uint64)
        self.base = np.cumsum(self.size).astype(np.int64) - self.size.astype(np.int64)
        self.starts = starts

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """How many levels of each key are in the filter, by probing one after the other until one is absent."""
        of = np.searchsorted(self.starts, keys, side="right") - 1
        found, live, level = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 1
        while len(live):
            for probe in range(PROBES):
                at = self.base[of[live]] + _places(keys[live], level, probe, self.size[of[live]])
                live = live[(self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            found[live] = level
            level += 1
        return found


def quantised(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c) as a byte; 0 for 0."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.uint8)


def _answer(plan: chunks.Layout, whole: bool):
    """Answers of a bucket: a token's count; a bigram's level by probing the bucket's share, or the share itself."""
    schema = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("answer", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        bucket, keys, owner, counts = chunks.gathered(table, plan)
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        total = np.add.reduceat(counts, heads)
        if bucket >= plan.buckets:
            taught = total > 0
            share = build_share(keys[heads][taught], total[taught])
            if whole:
                return pa.table({"chunk": [None], "bucket": [bucket], "answer": [share.tobytes()]}, schema)
            level = Filter([share], np.zeros(1, np.uint64)).levels(keys[heads])
            return pa.table(chunks.answers(bucket, owner, np.repeat(level, np.diff(np.append(heads, len(keys)))), lambda v: v.tobytes()), schema)
        each = np.repeat(total, np.diff(np.append(heads, len(keys))))
        rows = chunks.answers(bucket, owner, each, lambda v: v.astype("<i8").tobytes())
        rows["chunk"].append(None)
        rows["bucket"].append(bucket)
        rows["answer"].append(np.array([total.sum(), (total > 0).sum()], "<i8").tobytes())
        return pa.table(rows, schema)

    return run


def _score(plan: chunks.Layout, n: int, v: int, held):
    """Scores of a chunk's texts; ``held`` is the broadcast filter, or None where the levels were answered."""
    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        stream, offsets = tokens(rows["text"])
        told = dict(zip(replies["bucket"].to_pylist(), replies["answer"].to_pylist()))

        def answered(unique: np.ndarray, kind: int, dtype: str) -> np.ndarray:
            return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(told[b + kind * plan.buckets], dtype) for b, _, _ in plan.bucket_runs(unique))])

        unique, inverse = np.unique(stream, return_inverse=True)
        known = answered(unique, 0, "<i8")
        end = known[np.searchsorted(unique, END)] if len(unique) else 0
        c = known[inverse]
        unique, inverse = np.unique(bigrams(before(stream, offsets), stream), return_inverse=True)
        level = (answered(unique, 1, "u1") if held is None else held.value.levels(unique))[inverse].astype(np.int32)
        one = (c + 1.0) / (n + v + 1.0)
        prev = np.empty_like(c)
        prev[1:] = c[:-1]
        prev[offsets[:-1]] = end                            # as many starts as ends
        two, some = np.zeros(len(c)), np.flatnonzero((c > 0) & (prev > 0))
        seen = np.where(level[some] > 0, np.ldexp(1.0, level[some] - 1), 0.0)
        two[some] = np.minimum(seen, np.minimum(c[some], prev[some])) / prev[some]
        sums = lambda x: np.add.reduceat(x, offsets[:-1])  # noqa: E731  no text is without its end token
        del stream, unique, inverse, known, level, some, seen, prev, told
        logs = np.stack([sums(np.log10(w * two + (1 - w) * one)) for w in WEIGHTS])
        top = logs.max(0)
        score = top + np.log10(np.mean(10.0 ** (logs - top), 0))
        return pa.table({"id": rows["id"], "n_tokens": np.diff(offsets), "n_known": sums((c > 0).astype(np.int64)), "train_tokens": np.full(len(rows), n), "base_score": logs[0], "score": score})

    return run


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20,
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row; log10 probabilities."""
    spark = docs.sparkSession
    plan = chunks.layout(docs, id_col, text_col, chunk_bytes, bucket_bytes)
    whole = plan.total_bytes <= broadcast_bytes
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"), plan.chunk_column(id_col, F.xxhash64(text_col)).alias("chunk"))

    def ask(batches):
        for chunk, piece in chunks.pieces(batches, chunk_bytes):
            stream, offsets = tokens(piece["text"])
            taught = np.repeat(piece["train"].to_numpy(), np.diff(offsets))
            keys, inverse = np.unique(stream, return_inverse=True)
            yield chunks.questions(chunk, keys, plan, np.bincount(inverse[taught], minlength=len(keys)))
            keys, inverse = np.unique(bigrams(before(stream, offsets), stream)[taught if whole else slice(None)], return_inverse=True)
            yield chunks.questions(chunk, keys, plan, np.bincount(inverse if whole else inverse[taught], minlength=len(keys)), kind=1)

    replies = rows.mapInArrow(ask, chunks.QUESTION).groupBy("bucket").applyInArrow(_answer(plan, whole), "chunk int, bucket int, answer binary")
    replies = stored(replies, scratch_path(spark, "lm-replies"))
    n = v = 0
    shares = {}
    for r in replies.filter("chunk is null").toLocalIterator():
        if r.bucket >= plan.buckets:
            shares[r.bucket - plan.buckets] = np.frombuffer(r.answer, np.uint8)
        else:
            own = np.frombuffer(r.answer, "<i8")
            n, v = n + int(own[0]), v + int(own[1])
    # a bucket without training bigrams has an empty share
    held = spark.sparkContext.broadcast(Filter([shares.get(b, np.zeros(8, np.uint8)) for b in range(plan.buckets)], plan.bucket_starts())) if whole else None
    out = (rows.select("id", "text", "chunk").groupBy("chunk").cogroup(replies.filter("chunk is not null").groupBy("chunk"))
           .applyInArrow(_score(plan, n, v, held), f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    return out.withColumnRenamed("id", id_col)
