"""Substring dedup: remove every word of a token window that already starts in a document with a smaller id.

Rabin-Karp hashes of every window of ``size`` words are counted over the whole corpus by chunk and bucket (see
``chunks``). As chunks ascend with the id, a bucket answers one bit a hash: held by an earlier chunk or not. The chunk then
removes windows held by an earlier chunk, or by an earlier document of its own, and merges them into maximal intervals.

Two windows are equal if their 64-bit hashes are. Ids must be integers; rows that repeat an id are one document. Null text
has no words; rows without an id keep everything and count for nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.llm import chunks
from wardstat.llm.hashing import slices


def _windows(texts: pa.ChunkedArray | pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each window, first word of each window over all texts, hash of each window)."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    n, doc, first, hashes, base = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    for w in slices(texts):
        at, h = w.windows(w.hashes(), size)
        n.append(w.counts())
        doc.append(w.doc[at] + w.first)
        first.append(at + base)
        hashes.append(h)
        base += len(w.start)
    return np.concatenate(n), np.concatenate(doc), np.concatenate(first), np.concatenate(hashes)


def _answer(plan: chunks.Layout):
    def run(table: pa.Table) -> pa.Table:
        bucket, keys, owner, _ = chunks.gathered(table, plan)
        seen = np.zeros(len(keys), bool)
        seen[1:] = keys[1:] == keys[:-1]        # a chunk before this one holds it
        rows = chunks.answers(bucket, owner, seen, lambda v: np.packbits(v).tobytes())
        return pa.table(rows, pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("answer", pa.binary())]))

    return run


def _remove(size: int, kind: pa.DataType, plan: chunks.Layout):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        rows = rows.sort_by([("id", "ascending")])
        n_words, doc, first, hashes = _windows(rows["text"], size)
        base = np.concatenate([[0], np.cumsum(n_words)])
        cover = np.zeros(base[-1] + 1, np.int64)
        if len(replies) and len(hashes):
            ids = rows["id"].to_numpy()
            unique, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            told = {b: a for b, a in zip(replies["bucket"].to_pylist(), replies["answer"].to_pylist())}
            bits = [np.unpackbits(np.frombuffer(told[b], np.uint8))[: y - x] for b, x, y in plan.bucket_runs(unique)]
            gone = np.concatenate(bits).astype(bool)[inverse] | (ids[doc] > ids[doc[at]][inverse])
            np.add.at(cover, first[gone], 1)
            np.add.at(cover, first[gone] + size, -1)
        covered = np.cumsum(cover[:-1]) > 0
        texts, removed, spans = [], [], []
        for i, text in enumerate(rows["text"]):
            words, lost = (text.as_py() or "").encode().split(), covered[base[i] : base[i + 1]]
            k = int(lost.sum())
            removed.append(k)
            texts.append(b" ".join(compress(words, ~lost) if k else words).decode())
            edges = np.flatnonzero(np.diff(lost, prepend=False, append=False)) if k else ()
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
        return pa.table({"id": rows["id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, span), "text": pa.array(texts, pa.string())})

    return run


def remove_repeats(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 8 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """(id, n_words, n_removed, spans, text): the word intervals [start, end) that go, and the kept words joined by a space."""
    plan = chunks.layout(docs, id_col, text_col, chunk_bytes, bucket_bytes)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), plan.chunk_column(id_col, F.xxhash64(text_col)).alias("chunk"))

    def ask(batches):
        for chunk, piece in chunks.pieces(batches, chunk_bytes):
            if chunk >= 0:
                yield chunks.questions(chunk, np.unique(_windows(piece["text"], size)[3]), plan)

    kind = docs.schema[id_col].dataType
    replies = (rows.mapInArrow(ask, chunks.QUESTION).groupBy("bucket").applyInArrow(_answer(plan), "chunk int, bucket int, answer binary"))
    out = (rows.groupBy("chunk").cogroup(replies.groupBy("chunk"))
           .applyInArrow(_remove(size, kind, plan), f"id {kind.simpleString()}, n_words long, n_removed long, spans array<struct<start:long,end:long>>, text string"))
    return out.withColumnsRenamed({"id": id_col, "text": text_col})
