"""Line dedup: drop frequent lines everywhere but in the largest document that holds them.

Line hashes are range-partitioned by (hash, document) and sorted within each range, so a line held by a third of all
documents spreads over many ranges. Each range streams its sorted rows: the first document of a run keeps the line, the
others lose it. A run that touches the edge of its range is decided after the edges' totals are added up. What comes back
is a compressed bitmap of dropped lines for each document, not text.

Null text is one empty line. Rows without an id keep all lines and count for nothing. Rows that repeat an id are one
document; each such row is rewritten by its own text. An empty table gives an empty result. Columns named like the two
added ones are replaced; all others pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.session import scratch_path, small_side, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    lines = (docs.filter(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("body"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line"))).filter(F.char_length("key") >= min_chars))
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "body", "pos")


def _decide(min_docs: int):
    """Streams one range sorted by hash, document (largest first) and position.

    Gives the lines to drop (state 0), and of the first and the last run, which may go on in a neighbouring range, all
    rows (state 1) and one row with its documents and its largest document (state 2, ``pos`` holds the count).
    """
    def starts(t: pa.Table, names: list[str]) -> np.ndarray:
        new = np.zeros(len(t), bool)
        new[0] = True
        for n in names:
            a = t[n].to_numpy()
            new[1:] |= a[1:] != a[:-1]
        return new

    def closed(t: pa.Table) -> pa.Table:
        """Whole runs: all rows outside the run's first document go if the run has enough documents."""
        run, doc = starts(t, ["h1", "h2"]), starts(t, ["h1", "h2", "doc"])
        of, nth = np.cumsum(run) - 1, np.cumsum(doc)
        nth = nth - nth[run][of]
        docs = np.maximum.reduceat(nth, np.flatnonzero(run)) + 1
        return t.filter(pa.array((docs[of] >= min_docs) & (nth > 0)))

    def give(t: pa.Table, state: int) -> Iterator[pa.RecordBatch]:
        yield from t.append_column("state", pa.array(np.full(len(t), state, np.int32))).to_batches()

    def edge(t: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from give(t, 1)
        head = t.slice(0, 1)
        n = int(starts(t, ["doc"]).sum())
        yield from give(head.set_column(head.schema.get_field_index("pos"), "pos", pa.array([n], pa.int32())), 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: list[pa.Table] = []               # the run that is still open at the end of what was read
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            if tail:
                same = pc.and_(pc.equal(t["h1"], tail[-1]["h1"][0]), pc.equal(t["h2"], tail[-1]["h2"][0])).to_numpy()
                n = len(t) if same.all() else int(np.argmin(same))
                tail.append(t.slice(0, n))
                t = t.slice(n)
                if not len(t):
                    continue
                whole = pa.concat_tables(tail)
                yield from edge(whole) if first else give(closed(whole), 0)
                first = False
            cuts = np.flatnonzero(starts(t, ["h1", "h2"]))
            if first and len(cuts) > 1:
                yield from edge(t.slice(0, int(cuts[1])))
                t, cuts, first = t.slice(int(cuts[1])), cuts[1:] - cuts[1], False
            if cuts[-1]:
                yield from give(closed(t.slice(0, int(cuts[-1]))), 0)
            tail = [t.slice(int(cuts[-1]))]
        if tail:
            yield from edge(pa.concat_tables(tail))

    return run


def drop_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, body, dropped): for each document that loses lines a zlib-compressed bitmap, bit i for line i."""
    spark = docs.sparkSession
    rows = _occurrences(docs, id_col, text_col, min_chars)
    rows = stored(rows, scratch_path(spark, "lines"))
    kind = rows.schema["doc"].dataType.simpleString()
    ranged = rows.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", F.desc("doc"), "pos")
    out = ranged.mapInArrow(_decide(min_docs), f"h1 long, h2 long, doc {kind}, body long, pos int, state int")
    out = stored(out, scratch_path(spark, "line-runs"))
    total = (out.filter("state = 2").groupBy("h1", "h2").agg(F.sum("pos").alias("n"), F.max("doc").alias("keeper"))
             .filter(F.col("n") >= min_docs))
    late = (out.filter("state = 1").join(small_side(total), ["h1", "h2"]).filter("doc != keeper").select("doc", "body", "pos"))
    dropped = out.filter("state = 0").select("doc", "body", "pos").union(late)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps = []
            for places in b.column("places"):
                at = places.values.to_numpy()
                bits = np.zeros(int(at.max()) + 1, bool)
                bits[at] = True
                maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("body"), pa.array(maps, pa.binary())], ["doc", "body", "dropped"])

    per_doc = dropped.groupBy("doc", "body").agg(F.collect_list("pos").alias("places"))
    return per_doc.mapInArrow(pack, f"doc {kind}, body long, dropped binary")


def dedupe_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 added: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with the frequent lines taken out of the text, and how many lines there were and went."""
    marks = drop_bitmaps(docs, min_chars, min_docs, id_col, text_col)
    keep = [c for c in docs.columns if c not in added]
    rows = (docs.select(*keep, F.xxhash64(text_col).alias("_body"))
            .join(marks.select(F.col("doc").alias("_doc"), F.col("body").alias("_other"), F.col("dropped").alias("_dropped")),
                  (F.col(id_col) == F.col("_doc")) & (F.col("_body") == F.col("_other")), "left")
            .select(*keep, "_dropped"))
    place = keep.index(text_col)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, mark in zip(b.column(place), b.column(len(keep))):
                text, lost = text.as_py() or "", 0
                if mark.is_valid:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(mark.as_py()), np.uint8), bitorder="little")
                    lines, lost = text.split("\n"), int(bits.sum())
                    n_lines.append(len(lines))
                    gone = np.zeros(len(lines), bool)
                    gone[: len(bits)] = bits[: len(lines)]
                    text = "\n".join([x for x, g in zip(lines, gone.tolist()) if not g])
                else:
                    n_lines.append(text.count("\n") + 1)
                texts.append(text)
                n_dropped.append(lost)
            cols = [b.column(i) for i in range(len(keep))]
            cols[place] = pa.array(texts, b.schema.field(place).type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*keep, *added])

    schema = docs.select(*keep).schema.add(added[0], "long").add(added[1], "long")
    return rows.mapInArrow(rewrite, schema)
