"""MinHash near-dedup by an inverted join on signature coordinates.

A document is the set of its distinct word shingles (A-Z lower-cased; a shorter text is one shingle). Documents with equal
sets form a class and only its smallest id goes on. Each class is posted under its (coordinate, value) pairs. Two sets that
share ``match`` of the coordinates meet in a prefix: of the pairs that are not alone, the ``L - match + 1`` rarest, in one
global order; so very common values are never joined on. The classes of a posting meet at the posting's head, the class
with most shared pairs. There collisions are counted against one class after the other, skipping classes that are
connected already or cannot reach the similarity by size and shared shingles, and pairs above ``match`` are confirmed on
full sets. Only a spanning forest of the confirmed links comes back, so no group is expanded into all its pairs, and every
pair that passes ``match`` and the similarity is connected. A head with much text is cut into blocks that meet pairwise.

The matches asked for follow from the similarity: a pair right at it is missed with probability ``MISS`` at most. Of 64
coordinates that is 42 matches at 0.85 (missed with probability 3.0e-5) and 37 at 0.80 (1.4e-5).

Null and empty texts have no shingles and link with nothing. Rows without an id have no component and are kept. Rows that
repeat an id are one node: what any of them links to is connected. An empty table gives an empty result.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.llm.components import components
from wardstat.llm.hashing import mix, slices
from wardstat.session import scratch_path, stored

COORDINATES, MISS = 64, 3e-5
#: Text that meets in one task.
BLOCK_BYTES = 8 << 20
_A = mix(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(11)) | np.uint64(1)
_B = mix(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(7777))


def matches_for(percent: int, miss: float = MISS) -> int:
    """The most matches to ask for such that a pair at this similarity has fewer with probability ``miss`` at most."""
    p, tail = percent / 100, 0.0
    for match in range(COORDINATES + 1):
        tail += comb(COORDINATES, match) * p**match * (1 - p) ** (COORDINATES - match)
        if tail > miss:
            return max(1, match)
    return COORDINATES


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): the sorted distinct shingle hashes of each text, one after the other."""
    values, counts = [np.zeros(0, np.uint64)], []
    for w in slices(texts):
        h = w.hashes(lower=True)
        at, s = w.windows(h, size)
        bounds = np.searchsorted(w.doc[at], np.arange(w.docs + 1))
        words = np.concatenate([[0], np.cumsum(w.counts())])
        for d in range(w.docs):
            own = s[bounds[d] : bounds[d + 1]]
            if not len(own) and words[d + 1] > words[d]:
                acc = np.uint64(0)
                with np.errstate(over="ignore"):
                    for x in h[words[d] : words[d + 1]]:
                        acc = mix(np.array([acc + x]))[0]
                own = np.array([acc], np.uint64)
            own = np.unique(own)
            values.append(own)
            counts.append(len(own))
    return np.concatenate(values), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of 32-bit minima for each set that isn't empty."""
    heads = offsets[:-1][np.diff(offsets) > 0]
    out = np.zeros((len(heads), COORDINATES), np.uint32)
    for lo in range(0, len(heads), 256):                # so that the scratch array stays in the cache
        part = heads[lo : lo + 256]
        end = heads[lo + 256] if lo + 256 < len(heads) else len(values)
        block = values[part[0] : end]
        for k in range(COORDINATES):
            out[lo : lo + 256, k] = np.minimum.reduceat(((block * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), part - part[0])
    return out


def sketches(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, k1, k2, tokens) of each row: set size, a 128-bit key of the set, and its (coordinate, value) pairs as hashes."""
    coordinate = mix(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(55))

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                b = whole.slice(i, 1024)
                values, offsets = shingle_sets(b.column("t"), size)
                n = np.diff(offsets)
                full = np.flatnonzero(n)
                k1, k2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                tokens = [None] * len(n)
                if len(full):
                    k1[full], k2[full] = np.add.reduceat(mix(values), offsets[full]), np.add.reduceat(mix(values ^ np.uint64(0xABCDEF)), offsets[full])
                    made = mix(signatures(values, offsets).astype(np.uint64) ^ coordinate).view(np.int64)
                    for row, d in zip(made, full):
                        tokens[d] = row
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(tokens, pa.list_(pa.int64()))], ["id", "n", "k1", "k2", "tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, n long, k1 long, k2 long, tokens array<long>")


def meetings(classes: DataFrame, match: int) -> DataFrame:
    """Distinct (head, rep): for each posting of the prefix index its head, and the classes posted there."""
    tokens = classes.select("rep", F.explode("tokens").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("f")).filter("f > 1")
    own = tokens.join(often, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("held")).withColumn("l", F.size("held"))
    prefix = stored(own.filter(F.col("l") >= match).select("rep", "l", F.explode(F.slice("held", F.lit(1), F.col("l") - match + 1)).alias("p")).select("rep", "l", "p.token"), scratch_path(classes.sparkSession, "postings"))
    heads = prefix.groupBy("token").agg(F.max(F.struct("l", -F.col("rep"))).alias("top"), F.count("*").alias("f")).filter("f > 1").select("token", (-F.col("top")["col2"]).alias("head"))
    met = prefix.join(heads, "token").select("head", "rep").distinct()
    # a head that met nobody else has nothing to confirm
    return met.join(met.filter("head != rep").select("head").distinct(), "head", "left_semi")


def linked(ids: np.ndarray, values: np.ndarray, offsets: np.ndarray, percent: int, match: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of these sets with ``match`` equal coordinates and the similarity at least."""
    n = np.diff(offsets)
    _, code, held = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(n)), n)
    shared = np.add.reduceat(np.append(held[code] > 1, 0), offsets[:-1]).astype(np.int64) if len(values) else n
    order, starts = np.argsort(code, kind="stable"), np.concatenate([[0], np.cumsum(held)])
    posted, sig = owner[order], signatures(values, offsets)
    group, left, forest = np.arange(len(n)), np.ones(len(n), bool), []
    for p in np.argsort(-shared / n, kind="stable"):
        left[p] = False
        # the intersection cannot exceed either set's shingles that others have
        able = left & (group != group[p])
        able &= (100 + percent) * np.minimum(shared, shared[p]) >= percent * (n + n[p])
        maybe = np.flatnonzero(able)
        maybe = maybe[(sig[maybe] == sig[p]).sum(1) >= match]
        if len(maybe):
            lists = [posted[starts[c] : starts[c + 1]] for c in code[offsets[p] : offsets[p + 1]]]
            both = np.bincount(np.concatenate(lists), minlength=len(n))[maybe]
            for q in maybe[(100 + percent) * both >= percent * (n[maybe] + n[p])]:
                if group[q] != group[p]:
                    forest.append((int(ids[p]), int(ids[q])))
                    group[group == group[q]] = group[p]
    return forest


def confirm(met: DataFrame, docs: DataFrame, size: int, percent: int, match: int, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(a, b): links among the classes that met at a head, confirmed on the full sets of their texts."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("t"))
    rows = stored(texts.join(met.select("rep").distinct(), "rep", "left_semi").dropDuplicates(["rep", "t"]), scratch_path(docs.sparkSession, "met-texts"))
    sizes = met.join(rows.select("rep", F.octet_length("t").alias("b")), "rep").groupBy("head").agg(F.ceil(F.sum("b") / block_bytes).cast("int").alias("blocks"))
    placed = met.join(sizes.filter("blocks > 0"), "head").withColumn("i", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # block i meets itself and every other block once
    placed = placed.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("head", "rep", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))

    def run(table: pa.Table) -> pa.Table:
        values, offsets = shingle_sets(table["t"].combine_chunks(), size)
        full = np.flatnonzero(np.diff(offsets))
        pairs = linked(table["rep"].to_numpy()[full], values, np.append(offsets[full], offsets[-1]), percent, match) if len(full) > 1 else []
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    return placed.join(rows, "rep").groupBy("head", "i", "j").applyInArrow(run, "a long, b long").select(F.col("a").cast(kind), F.col("b").cast(kind))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 85, match: int | None = None, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row; documents whose similarity reaches ``percent`` are linked."""
    spark, match = docs.sparkSession, matches_for(percent) if match is None else match
    base = stored(sketches(docs, size, id_col, text_col), scratch_path(spark, "sketches"))
    keyed = base.filter("id is not null and n > 0")
    classes = stored(keyed.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep"), F.any_value("tokens").alias("tokens")), scratch_path(spark, "classes"))
    edges = confirm(meetings(classes, match), docs, size, percent, match, id_col, text_col, block_bytes)
    member = keyed.select("id", "k1", "k2", "n").join(classes.select("k1", "k2", "n", "rep"), ["k1", "k2", "n"]).select("id", "rep")
    whole = components(edges.union(member.filter("id != rep")))
    return (base.select("id", "n").join(whole, F.col("id") == F.col("node"), "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True))))
