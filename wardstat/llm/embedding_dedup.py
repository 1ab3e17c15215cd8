"""Embedding near-dedup by collision-counting projections.

Vectors are projected on many seeded random directions. On each direction the sorted values are cut into windows, and the
windows of ``DEPTH`` directions together make a cell; a pair at the similarity bound shares a cell in one of ``TABLES`` such
groups with probability 1 - 5e-6. Where two vectors share a cell, their collisions are counted: the directions on which
one lies in the window centred at the other. Pairs with at least the recall-calibrated count are verified by the cosine in
double precision. A pair found in several cells is counted in the first only. Equal vectors of one label are one
representative with a multiplicity, and a cell of many vectors is cut into blocks that meet pairwise; what comes back is a
number of links for each representative and a link to the least one it is connected with, never a list of pairs.

Vectors that are null, zero or hold null or non-finite components, and those without a label, link with nothing; so do
vectors of different lengths. Rows that repeat an id are vectors of their own, counted as each other's links if they are
similar. Rows without an id link like others but belong to no component.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.llm.components import components
from wardstat.session import scratch_path, stored

TABLES, DEPTH, COUNTED = 28, 6, 32
#: Vectors of one block of a cell, and pairs of vectors that are held at once.
BLOCK, AT_ONCE = 2000, 512
RECALL = 1 - 1e-6


def directions(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(directions, offsets): DEPTH of them for each table; seeded by the dimension alone."""
    rng = np.random.default_rng([dim, 2024])
    return rng.standard_normal((dim, TABLES * DEPTH)), rng.random(TABLES * DEPTH)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; a large or tiny row is scaled first, so that its squares stay finite."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def calibration(least: float) -> tuple[float, int]:
    """(half window, count): pairs at cosine ``least`` collide on ``count`` of the counted directions with RECALL."""
    apart = math.sqrt(max(0.0, 2 - 2 * least))
    half = 2.5 * apart
    p, count, tail = math.erf(2.5 / math.sqrt(2)), 0, 0.0
    for c in range(COUNTED + 1):
        tail += math.comb(COUNTED, c) * p**c * (1 - p) ** (COUNTED - c)
        if tail > 1 - RECALL:
            count = c
            break
    return half, count


def cells(units: np.ndarray, least: float) -> np.ndarray:
    """A 64-bit cell of each vector in each table; the cell's width is five times the distance of a pair at ``least``."""
    a, off = directions(units.shape[1])
    width = 5 * math.sqrt(max(1e-12, 2 - 2 * least))
    z = np.floor(units @ a / width + off).astype(np.int64).astype(np.uint64).reshape(len(units), TABLES, DEPTH)
    out = np.arange(TABLES, dtype=np.uint64)[None] + np.zeros((len(units), 1), np.uint64)
    for d in range(DEPTH):
        out = (out ^ z[:, :, d]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def links(a: np.ndarray, b: np.ndarray, least: float, half: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of a, j of b) whose collisions reach ``count`` and whose cosine reaches ``least``."""
    way = directions(a.shape[1])[0][:, :COUNTED]
    p, q, found = a @ way, b @ way, []
    for lo in range(0, len(a), AT_ONCE):
        part = p[lo : lo + AT_ONCE]
        hits = np.zeros((len(part), len(q)), np.int16)
        for m in range(COUNTED):
            hits += np.abs(part[:, m, None] - q[None, :, m]) <= half
        i, j = np.nonzero(hits >= count)
        ok = np.einsum("ij,ij->i", a[lo + i], b[j]) >= least
        found.append((lo + i[ok], j[ok]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _least_connected(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the least node that the pairs connect it with."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _meet(least: float):
    half, count = calibration(least)
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("peer", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        rep, times = table["rep"].to_numpy(), table["times"].to_numpy()
        cell, block, table_no = table["cell"].to_numpy(), table["block"].to_numpy(), table["nr"].to_numpy()
        units = unit(np.stack([np.frombuffer(v, "<f8") for v in table["vector"].to_pylist()]))
        own = cells(units, least)
        order = np.lexsort((rep, block, cell))
        sums, peers = np.zeros(len(rep), np.int64), np.arange(len(rep))
        edges = np.flatnonzero(np.concatenate([[True], cell[order][1:] != cell[order][:-1], [True]]))
        pairs_i, pairs_j = [], []
        for a, b in zip(edges[:-1], edges[1:]):
            at = order[a:b]
            mine = at[block[at] == block[at[0]]]
            other = at[block[at] != block[at[0]]]
            x, y = (mine, other) if len(other) else (mine, mine)
            i, j = links(units[x], units[y], least, half, count)
            i, j = x[i], y[j]
            keep = rep[i] < rep[j] if not len(other) else rep[i] != rep[j]
            i, j = i[keep], j[keep]
            first = np.argmax(own[i] == own[j], 1) == table_no[i]       # counted where they meet first
            pairs_i.append(i[first])
            pairs_j.append(j[first])
        i, j = np.concatenate(pairs_i), np.concatenate(pairs_j)
        np.add.at(sums, i, times[j])
        np.add.at(sums, j, times[i])
        label = _least_connected(len(rep), i, j)
        peers = label
        some = np.flatnonzero(sums > 0)
        return pa.table({"rep": rep[some], "links": sums[some], "peer": rep[peers[some]]}, schema)

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) of each row; rows of one label are linked if their cosine is ``least`` at least."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    as_double = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), as_double.alias("v"))
    good = F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    key = [F.xxhash64("label", "v").alias("k1"), F.xxhash64(F.lit(7), "v", "label").alias("k2")]
    rows = stored(rows.withColumn("ok", F.coalesce(good, F.lit(False))).select("id", "label", "v", "ok", *key), scratch_path(spark, "vectors"))
    reps = rows.filter("ok").groupBy("k1", "k2").agg(F.count("*").alias("times"), F.any_value("v").alias("v"), F.any_value("label").alias("label")).withColumn("rep", F.xxhash64("k1", "k2"))
    reps = stored(reps, scratch_path(spark, "vector-reps"))

    def place(batches):
        for b in batches:
            got = b.column("v")
            sizes = np.diff(got.offsets.to_numpy())
            flat = got.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                mat = flat[starts[at][:, None] + np.arange(dim)]
                seal = b.column("salt").to_numpy()[at].astype(np.uint64)
                cell = (cells(unit(mat), least) ^ (seal * np.uint64(0xD6E8FEB86659FD93))[:, None] ^ np.uint64(int(dim) * 1_000_003)).view(np.int64)
                rep = b.column("rep").to_numpy()[at]
                yield pa.RecordBatch.from_pydict({"rep": np.repeat(rep, TABLES), "nr": np.tile(np.arange(TABLES, dtype=np.int32), len(at)), "cell": cell.ravel()})

    placed = stored(reps.select("rep", "v", F.xxhash64("label").alias("salt")).mapInArrow(place, "rep long, nr int, cell long"), scratch_path(spark, "cells"))
    full = placed.groupBy("nr", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    met = placed.join(full, ["nr", "cell"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # small cells share a task; each pair of blocks of a large cell is a task of its own
    pair = F.xxhash64("cell", F.least("own", "with"), F.greatest("own", "with"))
    met = stored(met.select("rep", "nr", F.when(F.col("blocks") == 1, F.col("cell")).otherwise(pair).alias("cell"), F.col("own").alias("block"), "n", "blocks"), scratch_path(spark, "meetings"))
    tasks = max(1, -(-met.count() // 4000))
    met = met.withColumn("task", F.when(F.col("blocks") == 1, F.pmod("cell", F.lit(tasks))).otherwise(F.col("cell")))
    packed = reps.select("rep", "times", F.col("v").alias("vector"))

    def pack(batches):
        for b in batches:
            raw = [np.asarray(v.values, "<f8").tobytes() for v in b.column("vector")]
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("times"), pa.array(raw, pa.binary())], ["rep", "times", "vector"])

    packed = packed.mapInArrow(pack, "rep long, times long, vector binary")
    # one task's group must have one dimension: vectors of other lengths have other cells, so the length is part of the key
    ready = met.select("rep", "nr", "cell", "block", "task").join(packed, "rep").withColumn("dim", F.octet_length("vector"))
    found = stored(ready.groupBy("task", "dim").applyInArrow(_meet(least), "rep long, links long, peer long"), scratch_path(spark, "vector-links"))
    links_of = found.groupBy("rep").agg(F.sum("links").alias("links"))
    whole = components(found.select(F.col("rep").alias("a"), F.col("peer").alias("b")))
    # representatives are named by a hash: a component's id is the least vector id in it
    named = rows.filter("ok").join(reps.select("k1", "k2", "rep", "times"), ["k1", "k2"]).select("id", "rep", "times")
    named = stored(named.join(whole, F.col("rep") == F.col("node"), "left").join(links_of, "rep", "left")
                   .select("id", F.coalesce("component", "rep").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links")), scratch_path(spark, "vector-components"))
    first = named.groupBy("c").agg(F.min("id").alias("component_id"))
    linked = named.join(first, "c").select("id", "n_links", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
    alone = rows.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(alone)
    return out.select(F.col("id").cast(kind).alias(id_col), F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"),
                      F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
