"""How far the sources of a language differ in their words: hash-consed segment trees, priced pair by pair with a memo.

Terms are counted per (language, source) in one pass over the texts, with map-side sums. The terms a language keeps get a
block and, by falling count, a place in it. In a block every source is a segment tree over the places whose leaves are its
counts. Equal subtrees are one node, whichever sources they belong to; the tail of a block is mostly zeros and ones and
folds into a few nodes. Two sources are compared by walking both trees at once from the roots: what a pair of nodes adds
depends only on the two nodes and the two totals, so every such pair is walked and priced once for all the sources and
places it stands for; a node paired with itself under equal totals adds nothing and is not entered. Blocks of about
``BLOCK`` terms and pairs of chunks of ``CHUNK`` sources are separate groups, so no group grows with the corpus. Sums over
blocks give the divergence.

All arithmetic is in integers: a share is p = 1 + floor(10^9 (count + 2) / (N + 2 V)), the price of two shares is
floor((p - q)^2 / (p + q)).

Defined cases: null text, language and source are empty strings; a group without terms has zero counts; a language without
kept terms has pairs of value 0; repeated rows count as often as they occur; ties of a value go by the item's UTF-8 bytes;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstat.session import cut_lineage, small_side

BLOCK = 2048
CHUNK = 32
SCALE = 1_000_000_000
#: Distinct terms a task holds before it hands them on.
HELD = 250_000
#: Bytes of terms are kept, A-Z as a-z; all others part them.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial (lang, source, term, n, docs) of what a task reads; each group also has a row without a term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = pa.concat_arrays([pa.array(n.keys(), pa.binary()).cast(pa.string()), pa.nulls(1, pa.string())])
            yield pa.RecordBatch.from_pydict({"lang": pa.repeat(lang, len(terms)), "source": pa.repeat(source, len(terms)), "term": terms,
                                              "n": pa.array([*n.values(), 0], pa.int64()), "docs": pa.array([*map(docs.__getitem__, n), 0], pa.int64())})

    for b in batches:
        for i in range(0, b.num_rows, 128):
            part = b.slice(i, 128)
            for lang, source, text in zip(part["lang"].to_pylist(), part["source"].to_pylist(), part["text"].cast(pa.binary()).to_pylist()):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                words = text.translate(TERM_BYTES).split()
                n.update(words)
                docs.update(set(words))
                size += len(n)
                if size > HELD:
                    yield from hand_on()
                    held, size = {}, 0
    yield from hand_on()


def count_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, all_n): occurrences of each kept term in the source and in the language.

    Every group also has a row of the null term. The tasks' sums are dealt by term once; both the sums of a source and
    those of the language are then made where they are.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    dealt = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    of_term = Window.partitionBy("lang", "term")
    counted = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).withColumns({"all_n": F.sum("n").over(of_term), "all_docs": F.sum("docs").over(of_term)})
    return counted.filter(F.col("term").isNull() | (F.col("all_docs") >= min_docs)).select("lang", "source", "term", "n", "all_n")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total), by long division in steps of 1,000 so that nothing leaves 64 bits."""
    if len(totals) and int(totals.max()) >= 2**53:
        return np.array([1 + SCALE * (int(c) + 2) // int(t) for c, t in zip(counts, totals)], np.int64)
    whole, rest = np.divmod(counts + 2, totals)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + digit
    return whole + 1


def consed(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Trees over the rows of ``counts`` (a power of two wide) as shared nodes.

    Returns the counts of the distinct leaves, the (left, right) children of the distinct nodes of each level above, and
    each row's root.
    """
    leaves, ids = np.unique(counts, return_inverse=True)
    ids, known, levels = ids.reshape(counts.shape), len(leaves), []
    while ids.shape[1] > 1:
        nodes, upper = np.unique(ids[:, 0::2] * known + ids[:, 1::2], return_inverse=True)
        levels.append((nodes // known, nodes % known))
        ids, known = upper.reshape(len(ids), -1), len(nodes)
    return leaves, levels, ids[:, 0]


def divergences(counts: np.ndarray, totals: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sum of the prices over all columns for the row pairs (first, second). Negative counts are places without a term."""
    leaves, levels, roots = consed(counts)
    total, kind = np.unique(totals, return_inverse=True)
    sizes = [len(leaves), *(len(a) for a, _ in levels)]
    x, y = kind[first] * sizes[-1] + roots[first], kind[second] * sizes[-1] + roots[second]
    memo = []
    for depth in range(len(levels), -1, -1):
        n = sizes[depth]
        low, high = np.minimum(x, y), np.maximum(x, y)          # the price is symmetric
        live = low != high
        pairs, which = np.unique(low[live] * (len(total) * n) + high[live], return_inverse=True)
        memo.append((live, which))
        low, high = np.divmod(pairs, len(total) * n)
        if depth:
            left, right = levels[depth - 1]
            under = lambda key, child: key // n * sizes[depth - 1] + child[key % n]  # noqa: E731, B023
            x, y = np.concatenate([under(low, left), under(low, right)]), np.concatenate([under(high, left), under(high, right)])
    absent = (leaves[low % n] < 0) | (leaves[high % n] < 0)     # a place without a term has none in any row
    p, q = (shares(np.maximum(leaves[k % n], 0), total[k // n]) if len(k) else k for k in (low, high))
    price = np.where(absent, 0, (p - q) * (p - q) // np.maximum(p + q, 1))
    for depth, (live, which) in enumerate(reversed(memo)):
        if depth:
            price = price[: len(price) // 2] + price[len(price) // 2 :]
        out = np.zeros(len(live), np.int64)
        out[live] = price[which]
        price = out
    return price


def _price(rows: pa.Table) -> pa.Table:
    """Block sums of all source pairs between two chunks. One row a source: number, total, size of the block, counts."""
    rows = rows.sort_by("number")
    number, chunk, size = rows["number"].to_numpy(), rows["chunk"].to_numpy(), rows["size"][0].as_py()
    width = 1 << max(0, size - 1).bit_length()
    counts = np.zeros((len(number), width), np.int64)
    counts[:, size:] = -1
    lists = rows["places"].combine_chunks(), rows["counts"].combine_chunks()
    owner = np.repeat(np.arange(len(number)), lists[0].value_lengths().fill_null(0).to_numpy())
    counts[owner, lists[0].flatten().to_numpy()] = lists[1].flatten().to_numpy()
    i, j = np.triu_indices(len(number), 1)
    wanted = (chunk[i] == rows["low"][0].as_py()) & (chunk[j] == rows["high"][0].as_py())
    i, j = i[wanted], j[wanted]
    value = divergences(counts, rows["total"].to_numpy(), i, j)
    return pa.table({"lang": pa.repeat(rows["lang"][0], len(i)), "a": number[i], "b": number[j], "value": value}, pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())]))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (lang, source, text).

    ``pair`` rows compare a source with every other source of its language over all kept terms, those in at least
    ``min_docs`` of the language's documents; ``term`` rows are the ``top`` terms whose share in the source exceeds the
    language's by the highest price. Rank 1 is the highest value.
    """
    counted = cut_lineage(count_terms(docs, min_docs))
    kept = counted.filter("term is not null").groupBy("lang", "term").agg(F.first("all_n").alias("all_n"))
    langs = counted.select("lang").distinct().join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("all_total")), "lang", "left").fillna(0, ["v", "all_total"])
    langs = langs.withColumns({"blocks": F.greatest(F.lit(1), F.ceil(F.col("v") / BLOCK)).cast("int"), "all_total": F.col("all_total") + 2 * F.col("v")})
    langs = small_side(langs)
    placed = kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("place", F.row_number().over(Window.partitionBy("lang", "block").orderBy(F.desc("all_n"), "term")) - 1)
    placed = cut_lineage(placed.select("lang", "term", "all_n", "all_total", "block", "place"))
    counts = cut_lineage(counted.drop("all_n").join(placed, ["lang", "term"]).select("lang", "source", "term", "n", "all_n", "all_total", "block", "place"))

    groups = counted.select("lang", "source").distinct().join(counts.groupBy("lang", "source").agg(F.sum("n").alias("own")), ["lang", "source"], "left").join(langs, "lang")
    in_order = Window.partitionBy("lang").orderBy("source")
    groups = groups.select("lang", "source", "blocks", (F.coalesce("own", F.lit(0)) + 2 * F.col("v")).alias("total"), (F.row_number().over(in_order) - 1).alias("number"))
    groups = cut_lineage(groups.withColumn("chunk", F.floor(F.col("number") / CHUNK).cast("int")))

    # every source in every block, with its counts there
    there = counts.groupBy("lang", "source", "block").agg(F.collect_list("place").alias("places"), F.collect_list("n").alias("counts"))
    sizes = placed.groupBy("lang", "block").agg(F.count("*").cast("int").alias("size"))
    chunks = groups.groupBy("lang").agg((F.max("chunk") + 1).alias("chunks"))
    trees = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(there, ["lang", "source", "block"], "left").join(sizes, ["lang", "block"], "left").join(small_side(chunks), "lang")
    meets = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(F.least(o, "chunk").alias("low"), F.greatest(o, "chunk").alias("high")))
    trees = trees.select("lang", "block", "number", "chunk", F.greatest("total", F.lit(1)).alias("total"), F.coalesce("size", F.lit(0)).alias("size"), "places", "counts", F.inline(meets))
    pairs = trees.groupBy("lang", "block", "low", "high").applyInArrow(_price, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("number"), F.col("b").alias("other")), F.struct(F.col("b").alias("number"), F.col("a").alias("other"))))
    names = small_side(groups.select("lang", "number", "source"))
    pairs = (pairs.select("lang", "value", sides.alias("side")).select("lang", "value", "side.*").join(names, ["lang", "number"])
             .join(names.withColumnsRenamed({"number": "other", "source": "item"}), ["lang", "other"]))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

    share = lambda n, total: F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + 2 as decimal(19,0))) div cast({total} as decimal(19,0))")
    terms = counts.filter("n > 0").join(small_side(groups.select("lang", "source", "total")), ["lang", "source"]).withColumns({"p": share("n", "total"), "q": share("all_n", "all_total")}).filter("p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)
