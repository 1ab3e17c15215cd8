"""A Merkle manifest of a corpus: leaf coordinates from bitmap ranks, levels reduced in keyed slot arrays.

Every row is a leaf, the hash of its fields; the leaves of a language ascend by doc_id, runs of ``FAN`` nodes become their
hash until one node, the subroot, is left, and the subroots, by language, become the root in the same way.

Nothing is sorted as a whole. The ids of each language are a bitmap of 64-bit words, of which only the non-zero ones exist;
map-side partial bitmaps are merged with ``bit_or``. A directory holds the popcounts of 2^10 words, of 2^10 of those, and
so on; an id's rank is what stands before its word in the directory plus the popcount below its bit. The rank is the leaf's
coordinate: its upper digits name the block of ``FAN``^3 slots in which it meets its neighbours, the lower ones its slot.
A block reduces three levels at once; its digest is a node of the next round. Blocks and directory nodes are bounded, so no
language, however large, is one task, and each round shuffles a 512th of the one before.

Ids must be integers. Defined cases: a null id counts as the least 64-bit integer; a null language is a group of its own
and comes first; rows that share language and id ascend by leaf hash; repeated rows are leaves of their own; null fields
are hashed as ``-``, empty ones as ``0:``. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.operators.sequences import ordered
from wardstat.session import cut_lineage

FAN = 8
BLOCK_BITS = 9                                              # FAN ** 3 slots
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIRECTORY_BITS = 10
LEAST = -(2**63)
EMPTY_PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_hash(fields: list[Column]) -> Column:
    """Hash of the fields, each with its UTF-8 length so that no two rows have the same input."""
    def one(c: Column) -> Column:
        c = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))

    return digest(F.concat(*(one(c) for c in fields)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up lead to."""
    return F.aggregate(path, leaf, lambda node, at: digest(F.concat(at["left"], node, at["right"])))


def proof_text(path: Column) -> Column:
    """All siblings from the leaf's level to the root's, left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), "")


def _leaves(docs: DataFrame, changed: Column | None) -> DataFrame:
    """(lk, k, doc_id, leaf, other, copies): distinct leaves of each id; ``other`` is the leaf of the changed text."""
    fields = [F.col(c) for c in FIELDS]
    other = F.lit(None).cast("string") if changed is None else leaf_hash([*fields[:-1], changed])
    if changed is not None:
        other = F.when(changed.isNotNull(), other)
    rows = docs.select(F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang").cast("string"))).alias("lk"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("k"), F.col("doc_id"), leaf_hash(fields).alias("leaf"), other.alias("other"))
    return rows.groupBy("lk", "k", "doc_id", "leaf", "other").agg(F.count("*").alias("copies"))


def bitmaps(ids: DataFrame) -> DataFrame:
    """(lk, word, bits, extra, n) of (lk, k, copies): bit k mod 64 of word k div 64 is set; ``extra`` are further copies."""
    each = ids.groupBy("lk", "k").agg(F.sum("copies").alias("n"))
    bit = F.col("k").bitwiseAND(F.lit(63)).cast("int")
    return (each.withColumns({"word": F.shiftright("k", 6), "bit": bit})
            .groupBy("lk", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.collect_list(F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more")))).alias("extra"), F.sum("n").alias("n")))


def with_offsets(words: DataFrame) -> DataFrame:
    """Add ``start``: how many rows of the language stand before each word, from the popcount directory.

    Level by level, counts of at most 2^10 children are added up under their parent, then what stands before a parent is
    passed down. The number of levels follows the range of the words.
    """
    ends = words.agg(F.min("word").alias("a"), F.max("word").alias("b")).first()
    levels = [words.select("lk", F.col("word").alias("w"), "n")]
    top = lambda w: w >> DIRECTORY_BITS * (len(levels) - 1)
    while ends.a is not None and top(ends.a) != top(ends.b) and (top(ends.a), top(ends.b)) != (-1, 0):
        levels.append(cut_lineage(levels[-1].groupBy("lk", F.shiftright("w", DIRECTORY_BITS).alias("w")).agg(F.sum("n").alias("n"))))
    # one node a language, or one for negative ids and one for the others
    first = Window.partitionBy("lk").orderBy("w").rowsBetween(Window.unboundedPreceding, -1)
    start = levels[-1].select("lk", "w", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("start"))
    for level in reversed(levels[:-1]):
        before = Window.partitionBy("lk", "up").orderBy("w").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("up", F.shiftright("w", DIRECTORY_BITS)).withColumn("own", F.coalesce(F.sum("n").over(before), F.lit(0)))
        start = cut_lineage(level.join(start.select("lk", F.col("w").alias("up"), "start"), ["lk", "up"]).select("lk", "w", (F.col("start") + F.col("own")).alias("start")))
    return words.join(start.withColumnRenamed("w", "word"), ["lk", "word"])


def ranked(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with their coordinate ``pos`` in the language, one row each, and (lk, total)."""
    words = cut_lineage(bitmaps(leaves))
    below = F.expr("bits & ~shiftleft(-1L, cast(k & 63 as int))")
    at = F.col("k").bitwiseAND(F.lit(63))
    extra = F.aggregate(F.filter("extra", lambda x: x["bit"] < at), F.lit(0).cast("long"), lambda s, x: s + x["more"])
    placed = leaves.withColumn("word", F.shiftright("k", 6)).join(with_offsets(words), ["lk", "word"])
    placed = placed.withColumns({"pos": F.col("start") + F.bit_count(below) + extra, "shared": F.exists("extra", lambda x: x["bit"] == at)})
    placed = placed.select("lk", "k", "doc_id", "leaf", "other", "copies", "pos", "shared")
    alone = placed.filter(~F.col("shared")).select("lk", "pos", "doc_id", "leaf", "other")
    # rows of one id, by leaf hash; the hash's first digits cut an id that many rows share into chunks
    many = ordered(placed.filter("shared").withColumn("chunk", F.substring("leaf", 1, 3)), ["lk", "k"], "chunk", ["leaf"], running=["copies"])
    many = many.select("lk", F.explode(F.sequence(F.col("pos") + F.col("run_copies") - F.col("copies"), F.col("pos") + F.col("run_copies") - 1)).alias("pos"), "doc_id", "leaf", "other")
    return alone.unionByName(many), words.groupBy("lk").agg(F.sum("n").alias("total"))


def _runs(nodes: Column) -> Column:
    """The next level of a block: each run of FAN nodes becomes its hash."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) + (FAN - 1)) / FAN).cast("int") - 1), lambda i: digest(F.array_join(F.slice(nodes, i * FAN + 1, FAN), "")))


def _blocks(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Slot arrays of (key, pos, node, total, payload): one row a block with its nodes and the two levels above them."""
    nodes = nodes.withColumn("block", F.shiftright("pos", BLOCK_BITS))
    slots = nodes.groupBy("key", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "node", *payload))).alias("slots"), F.first("total").alias("total"))
    steps = F.when(F.col("total") <= 1, 0).when(F.col("total") <= FAN, 1).when(F.col("total") <= FAN**2, 2).otherwise(3)
    out = slots.withColumns({"steps": steps, "l0": F.col("slots.node")})
    for i in (1, 2, 3):
        out = out.withColumn(f"l{i}", F.when(F.col("steps") >= i, _runs(F.col(f"l{i - 1}"))).otherwise(F.col(f"l{i - 1}")))
    return cut_lineage(out.withColumn("top", F.col("l3")[0]).drop("l3"))


def _own_path(j: Column) -> Column:
    """Siblings of slot ``j`` on the levels inside its block."""
    def level(i: int) -> Column:
        nodes, at = F.col(f"l{i}"), F.shiftright(j, 3 * i)
        slot = F.pmod(at, F.lit(FAN))
        side = F.struct(F.array_join(F.slice(nodes, at - slot + 1, slot), "").alias("left"), F.array_join(F.slice(nodes, at + 2, F.lit(FAN - 1) - slot), "").alias("right"))
        return F.when(F.col("steps") > i, F.array(side)).otherwise(F.array().cast(EMPTY_PATH))

    return F.concat(*(level(i) for i in range(3)))


def reduce_levels(nodes: DataFrame, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Reduce (key, pos, node, total, payload) to one node a key: (the blocks of each round, (key, node))."""
    rounds = []
    size = nodes.agg(F.max("total")).first()[0] or 1
    while not rounds or size > 1:
        rounds.append(_blocks(nodes, payload if not rounds else []))
        nodes = rounds[-1].select("key", F.col("block").alias("pos"), F.col("top").alias("node"), F.ceil(F.col("total") / F.lit(1 << BLOCK_BITS)).alias("total"))
        size = -(-size >> BLOCK_BITS)
    return rounds, nodes.select("key", "node")


def paths(rounds: list[DataFrame], above: DataFrame, payload: list[str]) -> DataFrame:
    """Payload of each first-round node with its ``path`` of siblings, ``above`` (key, path, ...) appended to it."""
    kept = [c for c in above.columns if c not in ("key", "path")]
    upper = above.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        own = F.transform("slots", lambda slot, j: F.struct(slot.alias("slot"), F.concat(_own_path(j), F.col("path")).alias("path")))
        each = blocks.join(upper, ["key", "block"]).select("key", *kept, F.inline(own))
        upper = each.select("key", *kept, F.col("slot.pos").alias("block"), "path", *([F.col(f"slot.{c}") for c in ["node", *payload]] if blocks is rounds[0] else []))
    return upper.drop("block")


def manifest(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """(doc_id, leaf, other, subroot, root, path) of every row of ``docs`` (doc_id, source, lang, n_chars, text).

    ``path`` holds the siblings on each level up to the root. ``other`` is the leaf the row would have with the text
    ``changed``, null where that is null: a proof against tampering needs the original path and this leaf.
    """
    leaves = cut_lineage(_leaves(docs, changed))
    rows, totals = ranked(leaves)
    nodes = rows.join(totals, "lk").select(F.col("lk").alias("key"), "pos", F.col("leaf").alias("node"), "total", "doc_id", "other")
    groups, subroots = reduce_levels(nodes, ["doc_id", "other"])
    subroots = subroots.select(F.substring("key", 1, 0).alias("all"), F.substring("key", 1, 4).alias("chunk"), F.col("key").alias("lk"), "node", F.lit(1).alias("one"))
    tops = ordered(subroots, ["all"], "chunk", ["lk"], running=["one"])
    tops = tops.join(subroots.groupBy("all").agg(F.count("*").alias("total")), "all").select(F.col("all").alias("key"), (F.col("run_one") - 1).alias("pos"), "node", "total", "lk")
    top_rounds, root = reduce_levels(tops, ["lk"])
    above = root.select("key", F.col("node").alias("root"), F.array().cast(EMPTY_PATH).alias("path"))
    langs = paths(top_rounds, above, ["lk"]).select(F.col("lk").alias("key"), "path", "root", F.col("node").alias("subroot"))
    return paths(groups, cut_lineage(langs), ["doc_id", "other"]).select("doc_id", F.col("node").alias("leaf"), "other", "subroot", "root", "path")
