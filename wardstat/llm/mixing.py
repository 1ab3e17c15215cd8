"""Mixing sources to target weights by hierarchical budgets over a domain-language-source tree.

The budget of the root is handed down in proportion to integer weights. A child that cannot use its share, because all its
documents times ``max_epochs`` have fewer tokens, gets what it can use; what it leaves goes to its siblings first, by
water filling, and only what a whole subtree cannot use reaches the subtree's siblings. A leaf takes whole epochs as long
as its budget lasts, then the longest prefix of the next epoch's seeded order of its documents that fits.

Budgets are integers. The tree is one row a leaf; documents of a leaf are cut by their place in the seeded order into parts of
about ``PART_DOCS``, so that no window holds a whole large leaf: parts are added up first, then documents within a part.

Null names are leaves of their own, called "?". Children without a weight get weight 1, those of weight 0 nothing. Rows
that repeat an id are taken one by one. Rows without words cost nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.session import attach, scratch_path, small_side, stored

PART_DOCS = 5000
WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ["domain", "lang", "source"]


def words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(names: Mapping[str, int], column: str) -> Column:
    out = F.lit(1)
    for name, w in names.items():
        out = F.when(F.col(column) == name, w).otherwise(out)
    return out.cast("long")


def _hand_down(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` (parent, name, w, cap, given: the parent's budget) with ``budget``: water filling among siblings."""
    fill = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), name).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*parent)
    step = (nodes.withColumn("used", F.coalesce(F.sum("cap").over(fill), F.lit(0))).withColumn("rest", F.sum("w").over(every) - F.coalesce(F.sum("w").over(fill), F.lit(0)))
            .withColumn("full", F.col("cap") * F.col("rest") <= (F.col("given") - F.col("used")) * F.col("w")))
    step = (step.withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0)))
            .withColumn("open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(every), F.lit(0))))
    return step.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("((given - taken) * w) div greatest(open, 1)"))).drop("used", "rest", "full", "taken", "open")


def budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], share: tuple[int, int], max_epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, n_docs, n_tokens) with each leaf's ``budget`` of ``share`` of all tokens."""
    cap = leaves.withColumn("cap", F.col("n_tokens") * max_epochs)
    for level in LEVELS:
        cap = cap.withColumn(f"w_{level}", _weight(weights.get(level, {}), level))
    cap = cap.filter("w_domain > 0 and w_lang > 0 and w_source > 0 and cap > 0")
    total = leaves.agg(F.expr(f"cast(sum(n_tokens) as bigint) * {share[0]} div {share[1]}").alias("given"))
    top = cap.groupBy("domain").agg(F.first("w_domain").alias("w"), F.sum("cap").alias("cap"))
    top = _hand_down(attach(top, total).withColumn("root", F.lit(0)), ["root"], "domain").select("domain", F.col("budget").alias("given"))
    mid = cap.groupBy("domain", "lang").agg(F.first("w_lang").alias("w"), F.sum("cap").alias("cap")).join(top, "domain")
    mid = _hand_down(mid, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("given"))
    low = cap.select(*LEVELS, F.col("w_source").alias("w"), "cap").join(mid, ["domain", "lang"])
    return leaves.join(_hand_down(low, ["domain", "lang"], "source").select(*LEVELS, "budget"), LEVELS, "left").fillna(0, ["budget"])


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, int]], share: tuple[int, int] = (1, 1), max_epochs: int = 4, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(id, domain, lang, source, n_tokens, copies): how many epochs take each row; 0 if it is left out.

    ``weights`` has a mapping from name to integer weight for each of "domain", "lang" and "source"; ``share`` is the budget
    as a fraction (numerator, denominator) of the corpus' tokens.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(domain.cast("string"), F.lit("?")).alias("domain"), F.coalesce(F.col(lang).cast("string"), F.lit("?")).alias("lang"),
                       F.coalesce(F.col(source).cast("string"), F.lit("?")).alias("source"), words(text_col).alias("n_tokens"))
    rows = stored(rows, scratch_path(spark, "mix-rows"))
    leaves = rows.groupBy(*LEVELS).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    given = budgets(leaves, weights, share, max_epochs)
    leaf = given.select(*LEVELS, "budget", F.expr("coalesce(budget div nullif(n_tokens, 0), 0)").alias("epochs"),
                        F.expr("coalesce(budget % nullif(n_tokens, 0), 0)").alias("rest"), F.ceil(F.col("n_docs") / PART_DOCS).alias("parts"))
    leaf = stored(leaf, scratch_path(spark, "mix-leaves"))
    placed = rows.join(small_side(leaf), LEVELS).withColumn("place", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    placed = placed.withColumn("part", F.shiftrightunsigned(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * F.col("parts"), 32))
    sums = placed.groupBy(*LEVELS, "part").agg(F.sum("n_tokens").alias("n"))
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = Window.partitionBy(*LEVELS, "part").orderBy("place", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(before, [*LEVELS, "part"]).withColumn("end", F.col("before") + F.sum("n_tokens").over(inside))
    return out.select(F.col("id").cast(kind).alias(id_col), *LEVELS, "n_tokens", (F.col("epochs") + ((F.col("end") <= F.col("rest")) & (F.col("budget") > 0)).cast("long")).alias("copies"))


def stage_settings() -> tuple[Column, dict[str, dict[str, int]]]:
    """The domain of a source and the target weights that the named query and the pipeline use."""
    number = F.regexp_extract("source", r"(\d+)$", 1)
    domain = F.when(number == "", "other").when(number == "0", "web").when(number.cast("long") % 2 == 1, "forum").otherwise("books")
    return domain, {"domain": {"web": 2, "forum": 3, "books": 5}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
