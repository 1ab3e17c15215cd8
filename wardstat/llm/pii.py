"""Personal data: fixed forms as seeds, and unseen identifiers found by the words around them.

Seeds are the matches of four fixed forms that pass their checks. Every identifier, a seed or a looser form (an address
without a domain, hexadecimal groups, a number of 7 to 19 digits written in any way), is a node; so is every lexical
pattern, the one or two words before an identifier or the words on both sides. An edge says that the identifier was seen in
the pattern in some text. In rounds, a pattern's confidence is the weight of the identifiers known so far over all it was
seen with; an identifier seen in confident patterns becomes known, with the odds of all of them, and counts for its other
patterns in the next round. Where an identifier is known, all its occurrences are spans. Matches that fail a check (a
card number of the right length with a wrong check digit) count against their patterns and are never spans.

All of it is column functions and joins. The texts are read once; their matches are written to the shared folder, and what
is joined are identifiers and patterns, not texts. Edges are distinct, so copies of a text count once, and frequent patterns
are added up map-side. No round looks at a single group as a whole.

The patterns below are the plain forms written so that they can't backtrack: runs are possessive, and a run is entered at
its first character or at the end of the last match only, so a megabyte without a match is read once. Positions are code
points.

Defined cases: null text is empty and has no spans; texts of any length are read whole; repeated rows get equal spans; the
context of a match is what stands between it and the last or next match of its kind, ``CONTEXT`` code points at most;
overlapping looser forms are dropped; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL, _AT = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]", "[^\\s@<>(),;:\"'|]"
FORMS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = (rf"(?:(?<!{_AT})|\G){_AT}++@{_AT}+(?<![.!?])|(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{{0,4}}+:){{2,7}}+[0-9A-Fa-f]{{1,4}}+(?![0-9A-Fa-f:.])"
         r"|(?<![0-9])\(?[0-9](?:[\x20()./-]{0,2}+[0-9])++")
#: A text without this has no match of the form.
NEEDS = {"email": "@", "phone": "+"}
DIGIT_PAIR = r"[0-9][\x20()./-]{0,2}[0-9]"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

CONTEXT = 64
#: Confidence that a pattern and an identifier need; weight of an identifier not known yet; weight of doubt in each pattern.
CONFIDENT, UNKNOWN, DOUBT = 0.75, 0.1, 2.0
ROUNDS = 8
_STEP = 512


def _digits(form: Column) -> Column:
    return F.regexp_replace(form, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(turned, i + 1, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def passes(kind: str, form: Column) -> Column:
    if kind == "ip":
        return form.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(form)).between(16, 19), luhn(_digits(form))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(form)).between(8, 15)
    return F.lit(True)


def _before(lengths: str) -> tuple[Column, Column]:
    """Sum of all earlier elements for each element of an array column, in two levels of ``_STEP``.

    The first column has to be computed as ``_inner`` before the second is.
    """
    grow = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _STEP).cast("int"))
    inner = F.transform(blocks, lambda b: F.aggregate(F.slice(lengths, b * _STEP + 1, _STEP), F.array(F.lit(0)), grow))
    base = F.aggregate("_inner", F.array(F.lit(0)), lambda acc, blk: grow(acc, F.element_at(blk, -1)))
    starts = F.flatten(F.transform(F.arrays_zip("_inner", F.slice(base, 1, F.size("_inner")).alias("base")), lambda z: F.transform(F.slice(z["_inner"], 1, F.size(z["_inner"]) - 1), lambda x: x + z["base"])))
    return F.when(F.size(lengths) > 0, inner).otherwise(F.array().cast("array<array<int>>")), starts


def with_matches(texts: DataFrame, name: str, pattern: str, guard: Column) -> DataFrame:
    """Add ``name``: the matches of a pattern in column ``t`` as (form, start, end, left, right), in order."""
    kept = texts.columns
    none = F.array().cast("array<string>")
    df = texts.withColumn("_found", F.when(guard, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_parts", F.when(F.size("_found") > 0, F.split("t", pattern, -1)).otherwise(none))
    df = df.withColumn("_len", F.zip_with(F.slice("_parts", 1, F.size("_found")), "_found", lambda p, f: F.length(p) + F.length(f)))
    inner, starts = _before("_len")
    df = df.withColumn("_inner", inner).withColumn("_at", starts)

    def match(i: Column) -> Column:
        form, part = F.get("_found", i), F.get("_parts", i)
        start = F.get("_at", i) + F.length(part)
        return F.struct(form.alias("form"), start.alias("start"), (start + F.length(form)).alias("end"), F.right(part, F.lit(CONTEXT)).alias("left"), F.left(F.get("_parts", i + 1), F.lit(CONTEXT)).alias("right"))

    shape = "array<struct<form:string,start:int,end:int,left:string,right:string>>"
    out = F.when(F.size("_found") > 0, F.transform(F.sequence(F.lit(0), F.size("_found") - 1), match)).otherwise(F.array().cast(shape))
    return df.withColumn(name, out).select(*kept, name)


def matched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, email, ip, card, phone, loose): all matches of each text; rows without digits or ``@`` skip the patterns."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    df = df.withColumn("_numeric", F.col("t").rlike(DIGIT_PAIR))
    for kind in KINDS:
        df = with_matches(df, kind, FORMS[kind], F.contains("t", F.lit(NEEDS[kind])) if kind in NEEDS else F.col("_numeric"))
    df = with_matches(df, "loose", LOOSE, F.col("_numeric") | F.contains("t", F.lit("@")) | F.contains("t", F.lit("::")))
    return df.withColumn("key", F.sha2("t", 256)).drop("t", "_numeric")


def _identity(kind: Column, form: Column) -> Column:
    return F.when(kind.isin("card", "phone"), _digits(form)).otherwise(F.lower(form))


def occurrences(found: DataFrame) -> DataFrame:
    """(key, kind, start, end, identity, left, right, state) of each distinct text's matches.

    ``state`` is 1 for a seed, 0 for a match that fails its check, null for a looser form that no such match overlaps.
    """
    def fixed(kind: str) -> Column:
        failed_matters = {"card": lambda m: F.length(_digits(m["form"])).between(16, 19)}.get(kind, lambda m: F.lit(True))
        return F.transform(F.filter(kind, failed_matters), lambda m: F.struct(F.array(F.lit(kind)).alias("kinds"), m["form"].alias("form"), m["start"].alias("start"), m["end"].alias("end"), m["left"].alias("left"), m["right"].alias("right"), passes(kind, m["form"]).cast("int").alias("state")))

    def looser(m: Column) -> Column:
        n = F.length(_digits(m["form"]))
        number = F.concat(F.when(n.between(12, 19), F.array(F.lit("card"))).otherwise(F.array().cast("array<string>")), F.when(n.between(7, 15), F.array(F.lit("phone"))).otherwise(F.array().cast("array<string>")))
        kinds = F.when(F.contains(m["form"], F.lit("@")), F.array(F.lit("email"))).when(F.contains(m["form"], F.lit(":")), F.array(F.lit("ip"))).otherwise(number)
        return F.struct(kinds.alias("kinds"), m["form"].alias("form"), m["start"].alias("start"), m["end"].alias("end"), m["left"].alias("left"), m["right"].alias("right"), F.lit(None).cast("int").alias("state"))

    each = F.concat(*(fixed(k) for k in KINDS), F.filter(F.transform("loose", looser), lambda m: F.size(m["kinds"]) > 0))
    rows = found.withColumn("each", each).filter(F.size("each") > 0).select("key", F.inline("each")).distinct()
    earlier, later = (Window.partitionBy("key").orderBy(*o).rowsBetween(Window.unboundedPreceding, -1) for o in ((F.col("start"), F.col("end"), F.col("state").asc_nulls_last()), (F.desc("start"), F.desc("end"))))
    held = F.max(F.when(F.col("state").isNotNull(), F.col("end"))).over(earlier)
    ahead = F.min(F.when(F.col("state").isNotNull(), F.col("start"))).over(later)
    rows = rows.withColumns({"_held": held, "_ahead": ahead})
    free = F.col("state").isNotNull() | ((F.coalesce("_held", F.lit(0)) <= F.col("start")) & (F.coalesce("_ahead", F.col("end")) >= F.col("end")))
    rows = rows.filter(free).select("key", F.explode("kinds").alias("kind"), "form", "start", "end", "left", "right", "state")
    return rows.withColumn("identity", _identity(F.col("kind"), F.col("form"))).drop("form")


def edges(seen: DataFrame) -> DataFrame:
    """Distinct (kind, pattern, identity, state). Patterns: last word, last two words, words on both sides."""
    words = lambda c: F.split(F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[0-9]", "0"), r"\s+", " ")), " ")
    df = seen.withColumns({"l": F.filter(words("left"), lambda w: w != ""), "r": F.filter(words("right"), lambda w: w != "")})
    last, first = F.try_element_at("l", F.lit(-1)), F.get("r", 0)
    patterns = F.array(F.concat(F.lit("1 "), last), F.concat(F.lit("2 "), F.try_element_at("l", F.lit(-2)), F.lit(" "), last), F.concat(F.lit("B "), last, F.lit(" "), first))
    df = df.select("kind", "identity", "state", F.explode(patterns).alias("pattern")).filter("pattern is not null")
    return df.groupBy("kind", "pattern", "identity").agg(F.max("state").alias("state"))


def confident_patterns(graph: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, pattern, confidence) of the patterns that are confident, given (kind, identity, weight) of what is known."""
    weighted = graph.join(known, ["kind", "identity"], "left")
    good = F.sum(F.coalesce("weight", F.lit(0.0)))
    bad = F.sum(F.when(F.col("weight").isNotNull(), 0.0).when(F.col("state") == 0, 1.0).otherwise(UNKNOWN))
    return weighted.groupBy("kind", "pattern").agg((good / (good + bad + DOUBT)).alias("confidence")).filter(F.col("confidence") >= CONFIDENT)


def discover(graph: DataFrame) -> DataFrame:
    """(kind, identity, weight) of all identifiers known in the end: seeds at 1, the others by their patterns."""
    seeds = graph.filter("state = 1").select("kind", "identity", F.lit(1.0).alias("weight")).distinct()
    known = cut_lineage(seeds)
    size = known.count()
    for _ in range(ROUNDS):
        by_pattern = graph.filter("state is null").join(confident_patterns(graph, known), ["kind", "pattern"])
        new = by_pattern.groupBy("kind", "identity").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("weight"))
        # who is known stays known, at the most it has had
        known = cut_lineage(known.unionByName(new.filter(F.col("weight") >= CONFIDENT)).groupBy("kind", "identity").agg(F.max("weight").alias("weight")))
        size, before = known.count(), size
        if size == before:
            break
    return known


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: arrays of (kind, start, end), fixed forms alone and with what was discovered."""
    found = cut_lineage(matched(docs, id_col, text_col))
    seen = cut_lineage(occurrences(found))
    known = discover(cut_lineage(edges(seen)))
    number = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    added = seen.filter("state is null").join(known, ["kind", "identity"])
    added = added.groupBy("key", "start", "end").agg(F.max_by("kind", F.struct("weight", -number[F.col("kind")])).alias("kind"))
    added = added.groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))

    def kept(kind: str) -> Column:
        return F.transform(F.filter(kind, lambda m: passes(kind, m["form"])), lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))

    base = found.select(F.col("id").alias(id_col), "key", F.size("loose").alias("_loose"), F.concat(*(kept(k) for k in KINDS)).alias("base"))
    plain = base.filter("_loose = 0").withColumn("added", F.lit(None).cast("array<struct<kind:string,start:int,end:int>>"))
    joined = base.filter("_loose > 0").join(added, "key", "left").select(*plain.columns)
    every = F.transform(F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(number[s["kind"]].alias("n"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return plain.unionByName(joined).select(id_col, "base", F.when(F.size(F.coalesce("added", F.array())) > 0, every).otherwise(F.col("base")).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
