"""Reconciliation with official figures, spec rules, audits and the publication gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the publication rules.
TOLERANCE, RECONCILE_MAX_AGE_DAYS, AUDIT_MIN_ROWS = 0.02, 92, 100
SPEC_STATUSES, PROMISE_KINDS, AUDIT_ANSWERS = ("draft", "review", "frozen"), ("official", "comparison"), ("yes", "no", "n/a")


def figure_problems(f: DataFrame) -> DataFrame:
    """figure_id and problem for incomplete, repeated or inverted official figures."""
    need = ["figure_id", "measure", "period_start", "period_end", "value", "precision"]
    gaps = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in need]), lambda x: x.isNotNull())
    g = f.groupBy("figure_id").agg(F.count(F.lit(1)).alias("c"), F.max(F.size(gaps)).alias("gaps"),
                                   F.max(F.col("period_start") > F.col("period_end")).alias("inverted"))
    rows = F.array(F.when(F.col("gaps") > 0, "incomplete"), F.when(F.col("c") > 1, "duplicate figure_id"),
                   F.when(F.col("inverted"), "period_start after period_end"))
    return g.select("figure_id", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("problem"))


def reconcile(f: DataFrame, ours: str = "our_value", tolerance: float = TOLERANCE) -> DataFrame:
    """Gap to the official value; within 2% or half the rounding unit, else it needs a note."""
    gap = F.col(ours) - F.col("value")
    allowed = F.greatest(tolerance * F.abs("value"), F.col("precision") / 2)
    within = F.coalesce(F.abs(gap) <= allowed, F.lit(False))
    return (f.withColumn("gap", gap)
            .withColumn("relative_gap", F.when(F.col("value") != 0, gap / F.col("value")))
            .withColumn("within_tolerance", within)
            .withColumn("documented", within | (F.coalesce(F.col("gap_note"), F.lit("")) != "")))


def spec_reconciliation(results: DataFrame, spec_measures: DataFrame) -> DataFrame:
    """Per spec: oldest date and whether every figure of its measures is documented."""
    return (results.join(spec_measures, "measure").groupBy("spec_id")
            .agg(F.min("date").alias("date"), F.min("documented").alias("gap_documented"),
                 F.count(F.lit(1)).alias("figures")))


def spec_problems(specs: DataFrame) -> DataFrame:
    """Add ``problems``: array of rule violations (empty when the spec is valid).

    Columns: id, status, version, promise_kind, source_url, measures (array),
    text, objections array<struct<objection, response>>, thresholds
    array<struct<name, arbitrary, alternatives: int>>; a missing one is null.
    """
    need = ["id", "status", "version", "promise_kind", "measures", "objections", "thresholds"]
    gone = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in need]), lambda x: x.isNotNull())
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    frozen = F.coalesce(F.col("status") == "frozen", F.lit(False))
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    answered = F.size(F.filter("objections", lambda o: filled(o.objection) & filled(o.response)))
    thin = F.transform(F.filter("thresholds", lambda t: t.arbitrary & (t.alternatives < 2)),
                       lambda t: F.concat(F.lit("alternatives_few: "), t["name"]))
    single = F.array(
        F.when(F.size(gone) > 0, F.concat(F.lit("absent: "), F.array_join(gone, ", "))),
        F.when(~F.col("status").isin(*SPEC_STATUSES), F.lit("status_unknown, known: " + "/".join(SPEC_STATUSES))),
        F.when(~F.col("version").rlike(r"^\d+\.\d+$"), F.lit("version_format")),
        F.when(~F.col("promise_kind").isin(*PROMISE_KINDS), F.lit("promise_kind_unknown")),
        F.when(frozen & (F.col("promise_kind") == "official") & ~has("source_url"),
               F.lit("promise_source_absent")),
        F.when(frozen & ((F.coalesce(F.size("measures"), F.lit(0)) < 1) | ~has("text")),
               F.lit("reconciliation_absent")),
        F.when(frozen & (F.coalesce(answered, F.lit(0)) < 3), F.lit("objections_few")))
    rules = F.filter(single, lambda x: x.isNotNull())
    return specs.withColumn("problems", F.when(frozen, F.concat(rules, F.coalesce(thin, F.array().cast("array<string>"))))
                            .otherwise(rules))


def audit_summary(sheets: DataFrame, checks: list[str], min_rows: int = AUDIT_MIN_ROWS) -> DataFrame:
    """Per sheet: rows, problems. ``sheets``: sheet, auditor, notes and the check columns."""
    answers = F.array(*[F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))) for c in checks])
    a = (sheets.withColumn("_bad", F.size(F.filter(answers, lambda x: ~x.isin(*AUDIT_ANSWERS))))
         .withColumn("_no", F.array_contains(answers, "no")))
    empty = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    g = a.groupBy("sheet").agg(F.count(F.lit(1)).alias("rows"), F.count_if(empty("auditor")).alias("no_auditor"),
                               F.sum("_bad").alias("bad"), F.count_if(F.col("_no") & empty("notes")).alias("unexplained"))
    text = lambda c, t: F.concat(c.cast("string"), F.lit(t))
    probs = F.array(
        F.when(F.col("rows") < min_rows, text(F.col("rows"), f" rows, {min_rows} expected")),
        F.when(F.col("no_auditor") > 0, F.lit("rows_without_auditor")),
        F.when(F.col("bad") > 0, text(F.col("bad"), " unusable answers")),
        F.when(F.col("unexplained") > 0, text(F.col("unexplained"), " unexplained refusals")))
    return g.select("sheet", "rows", F.filter(probs, lambda x: x.isNotNull()).alias("problems"))


def newest_audit(summary: DataFrame) -> DataFrame:
    """Sheet names carry the run date, so the greatest name wins."""
    return summary.agg(F.max_by(F.struct("*"), "sheet").alias("s")).select("s.*")


def publish_gate(cells: DataFrame, as_of: Column) -> DataFrame:
    """Add ``missing`` (array) and ``publishable``. One row per metric with the evidence:

    blocked, frozen_valid, report_status, tests_passed, published_cells,
    cells_without_interval, reconciled_on, gap_documented, audit_problem
    ('' = complete, null = no audit).
    """
    stale = F.col("reconciled_on").isNull() | (F.date_diff(as_of, F.col("reconciled_on")) > RECONCILE_MAX_AGE_DAYS)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    probs = F.array(
        F.when(F.coalesce(F.col("blocked"), F.lit("")) != "", F.concat(F.lit("on_hold: "), F.trim("blocked"))),
        F.when(~yes("frozen_valid"), "definition_open"),
        F.when(~F.coalesce(F.col("report_status") == "pass", F.lit(False)),
               "source_checks_failed"),
        F.when(~yes("tests_passed"), "tests_open"),
        F.when((F.coalesce("published_cells", F.lit(0)) == 0) | (F.coalesce("cells_without_interval", F.lit(0)) > 0),
               "nothing_publishable"),
        F.when(stale, "official_comparison_stale")
         .when(~yes("gap_documented"), "official_gap_unexplained"),
        F.when(F.col("audit_problem").isNull(), "audit_absent")
         .when(F.col("audit_problem") != "",
               F.concat(F.lit("audit_open: "), F.col("audit_problem"))))
    return (cells.withColumn("missing", F.filter(probs, lambda x: x.isNotNull()))
            .withColumn("publishable", F.size("missing") == 0))


def interval_verdict(lo_a: Column, hi_a: Column, sup_a: Column, lo_b: Column, hi_b: Column, sup_b: Column) -> Column:
    """Two estimates differ only when their intervals do not overlap; '' when either is suppressed."""
    top = lambda h: F.when(h == -1, F.lit(float("inf"))).otherwise(h)
    return (F.when(sup_a | sup_b, "")
            .when((lo_a <= top(hi_b)) & (lo_b <= top(hi_a)), "overlap")
            .otherwise("apart"))


def feed_status(polls: DataFrame, feed: str, t: str, ok: str) -> DataFrame:
    """fail: the last three polls failed; warn: a fifth or more failed; else ok.

    The failing streak is the number of polls after the last success, so no
    ordering of the polls is needed. ``t`` must be unique per feed.
    """
    last_ok = polls.groupBy(feed).agg(F.max(F.when(F.col(ok), F.col(t))).alias("last_success_at"))
    g = (polls.join(last_ok, feed).groupBy(feed, "last_success_at").agg(
        F.count(F.lit(1)).alias("polls"), F.count_if(~F.col(ok)).alias("failed"),
        F.count_if(F.col("last_success_at").isNull() | (F.col(t) > F.col("last_success_at"))).alias("streak")))
    return g.withColumn("status", F.when(F.col("streak") >= 3, "fail")
                        .when(F.col("failed") >= 0.2 * F.col("polls"), "warn").otherwise("ok"))


def pipeline_health(checks: DataFrame, by: str) -> DataFrame:
    """ok / warn / fail with the reasons, per pipeline, from its check rows."""
    bad = ~F.col("passed")
    fail = F.when(bad & (F.col("severity") == "error"), F.col("name"))
    warn = F.when(bad & (F.col("severity") != "error") & F.col("kind").isin("volume", "referential"), F.col("name"))
    g = checks.groupBy(by).agg(F.sort_array(F.collect_list(fail)).alias("f"), F.sort_array(F.collect_list(warn)).alias("w"))
    return g.select(by, F.when(F.size("f") > 0, "fail").when(F.size("w") > 0, "warn").otherwise("ok").alias("status"),
                    F.when(F.size("f") > 0, F.concat(F.lit("validation failed: "), F.array_join("f", "; ")))
                    .otherwise(F.array_join("w", "; ")).alias("detail"))


def totals_agree(pairs: DataFrame, ours: str, ref: str, tolerance: float) -> DataFrame:
    """Groups whose sum misses the published one, and whether the grand totals match."""
    off = F.abs(F.col(ours) - F.col(ref)) > tolerance
    return pairs.agg(F.count(F.lit(1)).alias("groups"), F.count_if(off).alias("off"),
                     (F.round(F.sum(ours), 0) == F.round(F.sum(ref), 0)).alias("total_matches"))


def recompute(figures: DataFrame, raw: DataFrame, day: str, type_col: str, measures: dict[str, Column], earliest: Column) -> DataFrame:
    """Each official figure recomputed over the raw rows of its period and subgroup.

    ``figures``: figure_id, measure, subgroup ('' = all), period_start,
    period_end; a hand-kept table, counted before it is broadcast. Unknown
    measures and periods before ``earliest`` are refused.
    """
    from wardstat.session import small_side
    bad = figures.where(~F.col("measure").isin(*measures) | (F.col("period_start") < earliest)).limit(5).collect()
    if bad:
        raise ValueError("figures that cannot be recomputed: " + ", ".join(r["figure_id"] for r in bad))
    # Months make the range join an equi-join; figures cover few of them.
    f = figures.select("figure_id", "measure", "subgroup", "period_start", "period_end").withColumn(
        "_m", F.explode(F.sequence(F.trunc("period_start", "MM"), F.trunc("period_end", "MM"), F.expr("interval 1 month"))))
    r = raw.withColumn("_m", F.trunc(day, "MM"))
    j = r.join(small_side(f), "_m").where(F.col(day).between(F.col("period_start"), F.col("period_end"))
                                          & ((F.col("subgroup") == "") | (F.col("subgroup") == F.col(type_col))))
    got = j.groupBy("figure_id", "measure").agg(*[c.alias(f"_v_{m}") for m, c in measures.items()])
    pick = None
    for m in measures:
        cond = F.col("measure") == m
        pick = F.when(cond, F.col(f"_v_{m}")) if pick is None else pick.when(cond, F.col(f"_v_{m}"))
    return figures.join(got.select("figure_id", pick.alias("our_value")), "figure_id", "left")


def trace(sheet: DataFrame, fresh: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Sampled rows against a fresh fetch: which fields differ, or on which side a row is missing."""
    s = sheet.withColumn("_in_sheet", F.lit(True))
    f = fresh.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields], F.lit(True).alias("_in_fresh"))
    j = s.join(f, key, "full")
    diff = F.filter(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_new_{c}")), F.lit(c)) for c in fields]), lambda x: x.isNotNull())
    return j.withColumn("differs", F.when(F.col("_in_fresh").isNull(), "gone from source").when(F.col("_in_sheet").isNull(), "new in source")
                        .otherwise(F.array_join(diff, ",")))


def sector_from_number(record_id: Column) -> Column:
    """Sector read from a permit number like RES-NEW-123; null when it is not one."""
    part = F.regexp_extract(record_id, r"^(RES|COM)-(NEW|ALT|ADD|ACC)-\d", 1)
    return F.when(part == "RES", "residential").when(part == "COM", "commercial")
