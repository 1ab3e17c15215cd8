"""Range, interval and as-of joins expressed as equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.operators.sequences import ordered


def fan_out(df: DataFrame, rows: list[dict], schema: dict[str, str], where=None) -> DataFrame:
    """Repeat each row once per parameter set (windows, variants, thresholds).

    The parameter sets are a literal array, so this is an in-place explode and
    not a cross join; all sets are computed in one pass over the data.
    """
    sets = F.array(*[F.struct(*[F.lit(r[c]).cast(t).alias(c) for c, t in schema.items()]) for r in rows])
    out = df.withColumn("_set", F.explode(sets))
    out = out.select(*df.columns, *[F.col(f"_set.{c}").alias(c) for c in schema])
    return out.where(where) if where is not None else out


def by_area(df: DataFrame, levels: dict[str, Column]) -> DataFrame:
    """One row per geography a record falls in, as geo_type / geo_id."""
    arr = F.array(*[F.struct(F.lit(t).alias("geo_type"), c.cast("string").alias("geo_id"))
                    for t, c in levels.items()])
    return (df.withColumn("_a", F.explode(F.filter(arr, lambda a: a.geo_id.isNotNull())))
            .select(*df.columns, "_a.geo_type", "_a.geo_id"))


def inside_spans(df: DataFrame, lo: str, hi: str, spans: DataFrame, keys: list[str] = (),
                 out: str = "covered", bucket_s: int = 86400) -> DataFrame:
    """Is [lo, hi] inside one of the disjoint spans (span_start, span_end)?

    Spans are cut into day buckets, so each row meets only the spans of the
    day its interval starts on. All times are epoch seconds. ``df`` needs a
    unique set of columns: the row count is unchanged because spans are disjoint
    and at most one can contain ``lo``.
    """
    s = (spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col("span_start") / bucket_s),
                                                     F.floor(F.col("span_end") / bucket_s))))
         .select(*keys, "_b", "span_start", "span_end"))
    d = df.withColumn("_b", F.floor(F.col(lo) / bucket_s))
    cond = d["_b"] == s["_b"]
    for k in keys:
        cond = cond & (d[k] == s[k])
    cond = cond & (s["span_start"] <= d[lo]) & (d[lo] <= s["span_end"])
    return d.join(s, cond, "left").select(
        *[d[c] for c in df.columns],
        F.coalesce(s["span_end"] >= d[hi], F.lit(False)).alias(out))


def span_coverage(spans: DataFrame, keys: list[str], lo: Column, hi: Column) -> DataFrame:
    """Share of [lo, hi] covered by each key's spans."""
    part = F.greatest(F.lit(0), F.least(F.col("span_end"), hi) - F.greatest(F.col("span_start"), lo))
    return spans.groupBy(*keys).agg((F.sum(part) / (hi - lo)).alias("coverage"))


def asof_backward(left: DataFrame, right: DataFrame, left_t: str, right_t: str, payload: list[str],
                  chunk, keys: list[str] = (), tie: list[str] = ()) -> DataFrame:
    """Newest right row at or before each left row's time (nulls when there is none).

    Both sides are merged into one ordered stream and the last payload seen is
    carried forward, so no pair is ever materialised. ``chunk`` maps the time
    column to a chunk value; among equal right times the greatest ``tie`` wins.
    """
    row = F.struct(*[F.col(c) for c in left.columns])
    load = F.struct(*[F.col(c) for c in payload])
    keep = [F.col(k) for k in keys]
    # The greatest tie must come last among equal right times, and right rows
    # come before left rows of the same time.
    r = right.groupBy(*keep, F.col(right_t).alias("_t")).agg(
        F.max_by(load, F.struct(*[F.col(c) for c in (tie or payload)])).alias("_load"))
    r = r.select(*keys, "_t", F.lit(0).alias("_side"), F.lit(None).cast(left.select(row.alias("r")).schema["r"].dataType)
                 .alias("_row"), "_load")
    lft = left.select(*keys, F.col(left_t).alias("_t"), F.lit(1).alias("_side"), row.alias("_row"),
                      F.lit(None).cast(r.schema["_load"].dataType).alias("_load"))
    both = r.unionByName(lft).withColumn("_c", chunk(F.col("_t"))).withColumn("_k", F.lit(0))
    out = ordered(both, [*keys, "_k"], "_c", ["_t", "_side"], last_seen=["_load"])
    return out.where("_side = 1").select("_row.*", "last__load.*")


def with_all_areas(result: DataFrame, skeleton: DataFrame, on: list[str], fill: dict) -> DataFrame:
    """Every cell of the skeleton gets a row; cells without data take the fill values."""
    return skeleton.join(result, on, "left").fillna(fill)


def match_trips(sched: DataFrame, reports: DataFrame, spans: DataFrame, tolerance_min: list[int]) -> DataFrame:
    """Scheduled trips against reports by (service_date, trip_id), per tolerance.

    measurable: polling covered the trip's span widened by the tolerance.
    observed: reports overlap that widened span. Times are epoch seconds.
    """
    seen = reports.groupBy("service_date", "trip_id").agg(
        F.count(F.lit(1)).alias("n_reports"), F.min("t").alias("first_report"), F.max("t").alias("last_report"))
    s = fan_out(sched, [{"tolerance": m} for m in tolerance_min], {"tolerance": "int"})
    s = (s.withColumn("from_t", F.col("first_t") - F.col("tolerance") * 60)
         .withColumn("to_t", F.col("last_t") + F.col("tolerance") * 60))
    s = inside_spans(s, "from_t", "to_t", spans, out="measurable")
    return (s.join(seen, ["service_date", "trip_id"], "left")
            .withColumn("n_reports", F.coalesce("n_reports", F.lit(0)))
            .withColumn("observed", F.coalesce((F.col("first_report") <= F.col("to_t"))
                                               & (F.col("last_report") >= F.col("from_t")), F.lit(False))))


def classify_trips(matched: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    """observed / ghost (its block ran another trip that day) / unobserved."""
    key = ["service_date", "block_id", *extra_keys]
    ran = (matched.where(F.col("observed") & F.col("block_id").isNotNull() & (F.col("block_id") != ""))
           .select(*key).distinct().withColumn("_ran", F.lit(True)))
    return (matched.join(ran, key, "left")
            .withColumn("status", F.when(F.col("observed"), "observed")
                        .when(F.col("_ran"), "ghost").otherwise("unobserved")).drop("_ran"))
