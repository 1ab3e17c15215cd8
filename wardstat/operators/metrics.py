"""The published metrics. Each scans its input once: windows, variants and
geographies are explodes in front of one aggregation, not loops of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.functions.dates import roll_months, window_start_days, window_start_months
from wardstat.operators import aggregates as agg
from wardstat.operators.joins import by_area, fan_out, with_all_areas
from wardstat.operators.sequences import headway_gaps, latest_per_key, scheduled_gaps
from wardstat.operators.spatial import first_rereport
from wardstat.functions.intervals import wilson
from wardstat.session import attach, cut_lineage, small_side

CELL = ["geo_type", "geo_id"]
WINDOW = ["window_start", "window_end"]

# The windows, variants and floors of the published metrics.
REQUEST_WINDOWS = [{"days": 90}, {"days": 365}]
REOPEN_VARIANTS = [{"variant": "primary", "within": 30, "radius": 50}, {"variant": "window_14d", "within": 14, "radius": 50},
                   {"variant": "window_60d", "within": 60, "radius": 50}, {"variant": "radius_25m", "within": 30, "radius": 25},
                   {"variant": "radius_100m", "within": 30, "radius": 100}]
MIN_POPULATION, MIN_PARCELS, MIN_N_VALUE, MINOR_VALUE, CAP_VALUE = 1000, 250, 20, 5000.0, 1e7
CATEGORIES, SECTORS = ("new", "renovation", "accessory"), ("residential", "commercial")
PERMIT_WINDOWS = [{"months": 12}, {"months": 60}]
TRANSIT_WINDOWS = [{"days": 30}, {"days": 90}]
ON_TIME = [{"variant": "primary", "early": -60, "late": 300}, {"variant": "window_0_10", "early": 0, "late": 600}]
MATCH_FLOOR, FREQUENT_S = 0.85, 1800
RESTORATION_SPAN_S, MIN_N_RESTORATION = 1800, 20


def in_day_windows(df: DataFrame, day: str, through: Column, windows: list[dict]) -> DataFrame:
    """Rows whose date falls in the longest trailing window: what no window counts need not be joined or repeated."""
    return df.where(F.col(day).between(window_start_days(through, max(w["days"] for w in windows)), through))


def day_windows(df: DataFrame, day: str, through: Column, windows: list[dict]) -> DataFrame:
    """Repeat rows for every trailing window of days their date falls in."""
    # a plain condition on the date reaches the tables, unlike the one on what the repeat adds
    out = fan_out(in_day_windows(df, day, through, windows), windows, {"days": "int"})
    return (out.withColumn("window_start", window_start_days(through, F.col("days"))).withColumn("window_end", through)
            .where(F.col(day).between(F.col("window_start"), F.col("window_end"))).drop("days"))


def month_windows(df: DataFrame, day: str, through: Column, windows: list[dict], data_from: Column | None = None) -> DataFrame:
    start_of = lambda m: window_start_months(through, m) if data_from is None else F.greatest(window_start_months(through, m), data_from)
    longest = start_of(F.lit(max(w["months"] for w in windows)))
    out, start = fan_out(df.where(F.col(day).between(longest, through)), windows, {"months": "int"}), start_of(F.col("months"))
    return (out.withColumn("window_start", start).withColumn("window_end", through)
            .where(F.col(day).between(F.col("window_start"), F.col("window_end"))).drop("months"))


# --- requests -------------------------------------------------------------

def median_days(base: DataFrame, levels: dict[str, Column], through: Column, windows=REQUEST_WINDOWS) -> DataFrame:
    """Kaplan-Meier median business days to close; open requests are censored at their age."""
    d = base.where(F.col("close_problem").isNull())
    d = d.withColumn("time", F.when(F.col("is_closed"), F.col("bd_to_close")).otherwise(F.col("age_bd")))
    d = day_windows(d, "opened", through, windows)
    cells = ["type", *CELL, *WINDOW]
    counts = agg.roll_up(d.where("time is not null"), ["type", "time", *WINDOW], levels,
                         {"events": F.count_if("is_closed"), "censored": F.count_if(~F.col("is_closed"))})
    return (agg.km_median(counts, cells).withColumnRenamed("type", "subgroup")
            .withColumn("metric", F.lit("median_business_days_to_close")).withColumn("variant", F.lit("primary")))


def target_rows(base: DataFrame, targets: DataFrame, through: Column, windows=REQUEST_WINDOWS) -> DataFrame:
    """Requests whose deadline day is fully observed, with on_time, per target variant and window.

    ``targets``: config table type, low, high.
    """
    d = base.where(F.col("close_problem").isNull()).join(F.broadcast(targets), "type")
    pair = F.array(F.struct(F.lit("primary").alias("variant"), F.col("high").alias("target")),
                   F.struct(F.lit("lower_bound").alias("variant"), F.col("low").alias("target")))
    d = d.withColumn("_t", F.explode(F.filter(pair, lambda p: p.target.isNotNull())))
    d = d.withColumn("variant", F.col("_t.variant")).withColumn("target", F.col("_t.target")).drop("_t", "low", "high")
    d = d.where(F.col("age_bd") >= F.col("target")).withColumn(
        "on_time", F.coalesce(F.col("is_closed") & (F.col("bd_to_close") <= F.col("target")), F.lit(False)))
    return day_windows(d, "opened", through, windows)


def within_target(base: DataFrame, targets: DataFrame, levels: dict[str, Column], through: Column) -> DataFrame:
    out = agg.area_proportion(target_rows(base, targets, through), ["type", "variant", *WINDOW], levels, F.col("on_time"))
    return out.withColumnRenamed("type", "subgroup").withColumn("metric", F.lit("pct_within_target"))


def rereports(pts: DataFrame, through: Column, windows=REQUEST_WINDOWS, max_days: int = 60) -> DataFrame:
    """Primaries closed in some window, with days to the first later request of their type (r25, r50, r100).

    The pool of re-reports is every included, located, in-city request,
    near-duplicates too; only those up to ``max_days`` after a closing can answer it.
    """
    pool = pts.where(F.col("exclusion").isNull() & F.coalesce(F.col("in_city"), F.lit(False)) & F.col("x").isNotNull())
    day = lambda c: F.unix_date(F.col(c))
    closed = (in_day_windows(pool.where(F.col("duplicate_of").isNull() & F.col("is_closed")), "close_date", through, windows)
              .withColumn("g", F.col("type")).withColumn("t", day("close_date")))
    first = window_start_days(through, max(w["days"] for w in windows))
    reports = (pool.where((F.col("opened") > first) & (F.col("opened") <= F.date_add(through, max_days)))
               .select(F.col("type").alias("g"), "x", "y", day("opened").alias("t")))
    return first_rereport(closed, reports, [25, 50, 100], max_days).drop("g", "t")


def reopen_rate(rr: DataFrame, levels: dict[str, Column], through: Column) -> DataFrame:
    d = fan_out(rr, REOPEN_VARIANTS, {"variant": "string", "within": "int", "radius": "int"})
    lag = F.when(F.col("radius") == 25, F.col("r25")).when(F.col("radius") == 50, F.col("r50")).otherwise(F.col("r100"))
    d = (d.withColumn("reopened", F.coalesce(lag <= F.col("within"), F.lit(False)))
         .where(F.col("close_date") <= F.date_sub(through, F.col("within"))))
    d = day_windows(d, "close_date", through, REQUEST_WINDOWS)
    out = agg.area_proportion(d, ["type", "variant", *WINDOW], levels, F.col("reopened"))
    return out.withColumnRenamed("type", "subgroup").withColumn("metric", F.lit("reopen_rate"))


def requests_per_1000(base: DataFrame, population: DataFrame, levels: dict[str, Column], through: Column) -> DataFrame:
    """Rate for every type seen in the window and every area with a population, zeros included.

    ``population``: geo_type, geo_id, population - one row per area.
    """
    d = day_windows(base, "opened", through, REQUEST_WINDOWS)
    n = agg.roll_up(d, ["type", *WINDOW], levels, {"n": F.count(F.lit(1))})
    # Types seen per window as one short array: types are a code list.
    seen = n.groupBy(*WINDOW).agg(F.collect_set("type").alias("_types"))
    wins = fan_out(population, REQUEST_WINDOWS, {"days": "int"})
    sk = (wins.withColumn("window_start", window_start_days(through, F.col("days"))).withColumn("window_end", through)
          .join(seen, WINDOW).withColumn("type", F.explode("_types")).drop("_types", "days"))
    r = with_all_areas(n, sk, ["type", *CELL, *WINDOW], {"n": 0})
    r = agg.poisson_rate(r, "n", F.col("population"), 1000)
    sup = F.coalesce(F.col("population") < MIN_POPULATION, F.lit(True))
    for c in ("value", "ci_low", "ci_high"):
        r = r.withColumn(c, F.when(~sup, F.col(c)))
    return (r.withColumn("suppressed", sup).drop("population").withColumnRenamed("type", "subgroup")
            .withColumn("metric", F.lit("requests_per_1000")).withColumn("variant", F.lit("primary")))


def hex_metrics(base: DataFrame, rr: DataFrame, targets: DataFrame, headline: list[str], through: Column) -> DataFrame:
    """The three address-level measures over each cell and its six neighbours."""
    b = base.where(F.col("type").isin(*headline) & F.col("h9").isNotNull())
    by = ["type", *WINDOW]
    d = b.where(F.col("close_problem").isNull()).withColumn(
        "time", F.when(F.col("is_closed"), F.col("bd_to_close")).otherwise(F.col("age_bd")))
    km = agg.km_counts(day_windows(d, "opened", through, REQUEST_WINDOWS), ["h9", *by], "time", F.col("is_closed"))
    km = agg.over_disk(km, "h9", [*by, "time"], ["events", "censored"])
    med = agg.km_median(km, ["geo_id", *by]).withColumn("metric", F.lit("median_business_days_to_close"))

    def disk_share(rows: DataFrame, flag: str, metric: str) -> DataFrame:
        per = rows.groupBy("h9", *by).agg(F.count_if(flag).alias("x"), F.count(F.lit(1)).alias("n"))
        return (agg.proportion(agg.over_disk(per, "h9", by, ["x", "n"])).drop("x")
                .withColumn("metric", F.lit(metric)))

    tgt = disk_share(target_rows(b, targets, through).where("variant = 'primary'"), "on_time", "pct_within_target")
    c = rr.where(F.col("type").isin(*headline) & F.col("h9").isNotNull()
                 & (F.col("close_date") <= F.date_sub(through, 30)))
    c = day_windows(c, "close_date", through, REQUEST_WINDOWS).withColumn(
        "reopened", F.coalesce(F.col("r50") <= 30, F.lit(False)))
    reo = disk_share(c, "reopened", "reopen_rate")
    return (med.unionByName(tgt).unionByName(reo).withColumnRenamed("type", "subgroup")
            .withColumn("geo_type", F.lit("hex_174m")).withColumn("variant", F.lit("primary")))


# --- permits ----------------------------------------------------------------

def subgroup_names(category: Column, sector: Column) -> Column:
    """Array of the subgroups a permit belongs to: 'all', category, sector and both."""
    cat = F.when(category.isin(*CATEGORIES), category)
    sec = F.when(sector.isin(*SECTORS), sector)
    named = F.array(F.lit("all"), cat, F.when(sec.isNotNull(), F.concat(F.lit("all_"), sec)),
                    F.when(cat.isNotNull() & sec.isNotNull(), F.concat(cat, F.lit("_"), sec)))
    return F.filter(named, lambda s: s.isNotNull())


ALL_SUBGROUPS = [c if s == "all" else f"{c}_{s}" for c in (*CATEGORIES, "all") for s in ("all", *SECTORS)]


def _parcel_cells(parcels: DataFrame, subgroups: list[str], variants: list[str], through: Column) -> DataFrame:
    """Skeleton: every area x subgroup x variant x window. Areas are a dimension table."""
    sk = fan_out(parcels, [{"subgroup": s} for s in subgroups], {"subgroup": "string"})
    sk = fan_out(sk, [{"variant": v} for v in variants], {"variant": "string"})
    sk = fan_out(sk, PERMIT_WINDOWS, {"months": "int"})
    return (sk.withColumn("window_start", window_start_months(through, F.col("months")))
            .withColumn("window_end", through).drop("months"))


def permits_rate(base: DataFrame, parcels: DataFrame, levels: dict[str, Column], through: Column,
                 subgroup: Column | None = None, subgroups: list[str] = ALL_SUBGROUPS) -> DataFrame:
    """Permits per 1,000 parcels; excl_minor drops declared values under 5,000 and keeps unknown ones."""
    names = subgroup if subgroup is not None else subgroup_names(F.col("category"), F.col("sector"))
    cells = ["subgroup", "variant", *CELL, *WINDOW]
    d = month_windows(base.withColumn("_names", names), "issue_date", through, PERMIT_WINDOWS)
    major = F.col("value").isNull() | (F.col("value") >= MINOR_VALUE)
    c = agg.roll_up(d, ["_names", *WINDOW], levels, {"k": F.count(F.lit(1)), "k_major": F.count_if(major)})
    both = F.array(F.struct(F.lit("primary").alias("variant"), F.col("k").alias("k")),
                   F.struct(F.lit("excl_minor").alias("variant"), F.col("k_major").alias("k")))
    n = (c.withColumn("subgroup", F.explode("_names")).withColumn("_v", F.explode(both)).withColumn("variant", F.col("_v.variant"))
         .groupBy(*cells).agg(F.sum("_v.k").alias("n")))
    r = with_all_areas(n, _parcel_cells(parcels, subgroups, ["primary", "excl_minor"], through), cells, {"n": 0})
    r = agg.poisson_rate(r, "n", F.col("parcels"), 1000)
    sup = F.col("parcels") < MIN_PARCELS
    for c in ("value", "ci_low", "ci_high"):
        r = r.withColumn(c, F.when(~sup, F.col(c)))
    return r.withColumn("suppressed", sup).drop("parcels").withColumn("metric", F.lit("permits_per_1000_parcels"))


def declared_value(base: DataFrame, parcels: DataFrame, levels: dict[str, Column], through: Column) -> DataFrame:
    """Declared value per 1,000 parcels: total, without the top 1%, capped, and the median permit.

    Totals and their intervals come from sums of powers per combination of area, category and sector, rolled up to every
    cell afterwards: one method for cells of any size. The totals themselves are added up as decimals.
    """
    d = month_windows(base.where("value is not null"), "issue_date", through, PERMIT_WINDOWS)
    # permits are put together once for the quantile, the sums and the medians
    d = cut_lineage(d.select("value", *WINDOW, subgroup_names(F.col("category"), F.col("sector")).alias("_names"), *[c.alias(f"_lv_{g}") for g, c in levels.items()]))
    top = agg.quantiles(d, WINDOW, "value", {"top1": 0.99}).drop("n")
    d = d.join(F.broadcast(top), WINDOW)          # one row per window
    leaf = ["_names", *WINDOW, *[f"_lv_{g}" for g in levels]]
    lv = {g: F.col(f"_lv_{g}") for g in levels}
    values = {"primary": F.col("value"), "excl_top1pct": F.when(F.col("value") <= F.col("top1"), F.col("value")),
              "cap_10m": F.least(F.col("value"), F.lit(CAP_VALUE))}
    cells, parts = ["subgroup", *CELL, *WINDOW], [*agg.POWERS, "exact"]
    exact = lambda x: F.coalesce(F.sum(x.cast("decimal(20,4)")), F.lit(0).cast("decimal(30,4)"))
    sums = d.groupBy(*leaf).agg(*[c for v, x in values.items() for c in [*agg.power_sums(x, v + "_"), exact(x).alias(v + "_exact")]])
    kinds = F.array(*[F.struct(F.lit(v).alias("variant"), *[F.col(f"{v}_{p}").alias(p) for p in parts]) for v in values])
    cell_sums = (by_area(sums.select(*leaf, F.explode(kinds).alias("_k")), lv).withColumn("subgroup", F.explode("_names"))
                 .groupBy("_k.variant", *cells).agg(*[F.sum(f"_k.{p}").alias(p) for p in parts]).where("n > 0"))
    k = 1000.0 / F.col("parcels")
    tot = agg.total_interval(cell_sums).join(parcels, CELL).select(
        "variant", *cells, "n", (F.col("exact").cast("double") * k).alias("value"), (F.col("ci_low") * k).alias("lo"), (F.col("ci_high") * k).alias("hi"))
    in_cells = lambda v: by_area(v, lv).withColumn("subgroup", F.explode("_names"))
    med = agg.median_metric(d.select(*leaf, "value"), cells, "value", min_n=0, spread=in_cells).select(
        F.lit("median_per_permit").alias("variant"), *cells, "n", "value", F.col("ci_low").alias("lo"), F.col("ci_high").alias("hi"))
    sk = _parcel_cells(parcels, ALL_SUBGROUPS, [*values, "median_per_permit"], through)
    r = sk.join(tot.unionByName(med), ["variant", *cells], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sup = (F.col("n") < MIN_N_VALUE) | (F.col("parcels") < MIN_PARCELS)
    return r.select("variant", *cells, "n", sup.alias("suppressed"), F.when(~sup, F.col("value")).alias("value"),
                    F.when(~sup, F.least("lo", "value")).alias("ci_low"),
                    F.when(~sup, F.greatest("hi", "value")).alias("ci_high")).withColumn(
        "metric", F.lit("declared_value_per_1000_parcels"))


def demolition_ratio(demolitions: DataFrame, permits: DataFrame, parcels: DataFrame, levels: dict[str, Column],
                     through: Column) -> DataFrame:
    """Demolitions per new-construction permit; undefined (suppressed) without new construction."""
    both = (demolitions.withColumn("is_d", F.lit(1))
            .unionByName(permits.where("category = 'new'").withColumn("is_d", F.lit(0)), allowMissingColumns=True))
    cells = [*CELL, *WINDOW]
    c = agg.roll_up(month_windows(both, "issue_date", through, PERMIT_WINDOWS), WINDOW, levels,
                    {"d": F.sum("is_d"), "m": F.sum(1 - F.col("is_d"))})
    sk = _parcel_cells(parcels, ["all"], ["primary"], through).drop("parcels")
    r = agg.odds(with_all_areas(c, sk, cells, {"d": 0, "m": 0}), "d", "m")
    return r.drop("d", "m").withColumnRenamed("n_both", "n").withColumn("metric", F.lit("demolition_to_new_ratio"))


# --- inspections --------------------------------------------------------------

def food_scores(places: DataFrame, ins: DataFrame, levels: dict[str, Column], through: Column, months: int = 12,
                thresholds: tuple[int, ...] = (70, 80, 85), data_from: Column | None = None) -> DataFrame:
    """Median latest routine score, and share below each threshold (the first is primary)."""
    r = ins.where((F.col("kind") == "routine") & F.col("score").isNotNull() & F.col("exclusion").isNull())
    r = month_windows(r, "date", through, [{"months": months}], data_from)
    last = latest_per_key(r, ["place", *WINDOW], [F.col("date"), F.col("score")], ["date", "score"])
    d = by_area(last.join(places, "place"), levels)
    med = (agg.median_metric(d, [*CELL, *WINDOW], "score")
           .withColumn("metric", F.lit("median_latest_score")).withColumn("variant", F.lit("primary")))
    sets = [{"variant": "primary" if i == 0 else f"below_{t}", "limit": t} for i, t in enumerate(thresholds)]
    b = fan_out(d, sets, {"variant": "string", "limit": "double"})
    below = (agg.flag_proportion(b, ["variant", *CELL, *WINDOW], F.col("score") < F.col("limit"))
             .withColumn("metric", F.lit("pct_below_followup_threshold")))
    return med.unionByName(below)


def overdue_rows(places: DataFrame, ins: DataFrame, through: Column, active_months: int = 36, interval_months: int = 6,
                 graces: tuple[int, ...] = (0, 30, 90), data_from: Column | None = None) -> DataFrame:
    """Active places with reference date, due date and overdue flag per grace variant.

    ``places`` has closed_date. The clock starts at the latest routine or
    pre-opening inspection, else at the first inspection of any kind.
    """
    u = ins.where(F.col("exclusion").isNull() & (F.col("date") <= through))
    start = window_start_months(through, active_months)
    start = F.greatest(start, data_from) if data_from is not None else start
    g = u.groupBy("place").agg(
        F.max(F.when(F.col("kind").isin("routine", "pre_opening"), F.col("date"))).alias("clock"),
        F.min("date").alias("first"), F.max("date").alias("seen")).where(F.col("seen") >= start)
    e = places.join(g, "place").where(F.col("closed_date").isNull() | (F.col("closed_date") > through))
    e = e.withColumn("ref", F.coalesce("clock", "first")).withColumn("due", roll_months(F.col("ref"), interval_months))
    sets = [{"variant": "primary" if i == 0 else f"grace_{d}d", "grace": d} for i, d in enumerate(graces)]
    e = fan_out(e, sets, {"variant": "string", "grace": "int"})
    return (e.withColumn("overdue", through > F.date_add("due", F.col("grace")))
            .withColumn("window_start", start).withColumn("window_end", through).drop("clock", "first", "seen"))


def food_overdue(places, ins, levels, through, **kw) -> DataFrame:
    d = by_area(overdue_rows(places, ins, through, **kw), levels)
    return (agg.flag_proportion(d, ["variant", *CELL, *WINDOW], F.col("overdue"))
            .withColumn("metric", F.lit("pct_overdue_inspection")))


def food_reinspection(places: DataFrame, ins: DataFrame, levels: dict[str, Column], through: Column,
                      months: int = 12, data_from: Column | None = None) -> DataFrame:
    """Follow-ups as a share of routine and follow-up inspections."""
    u = ins.where(F.col("exclusion").isNull() & F.col("kind").isin("routine", "follow_up"))
    d = by_area(month_windows(u, "date", through, [{"months": months}], data_from).join(places, "place"), levels)
    return (agg.flag_proportion(d, [*CELL, *WINDOW], F.col("kind") == "follow_up")
            .withColumn("metric", F.lit("reinspection_rate")).withColumn("variant", F.lit("primary")))


# --- transit --------------------------------------------------------------------

def transit_levels(stops: bool) -> dict[str, Column]:
    lv = {"citywide": F.lit("city"), "route": F.col("route_id")}
    if stops:
        lv |= {"stop": F.col("stop_id"), "hex_461m": F.col("h8")}
    return lv


def ghost_rate(cls: DataFrame, stop_times: DataFrame, stop_cells: DataFrame, through: Column) -> DataFrame:
    """Ghost share: city and route over trips, stop and cell over trips at their stops.

    ``cls``: classified trips with a ``tolerance`` per variant; ``stop_cells``: stop_id, h8.
    """
    key, cells = ["service_date", "trip_id"], ["variant", *CELL, *WINDOW]
    d = cls.where(F.col("measurable") & (F.col("status") != "unobserved")).withColumn("ghost", F.col("status") == "ghost").withColumn("variant", _tolerance_name())
    # only days of some window, on both sides of the join; tolerances of a trip are one row until they are counted
    d, stop_times = (in_day_windows(x, "service_date", through, TRANSIT_WINDOWS) for x in (d, stop_times))
    lv = transit_levels(True)
    trip = d.groupBy(*key).agg(F.collect_list(F.struct("variant", "ghost")).alias("ghosts"))
    at = stop_times.select(*key, "stop_id").join(trip.select(*key), key, "left_semi").distinct().join(trip, key).join(stop_cells, "stop_id", "left").withColumn("g", F.explode("ghosts")).select("*", "g.*")

    def rates(df: DataFrame, levels: dict[str, Column]) -> DataFrame:
        """Counts of a day first; windows repeat those, not trips."""
        daily = agg.roll_up(df, ["service_date", "variant"], levels, {"x": F.count_if("ghost"), "n": F.count(F.lit(1))})
        c = day_windows(daily, "service_date", through, TRANSIT_WINDOWS).groupBy(*cells).agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
        return agg.proportion(c).drop("x")

    trips, stops = rates(d, transit_levels(False)), rates(at, {k: lv[k] for k in ("stop", "hex_461m")})
    return trips.unionByName(stops).withColumn("metric", F.lit("ghost_bus_rate"))


def _tolerance_name() -> Column:
    return F.when(F.col("tolerance") == 15, "primary").otherwise(
        F.concat(F.lit("tolerance_"), F.col("tolerance").cast("string"), F.lit("min")))


def routes_above_floor(cls: DataFrame, through: Column, floor: float = MATCH_FLOOR) -> DataFrame:
    """route_id per window whose share of observed trips among the measurable clears the floor."""
    d = day_windows(cls.where("measurable"), "service_date", through, TRANSIT_WINDOWS)
    return (d.groupBy("route_id", *WINDOW).agg(F.avg((F.col("status") == "observed").cast("double")).alias("rate"))
            .where(F.col("rate") >= floor))


def on_time(arrivals: DataFrame, cls: DataFrame, stop_cells: DataFrame, through: Column, floor: float = MATCH_FLOOR) -> DataFrame:
    a = day_windows(arrivals.where("arrival is not null"), "service_date", through, TRANSIT_WINDOWS)
    a = a.join(routes_above_floor(cls, through, floor).drop("rate"), ["route_id", *WINDOW], "left_semi")
    a = fan_out(a.join(stop_cells, "stop_id", "left"), ON_TIME, {"variant": "string", "early": "double", "late": "double"})
    d = by_area(a, transit_levels(True))
    return (agg.flag_proportion(d, ["variant", *CELL, *WINDOW], F.col("delay_s").between(F.col("early"), F.col("late")))
            .withColumn("metric", F.lit("on_time_pct")))


HEADWAY_KEY = ["service_date", "route_id", "direction_id", "stop_id"]


def headway_ratio(events: DataFrame, stop_cells: DataFrame, through: Column, windows=None) -> DataFrame:
    """Median observed over median scheduled gap on routes scheduled every 30 minutes or better."""
    windows = windows or TRANSIT_WINDOWS
    events = in_day_windows(events, "service_date", through, windows)      # a gap lies within its day
    ob = day_windows(headway_gaps(events, HEADWAY_KEY), "service_date", through, windows)
    sc = day_windows(scheduled_gaps(events, HEADWAY_KEY), "service_date", through, windows)
    route = agg.quantiles(sc, ["route_id", *WINDOW], "gap", {"med": 0.5}).where(F.col("med") <= FREQUENT_S)
    lv = transit_levels(True)
    cells = [*CELL, *WINDOW]
    ready = lambda d: by_area(d.join(route.select("route_id", *WINDOW), ["route_id", *WINDOW], "left_semi")
                              .join(stop_cells, "stop_id", "left"), lv)
    sched = agg.quantiles(ready(sc), cells, "gap", {"sched": 0.5}).select(*cells, "sched")
    obs = agg.median_metric(ready(ob), cells, "gap")
    r = obs.join(sched, cells)
    for c in ("value", "ci_low", "ci_high"):
        r = r.withColumn(c, F.col(c) / F.nullif(F.col("sched"), F.lit(0.0)))      # dense stops may be scheduled within one second
    return r.drop("sched").withColumn("metric", F.lit("peak_headway_ratio")).withColumn("variant", F.lit("primary"))


# --- outages ----------------------------------------------------------------------

OUTAGE_SIZES = [{"variant": "primary"}, {"variant": "min_10_customers"}, {"variant": "min_5_minutes"}]


def _outage_rows(ev: DataFrame, through: Column, days: int) -> DataFrame:
    d = day_windows(ev, "day", through, [{"days": days}])
    return d.withColumn("subgroup", F.when(F.col("planned"), "planned").otherwise("all"))


def _outage_cells(areas: DataFrame, through: Column, days: int, subgroups=("all", "planned")) -> DataFrame:
    sk = fan_out(areas, [{"subgroup": s} for s in subgroups], {"subgroup": "string"})
    return sk.withColumn("window_start", window_start_days(through, F.lit(days))).withColumn("window_end", through)


def outage_counts(ev: DataFrame, areas: DataFrame, levels: dict[str, Column], through: Column, days: int = 365,
                  cell: str | None = "h9") -> DataFrame:
    """Events per year with exact Poisson bounds; zero rows for quiet areas, disk counts per cell.

    ``ev`` has day (local date of the start), max_cust, duration_s, planned and level columns.
    """
    d = fan_out(_outage_rows(ev, through, days), OUTAGE_SIZES, {"variant": "string"})
    d = d.where(F.when(F.col("variant") == "primary", F.col("max_cust") >= 1)
                .when(F.col("variant") == "min_10_customers", F.col("max_cust") >= 10)
                .otherwise(F.col("duration_s") >= 300))
    cells = ["variant", "subgroup", *CELL, *WINDOW]
    n = by_area(d, levels).groupBy(*cells).agg(F.count(F.lit(1)).alias("n"))
    sk = fan_out(_outage_cells(areas, through, days), OUTAGE_SIZES, {"variant": "string"}).select(*cells)
    r = with_all_areas(n, sk, cells, {"n": 0})
    if cell:
        by = ["variant", "subgroup", *WINDOW]
        per = d.groupBy(F.col(cell).alias("cell"), *by).agg(F.count(F.lit(1)).alias("n"))
        r = r.unionByName(agg.over_disk(per, "cell", by, ["n"]).withColumn("geo_type", F.lit("hex_174m")))
    r = agg.poisson_rate(r, "n", F.lit(days / 365.0))
    return r.withColumn("suppressed", F.lit(False)).withColumn("metric", F.lit("outage_events_per_year"))


def customer_hours(ev: DataFrame, denominators: DataFrame, levels: dict[str, Column], through: Column,
                   days: int = 365) -> DataFrame:
    """Customer-hours per 1,000 households and year; the interval is the poll-timing bounds.

    ``denominators``: geo_type, geo_id, households, population.
    """
    d = by_area(_outage_rows(ev, through, days), levels)
    cells = ["subgroup", *CELL, *WINDOW]
    s = d.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"), F.sum("cust_hours_lo").alias("lo"), F.sum("cust_hours_hi").alias("hi"))
    r = with_all_areas(s, _outage_cells(denominators, through, days), cells, {"n": 0, "lo": 0.0, "hi": 0.0})
    sup = ~F.coalesce((F.col("population") >= MIN_POPULATION) & (F.col("households") > 0), F.lit(False))
    k = 1000.0 * 365 / days / F.nullif(F.col("households"), F.lit(0))
    return (r.withColumn("value", F.when(~sup, (F.col("lo") + F.col("hi")) / 2 * k))
            .withColumn("ci_low", F.when(~sup, F.col("lo") * k)).withColumn("ci_high", F.when(~sup, F.col("hi") * k))
            .withColumn("suppressed", sup).drop("lo", "hi", "population", "households")
            .withColumn("metric", F.lit("customer_hours_per_1000")).withColumn("variant", F.lit("primary")))


def restoration(ev: DataFrame, areas: DataFrame, levels: dict[str, Column], through: Column, days: int = 365,
                span_max_s: int = RESTORATION_SPAN_S) -> DataFrame:
    """Median minutes between restoration and the estimate, for three reference estimates."""
    d = _outage_rows(ev, through, days).where(
        ~F.col("planned") & F.col("confirmed") & (F.col("restoration_span_s") <= span_max_s))
    refs = F.array(*[F.struct(F.lit(v).alias("variant"), F.col(c).alias("etr")) for v, c in
                     (("primary", "first_etr"), ("etr_60m", "etr_60m"), ("final_etr", "final_etr"))])
    d = d.withColumn("_e", F.explode(F.filter(refs, lambda r: r.etr.isNotNull())))
    d = d.withColumn("variant", F.col("_e.variant")).withColumn("late_min", (F.col("restored_mid") - F.col("_e.etr")) / 60.0)
    cells = ["variant", *CELL, *WINDOW]
    m = agg.median_metric(by_area(d.drop("_e"), levels), cells, "late_min", MIN_N_RESTORATION)
    sk = fan_out(areas, [{"variant": v} for v in ("primary", "etr_60m", "final_etr")], {"variant": "string"})
    sk = (sk.withColumn("window_start", window_start_days(through, F.lit(days))).withColumn("window_end", through)
          .select(*cells))
    r = with_all_areas(m, sk, cells, {"n": 0, "suppressed": True})
    return r.withColumn("metric", F.lit("restoration_vs_estimate")).withColumn("subgroup", F.lit("all"))



# --- slow requests and pooled groups -------------------------------------------------

def flag_slow(d: DataFrame, min_n: int = 20) -> DataFrame:
    """Eligible requests with ``slow``: not closed within their type's median time.

    ``d`` has time (days to close, or age). Types with too few records or a
    median never reached are left out; a request is eligible once its threshold
    day has been observed.
    """
    thr = agg.km_median(agg.km_counts(d, ["type"], "time", F.col("is_closed")), ["type"], min_n)
    thr = thr.where("not suppressed").select("type", F.col("value").alias("threshold"))
    e = d.join(thr, "type").where(F.col("age_bd") >= F.col("threshold"))
    return e.withColumn("slow", ~F.coalesce(F.col("is_closed") & (F.col("bd_to_close") <= F.col("threshold")), F.lit(False)))


def cluster_groups(ratios: DataFrame, nb: DataFrame, area: str, nsim: int = 99_999, alpha: float = 0.05) -> DataFrame:
    """area, grp: slow_core, fast_core or other, by each area's local class after adjustment.

    ``ratios``: one row per area with observed, expected, null_var, suppressed; suppressed areas are in no group.
    """
    from wardstat.operators import spatial_stats as ss
    shown = cut_lineage(ratios.where("not suppressed"))
    z = cut_lineage(ss.eb_standardize(shown).select(F.col(area).alias("id"), F.coalesce("z", F.lit(0.0)).alias("z")))
    links = nb.join(z.select(F.col("id").alias("i")), "i", "left_semi").join(z.select(F.col("id").alias("j")), "j", "left_semi").select("i", "j")
    local = ss.lisa(z, links, "z", nsim, alpha=alpha).select(F.col("id").alias(area), "class")
    grp = F.when(F.col("class") == "HH", "slow_core").when(F.col("class") == "LL", "fast_core").otherwise("other")
    return shown.select(area).join(local, area, "left").select(area, grp.alias("grp"))


def pool_groups(e: DataFrame, classes: DataFrame, area: str) -> DataFrame:
    """Observed and expected slow share, their ratio with its interval, and the median time per group of areas.

    ``classes``: area, grp - one row per area.
    """
    p = e.groupBy("type").agg(F.avg(F.col("slow").cast("int")).alias("p"))
    # Counts per area and type carry everything the shares need.
    c = e.groupBy(area, "type").agg(F.count(F.lit(1)).alias("m"), F.count_if("slow").alias("k")).join(p, "type").join(classes, area)
    g = c.groupBy("grp").agg(F.count_distinct(area).alias("areas"), F.sum("m").alias("n"), F.sum("k").alias("k"), (F.sum(F.col("m") * F.col("p")) / F.sum("m")).alias("x"))
    low, high = wilson(F.col("k"), F.col("n"))
    km = agg.km_median(agg.km_counts(e.join(classes, area), ["grp"], "time", F.col("is_closed")), ["grp"])
    share = F.col("k") / F.col("n")
    return g.join(km.select("grp", F.col("value").alias("median_days")), "grp").select(
        "grp", "areas", "n", share.alias("observed_share"), F.col("x").alias("expected_share"), (share / F.col("x")).alias("ratio"), (low / F.col("x")).alias("ci_low"), (high / F.col("x")).alias("ci_high"), "median_days")


def group_context(components: DataFrame, classes: DataFrame, area: str, measures: list[tuple], events: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """grp, measure, value, moe, ci_low, ci_high, interval, count for each group of areas and for ``citywide``.

    Survey measures come from components added up over a group's areas, with the margin of the sum; ``events`` names, for
    each rate per 1,000, its records and the component that is its denominator. Citywide rows take all areas.
    """
    every = components.select(F.col("geo_id").alias(area)).distinct().withColumn("grp", F.lit("citywide"))
    member = classes.select(area, "grp").unionByName(every)
    pooled = components.join(member, components["geo_id"] == member[area]).groupBy("grp", "variable").agg(F.sum("estimate").alias("estimate"), F.sqrt(F.sum(F.pow("moe", 2))).alias("moe"))
    pooled = cut_lineage(pooled.select(F.lit("group").alias("geo_type"), F.col("grp").alias("geo_id"), "variable", "estimate", "moe"))
    dem = agg.derive_measures(pooled, measures).select(F.col("geo_id").alias("grp"), "measure", "value", "moe", (F.col("value") - F.col("moe")).alias("ci_low"), (F.col("value") + F.col("moe")).alias("ci_high"),
                                                       F.lit("survey 90% margin").alias("interval"), F.lit(None).cast("bigint").alias("count"))
    out = dem
    for name, (rows, variable) in events.items():
        per_area = rows.where(F.col(area).isNotNull()).groupBy(area).agg(F.count(F.lit(1)).alias("n"))
        den = pooled.where(F.col("variable") == variable).select(F.col("geo_id").alias("grp"), F.col("estimate").alias("den"))
        n = den.join(per_area.join(member, area).groupBy("grp").agg(F.sum("n").alias("n")), "grp", "left").fillna(0, ["n"])
        rate = agg.poisson_rate(n, "n", F.col("den"), 1000)
        out = out.unionByName(rate.select("grp", F.lit(name).alias("measure"), "value", F.lit(None).cast("double").alias("moe"), "ci_low", "ci_high", F.lit("95% Poisson").alias("interval"), F.col("n").alias("count")))
    return out


def top_values(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """keys, top: the k most frequent values (count descending, then value) as an array.

    Counts come first, so the array per group is over distinct values of a code
    list and not over records.
    """
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "value", "n")))
    return n.groupBy(*keys).agg(F.slice(ranked, 1, k).alias("top"))


def covering_values(df: DataFrame, group: str, value: str, share: float) -> DataFrame:
    """Most common value per group, and the values that together stay within ``share`` of it."""
    n = df.groupBy(group, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(group)
    order = w.orderBy(F.desc("n"), "v")
    s = (n.withColumn("k", F.row_number().over(order))
         .withColumn("cum", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(w)))
    kept = F.when((F.col("cum") <= share) | (F.col("k") == 1), F.struct("k", "v"))
    return s.groupBy(group).agg(F.max(F.when(F.col("k") == 1, F.col("v"))).alias("most"),
                                F.array_join(F.sort_array(F.collect_list(kept))["v"], ",").alias("covering"))


def address_report(addresses: DataFrame, cell_rows: DataFrame, area_rows: DataFrame) -> DataFrame:
    """One row per address and type: the metric near it, citywide, in its ZIP area and in its district.

    ``addresses``: id, cell, zcta, district; metric rows: type, geo_type, geo_id, value, n. A type is listed for every
    address as soon as it has a citywide row. What a report says depends on the areas alone, so it is put together once
    per combination of areas, and an address brings only its combination.
    """
    labels, areas = ["near", "city", "zip", "district"], ["cell", "zcta", "district"]
    homes = addresses.select("id", *areas).dropDuplicates(["id"])
    spots = homes.select(*areas).distinct()
    places = F.array(*[F.struct(F.lit(lab).alias("label"), F.lit(g).alias("geo_type"), c.alias("geo_id")) for lab, g, c in zip(
        labels, ("hex_174m", "citywide", "zcta", "super_district"), (F.col("cell"), F.lit("city"), F.col("zcta"), F.col("district")))])
    rows = cell_rows.select("type", *CELL, "value", "n").unionByName(area_rows.select("type", *CELL, "value", "n"))
    wide = (spots.select(F.struct(*areas).alias("spot"), F.inline(places)).join(rows, CELL).groupBy("spot", "type").pivot("label", labels)
            .agg(F.first("value").alias("value"), F.first("n").alias("n")))
    wide = cut_lineage(wide.fillna(0, [f"{lab}_n" for lab in labels]))
    at = homes.select("id", F.struct(*areas).alias("at"))
    return at.join(small_side(wide), F.col("at").eqNullSafe(F.col("spot"))).drop("at", "spot")


def dispositions(closed: DataFrame, resolution: str, sub: str, type_col: str, shown_id: Column, types: int = 3, samples: int = 5) -> DataFrame:
    """Every (resolution, sub-status) with its count, top types and a few sample ids in hash order.

    The sample keeps the smallest hashes per group: 4,096 hash ranges per
    group are cut to ``samples`` first, so no group is gathered whole.
    """
    clean = lambda c: F.when(F.col(c).isNull() | (F.trim(c) == ""), "(blank)").otherwise(F.col(c))
    d = closed.select(clean(resolution).alias("resolution"), clean(sub).alias("sub"), F.col(type_col).alias("ty"), shown_id.alias("id"))
    key = ["resolution", "sub"]
    top = top_values(d, key, "ty", types)
    n = d.groupBy(*key).agg(F.count(F.lit(1)).alias("closed_requests"))
    h = d.withColumn("h", F.md5(F.col("id").cast("binary"))).withColumn("part", F.substring("h", 1, 3))
    w = Window.partitionBy(*key, "part").orderBy("h")
    few = h.withColumn("k", F.row_number().over(w)).where(F.col("k") <= samples)
    ids = few.groupBy(*key).agg(F.slice(F.sort_array(F.collect_list(F.struct("h", "id"))), 1, samples)["id"].alias("ids"))
    return n.join(top, key).join(ids, key).select(*key, "closed_requests", F.array_join("top.value", "; ").alias("top_types"),
                                                  F.array_join("ids", " ").alias("samples"))


def closed_without_action(closed: DataFrame, mapping: dict[str, str], levels: dict[str, Column]) -> DataFrame:
    """Share of closed requests whose resolution code means nothing was done.

    ``mapping``: code -> 'strict' (certainly no action) or 'broad' (probably
    none). The strict variant counts strict codes, the broad one both.
    """
    kind = F.try_element_at(F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv]), F.col("code"))
    d = fan_out(closed, [{"variant": "strict"}, {"variant": "broad"}], {"variant": "string"})
    hit = F.coalesce((kind == "strict") | ((F.col("variant") == "broad") & (kind == "broad")), F.lit(False))
    return agg.flag_proportion(by_area(d.withColumn("_hit", hit), levels), ["variant", *CELL], F.col("_hit"))


def cluster_specification(base: DataFrame, nb: DataFrame, start: Column, end: Column, area: str,
                          exclude_types: tuple[str, ...] = (), nsim: int = 9999, nsim_local: int | None = None) -> DataFrame:
    """One row for one specification: record flow, global Moran, and how many areas have each local class.

    Slow requests against each area's own mix, empirical-Bayes z, then global
    and local Moran over the areas that clear the minimum. ``slow_cores`` and
    ``fast_cores`` are areas high or low among their like after adjustment,
    ``unadjusted`` those only before it, ``outliers`` those unlike their
    surroundings.
    """
    from wardstat.operators import spatial_stats as ss
    w = base.where(F.col("opened").between(start, end))
    d = w.where(F.col("close_problem").isNull())
    if exclude_types:
        d = d.where(~F.col("type").isin(*exclude_types))
    d = d.withColumn("time", F.when(F.col("is_closed"), F.col("bd_to_close")).otherwise(F.col("age_bd"))).where("time is not null")
    flow = w.agg(F.count(F.lit(1)).alias("in_window"), F.count("close_problem").alias("close_problem"))
    kept = d.agg(F.count(F.lit(1)).alias("timing_records"))
    ratios = cut_lineage(agg.standardized_ratio(flag_slow(d), area, "type", F.col("slow")).where("not suppressed"))
    z = ss.eb_standardize(ratios).select(F.col(area).alias("id"), F.coalesce("z", F.lit(0.0)).alias("z"))
    z = cut_lineage(z)
    links = nb.join(z.select(F.col("id").alias("i")), "i", "left_semi").join(z.select(F.col("id").alias("j")), "j", "left_semi").select("i", "j")
    g = ss.moran_global(z, links, "z", nsim).select("moran_i", "expected", "sd", F.col("z").alias("moran_z"), F.col("p_perm").alias("moran_p"), F.col("n").alias("areas"))
    c = F.col("class")
    loc = ss.lisa(z, links, "z", nsim_local or nsim).agg(
        F.count_if(c == "HH").alias("slow_cores"), F.count_if(c == "LL").alias("fast_cores"), F.count_if(c.endswith("_unadj")).alias("unadjusted"),
        F.count_if(c.isin("HL", "LH")).alias("outliers"), F.min("p").alias("min_p"), F.min("q").alias("min_q"))
    return flow.transform(attach, kept).transform(attach, g).transform(attach, loc)
