"""The published metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.functions import geo
from wardstat.functions.dates import local_day
from wardstat.operators import checks, metrics, normalize, spatial
from wardstat.operators import aggregates as A
from wardstat.operators.joins import by_area, classify_trips
from wardstat.plans import proxies as P
from wardstat.plans.proxies import day, rnd, sql, w_high, w_low
from wardstat.plans.q_aggregates import DERIVE, MEASURES, areas_slow, components, neighbors, slow_rows, sql_lisa, sql_moran
from wardstat.plans.q_joins import matched, sched_trips
from wardstat.plans.q_mapping import demolitions, inspections, permits
from wardstat.plans.q_sequences import food_places, outage_events, peak_events
from wardstat.plans.registry import query
from wardstat.session import cut_lineage

CI = ("value", "ci_low", "ci_high")
COLS = ["metric", "variant", "subgroup", "geo_type", "geo_id", "window_start", "window_end", "value", "ci_low", "ci_high", "n", "suppressed"]
_C = ", ".join(COLS)


def shaped(m, digits: int = 6):
    return rnd(m, digits, *CI).select(*COLS)


def _r(digits: int = 6) -> str:
    return _C.replace(" value, ci_low, ci_high", f" round(value, {digits}) AS value, round(ci_low, {digits}) AS ci_low, round(ci_high, {digits}) AS ci_high")


# --- requests -----------------------------------------------------------------

def tickets_linked(t):
    """Clean requests with near-duplicate links among included, located ones."""
    k = cut_lineage(P.tickets(t).drop("duplicate_of"))
    cand = k.where(F.col("exclusion").isNull() & F.col("x").isNotNull()).select("id", "type", "x", "y", F.unix_date("opened").cast("double").alias("t"))
    return cut_lineage(k.join(spatial.near_duplicates(cand, 50, 7), "id", "left"))


def sql_med(base: str, p: str = "md") -> list:
    """CTEs ending in <p>: median rows."""
    return [(f"{p}w", P.sql_windows(base, "opened")),
            (f"{p}t", f"SELECT *, CASE WHEN is_closed THEN bd_to_close ELSE age_bd END AS time, CAST(is_closed AS INTEGER) AS ev FROM {p}w WHERE close_problem IS NULL"),
            (f"{p}l", P.sql_levels(f"{p}t"))] + P.sql_km(f"{p}l", "type, geo_type, geo_id, window_start, window_end", f"{p}k") + [
            (p, f"SELECT 'median_business_days_to_close' AS metric, 'primary' AS variant, type AS subgroup, geo_type, geo_id, window_start, window_end, value, ci_low, ci_high, n, suppressed FROM {p}k")]


_TV = "(VALUES ('1-URGENT','primary',10),('1-URGENT','lower_bound',5),('2-HIGH','primary',15),('2-HIGH','lower_bound',10),('3-MEDIUM','primary',20),('4-NOT SPECIFIED','primary',20),('4-NOT SPECIFIED','lower_bound',10)) v(ty, variant, target)"


def sql_prop(src: str, metric: str, flag: str, by: str = "variant, subgroup, geo_type, geo_id, window_start, window_end") -> str:
    return (f"SELECT '{metric}' AS metric, {by}, n, {P.sql_proportion()} FROM (SELECT {by}, count(*) FILTER (WHERE {flag}) AS x, count(*) AS n FROM {src} GROUP BY ALL)")


def sql_tgt(base: str, p: str = "tg") -> list:
    return [(f"{p}0", f"SELECT b.*, type AS subgroup, variant, target, is_closed AND bd_to_close <= target AS on_time FROM {base} b JOIN {_TV} ON ty = type WHERE close_problem IS NULL AND age_bd >= target"),
            (f"{p}w", P.sql_windows(f"{p}0", "opened")), (f"{p}l", P.sql_levels(f"{p}w")), (p, sql_prop(f"{p}l", "pct_within_target", "coalesce(on_time, false)"))]


def sql_link() -> list:
    """CTEs ending in bl (base without duplicates) and rr (closings with re-report days)."""
    return [("cand", "SELECT id, type, x, y, CAST(opened - DATE '1990-01-01' AS DOUBLE) AS t FROM base")] + P.sql_dedupe("cand", 50, 7) + [
        ("bl", "SELECT base.* FROM base JOIN dd ON dd.id = base.id WHERE dd.duplicate_of IS NULL"),
        ("rr", """SELECT a.*, r25, r50, r100 FROM (SELECT * FROM bl WHERE is_closed) a LEFT JOIN (SELECT a.id AS rid, min(b.opened - a.close_date) FILTER (WHERE (a.x-b.x)**2 + (a.y-b.y)**2 <= 625) AS r25,
          min(b.opened - a.close_date) FILTER (WHERE (a.x-b.x)**2 + (a.y-b.y)**2 <= 2500) AS r50, min(b.opened - a.close_date) AS r100 FROM bl a JOIN base b ON a.is_closed AND a.type = b.type AND b.opened > a.close_date AND b.opened <= a.close_date + 60
          AND (a.x-b.x)**2 + (a.y-b.y)**2 <= 10000 GROUP BY a.id) q ON rid = a.id""")]


def sql_reo(p: str = "ro") -> list:
    v = "(VALUES ('primary', 30, 50), ('window_14d', 14, 50), ('window_60d', 60, 50), ('radius_25m', 30, 25), ('radius_100m', 30, 100)) v(variant, within, radius)"
    return [(f"{p}0", f"SELECT rr.*, type AS subgroup, variant, coalesce(CASE radius WHEN 25 THEN r25 WHEN 50 THEN r50 ELSE r100 END <= within, false) AS reopened FROM rr, {v} WHERE close_date <= DATE '{P.THROUGH}' - within"),
            (f"{p}w", P.sql_windows(f"{p}0", "close_date")), (f"{p}l", P.sql_levels(f"{p}w")), (p, sql_prop(f"{p}l", "reopen_rate", "reopened"))]


def sql_req(base: str, p: str = "rq") -> list:
    return [(f"{p}p", f"SELECT geo_type, geo_id, count(*) * 16 AS pop FROM ({P.sql_levels('pl')}) GROUP BY 1, 2"), (f"{p}w", P.sql_windows(base, "opened")),
            (f"{p}n", f"SELECT type, geo_type, geo_id, window_start, count(*) AS n FROM ({P.sql_levels(p + 'w')}) GROUP BY ALL"),
            (f"{p}s", f"SELECT p.*, w.*, coalesce(k.n, 0) AS n FROM {p}p p, (SELECT DISTINCT type, window_start, window_end FROM {p}w) w LEFT JOIN {p}n k ON k.type = w.type AND k.window_start = w.window_start AND k.geo_type = p.geo_type AND k.geo_id = p.geo_id")
            ] + P.sql_garwood(f"{p}s", f"{p}g") + [
            (p, f"""SELECT 'requests_per_1000' AS metric, 'primary' AS variant, type AS subgroup, geo_type, geo_id, window_start, window_end, CASE WHEN pop >= 1000 THEN s.n * 1000.0 / pop END AS value,
  CASE WHEN pop >= 1000 THEN lo * 1000 / pop END AS ci_low, CASE WHEN pop >= 1000 THEN hi * 1000 / pop END AS ci_high, s.n, pop < 1000 AS suppressed FROM {p}s s JOIN {p}g g ON g.n = s.n""")]


def population(t):
    p = P.places(t).withColumn("city", F.lit("city"))
    return by_area(p, P.levels()).groupBy("geo_type", "geo_id").agg((F.count(F.lit(1)) * 16).alias("population"))


@query("m_median_days", sql("base", f"SELECT {_C} FROM md", sql_med("base")))
def m_median_days(t):
    return metrics.median_days(normalize.base_records(P.tickets(t)), P.levels(), day(P.THROUGH)).select(*COLS)


@query("m_within_target", sql("base", f"SELECT {_C} FROM tg", sql_tgt("base")))
def m_within_target(t):
    return shaped(metrics.within_target(normalize.base_records(P.tickets(t)), P.targets(t), P.levels(), day(P.THROUGH)))


@query("m_reopen_rate", sql("base", f"SELECT {_C} FROM ro", sql_link() + sql_reo()))
def m_reopen_rate(t):
    return shaped(metrics.reopen_rate(metrics.rereports(tickets_linked(t), day(P.THROUGH)), P.levels(), day(P.THROUGH)))


@query("m_requests_per_1000", sql("base", f"SELECT {_r(4)} FROM rq", sql_req("base")))
def m_requests_per_1000(t):
    return shaped(metrics.requests_per_1000(normalize.base_records(P.tickets(t)), population(t), P.levels(), day(P.THROUGH)), 4)


HEADLINE = ["1-URGENT", "2-HIGH", "4-NOT SPECIFIED"]


def sql_hexm() -> list:
    disk = f"SELECT * EXCLUDE (h9), unnest({P.sql_disk('h9')}) AS geo_id, 'hex_174m' AS geo_type"
    cells = "type, geo_id, window_start, window_end"
    return sql_link() + [
        ("bh", P.sql_hex("(SELECT * FROM bl WHERE type IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED'))", 174.0, "h9", "h9")),
        ("hw", P.sql_windows("bh", "opened")), ("hd", f"{disk}, CASE WHEN is_closed THEN bd_to_close ELSE age_bd END AS time, CAST(is_closed AS INTEGER) AS ev FROM hw WHERE close_problem IS NULL")
    ] + P.sql_km("hd", cells, "hk") + [
        ("ht0", f"SELECT b.*, type AS subgroup, variant, target, is_closed AND bd_to_close <= target AS on_time FROM bh b JOIN {_TV} ON ty = type AND variant = 'primary' WHERE close_problem IS NULL AND age_bd >= target"),
        ("htw", P.sql_windows("ht0", "opened")), ("htd", f"{disk} FROM htw"), ("ht", sql_prop("htd", "pct_within_target", "coalesce(on_time, false)")),
        ("hr0", P.sql_hex(f"(SELECT *, type AS subgroup, 'primary' AS variant, coalesce(r50 <= 30, false) AS reopened FROM rr WHERE type IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') AND close_date <= DATE '{P.THROUGH}' - 30)", 174.0, "h9", "h9")),
        ("hrw", P.sql_windows("hr0", "close_date")), ("hrd", f"{disk} FROM hrw"), ("hr", sql_prop("hrd", "reopen_rate", "reopened")),
        ("hm", f"SELECT 'median_business_days_to_close' AS metric, 'primary' AS variant, type AS subgroup, 'hex_174m' AS geo_type, geo_id, window_start, window_end, value, ci_low, ci_high, n, suppressed FROM hk "
               f"UNION ALL SELECT {_C} FROM ht UNION ALL SELECT {_C} FROM hr")]


@query("m_hex_metrics", sql("base", f"SELECT {_C} FROM hm", sql_hexm()))
def m_hex_metrics(t):
    k = tickets_linked(t)
    return shaped(metrics.hex_metrics(normalize.base_records(k), metrics.rereports(k, day(P.THROUGH)), P.targets(t), HEADLINE, day(P.THROUGH)))


@query("m_address_report", sql("base", """SELECT a.id, c.type, h.value AS near_value, coalesce(h.n, 0) AS near_n, c.value AS city_value, coalesce(c.n, 0) AS city_n, z.value AS zip_value, coalesce(z.n, 0) AS zip_n, d.value AS district_value, coalesce(d.n, 0) AS district_n
  FROM ah a JOIN lk c ON c.geo_type = 'citywide' LEFT JOIN hk h ON h.geo_id = a.h9 AND h.type = c.type LEFT JOIN lk z ON z.geo_type = 'zcta' AND z.geo_id = a.nation AND z.type = c.type LEFT JOIN lk d ON d.geo_type = 'super_district' AND d.geo_id = a.region AND d.type = c.type""", [
    ("ah", P.sql_hex("(SELECT custkey AS id, nation, region, CAST((custkey * 7919) % 1999 AS DOUBLE) AS x, CAST((custkey * 104729) % 2003 AS DOUBLE) AS y FROM pl)", 174.0, "h9", "h9")),
    ("b1", f"SELECT *, CASE WHEN is_closed THEN bd_to_close ELSE age_bd END AS time, CAST(is_closed AS INTEGER) AS ev FROM base WHERE close_problem IS NULL AND opened BETWEEN DATE '{P.THROUGH}' - 364 AND DATE '{P.THROUGH}'"),
    ("bx", P.sql_hex("b1", 174.0, "h9", "h9")), ("bd", f"SELECT type, unnest({P.sql_disk('h9')}) AS geo_id, time, ev FROM bx"), ("bl", P.sql_levels("b1"))]
    + P.sql_km("bd", "type, geo_id", "hk") + P.sql_km("bl", "type, geo_type, geo_id", "lk")))
def m_address_report(t):
    b = normalize.base_records(P.tickets(t))
    area = metrics.median_days(b, P.levels(), day(P.THROUGH), [{"days": 365}]).withColumnRenamed("subgroup", "type")
    d = metrics.day_windows(b.where("close_problem is null"), "opened", day(P.THROUGH), [{"days": 365}])
    d = d.withColumn("time", F.when(F.col("is_closed"), F.col("bd_to_close")).otherwise(F.col("age_bd")))
    per = A.km_counts(d, ["type", "h9"], "time", F.col("is_closed"))
    near = A.km_median(A.over_disk(per, "h9", ["type", "time"], ["events", "censored"]), ["type", "geo_id"]).withColumn("geo_type", F.lit("hex_174m"))
    x, y = P.hashed_xy(F.col("custkey"))
    addr = P.places(t).select(F.col("custkey").alias("id"), geo.hex_cell(x, y, "h9").alias("cell"), F.col("nation").alias("zcta"), F.col("region").alias("district"))
    return metrics.address_report(addr, near, area)


def _with_city(src: str, digits: int = 6) -> str:
    return (f"SELECT a.metric, a.variant, a.subgroup, a.geo_type, a.geo_id, a.window_start, a.window_end, round(a.value, {digits}) AS value, round(a.ci_low, {digits}) AS ci_low, round(a.ci_high, {digits}) AS ci_high, a.n, a.suppressed, round(c.value, {digits}) AS citywide_median "
            f"FROM {src} a LEFT JOIN {src} c ON c.geo_type = 'citywide' AND c.metric = a.metric AND c.variant = a.variant AND c.subgroup = a.subgroup AND c.window_start = a.window_start")


def assembled(parts, skip=(), digits: int = 6):
    """Union of metric frames as a checked metrics table with the citywide reference."""
    m = parts[0]
    for p in parts[1:]:
        m = m.unionByName(p)
    m = checks.as_metrics(m, "0.1", day(P.THROUGH), F.lit("2001-07-16 00:00:00").cast("timestamp"))
    return rnd(checks.citywide_reference(m, skip), digits, *CI, "citywide_median").select(
        "metric", "variant", "subgroup", "geo_type", "geo_id", "window_start", "window_end", *CI, "n", "suppressed", "citywide_median")


@query("m_all_requests", sql("base", _with_city("al"), sql_link() + sql_med("bl") + sql_tgt("bl") + sql_reo() + sql_req("bl") + [
    ("al", f"SELECT {_C} FROM md UNION ALL SELECT {_C} FROM tg UNION ALL SELECT {_C} FROM ro UNION ALL SELECT {_C} FROM rq")]))
def m_all_requests(t):
    k = tickets_linked(t)
    b = normalize.base_records(k)
    th, lv = day(P.THROUGH), P.levels()
    return assembled([m.select(*COLS) for m in (
        metrics.median_days(b, lv, th), metrics.within_target(b, P.targets(t), lv, th), metrics.reopen_rate(metrics.rereports(k, th), lv, th),
        metrics.requests_per_1000(b, population(t), lv, th))])


# --- permits --------------------------------------------------------------------

def permit_points(t):
    return permits(t).where(F.col("exclusion").isNull() & F.col("x").isNotNull()).withColumn("city", F.lit("city"))


def demolition_points(t):
    return demolitions(t).where(F.col("exclusion").isNull() & F.col("x").isNotNull()).withColumn("city", F.lit("city"))


def parcels(t):
    p = P.places(t).withColumn("city", F.lit("city"))
    return by_area(p, P.levels()).groupBy("geo_type", "geo_id").agg((F.count(F.lit(1)) * 5).alias("parcels"))


P.cte("par", f"SELECT geo_type, geo_id, count(*) * 5 AS parcels FROM ({P.sql_levels('pl')}) GROUP BY 1, 2", "pl")
P.cte("pp", "SELECT * FROM pm WHERE exclusion IS NULL AND x IS NOT NULL", "pm")
P.cte("dp", "SELECT * FROM dm WHERE exclusion IS NULL AND x IS NOT NULL", "dm")
_PW = "(VALUES (DATE '2000-07-16'), (DATE '1996-07-16')) w(window_start)"
_SUBS = ", ".join(f"('{s}')" for s in metrics.ALL_SUBGROUPS)


def sql_rate(src: str, subs: str, sub_list: str, p: str) -> list:
    """CTEs ending in <p>: permits per 1,000 parcels."""
    return [(f"{p}0", f"SELECT s.*, variant, window_start, unnest({sub_list}) AS subgroup FROM {src} s, (VALUES ('primary'), ('excl_minor')) v(variant), {_PW} WHERE issue_date BETWEEN window_start AND DATE '{P.THROUGH}' AND (variant = 'primary' OR value IS NULL OR value >= 5000)"),
            (f"{p}n", f"SELECT variant, subgroup, geo_type, geo_id, window_start, count(*) AS n FROM ({P.sql_levels(p + '0')}) GROUP BY ALL"),
            (f"{p}s", f"SELECT p.*, s.subgroup, v.variant, w.window_start, coalesce(n, 0) AS n FROM par p, (VALUES {subs}) s(subgroup), (VALUES ('primary'), ('excl_minor')) v(variant), {_PW} LEFT JOIN {p}n k ON k.geo_type = p.geo_type AND k.geo_id = p.geo_id AND k.subgroup = s.subgroup AND k.variant = v.variant AND k.window_start = w.window_start")
            ] + P.sql_garwood(f"{p}s", f"{p}g") + [
            (p, f"""SELECT 'permits_per_1000_parcels' AS metric, variant, subgroup, geo_type, geo_id, window_start, DATE '{P.THROUGH}' AS window_end, CASE WHEN parcels >= 250 THEN s.n * 1000.0 / parcels END AS value, CASE WHEN parcels >= 250 THEN lo * 1000 / parcels END AS ci_low,
  CASE WHEN parcels >= 250 THEN hi * 1000 / parcels END AS ci_high, s.n, parcels < 250 AS suppressed FROM {p}s s JOIN {p}g g ON g.n = s.n""")]


_SUBLIST = "['all', category, 'all_' || sector, category || '_' || sector]"


@query("m_permits_rate", sql("pp par", f"SELECT {_r(4)} FROM pr", sql_rate("pp", _SUBS, _SUBLIST, "pr")))
def m_permits_rate(t):
    return shaped(metrics.permits_rate(permit_points(t), parcels(t), P.levels(), day(P.THROUGH)), 4)


_DK = "subgroup, geo_type, geo_id, window_start"


def _edge(z: str) -> str:
    """A percentile of the resampled total: Cornish-Fisher with skewness g and kurtosis k."""
    return f"s1 + ({z} + ({z}*{z} - 1) * g / 6 + (pow({z}, 3) - 3*{z}) * k / 24 - (2*pow({z}, 3) - 5*{z}) * g * g / 36) * sqrt(n * var)"


def _sql_value() -> list:
    sk = f"(VALUES {_SUBS}) s(subgroup), (VALUES ('primary'), ('excl_top1pct'), ('cap_10m'), ('median_per_permit')) v(variant), {_PW}"
    return [("dv0", f"SELECT s.*, window_start FROM pp s, {_PW} WHERE issue_date BETWEEN window_start AND DATE '{P.THROUGH}' AND value IS NOT NULL"),
            ("dv1", f"SELECT d.*, top1, unnest({_SUBLIST}) AS subgroup FROM dv0 d JOIN (SELECT window_start, quantile_cont(value, 0.99) AS top1 FROM dv0 GROUP BY 1) q USING (window_start)"),
            ("dv2", P.sql_levels("dv1")),
            ("dv3", " UNION ALL ".join(f"SELECT '{v}' AS variant, {_DK}, count(v) AS n, CAST(sum(CAST(v AS DECIMAL(20,4))) AS DOUBLE) AS s, sum(v) AS s1, sum(pow(v, 2)) AS s2, sum(pow(v, 3)) AS s3, sum(pow(v, 4)) AS s4, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi FROM (SELECT {_DK}, {x} AS v FROM dv2) GROUP BY ALL HAVING count(v) > 0"
                               for v, x in (("primary", "value"), ("excl_top1pct", "CASE WHEN value <= top1 THEN value END"), ("cap_10m", "least(value, 1e7)")))
             + f""" UNION ALL SELECT 'median_per_permit', {_DK}, n, s, 0, 0, 0, 0, l[greatest(1, CAST(ceil(n / 2.0::DOUBLE - {P.Z} * sqrt(n) / 2) AS BIGINT))], l[least(n, CAST(ceil(n / 2.0::DOUBLE + {P.Z} * sqrt(n) / 2) AS BIGINT))]
  FROM (SELECT {_DK}, count(*) AS n, median(value) AS s, list_sort(list(value)) AS l FROM dv2 GROUP BY ALL)"""),
            ("dv4", f"SELECT *, s1 / n AS m1, greatest(0, s2 / n - (s1 / n) * (s1 / n)) AS var FROM dv3"),
            ("dv5", """SELECT *, CASE WHEN var > 0 THEN (s3 / n - 3 * m1 * (s2 / n) + 2 * m1 * m1 * m1) / pow(var, 1.5) ELSE 0 END / sqrt(n) AS g,
  CASE WHEN var > 0 THEN (s4 / n - 4 * m1 * (s3 / n) + 6 * m1 * m1 * (s2 / n) - 3 * pow(m1, 4)) / (var * var) - 3 ELSE 0 END / n AS k FROM dv4"""),
            ("dv6", f"SELECT * REPLACE (coalesce(lo, {_edge('-' + P.Z)}) AS lo, coalesce(hi, {_edge(P.Z)}) AS hi) FROM dv5"),
            ("dv7", f"""SELECT p.geo_type, p.geo_id, s.subgroup, v.variant, w.window_start, coalesce(k.n, 0) AS n, coalesce(k.n, 0) < 20 OR parcels < 250 AS suppressed, CASE WHEN v.variant = 'median_per_permit' THEN 1 ELSE 1000.0::DOUBLE / parcels END AS per, k.s, k.lo, k.hi
  FROM par p, {sk} LEFT JOIN dv6 k ON k.geo_type = p.geo_type AND k.geo_id = p.geo_id AND k.subgroup = s.subgroup AND k.variant = v.variant AND k.window_start = w.window_start"""),
            ("dv", f"""SELECT 'declared_value_per_1000_parcels' AS metric, variant, subgroup, geo_type, geo_id, window_start, DATE '{P.THROUGH}' AS window_end, CASE WHEN NOT suppressed THEN s * per END AS value,
  CASE WHEN NOT suppressed THEN round(least(lo * per, s * per), 1) END AS ci_low, CASE WHEN NOT suppressed THEN round(greatest(hi * per, s * per), 1) END AS ci_high, n, suppressed FROM dv7""")]


def _sql_demo() -> list:
    return [("dr0", f"SELECT nation, region, window_start, 1 AS d FROM dp, {_PW} WHERE issue_date BETWEEN window_start AND DATE '{P.THROUGH}' UNION ALL SELECT nation, region, window_start, 0 FROM pp, {_PW} WHERE category = 'new' AND issue_date BETWEEN window_start AND DATE '{P.THROUGH}'"),
            ("dr", f"""SELECT 'demolition_to_new_ratio' AS metric, 'primary' AS variant, 'all' AS subgroup, p.geo_type, p.geo_id, w.window_start, DATE '{P.THROUGH}' AS window_end, CASE WHEN coalesce(d + m, 0) >= 20 AND m > 0 THEN CAST(d AS DOUBLE) / m END AS value, CASE WHEN coalesce(d + m, 0) >= 20 AND m > 0 THEN {w_low('d', '(d+m)')} / (1 - {w_low('d', '(d+m)')}) END AS ci_low,
  CASE WHEN coalesce(d + m, 0) >= 20 AND m > 0 THEN {w_high('d', '(d+m)')} / (1 - {w_high('d', '(d+m)')}) END AS ci_high, CAST(coalesce(d + m, 0) AS BIGINT) AS n, NOT (coalesce(d + m, 0) >= 20 AND m > 0) AS suppressed
  FROM par p, {_PW} LEFT JOIN (SELECT geo_type, geo_id, window_start, sum(d) AS d, sum(1 - d) AS m FROM ({P.sql_levels('dr0')}) GROUP BY ALL) k ON k.geo_type = p.geo_type AND k.geo_id = p.geo_id AND k.window_start = w.window_start""")]


def _in_tenths(m):
    """Intervals of declared values in tenths: sums of fourth powers differ by more in the last digits."""
    return m.withColumns({c: F.when(F.col("metric") == "declared_value_per_1000_parcels", F.round(c, 1)).otherwise(F.col(c)) for c in CI[1:]})


@query("declared_value", sql("pp par", f"SELECT {_r(6)} FROM dv", _sql_value()))
def declared_value(t):
    m = metrics.declared_value(permit_points(t), parcels(t), P.levels(), day(P.THROUGH))
    return shaped(_in_tenths(m), 6)


@query("m_permits_all", sql("pp dp par", _with_city("al", 4), sql_rate("pp", _SUBS, _SUBLIST, "pr") + sql_rate("dp", "('demolition')", "['demolition']", "dx") + _sql_value() + _sql_demo() + [
    ("al", " UNION ALL ".join(f"SELECT {_C} FROM {x}" for x in ("pr", "dx", "dv", "dr")))]))
def m_permits_all(t):
    pts, dem, par = cut_lineage(permit_points(t)), cut_lineage(demolition_points(t)), cut_lineage(parcels(t))
    th, lv = day(P.THROUGH), P.levels()
    parts = [metrics.permits_rate(pts, par, lv, th), _in_tenths(metrics.declared_value(pts, par, lv, th)),
             metrics.permits_rate(dem, par, lv, th, F.array(F.lit("demolition")), ["demolition"]),
             metrics.demolition_ratio(dem, pts, par, lv, th).withColumn("variant", F.lit("primary")).withColumn("subgroup", F.lit("all"))]
    return assembled([p.select(*COLS) for p in parts], digits=4)


# --- inspections ------------------------------------------------------------------

FT = "2024-01-29"
_FW = f"DATE '2024-01-02' AS window_start, DATE '{FT}' AS window_end"
P.cte("lr", "SELECT place, score, nation, region FROM (SELECT place, arg_max({'s': score}, (date, score)).s AS score FROM ins WHERE exclusion IS NULL AND kind = 'routine' AND score IS NOT NULL GROUP BY 1) JOIN fp USING (place)", "ins", "fp")


def _sql_food() -> list:
    return [("f1", f"SELECT 'median_latest_score' AS metric, 'primary' AS variant, 'all' AS subgroup, geo_type, geo_id, {_FW}, value, ci_low, ci_high, n, suppressed FROM ({P.sql_median('(' + P.sql_levels('lr') + ')', 'geo_type, geo_id', 'score')})"),
            ("f2s", f"SELECT *, 'all' AS subgroup, {_FW} FROM ({P.sql_levels('lr')}), (VALUES ('primary', 70), ('below_80', 80), ('below_85', 85)) v(variant, lim)"),
            ("f2", sql_prop("f2s", "pct_below_followup_threshold", "score < lim")),
            ("f3s", f"SELECT *, CASE grace WHEN 0 THEN 'primary' ELSE 'grace_' || grace || 'd' END AS variant, 'all' AS subgroup, DATE '2024-01-02' AS window_start, DATE '{FT}' AS window_end FROM ({P.sql_levels('od')})"),
            ("f3", sql_prop("f3s", "pct_overdue_inspection", "overdue")),
            ("f4a", "SELECT kind, nation, region FROM ins JOIN fp USING (place) WHERE exclusion IS NULL AND kind IN ('routine', 'follow_up')"),
            ("f4s", f"SELECT *, 'primary' AS variant, 'all' AS subgroup, {_FW} FROM ({P.sql_levels('f4a')})"), ("f4", sql_prop("f4s", "reinspection_rate", "kind = 'follow_up'"))]


def _food(t):
    pl, ins, th, lv, frm = food_places(t), inspections(t), day(FT), P.levels(), day("2024-01-02")
    from wardstat.plans.q_sequences import OVERDUE
    return (lambda: metrics.food_scores(pl, ins, lv, th, data_from=frm), lambda: metrics.food_overdue(pl, ins, lv, th, data_from=frm, **OVERDUE),
            lambda: metrics.food_reinspection(pl, ins, lv, th, data_from=frm))


@query("m_food_scores", sql("lr od", f"SELECT {_C} FROM f1 UNION ALL SELECT {_C} FROM f2", _sql_food()))
def m_food_scores(t):
    return shaped(_food(t)[0]().withColumn("subgroup", F.lit("all")))


@query("m_food_reinspection", sql("lr od", f"SELECT {_C} FROM f4", _sql_food()))
def m_food_reinspection(t):
    return shaped(_food(t)[2]().withColumn("subgroup", F.lit("all")))


@query("m_food_all", sql("lr od", _with_city("al"), _sql_food() + [("al", f"SELECT {_C} FROM f1 UNION ALL SELECT {_C} FROM f2 UNION ALL SELECT {_C} FROM f3 UNION ALL SELECT {_C} FROM f4")]))
def m_food_all(t):
    return assembled([f().withColumn("subgroup", F.lit("all")).select(*COLS) for f in _food(t)])


# --- transit --------------------------------------------------------------------

def stop_cells(t):
    """Stop places derived from the suppliers that serve them."""
    s = t.supplier.select((F.col("s_suppkey") % 20).alias("k")).distinct()
    x, y = P.hashed_xy(F.col("k") + 3)
    return s.select(F.concat(F.lit("s"), "k").alias("stop_id"), geo.hex_cell(x, y, "h8").alias("h8"))


P.cte("sc", P.sql_hex("(SELECT DISTINCT 's' || s_suppkey % 20 AS stop_id, CAST(((s_suppkey % 20 + 3) * 7919) % 1999 AS DOUBLE) AS x, CAST(((s_suppkey % 20 + 3) * 104729) % 2003 AS DOUBLE) AS y FROM supplier)", 461.0, "h8", "h8"))


def stop_times(t):
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.to_date("o_orderdate").alias("service_date"), F.col("l_orderkey").cast("string").alias("trip_id"), F.concat(F.lit("s"), F.col("l_suppkey") % 20).alias("stop_id"),
                    "l_linenumber", "l_partkey", F.col("o_orderpriority").alias("route_id")))


P.cte("stt", "SELECT CAST(o_orderdate AS DATE) AS service_date, CAST(l_orderkey AS VARCHAR) AS trip_id, 's' || l_suppkey % 20 AS stop_id, l_linenumber, l_partkey, o_orderpriority AS route_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey")


def sql_transit_levels(src: str, stops: bool, trips: bool = True) -> str:
    """One row per record and transit geography."""
    lv = ([("citywide", "'city'"), ("route", "route_id")] if trips else []) + ([("stop", "stop_id"), ("hex_461m", "h8")] if stops else [])
    return " UNION ALL ".join(f"SELECT *, '{g}' AS geo_type, {c} AS geo_id FROM {src} WHERE {c} IS NOT NULL" for g, c in lv)


def _sql_ghost() -> list:
    return [("g0", "SELECT *, 'all' AS subgroup, CASE tolerance WHEN 15 THEN 'primary' ELSE 'tolerance_' || tolerance || 'min' END AS variant FROM cls WHERE measurable AND status <> 'unobserved'"),
            ("gw", P.sql_windows("g0", "service_date", (30, 90))), ("gl", sql_transit_levels("gw", False)),
            ("gs", "SELECT gw.*, s.stop_id, h8 FROM gw JOIN (SELECT DISTINCT service_date, trip_id, stop_id FROM stt) s ON s.service_date = gw.service_date AND s.trip_id = gw.trip_id LEFT JOIN sc ON sc.stop_id = s.stop_id"),
            ("gsl", sql_transit_levels("gs", True, False)),
            ("gh", sql_prop("gl", "ghost_bus_rate", "status = 'ghost'") + " UNION ALL " + sql_prop("gsl", "ghost_bus_rate", "status = 'ghost'"))]


def _cls(t):
    return classify_trips(matched(t), ["tolerance"])


def _ghost(t, cls):
    return metrics.ghost_rate(cls, stop_times(t), stop_cells(t), day(P.THROUGH)).withColumn("subgroup", F.lit("all"))


@query("m_ghost_rate", sql("cls stt sc", f"SELECT {_C} FROM gh", _sql_ghost()))
def m_ghost_rate(t):
    return shaped(_ghost(t, _cls(t)))


FLOOR = 0.80


def arrivals(t):
    s = sched_trips(t).select("service_date", "trip_id", "first_t")
    a = stop_times(t).join(s, ["service_date", "trip_id"]).withColumn("scheduled", F.col("first_t") + F.col("l_linenumber") * 300)
    return a.withColumn("delay_s", F.col("l_partkey") % 700 - 200).withColumn("arrival", F.when(F.col("l_partkey") % 11 != 0, F.col("scheduled") + F.col("delay_s"))).select(
        "service_date", "trip_id", "route_id", "stop_id", "scheduled", "arrival", "delay_s")


def _sql_ontime() -> list:
    return [("cm", "SELECT * FROM cls WHERE measurable AND tolerance = 15"), ("cw", P.sql_windows("cm", "service_date", (30, 90))),
            ("okr", f"SELECT route_id, window_start FROM cw GROUP BY 1, 2 HAVING avg(CASE WHEN status = 'observed' THEN 1.0 ELSE 0 END) >= {FLOOR}"),
            ("a0", "SELECT stt.*, l_partkey % 700 - 200 AS delay, 'all' AS subgroup, h8 FROM stt LEFT JOIN sc ON sc.stop_id = stt.stop_id WHERE l_partkey % 11 <> 0"), ("aw", P.sql_windows("a0", "service_date", (30, 90))),
            ("av", "SELECT aw.*, variant, early, late FROM aw JOIN okr ON okr.route_id = aw.route_id AND okr.window_start = aw.window_start, (VALUES ('primary', -60, 300), ('window_0_10', 0, 600)) v(variant, early, late)"),
            ("al0", sql_transit_levels("av", True)), ("ot", sql_prop("al0", "on_time_pct", "delay BETWEEN early AND late"))]


def _on_time(t, cls):
    return metrics.on_time(arrivals(t), cls.where("tolerance = 15"), stop_cells(t), day(P.THROUGH), FLOOR).withColumn("subgroup", F.lit("all"))


@query("m_on_time", sql("cls stt sc", f"SELECT {_C} FROM ot", _sql_ontime()))
def m_on_time(t):
    return shaped(_on_time(t, _cls(t)))


def _sql_headway() -> list:
    pair = "SELECT g.*, h8 FROM {g} g JOIN fr ON fr.route_id = g.route_id AND fr.window_start = g.window_start LEFT JOIN sc ON sc.stop_id = g.stop_id"
    cells = "geo_type, geo_id, window_start, window_end"
    return [("hgw", P.sql_windows("hgap", "service_date", (30, 90))), ("sgw", P.sql_windows("sgap", "service_date", (30, 90))),
            ("fr", "SELECT route_id, window_start FROM sgw GROUP BY 1, 2 HAVING median(gap) <= 1800"),
            ("hx", pair.format(g="hgw")), ("sx", pair.format(g="sgw")), ("hxl", sql_transit_levels("hx", True)), ("sxl", sql_transit_levels("sx", True)),
            ("hmed", P.sql_median("hxl", cells, "gap", digits=9)),
            ("hw2", f"SELECT 'peak_headway_ratio' AS metric, 'primary' AS variant, 'all' AS subgroup, m.geo_type, m.geo_id, m.window_start, m.window_end, m.value / sched AS value, ci_low / sched AS ci_low, ci_high / sched AS ci_high, n, suppressed "
                    f"FROM hmed m JOIN (SELECT {cells}, median(gap) AS sched FROM sxl GROUP BY ALL) s ON s.geo_type = m.geo_type AND s.geo_id = m.geo_id AND s.window_start = m.window_start")]


def _headway(t):
    return metrics.headway_ratio(peak_events(t), stop_cells(t), day(P.THROUGH)).withColumn("subgroup", F.lit("all"))


@query("m_headway_ratio", sql("hgap sgap sc", f"SELECT {_r(6)} FROM hw2", _sql_headway()))
def m_headway_ratio(t):
    return shaped(_headway(t))


@query("m_transit_all", sql("cls stt sc hgap sgap", _with_city("al"), _sql_ghost() + _sql_ontime() + _sql_headway() + [("al", f"SELECT {_C} FROM gh UNION ALL SELECT {_C} FROM ot UNION ALL SELECT {_C} FROM hw2")]))
def m_transit_all(t):
    cls = cut_lineage(metrics.in_day_windows(_cls(t), "service_date", day(P.THROUGH), metrics.TRANSIT_WINDOWS))
    return assembled([m.select(*COLS) for m in (_ghost(t, cls), _on_time(t, cls), _headway(t))])


# --- outages ----------------------------------------------------------------------

def outages(t):
    """Events placed in the nation of their user's customer record."""
    e = outage_events(t).join(P.places(t).select(F.col("custkey").cast("string").alias("outage"), "nation", "region"), "outage")
    return (e.withColumn("day", local_day(F.timestamp_seconds("start"))).withColumn("city", F.lit("city"))
            .withColumn("h9", geo.hex_cell(F.col("lon"), F.col("lat"), "h9")))


def denominators(t):
    p = P.places(t).withColumn("city", F.lit("city"))
    return by_area(p, P.levels()).groupBy("geo_type", "geo_id").agg((F.count(F.lit(1)) * 16).alias("population"), (F.count(F.lit(1)) * 7).alias("households"))


ET = P.EVENTS_THROUGH
P.cte("oev", P.sql_hex("""(SELECT oe.*, nation, region, CAST(timezone('America/Chicago', timezone('UTC', make_timestamp(start * 1000000))) AS DATE) AS day, CASE WHEN planned THEN 'planned' ELSE 'all' END AS subgroup FROM oe JOIN pl ON CAST(custkey AS VARCHAR) = outage)""", 174.0, "h9", "h9", "lon", "lat"), "oe", "pl")
P.cte("den", f"SELECT geo_type, geo_id, count(*) * 16 AS population, count(*) * 7 AS households FROM ({P.sql_levels('pl')}) GROUP BY 1, 2", "pl")
_OW = f"DATE '{ET}' - 364 AS window_start, DATE '{ET}' AS window_end"
_SG = "(VALUES ('all'), ('planned')) s(subgroup)"
_OV = "(VALUES ('primary'), ('min_10_customers'), ('min_5_minutes')) v(variant)"


def _sql_outages() -> list:
    return [("w0", f"SELECT * FROM oev WHERE day BETWEEN DATE '{ET}' - 364 AND DATE '{ET}'"),
            ("v0", f"SELECT w0.*, variant FROM w0, {_OV} WHERE CASE variant WHEN 'primary' THEN max_cust >= 1 WHEN 'min_10_customers' THEN max_cust >= 10 ELSE duration_s >= 300 END"),
            ("c0", f"SELECT d.geo_type, d.geo_id, s.subgroup, v.variant, coalesce(n, 0) AS n FROM den d, {_SG}, {_OV} LEFT JOIN (SELECT geo_type, geo_id, subgroup, variant, count(*) AS n FROM ({P.sql_levels('v0')}) GROUP BY ALL) k ON k.geo_type = d.geo_type AND k.geo_id = d.geo_id AND k.subgroup = s.subgroup AND k.variant = v.variant"
                   f" UNION ALL SELECT 'hex_174m', geo_id, subgroup, variant, count(*) FROM (SELECT subgroup, variant, unnest({P.sql_disk('h9')}) AS geo_id FROM v0 WHERE h9 IS NOT NULL) GROUP BY ALL")
            ] + P.sql_garwood("c0", "cg") + [
            ("p1", f"SELECT 'outage_events_per_year' AS metric, variant, subgroup, geo_type, geo_id, {_OW}, CAST(c0.n AS DOUBLE) AS value, lo AS ci_low, hi AS ci_high, c0.n, false AS suppressed FROM c0 JOIN cg ON cg.n = c0.n"),
            ("p2", f"""SELECT 'customer_hours_per_1000' AS metric, 'primary' AS variant, s.subgroup, d.geo_type, d.geo_id, {_OW}, CASE WHEN population >= 1000 THEN (coalesce(lo, 0) + coalesce(hi, 0)) / 2 / households * 1000 END AS value, CASE WHEN population >= 1000 THEN coalesce(lo, 0) / households * 1000 END AS ci_low,
  CASE WHEN population >= 1000 THEN coalesce(hi, 0) / households * 1000 END AS ci_high, coalesce(n, 0) AS n, population < 1000 AS suppressed FROM den d, {_SG} LEFT JOIN (SELECT geo_type, geo_id, subgroup, count(*) AS n, sum(cust_hours_lo) AS lo, sum(cust_hours_hi) AS hi FROM ({P.sql_levels('w0')}) GROUP BY ALL) k
  ON k.geo_type = d.geo_type AND k.geo_id = d.geo_id AND k.subgroup = s.subgroup"""),
            ("r0", "SELECT nation, region, variant, (restored_mid - etr) / 60.0 AS late FROM (SELECT *, 'primary' AS variant, first_etr AS etr FROM w0 UNION ALL SELECT *, 'etr_60m', etr_60m FROM w0 UNION ALL SELECT *, 'final_etr', final_etr FROM w0) WHERE NOT planned AND confirmed AND restoration_span_s <= 3600 AND etr IS NOT NULL"),
            ("p3", f"""SELECT 'restoration_vs_estimate' AS metric, v.variant, 'all' AS subgroup, d.geo_type, d.geo_id, {_OW}, value, ci_low, ci_high, coalesce(n, 0) AS n, coalesce(suppressed, true) AS suppressed FROM den d, (VALUES ('primary'), ('etr_60m'), ('final_etr')) v(variant)
  LEFT JOIN ({P.sql_median('(' + P.sql_levels('r0') + ')', 'variant, geo_type, geo_id', 'late')}) k ON k.variant = v.variant AND k.geo_type = d.geo_type AND k.geo_id = d.geo_id""")]


def _events(t, ev):
    return metrics.outage_counts(ev, denominators(t).select("geo_type", "geo_id"), P.levels(), day(ET))


def _hours(t, ev):
    return metrics.customer_hours(ev, denominators(t), P.levels(), day(ET))


def _restore(t, ev):
    # Polls are hourly here, so restorations inside one poll gap are up to an hour wide.
    return metrics.restoration(ev, denominators(t).select("geo_type", "geo_id"), P.levels(), day(ET), span_max_s=3600)


@query("m_outage_events", sql("oev den", f"SELECT {_r(4)} FROM p1", _sql_outages()))
def m_outage_events(t):
    return shaped(_events(t, outages(t)), 4)


@query("m_customer_hours", sql("oev den", f"SELECT {_r(4)} FROM p2", _sql_outages()))
def m_customer_hours(t):
    return shaped(_hours(t, outages(t)), 4)


@query("m_restoration", sql("oev den", f"SELECT {_r(6)} FROM p3", _sql_outages()))
def m_restoration(t):
    return shaped(_restore(t, outages(t)))


@query("m_power_all", sql("oev den", _with_city("al").replace("round(c.value, 6)", "CASE WHEN a.metric <> 'outage_events_per_year' THEN round(c.value, 6) END"), _sql_outages() + [
    ("al", f"SELECT {_C} FROM p1 UNION ALL SELECT {_C} FROM p2 UNION ALL SELECT {_C} FROM p3")]))
def m_power_all(t):
    ev = cut_lineage(outages(t))
    return assembled([m.select(*COLS) for m in (_events(t, ev), _hours(t, ev), _restore(t, ev))], ("outage_events_per_year",))


# --- slow-service clusters and tables ------------------------------------------------

SPECS = [("primary", "2000-07-16", "contiguity", ()), ("two_years", "1999-07-16", "contiguity", ()), ("knn", "2000-07-16", "knn", ()), ("no_low", "2000-07-16", "contiguity", ("5-LOW",))]


LOCAL_SIMULATIONS, GLOBAL_SIMULATIONS = 99_999, 9_999
P.cte("xy", "SELECT n_name AS id, n_nationkey % 5 * 400 + 200.0 AS x, n_nationkey // 5 * 400 + 200.0 AS y FROM nation")
P.cte("knn", "SELECT i, j FROM (SELECT a.id AS i, b.id AS j, row_number() OVER (PARTITION BY a.id ORDER BY (a.x-b.x)**2 + (a.y-b.y)**2, b.id) AS rank FROM xy a JOIN xy b ON a.id <> b.id) WHERE rank <= 6", "xy")


def sql_cluster(name: str, start: str, nb: str, exclude: tuple[str, ...], p: str) -> list[tuple[str, str]]:
    """CTEs ending in <p>: one row for a specification."""
    types = f" AND type NOT IN ({', '.join(repr(x) for x in exclude)})" if exclude else ""
    return [(f"{p}w", f"SELECT * FROM base WHERE opened BETWEEN DATE '{start}' AND DATE '{P.THROUGH}'"),
            (f"{p}0", f"SELECT type AS g, nation AS area, is_closed, bd_to_close, age_bd, CASE WHEN is_closed THEN bd_to_close ELSE age_bd END AS time, CAST(is_closed AS INTEGER) AS ev FROM {p}w WHERE close_problem IS NULL{types}"),
            (f"{p}1", f"SELECT * FROM {p}0 WHERE time IS NOT NULL")] + P.sql_km(f"{p}1", "g", name=f"{p}k") + [
            (f"{p}2", f"SELECT s.*, NOT coalesce(is_closed AND bd_to_close <= t.value, false) AS is_slow FROM {p}1 s JOIN {p}k t ON t.g = s.g AND NOT t.suppressed WHERE age_bd >= t.value"),
            (f"{p}3", f"SELECT area, count(*) AS n, CAST(count(*) FILTER (WHERE is_slow) AS DOUBLE) AS observed, sum(p) AS expected, sum(p*(1-p)) AS null_var FROM {p}2 JOIN (SELECT g, avg(CAST(is_slow AS INTEGER)) AS p FROM {p}2 GROUP BY 1) q USING (g) GROUP BY area HAVING count(*) >= 30"),
            (f"{p}4", f"SELECT area, observed/expected AS r, sum(observed) OVER () / sum(expected) OVER () AS b, expected / sum(expected) OVER () AS w, null_var / expected**2 AS samp FROM {p}3"),
            (f"{p}5", f"SELECT *, greatest(0, sum(w * (r-b)**2) OVER () - sum(w * samp) OVER ()) AS a FROM {p}4"),
            (f"{p}6", f"SELECT area AS id, coalesce((r - b) / sqrt(nullif(a + samp, 0)), 0) AS v FROM {p}5"),
            (f"{p}z", f"SELECT id, v - avg(v) OVER () AS z FROM {p}6"),
            (f"{p}n", f"SELECT i, j FROM {nb} WHERE i IN (SELECT id FROM {p}z) AND j IN (SELECT id FROM {p}z)"),
            (f"{p}y", f"SELECT a.id, a.z, avg(b.z) AS lag FROM {p}z a JOIN {p}n n ON n.i = a.id JOIN {p}z b ON b.id = n.j GROUP BY 1, 2")
            ] + sql_moran(f"{p}z", f"{p}y", f"{p}n", GLOBAL_SIMULATIONS, f"{p}m") + sql_lisa(f"{p}z", f"{p}n", LOCAL_SIMULATIONS, f"{p}l") + [
            (p, f"""SELECT '{name}' AS spec, (SELECT count(*) FROM {p}w) AS in_window, (SELECT count(close_problem) FROM {p}w) AS close_problem, (SELECT count(*) FROM {p}1) AS timing_records, m.*, l.*
  FROM (SELECT round(moran_i, 6) AS moran_i, round(expected, 6) AS expected, round(sd, 6) AS sd, round(zscore, 5) AS moran_z, round(p_perm, 6) AS moran_p, n AS areas FROM {p}m) m,
  (SELECT count(*) FILTER (WHERE class = 'HH') AS slow_cores, count(*) FILTER (WHERE class = 'LL') AS fast_cores, count(*) FILTER (WHERE class LIKE '%_unadj') AS unadjusted, count(*) FILTER (WHERE class IN ('HL', 'LH')) AS outliers, round(min(p), 6) AS min_p, round(min(q), 6) AS min_q FROM {p}l) l""")]


@query("m_slow_clusters", sql("base nb knn", " UNION ALL ".join(f"SELECT * FROM sc{k}" for k in range(len(SPECS))),
                              [c for k, (n, a, kind, ex) in enumerate(SPECS) for c in sql_cluster(n, a, "knn" if kind == "knn" else "nb", ex, f"sc{k}")]))
def m_slow_clusters(t):
    base = cut_lineage(normalize.base_records(P.tickets(t)))
    nb = {"contiguity": cut_lineage(neighbors(t)), "knn": cut_lineage(spatial.nearest_neighbors(areas_slow(t), 6).select("i", "j"))}
    out = None
    for name, start, kind, ex in SPECS:
        r = metrics.cluster_specification(base, nb[kind], day(start), day(P.THROUGH), "nation", ex, nsim=GLOBAL_SIMULATIONS, nsim_local=LOCAL_SIMULATIONS)
        r = r.withColumn("spec", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return rnd(rnd(out, 6, "moran_i", "expected", "sd", "moran_p", "min_p", "min_q"), 5, "moran_z")


@query("m_closed_without_action", sql("base", f"SELECT variant, geo_type, geo_id, n, {P.sql_proportion()} FROM (SELECT variant, geo_type, geo_id, count(*) FILTER (WHERE hit) AS x, count(*) AS n FROM lv GROUP BY ALL)", [
    ("c", "SELECT *, CASE WHEN price < 60000 THEN 'none' WHEN price < 120000 THEN 'referred' ELSE 'done' END AS code FROM base WHERE is_closed"),
    ("cv", "SELECT c.*, 'strict' AS variant, code = 'none' AS hit FROM c UNION ALL SELECT c.*, 'broad', code IN ('none', 'referred') FROM c"), ("lv", P.sql_levels("cv"))]))
def m_closed_without_action(t):
    code = F.when(F.col("price") < 60000, "none").when(F.col("price") < 120000, "referred").otherwise("done")
    b = normalize.base_records(P.tickets(t)).where("is_closed").withColumn("code", code)
    m = metrics.closed_without_action(b, {"none": "strict", "referred": "broad"}, P.levels())
    return rnd(m, 6, *CI)


@query("m_mix_table", sql("pl", """SELECT nation, round(sum(c_acctbal) FILTER (WHERE seg = 'BUILDING'), 2) AS building, round(sum(c_acctbal) FILTER (WHERE seg = 'MACHINERY'), 2) AS machinery, max(k) AS requests_12m, round(max(k) * 1000.0 / count(*), 4) AS requests_per_1000, round(avg(CASE WHEN c_acctbal >= 0 THEN 1.0 ELSE 0 END), 3) AS share_in_city
  FROM (SELECT nation, c_mktsegment AS seg, c_acctbal FROM customer JOIN pl ON custkey = c_custkey) LEFT JOIN (SELECT nation AS n2, count(*) AS k FROM orders JOIN pl ON custkey = o_custkey WHERE o_orderdate >= '2000-08-01' GROUP BY 1) ON n2 = nation GROUP BY 1"""))
def m_mix_table(t):
    c = t.customer.join(P.places(t), F.col("c_custkey") == F.col("custkey"))
    wide = c.groupBy("nation").pivot("c_mktsegment", ["BUILDING", "MACHINERY"]).agg(F.round(F.sum("c_acctbal"), 2)).withColumnsRenamed({"BUILDING": "building", "MACHINERY": "machinery"})
    n = t.orders.where(F.col("o_orderdate") >= day("2000-08-01")).join(P.places(t), F.col("o_custkey") == F.col("custkey")).groupBy("nation").agg(F.count(F.lit(1)).alias("requests_12m"))
    pop = c.groupBy("nation").agg(F.count(F.lit(1)).alias("p"), F.round(F.avg((F.col("c_acctbal") >= 0).cast("int")), 3).alias("share_in_city"))
    return (wide.join(n, "nation", "left").join(pop, "nation").withColumn("requests_per_1000", F.round(F.col("requests_12m") * 1000 / F.col("p"), 4))
            .select("nation", "building", "machinery", "requests_12m", "requests_per_1000", "share_in_city"))


#: The test areas are hardly clustered: at the usual 0.05 all would be in one group.
GROUP_ALPHA = 0.6
_GROUPS = ([("gz", "SELECT id, z - avg(z) OVER () AS z FROM (SELECT area AS id, coalesce(z, 0) AS z FROM eb)")] + sql_lisa("gz", "nb", LOCAL_SIMULATIONS, "gl", GROUP_ALPHA)
           + [("gc", "SELECT eb.area, CASE class WHEN 'HH' THEN 'slow_core' WHEN 'LL' THEN 'fast_core' ELSE 'other' END AS grp FROM eb LEFT JOIN gl ON gl.id = eb.area")])


def _groups(t, e):
    return metrics.cluster_groups(A.standardized_ratio(e, "nation", "type", F.col("slow")), neighbors(t), "nation", LOCAL_SIMULATIONS, GROUP_ALPHA)


@query("group_pooling", sql("slow eb nb", f"""SELECT grp, areas, z.n, round(x / z.n, 6) AS observed_share, round(pe, 6) AS expected_share, round(x / z.n / pe, 6) AS ratio, round({w_low('x', 'z.n')} / pe, 6) AS ci_low, round({w_high('x', 'z.n')} / pe, 6) AS ci_high, round(km.value, 6) AS median_days FROM (
  SELECT grp, count(DISTINCT area) AS areas, count(*) AS n, CAST(count(*) FILTER (WHERE is_slow) AS DOUBLE) AS x, avg(p) AS pe FROM sg GROUP BY 1) z JOIN km USING (grp)""", _GROUPS + [
    ("sg", "SELECT slow.*, p, grp FROM slow JOIN gc USING (area) JOIN (SELECT g, avg(CAST(is_slow AS INTEGER)) AS p FROM slow GROUP BY 1) q USING (g)")] + P.sql_km("sg", "grp")))
def group_pooling(t):
    e = cut_lineage(slow_rows(t).select("nation", "type", "slow", "time", "is_closed"))
    return rnd(metrics.pool_groups(e, _groups(t, e), "nation"), 6, "observed_share", "expected_share", "ratio", "ci_low", "ci_high", "median_days")


_EVENTS = {"renovation_permits_per_1000_homes": ("BUILDING", "SELECT nation FROM pp WHERE category = 'renovation'"), "new_home_permits_per_1000_homes": ("BUILDING", "SELECT nation FROM pp WHERE category = 'new'"),
           "demolitions_per_1000_homes": ("BUILDING", "SELECT nation FROM dp"), "requests_per_1000_residents": ("HOUSEHOLD", "SELECT nation FROM base")}


@query("group_context", sql("slow eb nb comp pp dp base", """SELECT geo_id AS grp, measure, round(value, 5) AS value, round(moe, 5) AS moe, round(value - moe, 5) AS ci_low, round(value + moe, 5) AS ci_high, 'survey 90% margin' AS interval, NULL::BIGINT AS count FROM gd
  UNION ALL SELECT grp, measure, round(k.n * (1000 / den), 5), NULL, round(lo * (1000 / den), 5), round(hi * (1000 / den), 5), '95% Poisson', k.n FROM gk k JOIN gw ON gw.n = k.n""", _GROUPS + [
    ("gm", "SELECT area, grp FROM gc UNION ALL SELECT DISTINCT geo_id, 'citywide' FROM comp"),
    ("gp", "SELECT grp AS geo_id, v, sum(e) AS e, sqrt(sum(m * m)) AS m FROM comp JOIN gm ON geo_id = area GROUP BY 1, 2"),
    ("gd", DERIVE.replace("FROM comp", "FROM gp")),
    ("ge", " UNION ALL ".join(f"SELECT '{m}' AS measure, '{v}' AS v, nation FROM ({rows})" for m, (v, rows) in _EVENTS.items())),
    ("gk", f"""SELECT p.geo_id AS grp, x.measure, p.e AS den, coalesce(n, 0) AS n FROM (VALUES {', '.join(f"('{m}', '{v}')" for m, (v, _) in _EVENTS.items())}) x(measure, v) JOIN gp p ON p.v = x.v
  LEFT JOIN (SELECT grp, measure, count(*) AS n FROM ge JOIN gm ON nation = area GROUP BY 1, 2) c ON c.grp = p.geo_id AND c.measure = x.measure""")] + P.sql_garwood("gk", "gw")))
def group_context(t):
    pts = cut_lineage(permit_points(t).select("nation", "category"))
    rows = {"renovation_permits_per_1000_homes": pts.where("category = 'renovation'"), "new_home_permits_per_1000_homes": pts.where("category = 'new'"), "demolitions_per_1000_homes": demolition_points(t), "requests_per_1000_residents": normalize.base_records(P.tickets(t))}
    e = cut_lineage(slow_rows(t).select("nation", "type", "slow", "time", "is_closed"))
    m = metrics.group_context(components(t), _groups(t, e), "nation", MEASURES, {k: (rows[k].select("nation"), v) for k, (v, _) in _EVENTS.items()})
    return rnd(m, 5, *CI, "moe")
