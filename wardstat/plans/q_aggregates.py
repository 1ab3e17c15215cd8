"""Aggregations and estimators."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.functions import intervals
from wardstat.operators import aggregates as A
from wardstat.operators import checks, joins, metrics, normalize, spatial, spatial_stats
from wardstat.operators.sequences import latest_per_key
from wardstat.plans import proxies as P
from wardstat.plans.q_mapping import inspections, permits
from wardstat.plans.proxies import day, rnd, sql, w_high, w_low
from wardstat.plans.registry import query
from wardstat.session import attach, cut_lineage

CI = ("value", "ci_low", "ci_high")


@query("group_counts", sql("base", f"SELECT type, geo_type, geo_id, window_start, count(*) AS n FROM lv GROUP BY ALL", [("dw", P.sql_windows("base", "opened")), ("lv", P.sql_levels("dw"))]))
def group_counts(t):
    b = normalize.base_records(P.tickets(t))
    d = joins.by_area(metrics.day_windows(b, "opened", day(P.THROUGH), metrics.REQUEST_WINDOWS), P.levels())
    return d.groupBy("type", "geo_type", "geo_id", "window_start").agg(F.count(F.lit(1)).alias("n"))


@query("subgroup_cube", """SELECT coalesce(c, 'all') AS category, coalesce(s, 'all') AS sector, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size FROM (
  SELECT CASE p_type WHEN 'ECONOMY' THEN 'new' WHEN 'STANDARD' THEN 'new' WHEN 'PROMO' THEN 'renovation' ELSE 'accessory' END AS c, CASE WHEN p_size % 2 = 0 THEN 'residential' ELSE 'commercial' END AS s, p_size FROM part) GROUP BY CUBE (c, s)""")
def subgroup_cube(t):
    p = t.part.select(F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), "new").when(F.col("p_type") == "PROMO", "renovation").otherwise("accessory").alias("c"),
                      F.when(F.col("p_size") % 2 == 0, "residential").otherwise("commercial").alias("s"), "p_size")
    g = p.cube("c", "s").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size"), F.grouping("c").alias("gc"), F.grouping("s").alias("gs"))
    return g.select(F.when(F.col("gc") == 1, "all").otherwise(F.col("c")).alias("category"), F.when(F.col("gs") == 1, "all").otherwise(F.col("s")).alias("sector"), "n", "size")


@query("variant_fanout", """SELECT variant, o_orderpriority, count(*) AS n FROM orders JOIN (VALUES ('primary', 100000), ('low', 50000), ('high', 250000)) v(variant, floor_price) ON o_totalprice >= floor_price GROUP BY 1, 2""")
def variant_fanout(t):
    sets = [{"variant": "primary", "floor": 100000}, {"variant": "low", "floor": 50000}, {"variant": "high", "floor": 250000}]
    d = joins.fan_out(t.orders, sets, {"variant": "string", "floor": "double"}, F.col("o_totalprice") >= F.col("floor"))
    return d.groupBy("variant", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_by_id", "SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def distinct_by_id(t):
    o = t.orders.withColumn("d", F.to_date("o_orderdate"))
    return latest_per_key(o, ["o_custkey"], [F.col("d"), F.col("o_orderkey")], ["o_orderkey", "d", "o_orderstatus"])


P.cte("late", """SELECT nation, region, l_orderkey, l_linenumber, l_quantity, l_shipdate > o_orderdate + INTERVAL 60 DAY AS is_late, l_extendedprice, l_returnflag, p_type, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN pl ON o_custkey = custkey JOIN part ON l_partkey = p_partkey""", "pl")


def lines(t):
    return (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(P.places(t), F.col("o_custkey") == F.col("custkey"))
            .join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("is_late", F.col("l_shipdate") > F.date_add(F.to_date("o_orderdate"), 60)))


@query("wilson_ci", sql("late", f"SELECT nation, x, n, round({w_low('x', 'n')}, 6) AS ci_low, round({w_high('x', 'n')}, 6) AS ci_high FROM (SELECT nation, count(*) FILTER (WHERE is_late) AS x, count(*) AS n FROM late GROUP BY 1)"))
def wilson_ci(t):
    g = lines(t).groupBy("nation").agg(F.count_if("is_late").alias("x"), F.count(F.lit(1)).alias("n"))
    lo, hi = intervals.wilson(F.col("x"), F.col("n"))
    return g.select("nation", "x", "n", F.round(lo, 6).alias("ci_low"), F.round(hi, 6).alias("ci_high"))


@query("proportion_metric", sql("late", f"SELECT nation, p_type, n, {P.sql_proportion(floor=350)} FROM (SELECT nation, p_type, count(*) FILTER (WHERE is_late) AS x, count(*) AS n FROM late GROUP BY 1, 2)"))
def proportion_metric(t):
    return rnd(A.flag_proportion(lines(t), ["nation", "p_type"], F.col("is_late"), min_n=350), 6, *CI)


@query("poisson_rate", sql("pl", "SELECT nation, r.n, round(r.n * 1000.0 / pop, 6) AS value, round(lo * 1000 / pop, 4) AS ci_low, round(hi * 1000 / pop, 4) AS ci_high FROM r JOIN gw ON gw.n = r.n",
                           [("r", "SELECT nation, count(o_orderkey) AS n, count(DISTINCT custkey) * 40 AS pop FROM pl LEFT JOIN orders ON o_custkey = custkey GROUP BY 1")] + P.sql_garwood("r")))
def poisson_rate(t):
    pl = P.places(t)
    o = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count(F.lit(1)).alias("k"))
    g = pl.join(o, "custkey", "left").groupBy("nation").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), (F.count(F.lit(1)) * 40).alias("pop"))
    return rnd(rnd(A.poisson_rate(g, "n", F.col("pop"), 1000), 6, "value"), 4, "ci_low", "ci_high").drop("pop")


@query("median_metric", sql("late", P.sql_median("late", "nation, p_type", "l_quantity", floor=350)))
def median_metric(t):
    return rnd(A.median_metric(lines(t), ["nation", "p_type"], "l_quantity", min_n=350), 6, *CI)


@query("bootstrap_median", sql("pl", P.sql_median("(SELECT nation, o_totalprice FROM orders JOIN pl ON o_custkey = custkey)", "nation", "o_totalprice", digits=4)))
def bootstrap_median(t):
    o = t.orders.join(P.places(t), F.col("o_custkey") == F.col("custkey"))
    return rnd(A.median_metric(o, ["nation"], "o_totalprice"), 4, *CI)


def _sql_draws(reps: int) -> str:
    """Poisson weights of every copy of a value: four replicates to a hash, as the operator draws them."""
    cases = " ".join(f"WHEN u < '{b}' THEN {i}" for i, b in enumerate(A.poisson_steps()))
    return f"""SELECT nation, x, 4 * b + k AS rep, CASE {cases} ELSE {len(A.poisson_steps())} END AS w FROM (
  SELECT nation, x, b, k, substr(h, 8 * k + 1, 8) AS u FROM (SELECT *, md5('w:{A.SEED}:' || nation || ':' || CAST(x AS DECIMAL(24,4)) || ':' || copy || ':' || b) AS h FROM bt, range(0, {-(-reps // 4)}) g(b)), range(0, 4) q(k))"""


@query("bootstrap_total", sql("pl", """SELECT nation, any_value(n) AS n, round(any_value(total), 2) AS total, round(quantile_cont(s, 0.025), 2) AS ci_low, round(quantile_cont(s, 0.975), 2) AS ci_high FROM (
  SELECT nation, rep, any_value(n) AS n, any_value(total) AS total, any_value(n) * sum(w * x) / sum(w) AS s FROM bw JOIN (SELECT nation, count(*) AS n, sum(x) AS total FROM bt GROUP BY 1) USING (nation) GROUP BY nation, rep) GROUP BY nation""", [
    ("bt", "SELECT nation, o_totalprice AS x, row_number() OVER (PARTITION BY nation, o_totalprice) AS copy FROM orders JOIN pl ON o_custkey = custkey"), ("bw", _sql_draws(A.REPS))]))
def bootstrap_total(t):
    o = t.orders.join(P.places(t), F.col("o_custkey") == F.col("custkey")).select("nation", "o_totalprice")
    return rnd(A.bootstrap_total(o, ["nation"], "o_totalprice"), 2, "total", "ci_low", "ci_high")


_KM = [("tm", "SELECT *, CASE WHEN is_closed THEN bd_to_close ELSE age_bd END AS time, CAST(is_closed AS INTEGER) AS ev FROM base WHERE close_problem IS NULL")]


@query("km_median", sql("base", "SELECT type, region, value, ci_low, ci_high, n, suppressed FROM km", _KM + P.sql_km("tm", "type, region")))
def km_median(t):
    b = normalize.base_records(P.tickets(t)).where("close_problem is null")
    b = b.withColumn("time", F.when(F.col("is_closed"), F.col("bd_to_close")).otherwise(F.col("age_bd")))
    return A.km_median(A.km_counts(b, ["type", "region"], "time", F.col("is_closed")), ["type", "region"])


_HEXB = [("hb", P.sql_hex("tm", 174.0, "h9", "h9"))]


@query("hex_km", sql("base", "SELECT geo_id, value, ci_low, ci_high, n, suppressed FROM km",
                     _KM + _HEXB + [("dk", f"SELECT unnest({P.sql_disk('h9')}) AS geo_id, time, ev FROM hb")] + P.sql_km("dk", "geo_id")))
def hex_km(t):
    b = normalize.base_records(P.tickets(t)).where("close_problem is null")
    b = b.withColumn("time", F.when(F.col("is_closed"), F.col("bd_to_close")).otherwise(F.col("age_bd")))
    per = A.km_counts(b, ["h9"], "time", F.col("is_closed"))
    return A.km_median(A.over_disk(per, "h9", ["time"], ["events", "censored"]), ["geo_id"])


@query("hex_proportion", sql("base", f"SELECT geo_id, n, {P.sql_proportion()} FROM (SELECT unnest({P.sql_disk('h9')}) AS geo_id, count(*) FILTER (WHERE is_closed) AS x, count(*) AS n FROM hb GROUP BY 1)", [("hb", P.sql_hex("base", 174.0, "h9", "h9"))]))
def hex_proportion(t):
    per = normalize.base_records(P.tickets(t)).groupBy("h9").agg(F.count_if("is_closed").alias("x"), F.count(F.lit(1)).alias("n"))
    return rnd(A.proportion(A.over_disk(per, "h9", [], ["x", "n"])), 6, *CI).drop("x")


# --- demographics ---------------------------------------------------------------

@query("weighted_apportion", sql("pl", """WITH bg AS (SELECT o_orderkey AS bg, o_totalprice AS e, CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 2000 THEN NULL ELSE o_totalprice / 10 END AS m FROM orders),
  w AS (SELECT l_orderkey AS bg, l_returnflag AS geo, sum(l_quantity) / max(tot) AS wp, sum(l_extendedprice) / max(tot2) AS wh FROM (SELECT *, sum(l_quantity) OVER (PARTITION BY l_orderkey) AS tot, sum(l_extendedprice) OVER (PARTITION BY l_orderkey) AS tot2 FROM lineitem) GROUP BY 1, 2),
  x AS (SELECT geo, 'people' AS variable, e * wp AS e, m * wp AS m FROM w JOIN bg USING (bg) UNION ALL SELECT geo, 'homes', e * wh, m * wh FROM w JOIN bg USING (bg))
  SELECT 'flag' AS geo_type, geo AS geo_id, variable, round(sum(e), 2) AS estimate, CASE WHEN count(m) = count(*) THEN round(sqrt(sum(m * m)), 2) END AS moe FROM x GROUP BY ALL""").replace("WITH RECURSIVE pl AS", "WITH RECURSIVE pl AS").replace("\nWITH bg AS", ",\nbg AS", 1))
def weighted_apportion(t):
    li = A.even_share(t.lineitem, ["l_orderkey"], {"l_quantity": "weight_pop", "l_extendedprice": "weight_hu"})
    blocks = li.select(F.col("l_orderkey").alias("bg"), "weight_pop", "weight_hu", "l_returnflag")
    moe = F.when(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 2000)), F.col("o_totalprice") / 10)
    bg = t.orders.select(F.col("o_orderkey").alias("bg"), F.explode(F.array(F.lit("people"), F.lit("homes"))).alias("variable"), F.col("o_totalprice").alias("estimate"), moe.alias("moe"))
    return rnd(A.apportion(bg, blocks, {"flag": "l_returnflag"}, ["homes"]), 2, "estimate", "moe")


P.cte("acs", """SELECT c_mktsegment AS seg, n_name AS nation, sum(c_acctbal) FILTER (WHERE c_acctbal > 0) AS num, sum(abs(c_acctbal)) AS den, stddev_pop(c_acctbal) * 5 AS mn, stddev_pop(c_acctbal) * 4 AS md FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")


def acs_groups(t):
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("c_mktsegment").alias("seg"), F.col("n_name").alias("nation"))
            .agg(F.sum(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))).alias("num"), F.sum(F.abs("c_acctbal")).alias("den"),
                 (F.stddev_pop("c_acctbal") * 5).alias("mn"), (F.stddev_pop("c_acctbal") * 4).alias("md")))


@query("acs_moe", sql("acs", """SELECT seg, nation, round(sqrt(mn*mn + (num/den)**2 * md*md) / den, 6) AS ratio_moe,
  round(CASE WHEN mn*mn - (num/den)**2 * md*md < 0 THEN sqrt(mn*mn + (num/den)**2 * md*md) ELSE sqrt(mn*mn - (num/den)**2 * md*md) END / den, 6) AS prop_moe FROM acs"""))
def acs_moe(t):
    c = [F.col(x) for x in ("num", "den", "mn", "md")]
    return acs_groups(t).select("seg", "nation", F.round(intervals.acs_moe_ratio(*c), 6).alias("ratio_moe"), F.round(intervals.acs_moe_proportion(*c), 6).alias("prop_moe"))


@query("acs_reliability", """SELECT c_custkey, CASE WHEN m = 0 THEN 'high' WHEN e = 0 THEN NULL WHEN m/1.645/abs(e) < 0.12 THEN 'high' WHEN m/1.645/abs(e) <= 0.40 THEN 'medium' ELSE 'low' END AS reliability
  FROM (SELECT c_custkey, CASE WHEN c_acctbal < -900 THEN 0 ELSE c_acctbal END AS e, CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 900.0 END AS m FROM customer)""")
def acs_reliability(t):
    e = F.when(F.col("c_acctbal") < -900, 0.0).otherwise(F.col("c_acctbal"))
    m = F.when(F.col("c_mktsegment") == "BUILDING", 0.0).otherwise(900.0)
    return t.customer.select("c_custkey", intervals.acs_reliability(e, m).alias("reliability"))


def components(t):
    """Segment balances per nation as survey variables, one per area and variable."""
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("geo_id"), F.col("c_mktsegment").alias("variable")).agg(
        F.round(F.sum(F.abs("c_acctbal")), 2).alias("estimate"), F.count(F.lit(1)).cast("double").alias("k"))
    return c.select(F.lit("zcta").alias("geo_type"), "geo_id", "variable", "estimate", (F.col("k") * 100).alias("moe"))


P.cte("comp", "SELECT n_name AS geo_id, c_mktsegment AS v, round(sum(abs(c_acctbal)), 2) AS e, count(*) * 100.0 AS m FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
MEASURES = [("homes", "count", "BUILDING+HOUSEHOLD", ""), ("pct_auto", "proportion", "AUTOMOBILE", "AUTOMOBILE+MACHINERY+FURNITURE"), ("per_home", "ratio", "FURNITURE", "BUILDING+HOUSEHOLD")]
DERIVE = """SELECT geo_id, measure, CASE WHEN den IS NULL THEN num WHEN den > 0 THEN num / den END AS value, CASE WHEN den IS NULL THEN mnum WHEN den > 0 AND measure = 'pct_auto' AND mnum**2 - (num/den)**2*mden**2 >= 0 THEN sqrt(mnum**2 - (num/den)**2*mden**2)/den
  WHEN den > 0 THEN sqrt(mnum**2 + (num/den)**2*mden**2)/den END AS moe FROM (
  SELECT geo_id, 'homes' AS measure, sum(e) FILTER (WHERE v IN ('BUILDING','HOUSEHOLD')) AS num, NULL::DOUBLE AS den, sqrt(sum(m*m) FILTER (WHERE v IN ('BUILDING','HOUSEHOLD'))) AS mnum, NULL::DOUBLE AS mden FROM comp GROUP BY 1
  UNION ALL SELECT geo_id, 'pct_auto', sum(e) FILTER (WHERE v = 'AUTOMOBILE'), sum(e) FILTER (WHERE v IN ('AUTOMOBILE','MACHINERY','FURNITURE')), sqrt(sum(m*m) FILTER (WHERE v = 'AUTOMOBILE')), sqrt(sum(m*m) FILTER (WHERE v IN ('AUTOMOBILE','MACHINERY','FURNITURE'))) FROM comp GROUP BY 1
  UNION ALL SELECT geo_id, 'per_home', sum(e) FILTER (WHERE v = 'FURNITURE'), sum(e) FILTER (WHERE v IN ('BUILDING','HOUSEHOLD')), sqrt(sum(m*m) FILTER (WHERE v = 'FURNITURE')), sqrt(sum(m*m) FILTER (WHERE v IN ('BUILDING','HOUSEHOLD'))) FROM comp GROUP BY 1)"""
P.cte("derived", DERIVE, "comp")


@query("derive_measures", sql("derived", """SELECT 'zcta' AS geo_type, geo_id, measure, round(value, 5) AS value, round(moe, 5) AS moe, CASE WHEN moe/1.645/value < 0.12 THEN 'high' WHEN moe/1.645/value <= 0.4 THEN 'medium' ELSE 'low' END AS reliability FROM derived"""))
def derive_measures(t):
    return rnd(A.derive_measures(components(t), MEASURES), 5, "value", "moe")


@query("area_denominators", sql("comp", "SELECT geo_id, e AS households, m AS moe FROM comp WHERE v = 'HOUSEHOLD'"))
def area_denominators(t):
    c = components(t).where((F.col("geo_type") == "zcta") & (F.col("variable") == "HOUSEHOLD"))
    return c.select("geo_id", F.col("estimate").alias("households"), "moe")


@query("area_counts_snapshot", sql("pl", f"SELECT geo_type, geo_id, count(*) AS parcels FROM lv GROUP BY 1, 2", [
    ("u", "SELECT DISTINCT c_custkey, nation, region FROM customer JOIN pl ON custkey = c_custkey WHERE (c_custkey * 7919) % 1999 <= 1500"), ("lv", P.sql_levels("u"))]))
def area_counts_snapshot(t):
    x, _y = P.hashed_xy(F.col("custkey"))
    p = P.places(t).where(x <= 1500).withColumn("city", F.lit("city"))
    p = p.unionByName(p).dropDuplicates(["custkey"])
    return joins.by_area(p, P.levels()).groupBy("geo_type", "geo_id").agg(F.count(F.lit(1)).alias("parcels"))


P.cte("slow0", """SELECT type AS g, nation AS area, is_closed, bd_to_close, age_bd, CASE WHEN is_closed THEN bd_to_close ELSE age_bd END AS time, CAST(is_closed AS INTEGER) AS ev, region, price, id FROM base WHERE close_problem IS NULL""", "base")
for _n, _b in P.sql_km("slow0", "g", name="thr"):
    P.cte(_n, _b, "slow0", *([] if _n == "thr0" else [f"thr{i}" for i in range(5) if f"thr{i}" in P.CTES]))
P.cte("slow", "SELECT s.*, t.value AS threshold, NOT (is_closed AND bd_to_close <= t.value) AS is_slow FROM slow0 s JOIN thr t ON t.g = s.g AND NOT t.suppressed WHERE age_bd >= t.value", "slow0", "thr")
P.cte("ratios", f"""SELECT area, n, observed, expected, null_var, observed/expected AS ratio, {w_low('observed', 'n')} / (expected/n) AS ci_low, {w_high('observed', 'n')} / (expected/n) AS ci_high FROM (
  SELECT area, count(*) AS n, CAST(count(*) FILTER (WHERE is_slow) AS DOUBLE) AS observed, sum(p) AS expected, sum(p*(1-p)) AS null_var FROM slow JOIN (SELECT g, avg(CAST(is_slow AS INTEGER)) AS p FROM slow GROUP BY 1) q USING (g) GROUP BY area)""", "slow")


def slow_rows(t):
    """Requests flagged slow against their type's citywide Kaplan-Meier median; eligible ones only."""
    b = normalize.base_records(P.tickets(t)).where("close_problem is null")
    b = b.withColumn("time", F.when(F.col("is_closed"), F.col("bd_to_close")).otherwise(F.col("age_bd")))
    return metrics.flag_slow(b)


def area_ratios(t):
    return A.standardized_ratio(slow_rows(t), "nation", "type", F.col("slow"))


@query("indirect_standardization", sql("ratios", "SELECT area AS nation, n, observed, round(expected, 6) AS expected, round(null_var, 6) AS null_var, round(ratio, 6) AS ratio, round(ci_low, 6) AS ci_low, round(ci_high, 6) AS ci_high, n < 30 AS suppressed FROM ratios"))
def indirect_standardization(t):
    return rnd(area_ratios(t), 6, "expected", "null_var", "ratio", "ci_low", "ci_high")


@query("category_shares", sql("late", """WITH c AS (SELECT nation, coalesce(nullif(trim(code), ''), '(no code)') AS code, count(*) AS k FROM (SELECT nation, CASE WHEN l_quantity > 48 THEN ' ' WHEN l_quantity > 46 THEN 'rare ' || l_returnflag ELSE p_type END AS code FROM late) GROUP BY 1, 2),
  s AS (SELECT *, sum(k) OVER (PARTITION BY nation) AS tot FROM c), b AS (SELECT code, max(k / tot) >= 0.05 AS big FROM s GROUP BY 1)
  SELECT nation, CASE WHEN big THEN code ELSE 'other codes' END AS code, round(sum(k) / max(tot), 6) AS share, CAST(max(tot) AS BIGINT) AS n_group FROM s JOIN b USING (code) GROUP BY 1, 2""").replace("\nWITH c AS", ",\nc AS", 1))
def category_shares(t):
    code = F.when(F.col("l_quantity") > 48, " ").when(F.col("l_quantity") > 46, F.concat(F.lit("rare "), "l_returnflag")).otherwise(F.col("p_type"))
    return rnd(A.category_shares(lines(t), "nation", code), 6, "share")


# --- spatial statistics -----------------------------------------------------------

P.cte("eb", """SELECT *, (r - b) / sqrt(a + samp) AS z, b + a / (a + samp) * (r - b) AS smoothed FROM (SELECT *, greatest(0, sum(w * (r-b)**2) OVER () - sum(w * samp) OVER ()) AS a FROM (
  SELECT area, observed/expected AS r, sum(observed) OVER () / sum(expected) OVER () AS b, expected / sum(expected) OVER () AS w, null_var / expected**2 AS samp FROM ratios))""", "ratios")
P.cte("nb", "SELECT a.n_name AS i, b.n_name AS j FROM nation a JOIN nation b ON a.n_nationkey <> b.n_nationkey AND abs(a.n_nationkey % 5 - b.n_nationkey % 5) <= 1 AND abs(a.n_nationkey // 5 - b.n_nationkey // 5) <= 1")
P.cte("bal", "SELECT n_name AS id, avg(c_acctbal) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")


@query("eb_standardize", sql("eb", "SELECT area AS nation, round(z, 5) AS z, round(smoothed, 6) AS smoothed FROM eb"))
def eb_standardize(t):
    e = spatial_stats.eb_standardize(cut_lineage(area_ratios(t)))
    return rnd(rnd(e, 5, "z"), 6, "smoothed").select("nation", "z", "smoothed")


def balances(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("id")).agg(F.avg("c_acctbal").alias("v"))


def neighbors(t):
    return spatial.contiguity(spatial.rectangles_to_edges(P.areas_grid(t)))


def areas_slow(t):
    """Nations by the centre of their square."""
    return P.areas_grid(t).select(F.col("geo_id").alias("id"), (F.col("x0") + 200).alias("x"), (F.col("y0") + 200).alias("y"))


@query("spatial_lag", sql("bal nb", "SELECT i AS id, round(avg(v), 4) AS lag, count(*) AS neighbors FROM nb JOIN bal ON id = j GROUP BY 1"))
def spatial_lag(t):
    return rnd(spatial_stats.spatial_lag(balances(t), neighbors(t), "v"), 4, "lag").drop("v")


P.cte("zz", "SELECT id, v - avg(v) OVER () AS z FROM bal", "bal")
P.cte("lagz", "SELECT zz.id, zz.z, avg(y.z) AS lag FROM zz JOIN nb ON nb.i = zz.id JOIN zz y ON y.id = nb.j GROUP BY 1, 2", "zz", "nb")


def sql_orders(z: str, nsim: int, kind: str, name: str) -> list[tuple[str, str]]:
    """CTE <name>: r, id, z, place, upto - the areas of each simulation in the order of a hash."""
    return [(f"{name}k", f"SELECT id, z, r, md5('{kind}:{A.SEED}:' || r || ':' || id) AS key FROM {z}, range(1, {nsim + 1}) g(r)"),
            (name, f"SELECT r, id, z, row_number() OVER w AS place, sum(z) OVER w AS upto FROM {name}k WINDOW w AS (PARTITION BY r ORDER BY key, id ROWS UNBOUNDED PRECEDING)")]


def sql_moran(z: str, lag: str, nb: str, nsim: int, p: str) -> list[tuple[str, str]]:
    """CTEs ending in <p>: one row moran_i, expected, sd, zscore, p_perm, n. ``z``: id, z centred; ``lag``: id, z, lag."""
    return [(f"{p}w", f"SELECT i, j, 1.0::DOUBLE / count(*) OVER (PARTITION BY i) AS w FROM {nb}"),
            (f"{p}s", f"SELECT (SELECT sum(w) FROM {p}w) AS s0, (SELECT 0.5 * sum((coalesce(a.w, 0) + coalesce(b.w, 0))**2) FROM {p}w a FULL JOIN {p}w b ON a.i = b.j AND a.j = b.i) AS s1, (SELECT sum(q * q) FROM (SELECT id, sum(w) AS q FROM (SELECT i AS id, w FROM {p}w UNION ALL SELECT j, w FROM {p}w) GROUP BY 1)) AS s2"),
            (f"{p}m", f"SELECT CAST(count(*) AS DOUBLE) AS n, sum(z * lag) / sum(z * z) AS mi, sum(z * z) AS z2, count(*) * sum(z**4) / sum(z*z)**2 AS k FROM {lag}")] + sql_orders(z, nsim, "a", f"{p}a") + sql_orders(z, nsim, "b", f"{p}b") + [
            (f"{p}g", f"SELECT a.r, a.id, b.z FROM {p}a a JOIN {p}b b USING (r, place)"),
            (f"{p}h", f"SELECT count(*) FILTER (WHERE s / z2 >= mi - 1e-9) AS h FROM (SELECT x.r, sum(x.z * y.z * w.w) AS s FROM {p}g x JOIN {p}w w ON w.i = x.id JOIN {p}g y ON y.r = x.r AND y.id = w.j GROUP BY 1), {p}m"),
            (p, f"SELECT mi AS moran_i, -1/(n-1) AS expected, sd, (mi + 1/(n-1)) / sd AS zscore, (h + 1) / {nsim + 1}.0 AS p_perm, CAST(n AS BIGINT) AS n FROM (SELECT *, sqrt((n*((n*n-3*n+3)*s1 - n*s2 + 3*s0*s0) - k*((n*n-n)*s1 - 2*n*s2 + 6*s0*s0)) / ((n-1)*(n-2)*(n-3)*s0*s0) - 1/(n-1)**2) AS sd FROM {p}m, {p}s, {p}h)")]


def sql_lisa(z: str, nb: str, nsim: int, p: str, alpha: float = 0.05) -> list[tuple[str, str]]:
    """CTEs ending in <p>: id, ii, lag, z, p, q, quadrant, class."""
    return [(f"{p}l", f"SELECT a.id, a.z, avg(y.z) AS lag, count(*) AS k, (SELECT avg(z * z) FROM {z}) AS m2 FROM {z} a JOIN {nb} b ON b.i = a.id JOIN {z} y ON y.id = b.j GROUP BY 1, 2"),
            (f"{p}i", f"SELECT *, z * lag / m2 AS ii FROM {p}l")] + sql_orders(z, nsim, "l", f"{p}o") + [
            (f"{p}t", f"""SELECT id, count(*) FILTER (WHERE sim <= ii + 1e-9) AS lo, count(*) FILTER (WHERE sim >= ii - 1e-9) AS hi FROM (SELECT i.id, i.ii, i.z * CASE WHEN o.place > i.k THEN a.upto ELSE b.upto - i.z END / i.k / i.m2 AS sim
  FROM {p}o o JOIN {p}i i ON i.id = o.id JOIN {p}o a ON a.r = o.r AND a.place = i.k JOIN {p}o b ON b.r = o.r AND b.place = i.k + 1) GROUP BY 1"""),
            (f"{p}p", f"SELECT i.*, least(1.0, 2 * (least(lo, hi) + 1) / {nsim + 1}.0) AS p, CASE WHEN z > 0 AND lag > 0 THEN 'HH' WHEN z < 0 AND lag < 0 THEN 'LL' WHEN z > 0 THEN 'HL' ELSE 'LH' END AS quadrant FROM {p}i i JOIN {p}t USING (id)"),
            (f"{p}q", f"SELECT *, p * count(*) OVER () / (SELECT count(*) FROM {p}p b WHERE b.p <= a.p) AS adj FROM {p}p a"),
            (p, f"SELECT id, ii, lag, z, p, q, quadrant, CASE WHEN q < {alpha} THEN quadrant WHEN p < {alpha} THEN quadrant || '_unadj' ELSE 'ns' END AS class FROM (SELECT *, least(1.0, (SELECT min(adj) FROM {p}q b WHERE b.p >= a.p)) AS q FROM {p}q a)")]


@query("moran_global", sql("lagz", "SELECT round(moran_i, 6) AS moran_i, round(expected, 6) AS expected, round(sd, 6) AS sd, round(zscore, 5) AS z, round(p_perm, 6) AS p_perm, n FROM mg", sql_moran("zz", "lagz", "nb", 9999, "mg")))
def moran_global(t):
    m = spatial_stats.moran_global(balances(t), neighbors(t), "v")
    return rnd(rnd(m, 6, "moran_i", "expected", "sd", "p_perm"), 5, "z").select("moran_i", "expected", "sd", "z", "p_perm", "n")


@query("lisa", sql("lagz", "SELECT id, round(ii, 5) AS ii, round(lag, 4) AS lag, round(p, 6) AS p, round(q, 6) AS q, quadrant, class FROM li", sql_lisa("zz", "nb", 99999, "li")))
def lisa(t):
    r = spatial_stats.lisa(balances(t), neighbors(t), "v")
    return rnd(rnd(rnd(r, 5, "ii"), 4, "lag"), 6, "p", "q").select("id", "ii", "lag", "p", "q", "quadrant", "class")


@query("bh_adjust", """WITH p AS (SELECT n_name AS id, (count(*) FILTER (WHERE c_acctbal > 9000) + 1.0) / (count(*) + 1) AS p FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
  r AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p, id) AS a, row_number() OVER (ORDER BY p, id) AS k FROM p)
  SELECT id, round(least(1, min(a) OVER (ORDER BY k DESC)), 6) AS q FROM r""")
def bh_adjust(t):
    p = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("id")).agg(
        ((F.count_if(F.col("c_acctbal") > 9000) + 1) / (F.count(F.lit(1)) + 1)).alias("p"))
    return rnd(spatial_stats.bh_adjust(p, "p"), 6, "q").select("id", "q")


# --- volumes and frequencies -----------------------------------------------------

def _sql_band(kind: str, flag: str) -> str:
    return f"""SELECT '{flag}' AS pools, day, n AS count, CASE WHEN pool >= 30 THEN med END AS median, CASE WHEN pool >= 30 THEN round(mad, 4) END AS mad, CASE WHEN pool >= 30 THEN round(med - 3*mad, 4) END AS low, CASE WHEN pool >= 30 THEN round(med + 3*mad, 4) END AS high,
  CASE WHEN pool >= 30 THEN n BETWEEN med - 3*mad AND med + 3*mad END AS in_band, CASE WHEN pool < 30 THEN 'insufficient history' END AS skipped FROM (
  SELECT c.*, med, pool, (SELECT greatest(1, 1.4826 * median(abs(x.n - med))) FROM c x WHERE NOT x.target AND {kind.format('x')} = {kind.format('c')}) AS mad FROM c
  JOIN (SELECT {kind.format('y')} AS k, median(n) AS med, count(*) AS pool FROM c y WHERE NOT target GROUP BY 1) m ON m.k = {kind.format('c')}) WHERE target"""


@query("robust_volume_band", f"""WITH d AS (SELECT CAST(g AS DATE) AS day FROM generate_series(TIMESTAMP '2001-04-02', TIMESTAMP '2001-06-30', INTERVAL 1 DAY) s(g)),
  c AS (SELECT day, count(o_orderkey) AS n, isodow(day) >= 6 AS we, day >= DATE '2001-07-01' - 30 AS target FROM d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1),
  b AS ({_sql_band('{0}.we', 'by kind of day')} UNION ALL {_sql_band('({0}.we IS NULL)', 'all days')})
  SELECT b.*, 'daily volume within band' AS name, max(CASE WHEN in_band THEN 0 ELSE CASE WHEN in_band IS NULL THEN 0 ELSE 1 END END) OVER (PARTITION BY pools) = 0 AS passed, 'warning' AS severity,
    CAST(count(*) FILTER (WHERE NOT in_band) OVER (PARTITION BY pools) AS VARCHAR) || ' of 30 days out of band, ' || CAST(count(skipped) OVER (PARTITION BY pools) AS VARCHAR) || ' skipped' AS detail FROM b""")
def robust_volume_band(t):
    out = None
    for flag, by_kind in (("by kind of day", True), ("all days", False)):
        # weekends have fewer than 30 earlier days and are skipped
        days = cut_lineage(checks.daily_volume(t.orders, F.to_date("o_orderdate"), day("2001-07-01"), check_days=30, min_pool=30, by_day_type=by_kind))
        one = days.withColumn("pools", F.lit(flag)).transform(attach, checks.volume_check(days, "warning").select("name", "passed", "severity", "detail"))
        out = one if out is None else out.unionByName(one)
    return rnd(out, 4, "mad", "low", "high")


@query("month_volume_ratio", """WITH m AS (SELECT CAST(g AS DATE) AS month FROM generate_series(TIMESTAMP '2000-06-01', TIMESTAMP '2001-06-01', INTERVAL 1 MONTH) s(g)),
  c AS (SELECT o_orderpriority, month, count(*) FILTER (WHERE CAST(date_trunc('month', o_orderdate) AS DATE) = month) AS n FROM orders, m GROUP BY 1, 2)
  SELECT o_orderpriority, max(n) FILTER (WHERE month = DATE '2001-06-01') AS last_n, median(n) FILTER (WHERE month < DATE '2001-06-01') AS prior,
  max(n) FILTER (WHERE month = DATE '2001-06-01') BETWEEN median(n) FILTER (WHERE month < DATE '2001-06-01') / 2 AND median(n) FILTER (WHERE month < DATE '2001-06-01') * 2 AS ok FROM c GROUP BY 1""")
def month_volume_ratio(t):
    return checks.month_ratio(t.orders, "o_orderpriority", F.to_date("o_orderdate"), day("2001-06-30"))


@query("top_type_counts", sql("late", """SELECT nation, string_agg(p_type || ' (' || n || ')', '; ' ORDER BY n DESC, p_type) AS top FROM (SELECT nation, p_type, count(*) AS n FROM late GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY nation ORDER BY count(*) DESC, p_type) <= 3) GROUP BY 1"""))
def top_type_counts(t):
    return metrics.top_values(lines(t), ["nation"], "p_type", 3).select("nation", F.array_join(F.transform(
        "top", lambda r: F.concat(r.value, F.lit(" ("), r.n.cast("string"), F.lit(")"))), "; ").alias("top"))


@query("majority_value", """WITH c AS (SELECT l_returnflag AS grp, p_brand AS v, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
  s AS (SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY n DESC, v) / sum(n) OVER (PARTITION BY grp) AS share, row_number() OVER (PARTITION BY grp ORDER BY n DESC, v) AS k FROM c)
  SELECT grp, max(v) FILTER (WHERE k = 1) AS most, string_agg(v, ',' ORDER BY k) FILTER (WHERE share <= 0.75 OR k = 1) AS covering FROM s GROUP BY 1""")
def majority_value(t):
    li = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumnRenamed("l_returnflag", "grp")
    return metrics.covering_values(li, "grp", "p_brand", 0.75)


@query("source_inventory_prep", sql("tk pm ins", """SELECT 'requests' AS source, count(*) AS n, count(*) FILTER (WHERE exclusion IS NOT NULL) AS excluded, min(opened) AS first, max(opened) AS last FROM tk
  UNION ALL SELECT 'permits', count(*), count(*) FILTER (WHERE exclusion IS NOT NULL), min(issue_date), max(issue_date) FROM pm
  UNION ALL SELECT 'inspections', count(*), count(*) FILTER (WHERE exclusion IS NOT NULL), min(date), max(date) FROM ins"""))
def source_inventory_prep(t):
    from wardstat.session import scratch_path
    path = scratch_path(t.spark, "silver")
    for name, df, d in (("requests", P.tickets(t), "opened"), ("permits", permits(t), "issue_date"), ("inspections", inspections(t), "date")):
        df.select(F.col(d).alias("day"), "exclusion").write.parquet(f"{path}/source={name}")
    return t.spark.read.parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("exclusion").alias("excluded"), F.min("day").alias("first"), F.max("day").alias("last"))


@query("data_checks", sql("base", """WITH m AS (SELECT CAST(date_trunc('month', opened) AS DATE) AS month, round(avg(CASE WHEN close_problem IS NOT NULL THEN 1.0 ELSE 0 END) FILTER (WHERE state = 'closed'), 6) AS missing FROM base GROUP BY 1)
  SELECT month, missing, (SELECT max(k) FROM (SELECT count(*) AS k FROM base GROUP BY x, y)) AS max_stack, (SELECT median(k) FROM (SELECT count(*) AS k FROM base GROUP BY nation)) AS area_median,
  round((SELECT quantile_cont(k, 0.9) FROM (SELECT count(*) AS k FROM base GROUP BY nation)), 4) AS area_q90 FROM m""").replace("\nWITH m AS", ",\nm AS", 1))
def data_checks(t):
    b = cut_lineage(normalize.base_records(P.tickets(t)).select("opened", "state", "close_problem", "x", "y", "nation"))
    m = b.groupBy(F.to_date(F.date_trunc("month", "opened")).alias("month")).agg(F.round(F.avg(F.when(F.col("state") == "closed", F.col("close_problem").isNotNull().cast("int"))), 6).alias("missing"))
    stack = b.groupBy("x", "y").count().agg(F.max("count").alias("max_stack"))
    per = b.groupBy("nation").count().agg(F.median("count").alias("area_median"), F.round(F.percentile("count", 0.9), 4).alias("area_q90"))
    return m.transform(attach, stack).transform(attach, per)


@query("odds_ratio_metric", sql("late", f"""SELECT nation, d, m, n, d + n AS n_both, CASE WHEN s THEN round(CAST(d AS DOUBLE) / n, 6) END AS value, CASE WHEN s THEN round(lo / (1 - lo), 6) END AS ci_low, CASE WHEN s THEN round(hi / (1 - hi), 6) END AS ci_high, NOT s AS suppressed FROM (
  SELECT *, d + n >= 800 AND n > 0 AS s, {w_low('d', '(d+n)')} AS lo, {w_high('d', '(d+n)')} AS hi FROM (SELECT nation, count(*) FILTER (WHERE l_returnflag = 'R') AS d, count(*) FILTER (WHERE l_returnflag = 'N') AS n, count(*) AS m FROM late GROUP BY 1))"""))
def odds_ratio_metric(t):
    g = lines(t).groupBy("nation").agg(F.count_if(F.col("l_returnflag") == "R").alias("d"), F.count_if(F.col("l_returnflag") == "N").alias("n"), F.count(F.lit(1)).alias("m"))
    return rnd(A.odds(g, "d", "n", min_n=800), 6, *CI)
