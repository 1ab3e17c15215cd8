"""Validation, contracts, reconciliation and the publication gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.operators import checks, gate, metrics, normalize
from wardstat.plans import proxies as P
from wardstat.plans.proxies import day, rnd, sql
from wardstat.plans.q_metrics import sql_med
from wardstat.plans.registry import query

CONTRACT = {"o_orderkey": {"type": "integer", "nullable": False}, "o_orderstatus": {"type": "character", "allowed": ["F", "O"]},
            "o_totalprice": {"type": "numeric", "nullable": False}, "o_orderdate": {"type": "datetime"}, "o_comment": {"type": "character", "required": False},
            "o_orderpriority": {"type": "character", "nullable": False, "allowed": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}}


@query("check_schema", """WITH c AS (SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS k, count(DISTINCT o_orderstatus) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS u, min(o_orderstatus) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS lo,
    count(*) FILTER (WHERE o_totalprice IS NULL) AS p, count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority = '') AS q,
    count(DISTINCT o_orderpriority) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) AS v FROM orders)
  SELECT name, passed, severity FROM c, LATERAL (VALUES ('column type: o_orderkey', true, 'error'), ('not null: o_orderkey', k = 0, 'error'), ('column type: o_orderstatus', true, 'error'), ('allowed values: o_orderstatus', u = 0, 'error'), ('column type: o_totalprice', true, 'error'),
    ('not null: o_totalprice', p = 0, 'error'), ('column type: o_orderdate', true, 'error'), ('column present: o_comment', true, 'warning'), ('column type: o_orderpriority', true, 'error'), ('not null: o_orderpriority', q = 0, 'error'),
    ('allowed values: o_orderpriority', v = 0, 'error'), ('no unexpected columns', false, 'warning')) x(name, passed, severity)""")
def check_schema(t):
    return checks.schema_checks(t.orders, CONTRACT).select("name", "passed", "severity")


@query("check_freshness", "SELECT 'freshness' AS name, DATE '2001-08-03' - CAST(max(o_orderdate) AS DATE) <= 3 AS passed, CAST(DATE '2001-08-03' - CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS detail FROM orders")
def check_freshness(t):
    return checks.freshness(t.orders, F.to_date("o_orderdate"), day("2001-08-03"), 3).select("name", "passed", "detail")


@query("check_geocoding", "SELECT round(avg(CASE WHEN c_acctbal < 0 OR c_mktsegment = 'MACHINERY' THEN 1.0 ELSE 0 END), 6) AS share, avg(CASE WHEN c_acctbal < 0 OR c_mktsegment = 'MACHINERY' THEN 1.0 ELSE 0 END) <= 0.3 AS passed FROM customer")
def check_geocoding(t):
    q = F.when(F.col("c_mktsegment") == "MACHINERY", "tie").when(F.col("c_acctbal") >= 0, "exact")
    return checks.geocoding(t.customer, q, max_share=0.3).select(F.col("detail").cast("double").alias("share"), "passed")


@query("check_unique", """SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) = 0 AS passed, CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS VARCHAR) || '/0' AS detail FROM lineitem""")
def check_unique(t):
    li = t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"))
    return checks.unique_ids(li, "id").select("passed", "detail")


@query("check_min_rows", "SELECT count(*) >= 50000 AS passed, CAST(count(*) AS VARCHAR) AS detail FROM lineitem")
def check_min_rows(t):
    return checks.min_rows(t.lineitem, 50000).select("passed", "detail")


@query("check_ranges", """SELECT name, n = 0 AS passed, CAST(n AS VARCHAR) AS detail FROM (SELECT count(*) FILTER (WHERE value < 0 OR value > 100) AS a, count(*) FILTER (WHERE value < 0) AS b, count(*) FILTER (WHERE value <> floor(value)) AS c FROM events) e,
  LATERAL (VALUES ('score within 0 to 100', a), ('count is not negative', b), ('count is whole', c)) x(name, n)""")
def check_ranges(t):
    v = F.col("value")
    return checks.value_ranges(t.events, {"score within 0 to 100": (v < 0) | (v > 100), "count is not negative": v < 0, "count is whole": v != F.floor(v)}).select("name", "passed", "detail")


def order_checks(t):
    return checks.collect_checks([checks.schema_checks(t.orders, CONTRACT), checks.min_rows(t.orders, 1000), checks.unique_ids(t.orders, "o_orderkey"),
                                  checks.value_ranges(t.orders, {"price under 400,000": F.col("o_totalprice") >= 400000})])


@query("report_rollup", """SELECT 'fail' AS status, CAST(15 AS BIGINT) AS checks_run, CAST(14 AS BIGINT) - CAST(u > 0 AS INTEGER) - CAST(p > 0 AS INTEGER) AS checks_passed, CAST(CAST(u > 0 AS INTEGER) + CAST(p > 0 AS INTEGER) AS BIGINT) AS errors,
  concat_ws('; ', CASE WHEN u > 0 THEN 'allowed values: o_orderstatus' END, CASE WHEN p > 0 THEN 'price under 400,000' END) AS failed
  FROM (SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS u, count(*) FILTER (WHERE o_totalprice >= 400000) AS p FROM orders)""")
def report_rollup(t):
    return checks.rollup(order_checks(t))


@query("agreement_check", "SELECT round(avg(CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey = s_suppkey % 25 AS INTEGER) END), 6) AS share, avg(CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey = s_suppkey % 25 AS INTEGER) END) >= 0.95 AS passed FROM supplier")
def agreement_check(t):
    same = F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey") == F.col("s_suppkey") % 25)
    return checks.agreement(t.supplier, same, 0.95, "own area matches the source field").select(F.col("detail").cast("double").alias("share"), "passed")


@query("area_coverage_check", "SELECT count(*) = 0 AS passed, count(*) || ' unknown, first: ' || coalesce(CAST(min(c_nationkey) AS VARCHAR), '-') AS detail FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000))")
def area_coverage_check(t):
    known = t.supplier.where("s_acctbal > 5000").select("s_nationkey").distinct()
    return checks.referential(t.customer, "c_nationkey", known, "every area has a denominator").select("passed", "detail")


@query("hierarchy_reconcile", """WITH w AS (SELECT l_orderkey, sum(l_extendedprice / tot * o_totalprice) AS ours, max(o_totalprice) AS ref FROM (SELECT *, sum(l_extendedprice) OVER (PARTITION BY l_orderkey) AS tot FROM lineitem) JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
  SELECT count(*) AS groups, count(*) FILTER (WHERE abs(ours - ref) > 0.5) AS off, (SELECT round(sum(ours), 0) FROM w) = (SELECT round(sum(ref), 0) FROM w) AS total_matches FROM w""")
def hierarchy_reconcile(t):
    from wardstat.operators.aggregates import even_share
    li = even_share(t.lineitem, ["l_orderkey"], "l_extendedprice")
    ours = li.groupBy("l_orderkey").agg(F.sum("share").alias("share"))     # by the key the shares are dealt by: no further shuffle
    ours = ours.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", (F.col("share") * F.col("o_totalprice")).alias("ours"), F.col("o_totalprice").alias("ref"))
    return gate.totals_agree(ours, "ours", "ref", 0.5)


@query("metrics_contract", sql("base", """SELECT problem, n AS rows FROM (SELECT count(*) FILTER (WHERE NOT suppressed) AS a, 2 * count(*) FILTER (WHERE geo_type = 'zcta') AS b, count(*) AS c FROM md) m, LATERAL (VALUES ('interval_misses_value', a), ('area_kind_unlisted', b), ('repeated_key', c)) v(problem, n)""", sql_med("base")))
def metrics_contract(t):
    m = metrics.median_days(normalize.base_records(P.tickets(t)), P.levels(), day(P.THROUGH))
    m = checks.as_metrics(m, "0.1", day(P.THROUGH))
    # Break three rules on purpose: rows appear twice, one area type is unknown, intervals miss their value.
    m = m.withColumn("geo_type", F.when(F.col("geo_type") == "zcta", "village").otherwise(F.col("geo_type")))
    broken = m.withColumn("ci_low", F.col("value") + 1)
    return checks.metrics_problems(broken.unionByName(m)).select("problem", F.col("rows").cast("bigint").alias("rows"))


@query("citywide_reference", sql("base", """SELECT a.geo_type, a.geo_id, a.subgroup, a.window_start, a.value, c.value AS citywide_median FROM md a LEFT JOIN md c ON c.geo_type = 'citywide' AND c.subgroup = a.subgroup AND c.window_start = a.window_start""", sql_med("base")))
def citywide_reference(t):
    m = metrics.median_days(normalize.base_records(P.tickets(t)), P.levels(), day(P.THROUGH))
    return checks.citywide_reference(m).select("geo_type", "geo_id", "subgroup", "window_start", "value", "citywide_median")


# --- official figures --------------------------------------------------------------

def official(t):
    """Yearly order counts rounded as an office would publish them; some rows are faulty."""
    y = t.orders.groupBy(F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("subgroup")).agg(F.count(F.lit(1)).alias("k"))
    return y.select(F.concat_ws("-", F.lit("fig"), "y", F.substring("subgroup", 1, 1)).alias("figure_id"), F.when(F.col("y") % 2 == 0, "requests_created").otherwise("mean_value").alias("measure"),
                    "subgroup", F.make_date(F.col("y"), F.lit(1), F.lit(1)).alias("period_start"), F.make_date(F.col("y"), F.lit(12), F.lit(31)).alias("period_end"),
                    (F.round(F.col("k") / 50) * 50).cast("double").alias("value"), F.lit(50.0).alias("precision"), F.when(F.col("y") < 1998, "counted twice").otherwise("").alias("gap_note"), "k")


P.cte("fig", """SELECT 'fig-' || y || '-' || substr(p, 1, 1) AS figure_id, CASE WHEN y % 2 = 0 THEN 'requests_created' ELSE 'mean_value' END AS measure, p AS subgroup, make_date(y, 1, 1) AS period_start, make_date(y, 12, 31) AS period_end,
  CAST(round(k / 50.0) * 50 AS DOUBLE) AS value, 50.0 AS precision, CASE WHEN y < 1998 THEN 'counted twice' ELSE '' END AS gap_note, k FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority AS p, count(*) AS k FROM orders GROUP BY 1, 2)""")


@query("official_figures", sql("fig", "SELECT figure_id, problem FROM (SELECT figure_id, CASE WHEN k < 250 THEN ['incomplete'] ELSE [] END || CASE WHEN measure = 'mean_value' AND subgroup < '3' THEN ['duplicate figure_id'] ELSE [] END || CASE WHEN subgroup = '5-LOW' THEN ['period_start after period_end'] ELSE [] END AS p FROM fig), unnest(p) u(problem)"))
def official_figures(t):
    f = official(t).withColumn("value", F.when(F.col("k") >= 250, F.col("value")))
    f = f.withColumn("period_end", F.when(F.col("subgroup") == "5-LOW", F.date_sub("period_start", 1)).otherwise(F.col("period_end")))
    return gate.figure_problems(f.unionByName(f.where((F.col("measure") == "mean_value") & (F.col("subgroup") < "3"))))


@query("reconcile_figures", sql("fig", """SELECT figure_id, round(k * 1.03 - value, 4) AS gap, CASE WHEN value <> 0 THEN round((k * 1.03 - value) / value, 6) END AS relative_gap, abs(k * 1.03 - value) <= greatest(0.02 * abs(value), 25) AS within_tolerance,
  abs(k * 1.03 - value) <= greatest(0.02 * abs(value), 25) OR gap_note <> '' AS documented FROM fig"""))
def reconcile_figures(t):
    r = gate.reconcile(official(t).withColumn("our_value", F.col("k") * 1.03))
    return rnd(rnd(r, 4, "gap"), 6, "relative_gap").select("figure_id", "gap", "relative_gap", "within_tolerance", "documented")


@query("recompute_figures", sql("fig", """SELECT figure_id, round(CASE measure WHEN 'requests_created' THEN (SELECT count(*) FROM orders WHERE o_orderdate BETWEEN period_start AND period_end AND o_orderpriority = subgroup)
  ELSE (SELECT avg(o_totalprice) FROM orders WHERE o_orderdate BETWEEN period_start AND period_end AND o_orderpriority = subgroup AND o_orderstatus <> 'O') END, 4) AS our_value FROM fig WHERE period_start >= DATE '1995-06-01'"""))
def recompute_figures(t):
    f = official(t).where(F.col("period_start") >= day("1995-06-01"))
    raw = t.orders.select(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("type"), "o_totalprice", (F.col("o_orderstatus") != "O").alias("closed"))
    out = gate.recompute(f, raw, "day", "type", {"requests_created": F.count(F.lit(1)).cast("double"), "mean_value": F.avg(F.when(F.col("closed"), F.col("o_totalprice")))},
                         day("1995-06-01"))
    return rnd(out, 4, "our_value").select("figure_id", "our_value")


# --- specs, gate, audit ---------------------------------------------------------------

def specs(t):
    """Every brand as a metric spec whose completeness depends on its parts."""
    g = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.avg("p_size").alias("s"), F.min("p_retailprice").alias("m"), F.count_distinct("p_type").alias("types"))
    k = F.substring_index("p_brand", "#", -1).cast("int")
    obj = lambda i: F.struct(F.lit(f"objection {i}").alias("objection"), F.when((F.col("n") + i) % 3 != 0, "answer").otherwise("").alias("response"))
    return g.select(F.col("p_brand").alias("id"), F.when(k % 4 == 0, "draft").when(k % 9 == 1, "final").otherwise("frozen").alias("status"),
                    F.when(k % 7 == 0, "v1").otherwise(F.concat_ws(".", F.lit("0"), k.cast("string"))).alias("version"), F.when(F.col("s") > 25, "official").otherwise("comparison").alias("promise_kind"),
                    F.when(k % 3 == 0, "https://example.org/promise").alias("source_url"), F.when(k % 5 != 0, F.array(F.lit("requests_created"))).alias("measures"),
                    F.when(k % 6 != 0, "how it reconciles").alias("text"), F.array(*[obj(i) for i in range(4)]).alias("objections"),
                    F.array(F.struct(F.lit("window").alias("name"), F.lit(True).alias("arbitrary"), (F.col("n") % 3).cast("int").alias("alternatives"))).alias("thresholds"), "n")


P.cte("sp", """SELECT p_brand AS id, k, n, CASE WHEN k % 4 = 0 THEN 'draft' WHEN k % 9 = 1 THEN 'final' ELSE 'frozen' END AS status, s > 25 AS official, list_filter([
  CASE WHEN k % 5 = 0 THEN 'absent: measures' END, CASE WHEN k % 4 <> 0 AND k % 9 = 1 THEN 'status_unknown, known: draft/review/frozen' END, CASE WHEN k % 7 = 0 THEN 'version_format' END,
  CASE WHEN k % 4 <> 0 AND k % 9 <> 1 AND s > 25 AND k % 3 <> 0 THEN 'promise_source_absent' END,
  CASE WHEN k % 4 <> 0 AND k % 9 <> 1 AND (k % 5 = 0 OR k % 6 = 0) THEN 'reconciliation_absent' END,
  CASE WHEN k % 4 <> 0 AND k % 9 <> 1 AND 4 - CASE WHEN n % 3 = 0 THEN 2 ELSE 1 END < 3 THEN 'objections_few' END,
  CASE WHEN k % 4 <> 0 AND k % 9 <> 1 AND n % 3 < 2 THEN 'alternatives_few: window' END], lambda x: x IS NOT NULL) AS problems FROM (
  SELECT p_brand, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS k, count(*) AS n, avg(p_size) AS s FROM part GROUP BY 1)""")


@query("spec_rules", sql("sp", "SELECT id, array_to_string(problems, '; ') AS problems FROM sp"))
def spec_rules(t):
    return gate.spec_problems(specs(t)).select("id", F.array_join("problems", "; ").alias("problems"))


def audit_sheets(t):
    """Orders of each quarter as audit sheets with three check columns."""
    o = t.orders
    p = F.col("o_totalprice")
    return o.select(F.concat(F.lit("audit_"), F.to_date(F.date_trunc("quarter", "o_orderdate")).cast("string")).alias("sheet"), F.when(p < 1500, " ").otherwise("ann").alias("auditor"),
                    F.when((p > 449000) & (p < 449500), "looked wrong").when(p > 449000, "").otherwise("ok").alias("notes"), F.when(p > 448500, "No").otherwise("yes ").alias("1_found"), F.lit("n/a").alias("2_dates"),
                    F.when(F.col("o_orderstatus") == "O", F.when(p > 445000, "?").otherwise("yes")).otherwise("yes").alias("3_place"))


P.cte("au", """SELECT sheet, count(*) AS rows, list_filter([CASE WHEN count(*) < 100 THEN count(*) || ' rows, 100 expected' END, CASE WHEN count(*) FILTER (WHERE p < 1500) > 0 THEN 'rows_without_auditor' END,
  CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'O' AND p > 445000) > 0 THEN count(*) FILTER (WHERE o_orderstatus = 'O' AND p > 445000) || ' unusable answers' END,
  CASE WHEN count(*) FILTER (WHERE p >= 449500) > 0 THEN count(*) FILTER (WHERE p >= 449500 OR (p > 449000 AND p < 449000)) || ' unexplained refusals' END], lambda x: x IS NOT NULL) AS problems
  FROM (SELECT 'audit_' || CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS sheet, o_totalprice AS p, o_orderstatus FROM orders) GROUP BY 1""")


@query("audit_completeness", sql("au", "SELECT sheet, rows, array_to_string(problems, '; ') AS problems, sheet = (SELECT max(sheet) FROM au) AS newest FROM au"))
def audit_completeness(t):
    a = gate.audit_summary(audit_sheets(t), ["1_found", "2_dates", "3_place"])
    newest = gate.newest_audit(a).select(F.col("sheet").alias("top"))
    from wardstat.session import attach
    return a.transform(attach, newest).select("sheet", "rows", F.array_join("problems", "; ").alias("problems"), (F.col("sheet") == F.col("top")).alias("newest"))


@query("publish_gate", sql("sp au", """SELECT id, len(m) = 0 AS publishable, array_to_string(m, '; ') AS missing FROM (SELECT sp.id, list_filter([CASE WHEN sp.k = 13 THEN 'on_hold: no data' END, CASE WHEN sp.status <> 'frozen' OR len(sp.problems) > 0 THEN 'definition_open' END,
  CASE WHEN sp.n % 10 = 0 THEN 'source_checks_failed' END, CASE WHEN g.cells = 0 THEN 'nothing_publishable' END,
  CASE WHEN g.d < DATE '2001-07-15' - 92 THEN 'official_comparison_stale' WHEN sp.n % 2 = 1 THEN 'official_gap_unexplained' END,
  CASE WHEN len(a.problems) > 0 THEN 'audit_open: ' || a.problems[1] END], lambda x: x IS NOT NULL) AS m FROM sp
  JOIN (SELECT p_brand, count(*) FILTER (WHERE p_size > 45) - 4 AS c0, greatest(0, count(*) FILTER (WHERE p_size > 45) - 4) AS cells, DATE '2001-07-15' - CAST(min(p_size) * 40 AS INTEGER) AS d FROM part GROUP BY 1) g ON g.p_brand = sp.id, (SELECT * FROM au WHERE sheet = (SELECT max(sheet) FROM au)) a)"""))
def publish_gate(t):
    s = gate.spec_problems(specs(t))
    cells = t.part.groupBy(F.col("p_brand").alias("id")).agg(F.greatest(F.lit(0), F.count_if(F.col("p_size") > 45) - 4).alias("published_cells"),
                                                             F.date_sub(day(P.THROUGH), (F.min("p_size") * 40).cast("int")).alias("reconciled_on"))
    audit = gate.newest_audit(gate.audit_summary(audit_sheets(t), ["1_found", "2_dates", "3_place"]))
    from wardstat.session import attach
    e = s.join(cells, "id").transform(attach, audit.select(F.coalesce(F.try_element_at("problems", F.lit(1)), F.lit("")).alias("audit_problem")))
    e = (e.withColumn("blocked", F.when(F.col("id") == "Brand#13", " no data")).withColumn("frozen_valid", (F.col("status") == "frozen") & (F.size("problems") == 0))
         .withColumn("report_status", F.when(F.col("n") % 10 != 0, "pass").otherwise("fail")).withColumn("tests_passed", F.lit(True))
         .withColumn("cells_without_interval", F.lit(0)).withColumn("gap_documented", F.col("n") % 2 == 0))
    return gate.publish_gate(e, day(P.THROUGH)).select("id", "publishable", F.array_join("missing", "; ").alias("missing"))


@query("interval_verdict", sql("pl", """WITH s AS (SELECT nation, region, sum(o_totalprice) AS v, count(*) AS n FROM orders JOIN pl ON o_custkey = custkey GROUP BY 1, 2), i AS (SELECT nation, region, n, n - 2 * sqrt(n) AS lo, CASE WHEN n > 640 THEN -1 ELSE n + 2 * sqrt(n) END AS hi, n < 540 AS sup FROM s),
  r AS (SELECT region, avg(n) AS m FROM i GROUP BY 1)
  SELECT i.nation, CASE WHEN i.sup THEN '' WHEN i.lo <= r.m * 1.05 AND r.m * 0.95 <= CASE WHEN i.hi = -1 THEN 'inf'::DOUBLE ELSE i.hi END THEN 'overlap' ELSE 'apart' END AS verdict FROM i JOIN r USING (region)""").replace("\nWITH s AS", ",\ns AS", 1))
def interval_verdict(t):
    s = (t.orders.join(P.places(t), F.col("o_custkey") == F.col("custkey")).groupBy("nation", "region").agg(F.count(F.lit(1)).alias("n")))
    s = s.withColumn("lo", F.col("n") - 2 * F.sqrt("n")).withColumn("hi", F.when(F.col("n") > 640, -1.0).otherwise(F.col("n") + 2 * F.sqrt("n")))
    j = s.join(s.groupBy("region").agg(F.avg("n").alias("m")), "region")
    v = gate.interval_verdict(F.col("lo"), F.col("hi"), F.col("n") < 540, F.col("m") * 0.95, F.col("m") * 1.05, F.lit(False))
    return j.select("nation", v.alias("verdict"))


@query("pipeline_health", """SELECT o_orderpriority AS pipeline, CASE WHEN u > 0 THEN 'fail' WHEN w > 0 THEN 'warn' ELSE 'ok' END AS status, CASE WHEN u > 0 THEN 'validation failed: price floor' WHEN w > 0 THEN 'volume' ELSE '' END AS detail FROM (
  SELECT o_orderpriority, count(*) FILTER (WHERE o_totalprice < 1050) AS u, CAST(count(*) > 3000 AS INTEGER) AS w FROM orders GROUP BY 1)""")
def pipeline_health(t):
    g = t.orders.groupBy(F.col("o_orderpriority").alias("pipeline")).agg(F.count_if(F.col("o_totalprice") < 1050).alias("u"), F.count(F.lit(1)).alias("n"))
    rows = F.array(checks.check("price floor", "range", F.col("u") == 0, F.col("u")), checks.check("volume", "volume", F.col("n") <= 3000, F.col("n"), "warning"),
                   checks.check("no unexpected columns", "schema", F.lit(False), F.lit("x"), "warning"))
    return gate.pipeline_health(g.select("pipeline", F.inline(rows)), "pipeline")


@query("feed_status", """WITH p AS (SELECT user_id AS feed, event_id AS t, event_type NOT IN ('error', 'view') AS ok FROM events), l AS (SELECT feed, max(t) FILTER (WHERE ok) AS last_success_at FROM p GROUP BY 1)
  SELECT feed, last_success_at, polls, failed, streak, CASE WHEN streak >= 3 THEN 'fail' WHEN failed >= 0.2 * polls THEN 'warn' ELSE 'ok' END AS status FROM (SELECT p.feed, last_success_at, count(*) AS polls, count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE last_success_at IS NULL OR t > last_success_at) AS streak FROM p JOIN l ON l.feed = p.feed GROUP BY 1, 2)""")
def feed_status(t):
    p = t.events.select(F.col("user_id").alias("feed"), F.col("event_id").alias("t"), (~F.col("event_type").isin("error", "view")).alias("ok"))
    return gate.feed_status(p, "feed", "t", "ok")


@query("audit_trace", """SELECT o_orderkey, CASE WHEN o_totalprice < 10000 THEN 'gone from source' WHEN o_totalprice > 445000 THEN 'new in source' ELSE concat_ws(',', CASE WHEN o_orderkey % 1000 = 7 THEN 'status' END, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'price' END) END AS differs,
  CASE WHEN o_totalprice > 445000 THEN NULL ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'residential' ELSE 'commercial' END END AS sector FROM orders""")
def audit_trace(t):
    rec = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "RES").otherwise("COM"), F.lit("-NEW-"), "o_orderkey")
    sheet = t.orders.where("o_totalprice <= 445000").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), rec.alias("record_id"))
    fresh = t.orders.where("o_totalprice >= 10000").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 1000 == 7, "X").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("price"))
    d = gate.trace(sheet, fresh, "o_orderkey", ["status", "price"])
    return d.select("o_orderkey", "differs", gate.sector_from_number(F.col("record_id")).alias("sector"))
