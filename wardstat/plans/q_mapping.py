"""Projections, filters, mappings and exclusion flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.functions import dates, text
from wardstat.operators import metrics, normalize
from wardstat.operators.joins import fan_out
from wardstat.plans import proxies as P
from wardstat.plans.proxies import day, sql
from wardstat.plans.registry import query
from wardstat.sources import sinks


@query("status_map_lookup", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'unmapped' END AS state FROM orders")
def status_map_lookup(t):
    return t.orders.select("o_orderkey", text.codes_to_state(F.col("o_orderstatus"), {"F": "closed", "O": "open", "": "unknown"}).alias("state"))


@query("first_match_exclusion", """SELECT o_orderkey, CASE WHEN o_orderdate < '1996-01-01' THEN 'pre_migration' WHEN o_orderdate > '2001-07-15' THEN 'partial_day'
  WHEN o_totalprice < 20000 THEN 'city_duplicate' WHEN o_orderstatus = 'P' THEN 'unknown_status' END AS exclusion FROM orders""")
def first_match_exclusion(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", text.first_reason([
        ("pre_migration", d < day("1996-01-01")), ("partial_day", d > day("2001-07-15")),
        ("city_duplicate", F.col("o_totalprice") < 20000), ("unknown_status", F.col("o_orderstatus") == "P")]).alias("exclusion"))


@query("close_problem_flags", sql("tk0", "SELECT id, close_problem FROM tk0"))
def close_problem_flags(t):
    r = P.tickets_raw(t).withColumn("state", text.codes_to_state(F.col("status"), P.STATES))
    return r.select("id", text.close_problem(F.col("state"), F.col("opened"), F.col("closed"), day(P.THROUGH), day(P.SYSTEM_START)).alias("close_problem"))


_REQ = "id, type, state, opened, close_date, close_problem, is_closed, bd_to_close, age_bd, origin, x, y, match_quality, exclusion"


@query("normalize_requests", sql("tk", f"SELECT {_REQ} FROM tk"))
def normalize_requests(t):
    return normalize.request_records(P.tickets_raw(t), P.calendar(t), P.STATES, day(P.THROUGH), day(P.SYSTEM_START), P.BOX).select(*_REQ.split(", "))


# --- permits and demolitions --------------------------------------------------

CATEGORY = [("ECONOMY", "new build", "new"), ("STANDARD", "new build", "new"), ("PROMO", "alteration", "renovation"),
            ("SMALL", "addition", "renovation"), ("LARGE", "shed", "accessory")]


def permits_raw(t):
    """Order lines with their part as permits; rows of one line are told apart by part and supplier."""
    x, y = P.hashed_xy(F.col("l_orderkey"))
    sector = F.when(F.substring_index("p_brand", "#", -1).cast("int") % 5 == 0, "certificate").when(
        F.substring_index("p_brand", "#", -1).cast("int") % 2 == 0, "dwelling").otherwise("shop")
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(P.places(t), F.col("o_custkey") == F.col("custkey"))
            .select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.to_date("l_shipdate").alias("issued"),
                    F.concat(F.lit(" "), sector).alias("sub_type"), F.concat("p_type", F.lit(" ")).alias("work_type"),
                    F.when(F.col("l_quantity") > 3, F.col("l_extendedprice")).otherwise(0.0).alias("value"),
                    x.alias("x"), y.alias("y"), "nation", "region", "l_returnflag"))


def permits(t):
    s = t.spark.createDataFrame([("certificate", "excluded"), ("dwelling", "residential"), ("shop", "commercial")], "sub_type string, sector string")
    c = t.spark.createDataFrame(CATEGORY, "work_type string, work string, category string")
    raw = permits_raw(t)
    p = normalize.permit_records(raw.withColumn("id", F.struct("id", "nation", "region")), s, c, day(P.THROUGH), P.BOX)
    return p.select("id.*", *[x for x in p.columns if x != "id"])


P.cte("pm_raw", """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id, CAST(l_shipdate AS DATE) AS issued,
  CAST(split_part(p_brand, '#', 2) AS INTEGER) AS b, p_type, CASE WHEN l_quantity > 3 THEN l_extendedprice ELSE 0 END AS v,
  CAST((l_orderkey * 7919) % 1999 AS DOUBLE) AS x, CAST((l_orderkey * 104729) % 2003 AS DOUBLE) AS y, nation, region, l_returnflag
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN pl ON o_custkey = custkey""", "pl")
P.cte("pm0", """SELECT *, CASE WHEN b % 5 = 0 THEN 'excluded' WHEN b % 2 = 0 THEN 'residential' ELSE 'commercial' END AS sector,
  CASE p_type WHEN 'ECONOMY' THEN 'new build' WHEN 'STANDARD' THEN 'new build' WHEN 'PROMO' THEN 'alteration' WHEN 'SMALL' THEN 'addition' WHEN 'LARGE' THEN 'shed' END AS work,
  CASE p_type WHEN 'ECONOMY' THEN 'new' WHEN 'STANDARD' THEN 'new' WHEN 'PROMO' THEN 'renovation' WHEN 'SMALL' THEN 'renovation' WHEN 'LARGE' THEN 'accessory' END AS category,
  x <= 1980 AND y <= 1980 AS inside FROM pm_raw""", "pm_raw")
P.cte("pm", f"""SELECT id, nation, region, issued AS issue_date, sector, work, category, CASE WHEN v > 0 THEN v END AS value, CASE WHEN inside THEN x END AS x,
  CASE WHEN inside THEN y END AS y, CASE WHEN inside THEN 'source_point' ELSE 'out_of_area' END AS match_quality,
  CASE WHEN sector = 'excluded' THEN 'not_a_permit' WHEN category IS NULL THEN 'unmapped_type' WHEN issued > DATE '{P.THROUGH}' THEN 'after_data_through' END AS exclusion
  FROM pm0""", "pm0")
_PM = "id, issue_date, sector, work, category, value, x, y, match_quality, exclusion"


@query("normalize_permits", sql("pm", f"SELECT {_PM}, nation FROM pm"))
def normalize_permits(t):
    return permits(t).select(*_PM.split(", "), "nation")


def demolitions(t):
    raw = permits_raw(t).where("l_returnflag = 'R'")
    d = raw.select(F.struct("nation", "region", F.split("id", "-")[0].alias("order_id")).alias("id"), F.col("issued").alias("status_date"),
                   F.col("value").cast("string").alias("cost"), F.col("x").cast("string").alias("x"), F.col("y").cast("string").alias("y"))
    p = normalize.demolition_records(d, day(P.THROUGH), P.BOX)
    return p.select(F.col("id.order_id").alias("id"), "id.nation", "id.region", *[c for c in p.columns if c != "id"])


P.cte("dm", f"""SELECT id, nation, region, issue_date, 'demolition' AS category, CASE WHEN v > 0 THEN v END AS value, CASE WHEN x <= 1980 AND y <= 1980 THEN x END AS x,
  CASE WHEN x <= 1980 AND y <= 1980 THEN y END AS y,
  CASE WHEN issue_date > DATE '{P.THROUGH}' THEN 'after_data_through' END AS exclusion FROM (
  SELECT split_part(id, '-', 1) AS id, nation, region, issued AS issue_date, v, x, y, row_number() OVER (PARTITION BY split_part(id, '-', 1)
  ORDER BY issued DESC, CASE WHEN v = floor(v) AND v < 1e7 THEN CAST(CAST(v AS BIGINT) AS VARCHAR) || '.0' ELSE CAST(v AS VARCHAR) END DESC) AS k FROM pm_raw WHERE l_returnflag = 'R') WHERE k = 1""", "pm_raw")


@query("normalize_demolitions", sql("dm", "SELECT id, nation, issue_date, category, value, x, y, exclusion FROM dm"))
def normalize_demolitions(t):
    return demolitions(t).select("id", "nation", "issue_date", "category", "value", "x", "y", "exclusion")


# --- inspections ----------------------------------------------------------------

KINDS = {"click": "routine", "purchase": "follow_up", "signup": "pre_opening", "view": "complaint"}


def inspections(t):
    e = t.events.select(
        "event_id", "user_id", F.when(F.col("user_id") % 7 == 0, F.lit("")).otherwise(F.col("user_id").cast("string")).alias("place_id"),
        F.concat(F.lit("Cafe No. "), "user_id").alias("name"), F.lit("1 Main St., #2").alias("address"), F.to_date("ts").alias("date"),
        F.col("event_type").alias("kind_text"),
        F.when(F.col("value") > 150, "n/a").otherwise(F.col("value").cast("string")).alias("score_text"))
    return normalize.inspection_records(e, KINDS, day("2024-01-29"), day("2024-01-02"))


P.cte("ins", """SELECT event_id, user_id, CASE WHEN user_id % 7 = 0 THEN 'name_address:CAFE NO ' || user_id || ' 1 MAIN ST 2' ELSE 'permit:' || user_id END AS place,
  CAST(ts AS DATE) AS date, CASE event_type WHEN 'click' THEN 'routine' WHEN 'purchase' THEN 'follow_up' WHEN 'signup' THEN 'pre_opening' WHEN 'view' THEN 'complaint' END AS kind,
  CASE WHEN value <= 150 THEN value END AS score,
  CASE WHEN event_type = 'error' THEN 'unmapped_inspection_type' WHEN CAST(ts AS DATE) > DATE '2024-01-29' THEN 'after_data_through'
    WHEN CAST(ts AS DATE) < DATE '2024-01-02' THEN 'before_data_from' END AS exclusion FROM events""")


@query("normalize_inspections", sql("ins", "SELECT event_id, place, date, kind, score, exclusion FROM ins"))
def normalize_inspections(t):
    return inspections(t).select("event_id", "place", "date", "kind", "score", "exclusion")


@query("normalize_establishments", """WITH listed AS (SELECT 'permit:' || c_custkey AS place, c_name AS name, c_mktsegment AS place_type FROM customer WHERE c_acctbal >= 0),
  seen AS (SELECT place, r.name AS name, r.pt AS place_type FROM (SELECT place, arg_max({'name': name, 'pt': place_type}, (date, name)) AS r FROM (SELECT 'permit:' || o_custkey AS place, CAST(o_orderdate AS DATE) AS date,
    'order ' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS name, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS place_type FROM orders) GROUP BY place))
  SELECT * FROM (SELECT * FROM listed UNION ALL SELECT * FROM seen WHERE place NOT IN (SELECT place FROM listed)) WHERE place_type IS NULL OR place_type NOT IN ('BUILDING', '5-LOW')""")
def normalize_establishments(t):
    listed = t.customer.where("c_acctbal >= 0").select(
        F.concat(F.lit("permit:"), "c_custkey").alias("place"), F.col("c_name").alias("name"), F.lit("1 Main St").alias("address"), F.col("c_mktsegment").alias("place_type"))
    ins = t.orders.select(F.concat(F.lit("permit:"), "o_custkey").alias("place"), F.to_date("o_orderdate").alias("date"),
                          F.concat(F.lit("order "), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("name"), F.lit("1 Main St").alias("address"),
                          F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("place_type"))
    return normalize.place_records(listed, ins, ["BUILDING", "5-LOW"]).select("place", "name", "place_type")


@query("establishment_key", """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'name_address:' || upper(replace(s_name, '#', ' ')) || ' 12 N FIRST ST APT 4' ELSE 'permit:' || s_suppkey END AS place FROM supplier""")
def establishment_key(t):
    return t.supplier.select("s_suppkey", text.place_key(F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey").cast("string")), F.col("s_name"),
                                                         F.lit("12 N. First  St, apt #4")).alias("place"))


@query("program_filter", """SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY p_brand HAVING avg(p_size) > 25)""")
def program_filter(t):
    include = t.part.groupBy("p_brand").agg(F.avg("p_size").alias("s")).where("s > 25")
    return normalize.program_rows(t.part, include, "p_brand").select("p_partkey", "p_brand")


@query("bbox_locate", """SELECT c_custkey, (c_custkey * 7919) % 1999 BETWEEN 100 AND 1500 AND (c_custkey * 104729) % 2003 BETWEEN 200 AND 1600 AS located FROM customer""")
def bbox_locate(t):
    x, y = P.hashed_xy(F.col("c_custkey"))
    return t.customer.select("c_custkey", text.in_box(x, y, (100, 200, 1500, 1600)).alias("located"))


@query("match_quality", """SELECT c_custkey, CASE WHEN x BETWEEN 100 AND 1500 AND y BETWEEN 200 AND 1600 THEN 'source_point' WHEN x IS NULL THEN 'missing' ELSE 'out_of_area' END AS quality
  FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN (c_custkey * 7919) % 1999 END AS x, (c_custkey * 104729) % 2003 AS y FROM customer)""")
def match_quality(t):
    x, y = P.hashed_xy(F.col("c_custkey"))
    x = F.when(F.col("c_acctbal") >= 0, x)
    return t.customer.select("c_custkey", text.match_quality(x, y, text.in_box(x, y, (100, 200, 1500, 1600))).alias("quality"))


@query("base_records", sql("base", "SELECT id, type, opened, nation FROM base"))
def base_records(t):
    return normalize.base_records(P.tickets(t)).select("id", "type", "opened", "nation")


@query("rolling_window", """WITH w AS (SELECT 'd90' AS w, DATE '2001-07-15' - 89 AS s UNION ALL SELECT 'd365', DATE '2001-07-15' - 364 UNION ALL SELECT 'm12', DATE '2000-07-16' UNION ALL SELECT 'm60', DATE '1996-07-16')
  SELECT o_orderpriority, w, s AS window_start, DATE '2001-07-15' AS window_end, count(*) AS n FROM orders JOIN w ON CAST(o_orderdate AS DATE) BETWEEN s AND DATE '2001-07-15' GROUP BY ALL""")
def rolling_window(t):
    th = day(P.THROUGH)
    o = fan_out(t.orders.select("o_orderpriority", F.to_date("o_orderdate").alias("d")),
                [{"w": "d90", "days": 90, "months": 0}, {"w": "d365", "days": 365, "months": 0}, {"w": "m12", "days": 0, "months": 12}, {"w": "m60", "days": 0, "months": 60}],
                {"w": "string", "days": "int", "months": "int"})
    start = F.when(F.col("days") > 0, dates.window_start_days(th, F.col("days"))).otherwise(dates.window_start_months(th, F.col("months")))
    return (o.withColumn("window_start", start).withColumn("window_end", th).where(F.col("d").between(F.col("window_start"), F.col("window_end")))
            .groupBy("o_orderpriority", "w", "window_start", "window_end").agg(F.count(F.lit(1)).alias("n")))


@query("roll_months", """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 6 MONTH AS DATE) + (day(o_orderdate)::INTEGER - 1) AS plus6,
  CAST(date_trunc('month', o_orderdate) - INTERVAL 3 MONTH AS DATE) + (day(o_orderdate)::INTEGER - 1) AS minus3 FROM orders""")
def roll_months(t):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", dates.roll_months(d, 6).alias("plus6"), dates.roll_months(d, -3).alias("minus3"))


@query("data_through_month", """SELECT o_orderpriority, least(CAST(date_trunc('month', max(o_orderdate)) AS DATE) - 1, DATE '2001-07-15' - 1) AS through FROM orders GROUP BY 1""")
def data_through_month(t):
    return t.orders.groupBy("o_orderpriority").agg(dates.last_complete_month(F.to_date(F.max("o_orderdate")), day(P.THROUGH)).alias("through"))


_SPELL = """CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:00' WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN o_orderstatus = 'O' THEN 'unknown' ELSE '20 ' || strftime(o_orderdate, '%d.%m.%Y') END"""


@query("parse_dates_multi", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 IN (0, 1) OR o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS d FROM orders""")
def parse_dates_multi(t):
    o = F.col("o_orderdate")
    s = (F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.date_format(o, "yyyy-MM-dd"), F.lit(" 10:00")))
         .when(F.col("o_orderkey") % 3 == 1, F.date_format(o, " MM/dd/yyyy")).when(F.col("o_orderstatus") == "O", "unknown")
         .when(F.col("o_orderstatus") == "P", F.concat(F.lit("01/01/1789"))).otherwise(F.date_format(o, "dd.MM.yyyy")))
    return t.orders.select("o_orderkey", dates.parse_first_date(s, [("yyyy-MM-dd", 10), ("MM/dd/yyyy", 10), ("dd.MM.yyyy", 0)]).alias("d"))


@query("normalize_address", r"""SELECT c_custkey, trim(regexp_replace(regexp_replace(upper(c_name || '., ' || lower(c_mktsegment) || '   st. #' || c_custkey), '[.,#]', ' ', 'g'), '\s+', ' ', 'g')) AS k FROM customer""")
def normalize_address(t):
    return t.customer.select("c_custkey", text.address_key(F.concat(F.lit(" "), "c_name", F.lit("., "), F.lower("c_mktsegment"), F.lit("   st. #"), "c_custkey")).alias("k"))


@query("parse_geocode_batch", """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN -90.0 + c_custkey / 8.0 END AS lon, CASE WHEN c_acctbal >= 0 THEN 35.5 END AS lat,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'exact' WHEN c_mktsegment = 'FURNITURE' THEN 'non_exact' WHEN c_mktsegment = 'MACHINERY' THEN 'tie' ELSE 'no_match' END AS quality FROM customer""")
def parse_geocode_batch(t):
    c = t.customer
    pair = F.when(F.col("c_acctbal") >= 0, F.concat(-90.0 + F.col("c_custkey") / 8.0, F.lit(",35.5"))).when(F.col("c_acctbal") > -500, "").otherwise("1,2,3")
    lon, lat = text.lon_lat_pair(pair)
    seg = F.col("c_mktsegment")
    status = F.when(seg.isin("BUILDING", "FURNITURE"), "Match").when(seg == "MACHINERY", "Tie").otherwise("No_Match")
    kind = F.when(seg == "BUILDING", "Exact").otherwise("Non_Exact")
    return c.select("c_custkey", lon.alias("lon"), lat.alias("lat"), text.geocode_quality(status, kind).alias("quality"))


@query("geocode_cache_join", """WITH cache AS (SELECT upper(replace(c_name, '#', ' ')) AS k, c_custkey / 8.0 AS lon, CASE WHEN c_mktsegment = 'BUILDING' THEN 'exact' WHEN c_mktsegment = 'MACHINERY' THEN 'tie' ELSE 'non_exact' END AS q
    FROM customer WHERE c_acctbal > 4500),
  o AS (SELECT o_orderkey, upper(replace(c_name, '#', ' ')) AS k FROM orders JOIN customer ON o_custkey = c_custkey)
  SELECT o_orderkey, CASE WHEN q <> 'tie' THEN lon END AS longitude, coalesce(q, 'no_match') AS match_quality, q IS NULL AS to_do FROM o LEFT JOIN cache ON o.k = cache.k""")
def geocode_cache_join(t):
    seg = F.col("c_mktsegment")
    cache = t.customer.where("c_acctbal > 4500").select(
        text.address_key(F.col("c_name")).alias("address_key"), (F.col("c_custkey") / 8.0).alias("longitude"), F.lit(35.0).alias("latitude"),
        F.when(seg == "BUILDING", "exact").when(seg == "MACHINERY", "tie").otherwise("non_exact").alias("match_quality"))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    todo = normalize.addresses_to_geocode(o, cache, text.address_key(F.col("c_name"))).withColumn("to_do", F.lit(True))
    g = normalize.geocoded(o, cache, text.address_key(F.col("c_name"))).join(todo, "address_key", "left")
    return g.select("o_orderkey", "longitude", "match_quality", F.coalesce("to_do", F.lit(False)).alias("to_do"))


@query("split_address", r"""SELECT c_custkey, CASE WHEN regexp_matches(trim(split_part(a, ',', 1)), '^[1-9][0-9]*\s+\S') THEN trim(split_part(a, ',', 1)) END AS street
  FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name ELSE c_custkey || ' ' || c_mktsegment END || ', city, 381' AS a FROM customer)""")
def split_address(t):
    a = F.concat(F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(F.concat_ws(" ", "c_custkey", "c_mktsegment")), F.lit(", city, 381"))
    return t.customer.select("c_custkey", text.street_part(a).alias("street"))


@query("suppression_reason", sql("pl", """SELECT nation, o_orderpriority AS type, n, CASE WHEN nation = 'NATION_3' THEN 'not reported for this kind of area' WHEN n IS NULL THEN 'no records in this window'
  WHEN pop < 2200 AND n >= 30 THEN 'fewer than 2200 residents' WHEN pop < 2000 AND n >= 30 THEN 'fewer than 2000 parcels' WHEN n < 30 THEN 'too few records' ELSE '' END AS reason
  FROM (SELECT a.nation, a.o_orderpriority, n, pop FROM (SELECT nation, o_orderpriority FROM (SELECT DISTINCT nation FROM pl), (SELECT DISTINCT o_orderpriority FROM orders)) a
  JOIN (SELECT nation, count(*) * 40 AS pop FROM pl GROUP BY 1) p ON a.nation = p.nation
  LEFT JOIN (SELECT nation, o_orderpriority, count(*) AS n FROM orders JOIN pl ON o_custkey = custkey WHERE o_orderdate >= '2001-03-01' GROUP BY 1, 2) c ON c.nation = a.nation AND c.o_orderpriority = a.o_orderpriority)"""))
def suppression_reason(t):
    pl = P.places(t)
    pop = pl.groupBy("nation").agg((F.count(F.lit(1)) * 40).alias("pop"))
    n = (t.orders.where(F.col("o_orderdate") >= day("2001-03-01")).join(pl, F.col("o_custkey") == F.col("custkey"))
         .groupBy("nation", F.col("o_orderpriority").alias("type")).agg(F.count(F.lit(1)).alias("n")))
    types = t.orders.select(F.col("o_orderpriority").alias("type")).distinct().agg(F.collect_list("type").alias("types"))   # a code list
    from wardstat.session import attach
    cells = pop.transform(attach, types).withColumn("type", F.explode("types")).drop("types").join(n, ["nation", "type"], "left")
    return cells.select("nation", "type", "n", text.suppression(
        reported=F.col("nation") != "NATION_3", n=F.col("n"), suppressed=(F.col("n") < 30) | (F.col("pop") < 2200), min_n=30,
        population=(F.col("pop"), 2200), parcels=(F.col("pop"), 2000)).alias("reason"))


@query("compact_rows", sql("base", """SELECT geo_type, geo_id, type AS subgroup, value, ci_low, CASE WHEN ci_high = 'inf' THEN -1 ELSE ci_high END AS ci_high, n, suppressed FROM km""",
                           [("tm", "SELECT *, CASE WHEN is_closed THEN bd_to_close ELSE age_bd END AS time, CAST(is_closed AS INTEGER) AS ev, DATE '2001-04-17' AS window_start FROM base WHERE close_problem IS NULL AND opened >= DATE '2001-04-17'"),
                            ("lv", P.sql_levels("tm"))] + P.sql_km("lv", "type, geo_type, geo_id")))
def compact_rows(t):
    m = metrics.median_days(normalize.base_records(P.tickets(t)), P.levels(), day(P.THROUGH), [{"days": 90}])
    return sinks.compact(m, ["geo_type", "geo_id", "subgroup", "value", "ci_low", "ci_high", "n", "suppressed"])


@query("ratio_bins", """SELECT s_suppkey, CASE WHEN r < 0.5 THEN 'far below' WHEN r < 0.9 THEN 'below' WHEN r < 1.1 THEN 'near' WHEN r < 1.5 THEN 'above' ELSE 'far above' END AS bin
  FROM (SELECT s_suppkey, s_acctbal / (SELECT avg(s_acctbal) FROM supplier) AS r FROM supplier)""")
def ratio_bins(t):
    from wardstat.session import attach
    s = t.supplier.transform(attach, t.supplier.agg(F.avg("s_acctbal").alias("m")))
    return s.select("s_suppkey", text.ratio_class(F.col("s_acctbal") / F.col("m"), [0.5, 0.9, 1.1, 1.5], ["far below", "below", "near", "above", "far above"]).alias("bin"))


@query("annotation_codes", """WITH l AS (SELECT c_custkey, 'B01' AS variable, c_acctbal AS e, CASE WHEN c_mktsegment = 'BUILDING' THEN -555555555 WHEN c_mktsegment = 'MACHINERY' THEN -222222222 ELSE 10 END AS m FROM customer
    UNION ALL SELECT c_custkey, 'B02', CAST(c_custkey % 50 AS DOUBLE), 5 FROM customer)
  SELECT c_custkey, variable, CASE WHEN e >= 0 THEN e WHEN z THEN 0 END AS estimate, CASE WHEN e < 0 AND z THEN 0 WHEN m = -555555555 THEN 0 WHEN m >= 0 THEN CAST(m AS DOUBLE) END AS moe
  FROM (SELECT *, c_custkey % 50 = 0 AS z FROM l)""")
def annotation_codes(t):
    seg = F.col("c_mktsegment")
    wide = t.customer.select("c_custkey", F.col("c_acctbal").alias("B01E"), F.when(seg == "BUILDING", -555555555.0).when(seg == "MACHINERY", -222222222.0).otherwise(10.0).alias("B01M"),
                             (F.col("c_custkey") % 50).cast("double").alias("B02E"), F.lit(5.0).alias("B02M"))
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v + "E").alias("estimate"), F.col(v + "M").alias("moe")) for v in ("B01", "B02")])
    long = normalize.code_annotations(wide.select("c_custkey", F.inline(rows)))
    empty = long.where("variable = 'B02' and estimate = 0").select("c_custkey")
    return normalize.fill_empty_areas(long, empty, "c_custkey")


@query("subgroup_parse", """SELECT s AS subgroup, count(*) AS n FROM part, (VALUES (''), ('ECONOMY|PROMO'), ('category:new')) v(s)
  WHERE s = '' OR (s = 'ECONOMY|PROMO' AND p_type IN ('ECONOMY', 'PROMO')) OR (s = 'category:new' AND p_type IN ('ECONOMY', 'STANDARD')) GROUP BY s""")
def subgroup_parse(t):
    cat = text.codes_to_state(F.col("p_type"), {a: c for a, _, c in CATEGORY}, "none")
    names = ["", "ECONOMY|PROMO", "category:new"]
    hit = F.filter(F.array(*[F.when(normalize.subgroup_condition(s, F.col("p_type"), cat), F.lit(s)) for s in names]), lambda x: x.isNotNull())
    return t.part.select(F.explode(hit).alias("subgroup")).groupBy("subgroup").agg(F.count(F.lit(1)).alias("n"))
