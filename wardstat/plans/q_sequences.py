"""Ordered and windowed operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.functions import geo
from wardstat.operators import checks, metrics, sequences, spatial, tracks
from wardstat.operators.aggregates import even_share
from wardstat.operators.joins import classify_trips
from wardstat.plans import proxies as P
from wardstat.plans.proxies import day, rnd, sql
from wardstat.plans.q_joins import matched, polls
from wardstat.plans.q_spatial import order_points, order_shapes, order_tracks
from wardstat.plans.registry import query
from wardstat.session import cut_lineage


@query("covered_spans", sql("spans", "SELECT user_id, span_start, span_end FROM spans"))
def covered_spans(t):
    return sequences.covered_spans(polls(t), ["user_id"], "t", 21600)


# --- outages --------------------------------------------------------------------

def outage_polls(t):
    """Hours with any event are polls; nobody polled from 03:00 to 05:59."""
    h = t.events.where(~F.hour("ts").between(3, 5)).select((F.floor(F.unix_seconds("ts") / 3600) * 3600).alias("t"))
    return h.distinct()


def outage_obs(t):
    """A user's events in one polled hour are one sighting of outage <user>."""
    e = t.events.where(~F.hour("ts").between(3, 5)).withColumn("t", F.floor(F.unix_seconds("ts") / 3600) * 3600)
    g = e.groupBy(F.col("user_id").alias("uid"), "t").agg(
        F.max("value").alias("cust"), F.min("event_id").alias("e"), F.max((F.col("event_type") == "signup") & (F.col("value") > 100)).alias("planned"),
        F.max(F.col("event_type") != "error").alias("placed"))
    x, y = P.hashed_xy(F.col("uid"))
    return g.select(F.col("uid").cast("string").alias("outage"), "t", F.when(F.col("e") % 2 == 0, F.col("t") - 900).alias("start_ts"),
                    F.when(F.col("e") % 7 != 0, F.col("t") + 3600 * (F.col("e") % 4)).alias("etr"), "cust", "planned",
                    F.when(F.col("placed"), x).alias("lon"), F.when(F.col("placed"), y).alias("lat"))


def outage_events(t):
    return sequences.outage_events(outage_obs(t), outage_polls(t))


P.cte("op0", "SELECT *, CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS t FROM events WHERE hour(ts) NOT BETWEEN 3 AND 5")
P.cte("pidx", "SELECT t, row_number() OVER (ORDER BY t) AS i, lead(t) OVER (ORDER BY t) AS after1, lead(t, 2) OVER (ORDER BY t) AS after2 FROM (SELECT DISTINCT t FROM op0)", "op0")
P.cte("obs", """SELECT CAST(user_id AS VARCHAR) AS outage, t, max(value) AS cust, min(event_id) AS e, bool_or(event_type = 'signup' AND value > 100) AS planned,
  CASE WHEN min(event_id) % 2 = 0 THEN t - 900 END AS start_ts, CASE WHEN min(event_id) % 7 <> 0 THEN t + 3600 * (min(event_id) % 4) END AS etr,
  CASE WHEN bool_or(event_type <> 'error') THEN CAST((user_id * 7919) % 1999 AS DOUBLE) END AS lon, CASE WHEN bool_or(event_type <> 'error') THEN CAST((user_id * 104729) % 2003 AS DOUBLE) END AS lat FROM op0 GROUP BY user_id, t""", "op0")
P.cte("o1", """SELECT o.*, p.i, p.after1, p.after2, p.i - lag(p.i) OVER w - 1 AS absent, o.t - lag(p.after1) OVER w AS gone FROM obs o JOIN pidx p ON p.t = o.t WINDOW w AS (PARTITION BY outage ORDER BY o.t)""", "obs", "pidx")
P.cte("o2", """SELECT *, CASE WHEN absent IS NULL OR (absent >= 2 AND gone > 7200) THEN 1 ELSE 0 END AS fresh FROM o1""", "o1")
P.cte("o3", """SELECT *, sum(fresh) OVER (PARTITION BY outage ORDER BY t) AS event, fresh = 0 AND absent >= 2 AS back,
  coalesce(lead(i) OVER w = i + 1 AND lead(fresh) OVER w = 0, false) AS certain, cust * coalesce(after1 - t, 0) AS cs FROM o2 WINDOW w AS (PARTITION BY outage ORDER BY t)""", "o2")
P.cte("oe0", """SELECT outage, CAST(event AS BIGINT) AS event, coalesce(min(start_ts), min(t)) AS start, min(t) AS first_seen, max(t) AS last_seen, arg_max({'a': after1, 'b': after2}, t) AS nx, bool_or(back) AS reappeared, max(cust) AS max_cust,
  coalesce(sum(cs) FILTER (WHERE certain), 0) / 3600 AS cust_hours_lo, sum(cs) / 3600 AS cust_hours_hi, arg_min(etr, t) FILTER (WHERE etr IS NOT NULL) AS first_etr, arg_max(etr, t) FILTER (WHERE etr IS NOT NULL) AS final_etr,
  bool_or(planned) AS planned, arg_min(lon, t) FILTER (WHERE lon IS NOT NULL) AS lon, arg_min(lat, t) FILTER (WHERE lon IS NOT NULL) AS lat FROM o3 GROUP BY 1, 2""", "o3")
P.cte("oe", """SELECT *, CASE WHEN confirmed THEN (restored_lo + restored_hi) / 2.0 END AS restored_mid, restored_hi - restored_lo AS restoration_span_s, CASE WHEN confirmed THEN (restored_lo + restored_hi) / 2.0 ELSE last_seen END - start AS duration_s FROM (
  SELECT e.outage, e.event, e.outage || '-' || e.event AS event_id, start, first_seen, last_seen, nx.b IS NOT NULL AS confirmed, CASE WHEN nx.b IS NOT NULL THEN last_seen END AS restored_lo, CASE WHEN nx.b IS NOT NULL THEN nx.a END AS restored_hi,
    reappeared, max_cust, cust_hours_lo, cust_hours_hi, first_etr, CASE WHEN h.at_t >= start + 3000 THEN h.etr END AS etr_60m, final_etr, planned, lon, lat FROM oe0 e
  LEFT JOIN (SELECT o3.outage, o3.event, max(t) AS at_t, arg_max({'e': etr}, t).e AS etr FROM o3 JOIN oe0 ON oe0.outage = o3.outage AND oe0.event = o3.event WHERE t <= start + 3600 GROUP BY 1, 2) h ON h.outage = e.outage AND h.event = e.event)""", "oe0", "o3")


@query("poll_index", sql("pidx", "SELECT t, i, after1, after2 FROM pidx"))
def poll_index(t):
    return sequences.poll_index(outage_polls(t), "t")


_OE = ("event_id, start, first_seen, last_seen, confirmed, restored_lo, restored_hi, reappeared, max_cust, first_etr, etr_60m, final_etr, planned, lon, lat, restored_mid, "
       "restoration_span_s, duration_s, round(cust_hours_lo, 4) AS cust_hours_lo, round(cust_hours_hi, 4) AS cust_hours_hi")


@query("build_outage_events", sql("oe", f"SELECT {_OE} FROM oe"))
def build_outage_events(t):
    cols = [c.strip().split(" AS ")[-1] for c in _OE.replace("round(cust_hours_lo, 4) AS", "").replace("round(cust_hours_hi, 4) AS", "").split(",")]
    return rnd(outage_events(t), 4, "cust_hours_lo", "cust_hours_hi").select(*cols)


# --- transit --------------------------------------------------------------------

@query("classify_trips", sql("cls", "SELECT trip_id, tolerance, status, count(*) AS n FROM cls GROUP BY ALL"))
def classify(t):
    return classify_trips(matched(t), ["tolerance"]).groupBy("trip_id", "tolerance", "status").agg(F.count(F.lit(1)).alias("n"))


P.cte("stops3", "SELECT DISTINCT service_date, trip_id, CAST(300 * k AS DOUBLE) AS stop_along FROM trk, (VALUES (1), (2), (3)) v(k)", "trk")
P.cte("pr", "SELECT *, lag(along) OVER w AS pa, lag(t) OVER w AS pt, row_number() OVER w AS j FROM prog WHERE along IS NOT NULL WINDOW w AS (PARTITION BY service_date, trip_id ORDER BY t)", "prog")
P.cte("cross0", """SELECT s.service_date, s.trip_id, s.stop_along, min(j) FILTER (WHERE along >= stop_along - 0.5) AS j, min(j) FILTER (WHERE along >= stop_along - 30) AS c
  FROM stops3 s JOIN pr p ON p.service_date = s.service_date AND p.trip_id = s.trip_id GROUP BY 1, 2, 3""", "stops3", "pr")
P.cte("crossed", """SELECT s.service_date, s.trip_id, s.stop_along, CASE WHEN p.j IS NULL OR p.j = 1 OR p.t - p.pt > 180 THEN NULL WHEN x.j IS NULL OR p.along <= p.pa THEN p.t
  ELSE p.pt + (least(s.stop_along, p.along) - p.pa) / (p.along - p.pa) * (p.t - p.pt) END AS arrival FROM stops3 s LEFT JOIN cross0 x ON x.service_date = s.service_date AND x.trip_id = s.trip_id AND x.stop_along = s.stop_along
  LEFT JOIN pr p ON p.service_date = s.service_date AND p.trip_id = s.trip_id AND p.j = coalesce(x.j, x.c)""", "cross0", "pr", "stops3")


@query("crossing_times", sql("crossed", "SELECT service_date, trip_id, stop_along, round(arrival, 4) AS arrival FROM crossed"))
def crossing_times(t):
    stops = order_tracks(t).select("service_date", "trip_id").distinct().withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    stops = stops.select("service_date", "trip_id", F.col("k").cast("string").alias("stop_id"), (F.col("k") * 300.0).alias("stop_along"))
    return rnd(tracks.crossing_times(order_tracks(t), stops, order_shapes(t)), 4, "arrival").drop("stop_id")


@query("infer_arrivals", sql("crossed", """SELECT c.service_date, c.trip_id, o_orderpriority AS route_id, CAST(round(stop_along / 300) AS INTEGER) AS stop_sequence, round(arrival, 4) AS arrival, round(arrival - 100 * round(stop_along / 300), 4) AS delay_s
  FROM crossed c JOIN orders ON o_orderkey = c.trip_id WHERE stop_along >= 600 AND o_orderstatus <> 'O' AND o_totalprice >= 20000"""))
def infer_arrivals(t):
    m = t.orders.select(F.to_date("o_orderdate").alias("service_date"), F.col("o_orderkey").alias("trip_id"), F.col("o_orderpriority").alias("route_id"), F.lit("0").alias("direction_id"),
                        F.col("o_orderkey").alias("shape_id"), (F.col("o_orderstatus") != "O").alias("observed"), (F.col("o_totalprice") >= 20000).alias("measurable"))
    reports = order_tracks(t).drop("shape_id")
    st = reports.select("service_date", "trip_id").distinct().withColumn("stop_sequence", F.explode(F.array(*map(F.lit, range(0, 4)))))
    st = st.select("service_date", "trip_id", F.col("stop_sequence").cast("string").alias("stop_id"), "stop_sequence", (F.col("stop_sequence") > 0).alias("timepoint"),
                   (F.col("stop_sequence") * 300.0 * 1.003).alias("dist"), (F.col("stop_sequence") * 100.0).alias("scheduled"))
    a = tracks.infer_arrivals(m, st, reports, order_shapes(t))
    return rnd(a, 4, "arrival", "delay_s").select("service_date", "trip_id", "route_id", "stop_sequence", "arrival", "delay_s")


def headway_events(t):
    """Order lines as timed stops of their week's Monday, in the morning peak."""
    monday = F.to_date(F.date_trunc("week", "l_shipdate"))
    s = F.unix_seconds(F.to_timestamp(monday)) + 12 * 3600 + (F.col("l_partkey") * 37 + F.col("l_orderkey") * 11) % 10800
    late = F.col("l_suppkey") % 400 - 100
    return t.lineitem.select(
        monday.alias("service_date"), F.concat(F.lit("r"), F.col("l_suppkey") % 3).alias("route_id"), (F.col("l_linenumber") % 2).cast("string").alias("direction_id"),
        F.concat(F.lit("s"), F.col("l_partkey") % 5).alias("stop_id"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trip_id"),
        s.alias("scheduled"), F.when(F.col("l_quantity") <= 45, s + late).alias("arrival"),
        F.when(F.col("l_returnflag") == "R", "ghost").when(F.col("l_quantity") > 40, "unobserved").otherwise("observed").alias("status"), (F.col("l_discount") < 0.09).alias("measurable"))


P.cte("hev0", """SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS service_date, 'r' || l_suppkey % 3 AS route_id, CAST(l_linenumber % 2 AS VARCHAR) AS direction_id, 's' || l_partkey % 5 AS stop_id,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS trip_id, CAST(epoch(date_trunc('week', l_shipdate)) AS BIGINT) + 43200 + (l_partkey * 37 + l_orderkey * 11) % 10800 AS scheduled,
  CASE WHEN l_quantity <= 45 THEN CAST(epoch(date_trunc('week', l_shipdate)) AS BIGINT) + 43200 + (l_partkey * 37 + l_orderkey * 11) % 10800 + l_suppkey % 400 - 100 END AS arrival,
  CASE WHEN l_returnflag = 'R' THEN 'ghost' WHEN l_quantity > 40 THEN 'unobserved' ELSE 'observed' END AS status, l_discount < 0.09 AS measurable FROM lineitem""")
P.cte("hev", "SELECT * FROM (SELECT *, timezone('America/Chicago', timezone('UTC', make_timestamp(scheduled * 1000000))) AS lt FROM hev0) WHERE isodow(lt) <= 5 AND (hour(lt) BETWEEN 6 AND 8 OR hour(lt) BETWEEN 15 AND 17)", "hev0")
P.cte("hgap", """SELECT *, arr - lag(arr) OVER (PARTITION BY service_date, route_id, direction_id, stop_id ORDER BY scheduled, trip_id) AS gap FROM (SELECT *, CASE WHEN measurable AND status = 'observed' THEN arrival END AS arr FROM hev WHERE NOT (measurable AND status = 'ghost'))
  QUALIFY gap > 0""", "hev")
P.cte("sgap", "SELECT *, scheduled - lag(scheduled) OVER (PARTITION BY service_date, route_id, direction_id, stop_id ORDER BY scheduled, trip_id) AS gap FROM hev QUALIFY gap IS NOT NULL", "hev")


def peak_events(t):
    from wardstat.functions.dates import in_peak
    return headway_events(t).where(in_peak(F.timestamp_seconds("scheduled")))


@query("headway_gaps", sql("hgap", "SELECT service_date, route_id, direction_id, stop_id, scheduled, gap FROM hgap"))
def headway_gaps(t):
    return sequences.headway_gaps(peak_events(t), metrics.HEADWAY_KEY)


@query("route_match_floor", sql("cls", f"""SELECT route_id, window_start, round(avg(CASE WHEN status = 'observed' THEN 1.0 ELSE 0 END), 6) AS rate FROM dw GROUP BY 1, 2 HAVING avg(CASE WHEN status = 'observed' THEN 1.0 ELSE 0 END) >= 0.85""",
                                [("cm", "SELECT * FROM cls WHERE measurable AND tolerance = 15"), ("dw", P.sql_windows("cm", "service_date", (30, 90)))]))
def route_match_floor(t):
    c = classify_trips(matched(t), ["tolerance"]).where("tolerance = 15")
    return rnd(metrics.routes_above_floor(c, day(P.THROUGH)), 6, "rate").select("route_id", "window_start", "rate")


@query("latest_per_key", """SELECT user_id, event_id, CAST(ts AS DATE) AS d, value FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, value DESC, event_id DESC) = 1""")
def latest_per_key(t):
    e = t.events.where("event_type = 'click'").withColumn("d", F.to_date("ts"))
    return sequences.latest_per_key(e, ["user_id"], [F.col("d"), F.col("value"), F.col("event_id")], ["event_id", "d", "value"])


def food_places(t):
    """Users as establishments, placed in their customer's nation."""
    p = t.events.select("user_id").distinct().join(P.places(t), F.col("user_id") == F.col("custkey"))
    key = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("name_address:CAFE NO "), "user_id", F.lit(" 1 MAIN ST 2"))).otherwise(F.concat(F.lit("permit:"), "user_id"))
    return p.select(key.alias("place"), "nation", "region", F.lit("city").alias("city"), F.when(F.col("user_id") % 11 == 0, day("2024-01-15")).alias("closed_date"))


P.cte("fp", """SELECT CASE WHEN user_id % 7 = 0 THEN 'name_address:CAFE NO ' || user_id || ' 1 MAIN ST 2' ELSE 'permit:' || user_id END AS place, nation, region, CASE WHEN user_id % 11 = 0 THEN DATE '2024-01-15' END AS closed_date
  FROM (SELECT DISTINCT user_id FROM events) JOIN pl ON custkey = user_id""", "pl")
P.cte("od", """SELECT place, nation, region, ref, due, grace, DATE '2024-01-29' > due + CAST(grace AS INTEGER) AS overdue FROM (SELECT p.*, coalesce(clock, first) AS ref, CAST(date_trunc('month', coalesce(clock, first)) + INTERVAL 0 MONTH AS DATE) + (day(coalesce(clock, first))::INTEGER - 1) AS due
  FROM fp p JOIN (SELECT place, max(date) FILTER (WHERE kind IN ('routine', 'pre_opening')) AS clock, min(date) AS first, max(date) AS seen FROM ins WHERE exclusion IS NULL AND date <= DATE '2024-01-29' GROUP BY 1) g USING (place)
  WHERE seen >= DATE '2023-12-30' AND (closed_date IS NULL OR closed_date > DATE '2024-01-29')), (VALUES (0), (5), (10)) v(grace)""", "fp", "ins")
OVERDUE = {"active_months": 1, "interval_months": 0, "graces": (0, 5, 10)}


@query("overdue_flag", sql("od", "SELECT place, ref, due, CASE grace WHEN 0 THEN 'primary' ELSE 'grace_' || grace || 'd' END AS variant, overdue FROM od"))
def overdue_flag(t):
    from wardstat.plans.q_mapping import inspections
    return metrics.overdue_rows(food_places(t), inspections(t), day("2024-01-29"), **OVERDUE).select("place", "ref", "due", "variant", "overdue")


@query("block_even_share", """SELECT o_orderkey, o_custkey, round(CASE WHEN tot > 0 THEN v / tot ELSE 1.0 / k END, 8) AS share FROM (SELECT *, sum(v) OVER (PARTITION BY o_custkey) AS tot, count(*) OVER (PARTITION BY o_custkey) AS k FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_totalprice END AS v FROM orders))""")
def block_even_share(t):
    o = t.orders.withColumn("v", F.when(F.col("o_custkey") % 3 == 0, 0.0).otherwise(F.col("o_totalprice")))
    return rnd(even_share(o, ["o_custkey"], "v"), 8, "share").select("o_orderkey", "o_custkey", "share")


_RR = " , ".join(f"min(b.t - a.t) FILTER (WHERE d2 <= {r * r}) AS r{r}" for r in (25, 50, 100))


@query("first_rereport", sql("op", """SELECT a.id, min(lag) FILTER (WHERE d2 <= 625) AS r25, min(lag) FILTER (WHERE d2 <= 2500) AS r50, min(lag) FILTER (WHERE d2 <= 10000) AS r100 FROM op a LEFT JOIN (
  SELECT a.id, b.t - a.t - 3 AS lag, (a.x-b.x)**2 + (a.y-b.y)**2 AS d2 FROM op a JOIN op b ON a.type = b.type AND b.t - a.t - 3 > 0 AND b.t - a.t - 3 <= 60 AND (a.x-b.x)**2 + (a.y-b.y)**2 <= 10000) p ON p.id = a.id GROUP BY 1"""))
def first_rereport(t):
    p = order_points(t).withColumnRenamed("type", "g")
    r = spatial.first_rereport(p.withColumn("t", F.col("t") + 3), p, [25, 50, 100])
    return r.select("id", "r25", "r50", "r100")


@query("recent_list", sql("op", f"SELECT id, t, duplicate_of IS NOT NULL AS is_duplicate FROM hx JOIN dd USING (id) WHERE list_contains({P.sql_disk('(SELECT h9 FROM hx ORDER BY t DESC, id DESC LIMIT 1)')}, h9) ORDER BY t DESC, id DESC LIMIT 15",
                          P.sql_dedupe("op", 50, 7) + [("hx", P.sql_hex("op", 174.0, "h9", "h9"))]))
def recent_list(t):
    p = cut_lineage(order_points(t).withColumn("h9", geo.hex_cell(F.col("x"), F.col("y"), "h9")))
    here = p.agg(F.max_by("h9", F.struct("t", "id")).alias("cell")).select(F.explode(geo.hex_disk(F.col("cell"))).alias("h9"))
    near = p.join(here, "h9", "left_semi")
    dup = spatial.near_duplicates(p, 50, 7)
    return near.orderBy(F.desc("t"), F.desc("id")).limit(15).join(dup, "id").select("id", "t", F.col("duplicate_of").isNotNull().alias("is_duplicate"))


@query("fetch_completeness", """SELECT o_orderpriority AS feed, count(*) AS fetched, CAST(max(k) AS BIGINT) AS announced, count(*) >= max(k) AS complete FROM orders JOIN (SELECT o_orderpriority AS p, CAST(count(DISTINCT o_custkey) * 2.2 AS BIGINT) AS k FROM orders GROUP BY 1) ON p = o_orderpriority GROUP BY 1""")
def fetch_completeness(t):
    announced = t.orders.groupBy(F.col("o_orderpriority").alias("feed")).agg(F.round(F.count_distinct("o_custkey") * 2.2).cast("bigint").alias("announced"))
    return checks.fetch_complete(t.orders.withColumnRenamed("o_orderpriority", "feed"), announced, "feed")
