"""Equi, interval and area joins, and the transit matching built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.operators import joins
from wardstat.operators.sequences import covered_spans
from wardstat.plans import proxies as P
from wardstat.plans.proxies import rnd, sql
from wardstat.plans.registry import query


@query("equi_lookup_join", sql("pl", "SELECT o_orderkey, nation, c_mktsegment FROM orders LEFT JOIN pl ON custkey = o_custkey LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0"))
def equi_lookup_join(t):
    c = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"))
    return o.join(P.places(t), "custkey", "left").join(c, "custkey", "left").select("o_orderkey", "nation", "c_mktsegment")


#: Rows of the larger side that one task of a join should hold.
PART_ROWS = 1_000_000


@query("semi_anti_join", """SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS returned FROM orders
  WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def semi_anti_join(t):
    # files say little of rows in memory: parts are dealt by counted rows, and no side is sent whole to every task
    n = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-t.lineitem.count() // PART_ROWS))
    lines = t.lineitem.select("l_orderkey", "l_returnflag").repartition(n, "l_orderkey")
    r = lines.where("l_returnflag = 'R'").select("l_orderkey").distinct().hint("merge")
    have = t.orders.select("o_orderkey").repartition(n, "o_orderkey").join(
        lines.select("l_orderkey").distinct().hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    yes = have.join(r, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").withColumn("returned", F.lit(True))
    no = have.join(r, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").withColumn("returned", F.lit(False))
    return yes.unionByName(no)


def polls(t):
    """Event times per user as successful polls, in whole seconds."""
    return t.events.select("event_id", "user_id", F.unix_seconds("ts").alias("t"))


P.cte("ev", "SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, event_type, value FROM events")
P.cte("spans", """SELECT user_id, min(t) AS span_start, max(t) AS span_end FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY t) AS run FROM (
  SELECT user_id, t, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= 21600 THEN 0 ELSE 1 END AS b FROM (SELECT DISTINCT user_id, t FROM ev))) GROUP BY user_id, run HAVING max(t) > min(t)""", "ev")


@query("interval_containment", sql("spans", """SELECT event_id, coalesce(bool_or(t + 1800 <= span_end), false) AS covered FROM ev LEFT JOIN spans s ON s.user_id = ev.user_id AND span_start <= t AND t <= span_end GROUP BY event_id"""))
def interval_containment(t):
    p = polls(t)
    spans = covered_spans(p, ["user_id"], "t", 21600)
    return joins.inside_spans(p.withColumn("to_t", F.col("t") + 1800), "t", "to_t", spans, ["user_id"]).select("event_id", "covered")


# --- transit ---------------------------------------------------------------------

def _midnight(c):
    return F.unix_seconds(F.to_timestamp(c))


def sched_trips(t):
    """Orders as scheduled trips of their day."""
    start = _midnight(F.to_date("o_orderdate")) + 6 * 3600 + (F.col("o_orderkey") % 600) * 60
    return t.orders.select(F.to_date("o_orderdate").alias("service_date"), F.col("o_orderkey").cast("string").alias("trip_id"),
                           F.col("o_orderpriority").alias("route_id"), (F.col("o_orderkey") % 2).cast("string").alias("direction_id"),
                           F.when(F.col("o_totalprice") < 30000, "").otherwise((F.col("o_custkey") % 40).cast("string")).alias("block_id"),
                           start.alias("first_t"), (start + 1800).alias("last_t"))


def trip_reports(t):
    """Order lines as vehicle reports around their trip's schedule; open lines were never sent."""
    o = sched_trips(t).select("service_date", "trip_id", "first_t")
    at = F.col("first_t") + F.col("l_linenumber") * 300 - 1500 + F.col("l_partkey") % 420
    return (t.lineitem.where("l_linestatus = 'F'").join(o, F.col("l_orderkey").cast("string") == F.col("trip_id"))
            .select("service_date", "trip_id", at.alias("t"), "l_linenumber", "l_suppkey"))


def poller_spans(t):
    """A day with at least five orders was polled from 05:00 to 23:00, other days until noon."""
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return d.select((_midnight(F.col("d")) + 5 * 3600).alias("span_start"),
                    (_midnight(F.col("d")) + F.when(F.col("n") >= 5, 23).otherwise(12) * 3600).alias("span_end"))


P.cte("trips", """SELECT CAST(o_orderdate AS DATE) AS service_date, CAST(o_orderkey AS VARCHAR) AS trip_id, o_orderpriority AS route_id, CAST(o_orderkey % 2 AS VARCHAR) AS direction_id,
  CASE WHEN o_totalprice < 30000 THEN '' ELSE CAST(o_custkey % 40 AS VARCHAR) END AS block_id,
  CAST(epoch(o_orderdate) AS BIGINT) + 21600 + (o_orderkey % 600) * 60 AS first_t, CAST(epoch(o_orderdate) AS BIGINT) + 23400 + (o_orderkey % 600) * 60 AS last_t FROM orders""")
P.cte("reports", """SELECT service_date, trip_id, first_t + l_linenumber * 300 - 1500 + l_partkey % 420 AS t, l_linenumber, l_suppkey FROM lineitem JOIN trips ON trip_id = CAST(l_orderkey AS VARCHAR) WHERE l_linestatus = 'F'""", "trips")
P.cte("pspans", """SELECT CAST(epoch(o_orderdate) AS BIGINT) + 18000 AS span_start, CAST(epoch(o_orderdate) AS BIGINT) + CASE WHEN count(*) >= 5 THEN 23 ELSE 12 END * 3600 AS span_end FROM orders GROUP BY o_orderdate""")
P.cte("matched", """SELECT s.*, first_t - tol * 60 AS from_t, last_t + tol * 60 AS to_t, CAST(tol AS INTEGER) AS tolerance, EXISTS (SELECT 1 FROM pspans p WHERE p.span_start <= first_t - tol * 60 AND last_t + tol * 60 <= p.span_end) AS measurable,
  coalesce(n, 0) AS n_reports, coalesce(fr <= last_t + tol * 60 AND lr >= first_t - tol * 60, false) AS observed FROM trips s, (VALUES (10), (15), (30)) v(tol)
  LEFT JOIN (SELECT service_date, trip_id, count(*) AS n, min(t) AS fr, max(t) AS lr FROM reports GROUP BY 1, 2) r ON r.trip_id = s.trip_id AND r.service_date = s.service_date""", "trips", "reports", "pspans")
P.cte("cls", """SELECT m.*, CASE WHEN observed THEN 'observed' WHEN block_id <> '' AND bool_or(observed) OVER (PARTITION BY service_date, block_id, tolerance) THEN 'ghost' ELSE 'unobserved' END AS status FROM matched m""", "matched")


def matched(t):
    return joins.match_trips(sched_trips(t), trip_reports(t), poller_spans(t), [10, 15, 30])


@query("match_trips", sql("matched", "SELECT trip_id, tolerance, measurable, n_reports, observed FROM matched"))
def match_trips(t):
    return matched(t).select("trip_id", "tolerance", "measurable", "n_reports", "observed")


@query("with_all_areas", """SELECT n_name AS nation, seg AS segment, coalesce(n, 0) AS n FROM nation, (SELECT DISTINCT c_mktsegment AS seg FROM customer)
  LEFT JOIN (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1, 2) c ON c_nationkey = n_nationkey AND c_mktsegment = seg""")
def with_all_areas(t):
    n = (t.customer.where("c_acctbal > 9000").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .groupBy(F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n")))
    segs = t.customer.agg(F.sort_array(F.collect_set("c_mktsegment")).alias("segs"))          # a code list
    from wardstat.session import attach
    sk = t.nation.select(F.col("n_name").alias("nation")).transform(attach, segs).select("nation", F.explode("segs").alias("segment"))
    return joins.with_all_areas(n, sk, ["nation", "segment"], {"n": 0})


@query("explode_geographies", sql("pl", f"""SELECT geo_type, geo_id, count(*) AS n FROM ({P.sql_levels('pl')}) GROUP BY 1, 2"""))
def explode_geographies(t):
    p = P.places(t).withColumn("city", F.lit("city"))
    return joins.by_area(p, P.levels()).groupBy("geo_type", "geo_id").agg(F.count(F.lit(1)).alias("n"))


@query("window_coverage", sql("spans", """SELECT user_id, round(sum(greatest(0, least(span_end, b) - greatest(span_start, a))) / (b - a), 6) AS coverage FROM spans, (SELECT CAST(epoch(TIMESTAMP '2024-01-05') AS BIGINT) AS a, CAST(epoch(TIMESTAMP '2024-01-25') AS BIGINT) AS b) GROUP BY user_id, a, b HAVING sum(greatest(0, least(span_end, b) - greatest(span_start, a))) / (b - a) >= 0.05"""))
def window_coverage(t):
    spans = covered_spans(polls(t), ["user_id"], "t", 21600)
    lo, hi = (F.unix_seconds(F.lit(d).cast("timestamp")) for d in ("2024-01-05", "2024-01-25"))
    return rnd(joins.span_coverage(spans, ["user_id"], lo, hi).where("coverage >= 0.05"), 6, "coverage")
