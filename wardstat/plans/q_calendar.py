"""Calendar, dates and clock times."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.functions import dates
from wardstat.operators import calendar as cal_ops
from wardstat.plans import proxies as P
from wardstat.plans.proxies import sql
from wardstat.plans.registry import query
from wardstat.sources import files


@query("holiday_rules", sql("hol", "SELECT d AS date, holiday, count(o_orderkey) AS n FROM hol LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d WHERE year(d) BETWEEN 1995 AND 2001 GROUP BY 1, 2"))
def holiday_rules(t):
    span = t.orders.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"))
    years = span.select(F.explode(F.sequence(F.col("a") - 1, F.col("b") + 1)).alias("year"))
    h = cal_ops.holidays(years, P.RULES).where(F.year("date").between(1995, 2001))
    n = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return h.join(n, "date", "left").select("date", "holiday", F.coalesce("n", F.lit(0)).alias("n"))


@query("local_date", """SELECT event_id, CAST(timezone('America/Chicago', timezone('UTC', ts)) AS DATE) AS from_instant,
  CASE WHEN event_id % 2 = 0 THEN CAST(timezone('America/Chicago', timezone('UTC', date_trunc('second', ts))) AS DATE) ELSE CAST(ts AS DATE) END AS from_text FROM events""")
def local_date(t):
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = (F.when(F.col("event_id") % 2 == 0, utc).when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("event_id") % 5 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm")))
    return t.events.select("event_id", dates.local_day(F.col("ts")).alias("from_instant"), dates.local_day_from_text(text).alias("from_text"))


@query("parse_local_time", """SELECT event_id, CASE WHEN event_type <> 'view' THEN timezone('UTC', timezone('America/Chicago', date_trunc('second', ts))) END AS utc FROM events""")
def parse_local_time(t):
    clock = F.when(F.col("event_type") == "view", " ").otherwise(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"))
    return t.events.select("event_id", dates.local_clock_to_utc(clock).alias("utc"))


@query("is_business_day", sql("cal", "SELECT o_orderkey, is_bd FROM orders JOIN cal ON d = CAST(o_orderdate AS DATE)"))
def is_business_day(t):
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return cal_ops.with_business_flag(o, "d", P.calendar(t)).select("o_orderkey", "is_bd")


@query("business_days_between", sql("cal", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_shipdate >= o_orderdate THEN b.cum - a.cum END AS bd
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN cal a ON a.d = CAST(o_orderdate AS DATE) JOIN cal b ON b.d = CAST(l_shipdate AS DATE)"""))
def business_days_between(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("o_orderdate").alias("s"), F.to_date("l_shipdate").alias("e"))
    return cal_ops.with_business_days(j, "s", "e", P.calendar(t), "bd").drop("s", "e")


@query("add_business_days", sql("cal", """SELECT o_orderkey, CASE WHEN n = 0 THEN CAST(o_orderdate AS DATE) ELSE b.d END AS due FROM (SELECT *, o_orderkey % 10 AS n FROM orders)
  JOIN cal a ON a.d = CAST(o_orderdate AS DATE) JOIN cal b ON b.is_bd AND b.cum = a.cum + greatest(n, 1)"""))
def add_business_days(t):
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("s"), (F.col("o_orderkey") % 10).alias("n"))
    return cal_ops.with_deadline(o, "s", "n", P.calendar(t), "due").select("o_orderkey", "due")


@query("gtfs_active_services", """WITH c AS (SELECT o_orderpriority AS service, CAST(min(o_orderdate) AS DATE) + 100 AS a, CAST(max(o_orderdate) AS DATE) - 400 AS b FROM orders GROUP BY 1),
  d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
  base AS (SELECT day, service FROM d JOIN c ON day BETWEEN a AND b AND ((service < '3' AND isodow(day) <= 5) OR (service >= '3' AND isodow(day) >= 6))),
  x AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS service, max(o_totalprice) >= 400000 AS adds, min(o_totalprice) < 20000 AS removes FROM orders GROUP BY 1, 2)
  SELECT day, service FROM (SELECT * FROM base UNION SELECT day, service FROM x WHERE adds) EXCEPT SELECT day, service FROM x WHERE removes""")
def gtfs_active_services(t):
    o = t.orders.select(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("service_id"), "o_totalprice")
    wd = F.when(F.col("service_id") < "3", F.array(*map(F.lit, range(5)))).otherwise(F.array(F.lit(5), F.lit(6)))
    cal = o.groupBy("service_id").agg(F.date_add(F.min("day"), 100).alias("start_date"), F.date_sub(F.max("day"), 400).alias("end_date")).withColumn("weekdays", wd)
    x = o.groupBy("day", "service_id").agg(F.max("o_totalprice").alias("hi"), F.min("o_totalprice").alias("lo"))
    kinds = F.filter(F.array(F.when(F.col("hi") >= 400000, 1), F.when(F.col("lo") < 20000, 2)), lambda k: k.isNotNull())
    exc = x.select("day", "service_id", F.explode(kinds).alias("exception_type"))
    return files.active_services(o, cal, exc).select("day", F.col("service_id").alias("service"))


@query("gtfs_time_to_seconds", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST((4 + l_linenumber * 3) * 3600 + (l_partkey % 60) * 60 + l_suppkey % 60 AS INTEGER) AS secs FROM lineitem")
def gtfs_time_to_seconds(t):
    hms = F.format_string("%02d:%02d:%02d", 4 + F.col("l_linenumber") * 3, (F.col("l_partkey") % 60).cast("int"), (F.col("l_suppkey") % 60).cast("int"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dates.hms_seconds(hms).alias("secs"))


@query("scheduled_times", """WITH s AS (SELECT l_orderkey, timezone('UTC', timezone('America/Chicago', CAST(o_orderdate AS TIMESTAMP) + INTERVAL 12 HOUR)) - INTERVAL 12 HOUR + to_seconds(CAST(18000 + l_linenumber * 1200 + l_partkey % 600 AS INTEGER)) AS sched,
  l_returnflag = 'A' AS tp FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT l_orderkey AS trip_id, min(sched) AS first, max(sched) AS last, count(*) AS n_stops, count(*) FILTER (WHERE tp) AS n_timepoints FROM s GROUP BY 1""")
def scheduled_times(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    at = dates.scheduled_instant(F.to_date("o_orderdate"), 18000 + F.col("l_linenumber") * 1200 + F.col("l_partkey") % 600)
    return j.groupBy(F.col("l_orderkey").alias("trip_id")).agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n_stops"),
                                                               F.count_if(F.col("l_returnflag") == "A").alias("n_timepoints"))


@query("in_peak", """SELECT event_id, isodow(l) <= 5 AND (hour(l) BETWEEN 6 AND 8 OR hour(l) BETWEEN 15 AND 17) AS peak FROM (SELECT event_id, timezone('America/Chicago', timezone('UTC', ts)) AS l FROM events)""")
def in_peak(t):
    return t.events.select("event_id", dates.in_peak(F.col("ts")).alias("peak"))
