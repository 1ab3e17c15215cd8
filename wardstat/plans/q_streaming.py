"""Streaming forms of the collectors, replayed over landed files of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.plans.proxies import rnd, sql
from wardstat.plans.q_sequences import outage_obs, outage_polls
from wardstat.plans.registry import query
from wardstat.streaming import streams

# Landed files are read in any order, so replays keep state for the whole month.
DELAY = "60 days"


@query("stream_ingest_dedupe", "SELECT user_id AS vehicle, date_trunc('second', ts) AS timestamp FROM events GROUP BY 1, 2")
def stream_ingest_dedupe(t):
    e = t.events.select(F.col("user_id").alias("vehicle"), F.date_trunc("second", "ts").alias("timestamp"))
    twice = e.unionByName(e.where(F.col("vehicle") % 2 == 0))
    path = streams.land(twice, "positions", "timestamp", files=6)
    s = streams.read_landed(t.spark, path, twice.schema)
    return streams.drain(streams.dedupe_reports(s, ["vehicle", "timestamp"], "timestamp", DELAY), "dedupe")


@query("stream_decode_reports", """SELECT 'alert' AS kind, CAST(event_id AS VARCHAR) AS id, CAST(floor(epoch(ts)) AS BIGINT) + 60 * k AS period_start, CASE WHEN event_type <> 'view' THEN 'r' || user_id END AS route_id, NULL::DOUBLE AS lat FROM events, (VALUES (0), (1)) v(k) WHERE event_type <> 'click'
  UNION ALL SELECT 'alert', CAST(event_id AS VARCHAR), NULL, 'r' || user_id, NULL FROM events WHERE event_type = 'click' UNION ALL SELECT 'vehicle', CAST(event_id AS VARCHAR), CAST(floor(epoch(ts)) AS BIGINT), CAST(user_id AS VARCHAR), value FROM events""")
def stream_decode_reports(t):
    start = F.unix_seconds("ts")
    period = lambda k: F.struct((start + 60 * k).alias("start"), (start + 600).alias("end"))
    alert = F.struct(F.col("event_type").alias("header"), F.lit("DETOUR").alias("effect"),
                     F.when(F.col("event_type") == "click", F.array().cast("array<struct<start:bigint,end:bigint>>")).otherwise(F.array(period(0), period(1))).alias("active_period"),
                     F.when(F.col("event_type") != "view", F.array(F.struct(F.concat(F.lit("r"), "user_id").alias("route_id"), F.lit("s1").alias("stop_id")))).alias("informed_entity"))
    lines = t.events.select(F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), alert.alias("alert"))).alias("value"))
    path = streams.land(lines, "alerts", "value", files=4, fmt="text")
    a = streams.drain(streams.decode_alerts(streams.read_landed(t.spark, path, None, "text")), "alerts")
    veh = t.events.select(F.to_json(F.struct(F.col("event_id").cast("string").alias("entity_id"), F.struct(F.col("user_id").cast("string").alias("id")).alias("vehicle"),
                                             F.struct(F.col("value").alias("latitude")).alias("position"), start.alias("timestamp"))).alias("value"))
    vpath = streams.land(veh, "vehicles", "value", files=4, fmt="text")
    v = streams.drain(streams.decode_vehicles(streams.read_landed(t.spark, vpath, None, "text")), "vehicles")
    a = a.select(F.lit("alert").alias("kind"), F.col("alert_id").alias("id"), "period_start", "route_id", F.lit(None).cast("double").alias("lat"))
    return a.unionByName(v.select(F.lit("vehicle").alias("kind"), F.col("entity_id").alias("id"), F.col("timestamp").alias("period_start"), F.col("vehicle_id").alias("route_id"), "lat"))


@query("stream_outage_parse", """WITH d AS (SELECT event_id // 5 AS poll, event_id, user_id, value, bool_or(value > 300) OVER (PARTITION BY event_id // 5) AS lacks, bool_or(value < 0.1) OVER (PARTITION BY event_id // 5) AS odd FROM events)
  SELECT poll, true AS ok, NULL AS problem, CAST(event_id AS VARCHAR) AS outage_no, value AS lon FROM d WHERE NOT lacks AND NOT odd
  UNION ALL SELECT DISTINCT poll, false, CASE WHEN odd THEN 'not_features' ELSE 'properties_absent: STATUS' END, NULL, NULL FROM d WHERE lacks OR odd""")
def stream_outage_parse(t):
    e = t.events.withColumn("poll", F.floor(F.col("event_id") / 5))
    prop = {"OUTAGE_NO": F.concat(F.lit(" "), F.col("event_id").cast("string")), "TIME_STAMP": F.lit("01/01/2024 01:00:00 AM"), "EST_REPAIR_TIME": F.lit(""),
            "CUR_CUST_AFF": F.floor("value").cast("string")}
    full = F.create_map(*[x for k, v in prop.items() for x in (F.lit(k), v)])
    props = F.when(F.col("value") > 300, full).otherwise(F.map_concat(full, F.create_map(F.lit("STATUS"), F.lit("A"))))
    feat = F.struct(props.alias("properties"), F.struct(F.array("value", F.lit(35.0)).alias("coordinates")).alias("geometry"))
    docs = e.groupBy("poll").agg(F.collect_list(feat).alias("features"), F.min("value").alias("low"))           # five features a document
    kind = F.when(F.col("low") < 0.1, "Page").otherwise("FeatureCollection")
    body = docs.select("poll", F.to_json(F.struct(kind.alias("type"), "features")).alias("body"))
    path = streams.land(body, "snapshots", "poll")
    out = streams.drain(streams.parse_outages(streams.read_landed(t.spark, path, body.schema), "poll", "body"), "outages")
    return out.select("poll", "ok", "problem", "outage_no", "lon")


_FOOT = r"\(c\) (\S+) \| "


@query("stream_summary_parse", r"""SELECT page_id, page_id % 3 <> 0 AS ok, CASE WHEN page_id % 3 <> 0 THEN (page_id % 1000) / 10.0::DOUBLE END AS pct_with_power, CASE WHEN page_id % 3 <> 0 THEN page_id * 37 + 1000 END AS customers_with_power,
  CASE WHEN page_id % 3 <> 0 THEN 100.0 - (page_id % 1000) / 10.0::DOUBLE END AS pct_without_power, CASE WHEN page_id % 3 <> 0 THEN page_id * 3 END AS customers_without_power,
  CASE WHEN page_id % 3 <> 0 THEN '09/24/2026 10:' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') || ' AM' END AS current_as_of_local, regexp_extract(x, '\(c\) (\S+) \| ', 1) AS host FROM (SELECT page_id,
  replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&copy;', '(c)'), '&middot;', '|'), '&amp;', '&') AS x FROM pages)""")
def stream_summary_parse(t):
    """Two pages of three carry the summary's wording, with figures made from the page's id."""
    k, tenth = F.col("page_id"), (F.col("page_id") % 1000).cast("decimal(10,1)") / 10
    wording = F.concat(F.lit("<p>"), F.format_string("%.1f", tenth.cast("double")), F.lit("% <b>Customers With Power</b>&nbsp;"), F.format_number(k * 37 + 1000, 0), F.lit("</p><p>"),
                       F.format_string("%.1f", 100.0 - tenth.cast("double")), F.lit("% Customers Without Power "), F.format_number(k * 3, 0), F.lit("</p><i>CURRENT AS OF 09/24/2026 10:"),
                       F.lpad((k % 60).cast("string"), 2, "0"), F.lit(" AM</i>"))
    pages = t.pages.select("page_id", F.concat("html", F.when(k % 3 != 0, wording).otherwise("")).alias("html"))
    path = streams.land(pages, "pages", "page_id")
    s = streams.read_landed(t.spark, path, pages.schema)
    s = s.withColumn("host", F.regexp_extract(streams.page_text(F.col("html")), _FOOT, 1))
    out = streams.drain(streams.parse_summary(s), "summary")
    return rnd(out, 6, "pct_with_power", "pct_without_power").select("page_id", "ok", *[f"{a}_{b}" for b in ("with_power", "without_power") for a in ("pct", "customers")], "current_as_of_local", "host")


def _user_spans_sql() -> str:
    return """SELECT user_id, min(t) AS span_start, max(t) AS span_end FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY t) AS run FROM (SELECT user_id, t, CASE WHEN epoch(t) - epoch(lag(t) OVER (PARTITION BY user_id ORDER BY t)) <= 21600 THEN 0 ELSE 1 END AS b
  FROM (SELECT DISTINCT user_id, date_trunc('second', ts) AS t FROM events))) GROUP BY user_id, run HAVING max(t) > min(t)"""


@query("stream_uptime_windows", _user_spans_sql())
def stream_uptime_windows(t):
    p = t.events.select("user_id", F.date_trunc("second", "ts").alias("t"))
    # A closing tick far ahead ends every session; it is a session of one poll and drops out.
    tick = p.agg((F.max("t") + F.expr("interval 1 year")).alias("t")).select(F.lit(-1).cast("bigint").alias("user_id"), "t")
    path = streams.land(p, "polls", "t", files=4, tail=tick)
    s = streams.read_landed(t.spark, path, p.schema, per_trigger=5)
    return streams.drain(streams.uptime_windows(s, ["user_id"], "t", "6 hours", DELAY), "uptime")


@query("stream_event_chains", sql("obs pidx oe", """SELECT outage, event, first_seen, last_seen, restored_hi, reappeared, round(max_cust, 4) AS max_cust FROM oe WHERE confirmed AND (SELECT max(t) FROM pidx) - restored_hi > 7200"""))
def stream_event_chains(t):
    obs, polls = outage_obs(t).select("t", "outage", "cust"), outage_polls(t)
    # closing ticks right after the last poll: they release the last sightings and move the watermark past the last poll
    close = polls.agg(F.max("t").alias("t")).select(F.explode(F.array(*(F.col("t") + k for k in (1, 2, 3)))).alias("t"))
    polls = polls.unionByName(close)
    obs, notes = streams.with_heartbeats(obs, polls), streams.poll_notes(polls)
    paths = [streams.land_in_order(obs, "sightings", "t", files=5), streams.land_in_order(notes, "polls", "t", files=5)]
    s, n = (streams.read_landed(t.spark, p, d.schema, per_trigger=1) for p, d in zip(paths, (obs, notes)))
    out = streams.drain(streams.event_chains(streams.with_next_polls(s, n, "0 seconds")), "chains")
    return out.withColumn("max_cust", F.round("max_cust", 4))


@query("stream_poll_counts", "SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start, count(*) AS reports, round(sum(value), 2) AS customers FROM events GROUP BY 1")
def stream_poll_counts(t):
    e = t.events.select("ts", "value")
    path = streams.land(e, "counts", "ts")
    s = streams.read_landed(t.spark, path, e.schema)
    out = streams.drain(streams.poll_counts(s, "ts", "30 minutes", DELAY, "value"), "counts", "update", ["window_start"])
    return out.withColumn("customers", F.round("customers", 2))
