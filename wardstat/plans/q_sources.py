"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.functions.dates import from_epoch_ms, local_day
from wardstat.operators import checks, metrics
from wardstat.operators.joins import asof_backward
from wardstat.plans import proxies as P
from wardstat.plans.proxies import day, sql
from wardstat.plans.registry import query
from wardstat.session import scratch_path
from wardstat.sources import files, sinks


@query("scan_csv_typed", "SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS id, n_name AS name, CAST(n_regionkey AS INTEGER) AS region_id, "
       "CASE WHEN n_regionkey <> 0 THEN CAST(n_nationkey AS DOUBLE) / 4 END AS weight FROM nation")
def scan_csv_typed(t):
    path = scratch_path(t.spark, "csv")
    (t.nation.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("id"), F.col("n_name").alias("name"),
                     F.col("n_regionkey").alias("region_id"),
                     F.when(F.col("n_regionkey") == 0, "NA").otherwise((F.col("n_nationkey") / 4).cast("string")).alias("weight"))
     .write.csv(path, header=True))
    return files.read_csv(t.spark, path, "id string, name string, region_id int, weight double")


@query("scan_export_columns", """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS cust_id,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders""")
def scan_export_columns(t):
    path = scratch_path(t.spark, "export")
    (t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("cust_id"),
                     F.when(F.col("o_orderstatus") == "O", "NULL").otherwise(F.col("o_orderstatus")).alias("status"),
                     F.to_date("o_orderdate").alias("day"),
                     F.when(F.col("o_orderpriority") == "5-LOW", "NA").otherwise(F.col("o_orderpriority")).alias("priority"))
     .write.csv(path, header=True))
    return files.read_export(t.spark, path, "PART-*.csv")


@query("scan_canonical_table", """SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS place_id, c_name AS name, c_mktsegment AS kind,
  DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS inspection_date FROM customer""")
def scan_canonical_table(t):
    raw = t.customer.select(
        F.col("c_custkey").cast("string").alias("Permit ID"), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("Permit Name"),
        F.col("c_mktsegment").alias("Permit Type"),
        F.date_format(F.date_add(day("1995-01-01"), (F.col("c_custkey") % 2000).cast("int")), "MM/dd/yyyy").alias("Inspected"))
    table, _ = files.canonical(raw.unionByName(raw), {"place_id": "Permit ID", "name": "Permit Name", "kind": "Permit Type",
                                                      "inspection_date": "Inspected", "closed_date": None},
                               ["place_id"], {"inspection_date": [("yyyy-MM-dd", 10), ("MM/dd/yyyy", 10)]})
    return table


@query("scan_jsonl_gz", "SELECT event_id, event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
       "CASE WHEN event_type = 'error' THEN value END AS loss FROM events")
def scan_jsonl_gz(t):
    path = scratch_path(t.spark, "jsonl")
    k = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    e = t.events
    whole = e.select(F.to_json(F.struct("event_id", F.col("event_type").alias("kind"), k,
                                        F.when(F.col("event_type") == "error", F.col("value")).alias("loss"))).alias("value"))
    broken = whole.select(F.substring("value", 1, 12).alias("value"))      # lines cut off in the middle
    whole.unionByName(broken).write.option("compression", "gzip").text(path)
    return files.read_json_lines(t.spark, path, "event_id bigint, kind string, k bigint, loss double")


_REPORTS = """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, CASE WHEN event_type = 'view' THEN '' ELSE CAST(user_id AS VARCHAR) END AS vehicle_id,
  'e' || event_type AS entity_id, CASE WHEN event_type <> 'error' THEN value END AS lat FROM events"""


@query("scan_positions", f"""SELECT vehicle, timestamp, make_timestamp(timestamp * 1000000) AS time,
  CAST(timezone('America/Chicago', timezone('UTC', make_timestamp(timestamp * 1000000))) AS DATE) AS service_date, min(lat) AS lat, count(*) > 0 AS kept
  FROM (SELECT CASE WHEN vehicle_id = '' THEN entity_id ELSE vehicle_id END AS vehicle, timestamp, lat FROM ({_REPORTS})) WHERE lat IS NOT NULL
  GROUP BY vehicle, timestamp""")
def scan_positions(t):
    r = t.events.select(
        F.floor(F.unix_micros("ts") / 1000000).alias("timestamp"),
        F.when(F.col("event_type") == "view", "").otherwise(F.col("user_id").cast("string")).alias("vehicle_id"),
        F.concat(F.lit("e"), "event_type").alias("entity_id"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("lat"), F.lit(-90.0).alias("lon"))
    again = r.where("vehicle_id <> ''")
    r = r.select("lat", "lon", "vehicle_id", "entity_id", "timestamp").unionByName(again)
    return files.vehicle_positions(r).select("vehicle", "timestamp", "time", "service_date", "lat", F.lit(True).alias("kept"))


@query("scan_snapshots", """SELECT date_trunc('hour', ts) AS poll, user_id AS outage, max(value) AS cust, count(*) AS n FROM (
  SELECT ts, user_id, value FROM events) GROUP BY 1, 2""")
def scan_snapshots(t):
    # Nested snapshots per hour and user range, so one document stays small.
    e = t.events.groupBy(F.date_trunc("hour", "ts").alias("poll"), F.col("user_id").alias("outage")).agg(
        F.max("value").alias("cust"), F.count(F.lit(1)).alias("n"))
    snap = e.groupBy("poll", F.floor(F.col("outage") / 100).alias("part")).agg(
        F.collect_list(F.struct("outage", "cust", "n")).alias("outages"))
    empty = snap.select("poll", "part", F.array().cast(snap.schema["outages"].dataType).alias("outages"))
    polls, obs = files.snapshots(snap.unionByName(empty).drop("part"), "poll", "outages", "outage")
    return polls.join(obs, "poll").select("poll", "outage", "cust", "n")


@query("scan_poll_log", "SELECT CAST(user_id AS VARCHAR) AS feed, ts AS time, event_type <> 'error' AND event_type <> 'view' AS ok FROM events WHERE value >= 10")
def scan_poll_log(t):
    raw = t.events.select(F.when(F.col("value") >= 10, "outages").otherwise("summary").alias("feed"), F.col("ts").alias("time"),
                          F.when(F.col("event_type") != "view", F.col("event_type") != "error").alias("ok"),
                          F.col("user_id").cast("string").alias("who"))
    log = files.poll_log(raw.withColumn("time", F.struct("time", "who")), "outages")
    return log.select(F.col("time.who").alias("feed"), F.col("time.time").alias("time"), "ok")


@query("scan_gtfs_tables", """SELECT 'trips' AS tbl, CAST(o_orderkey AS VARCHAR) AS k, o_orderpriority || '|' || o_orderstatus || '|' || CAST(o_orderkey % 2 AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) AS v, 1 AS n, NULL::DOUBLE AS num FROM orders
  UNION ALL SELECT 'stop_times', CAST(l_orderkey AS VARCHAR), CAST(CAST(l_linenumber AS INTEGER) AS VARCHAR) || '|0' || CAST(l_suppkey AS VARCHAR) || '|' || CASE WHEN l_returnflag = 'A' THEN 'true' ELSE 'false' END, count(*), sum(l_quantity) FROM lineitem GROUP BY ALL
  UNION ALL SELECT 'stops', '0' || CAST(s_suppkey AS VARCHAR), s_name, 1, s_suppkey / 7.0::DOUBLE FROM supplier
  UNION ALL SELECT 'shapes', CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR), 1, p_retailprice FROM part
  UNION ALL SELECT 'calendar', o_orderstatus, strftime(min(o_orderdate), '%Y%m%d') || '|' || strftime(max(o_orderdate), '%Y%m%d'), 5, NULL FROM orders GROUP BY o_orderstatus
  UNION ALL SELECT DISTINCT 'calendar_dates', o_orderstatus, strftime(o_orderdate, '%Y%m%d'), CASE WHEN day(o_orderdate) = 1 THEN 1 ELSE 2 END, NULL FROM orders WHERE day(o_orderdate) < 3""")
def scan_gtfs_tables(t):
    base = scratch_path(t.spark, "gtfs")
    o, txt = t.orders.withColumn("day", F.date_format("o_orderdate", "yyyyMMdd")), lambda c: F.col(c).cast("string")
    tables = {
        "trips": o.select(F.col("o_orderpriority").alias("route_id"), F.col("o_orderstatus").alias("service_id"), txt("o_orderkey").alias("trip_id"), (F.col("o_orderkey") % 2).alias("direction_id"), txt("o_custkey").alias("shape_id")),
        "stop_times": t.lineitem.select(F.col("l_orderkey").alias("trip_id"), F.concat(F.lit("0"), "l_suppkey").alias("stop_id"), F.col("l_linenumber").alias("stop_sequence"), F.col("l_quantity").alias("shape_dist_traveled"),
                                        (F.col("l_returnflag") == "A").cast("int").alias("timepoint"), F.lit("06:00:00").alias("arrival_time")),
        "stops": t.supplier.select(F.concat(F.lit("0"), "s_suppkey").alias("stop_id"), F.col("s_name").alias("stop_name"), (F.col("s_suppkey") / 7.0).alias("stop_lat"), F.lit(-90.0).alias("stop_lon")),
        "shapes": t.part.select(F.col("p_partkey").alias("shape_id"), F.col("p_retailprice").alias("shape_pt_lat"), F.lit(-90.0).alias("shape_pt_lon"), F.col("p_size").alias("shape_pt_sequence")),
        "calendar": o.groupBy(F.col("o_orderstatus").alias("service_id")).agg(F.min("day").alias("start_date"), F.max("day").alias("end_date")).select("service_id", *(F.lit(int(d[0] != "s")).alias(d) for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")), "start_date", "end_date"),
        "calendar_dates": o.where(F.dayofmonth("o_orderdate") < 3).select(F.col("o_orderstatus").alias("service_id"), F.col("day").alias("date"), F.when(F.dayofmonth("o_orderdate") == 1, 1).otherwise(2).alias("exception_type")).distinct(),
    }
    for name, df in tables.items():
        df.write.csv(f"{base}/version=2001-01-01/{name}.txt", header=True)
    g = files.read_gtfs(t.spark, base)
    row = lambda name, k, v, n=F.lit(1), num=F.lit(None): g[name].select(F.lit(name).alias("tbl"), F.col(k).alias("k"), v.alias("v"), n.cast("bigint").alias("n"), num.cast("double").alias("num"))
    text = lambda *cols: F.concat_ws("|", *(F.col(c).cast("string") for c in cols))
    days = sum((F.col(d) for d in ("tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")), F.col("monday"))
    st = row("stop_times", "trip_id", text("stop_sequence", "stop_id", "timepoint"), num=F.col("shape_dist_traveled")).groupBy("tbl", "k", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("num").alias("num"))
    return (row("trips", "trip_id", text("route_id", "service_id", "direction_id", "shape_id")).unionByName(st).unionByName(row("stops", "stop_id", F.col("stop_name"), num=F.col("stop_lat")))
            .unionByName(row("shapes", "shape_id", text("shape_pt_sequence"), num=F.col("shape_pt_lat"))).unionByName(row("calendar", "service_id", text("start_date", "end_date"), days))
            .unionByName(row("calendar_dates", "service_id", F.col("date"), F.col("exception_type"))))


_VERSIONS = """SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) + 20 AS vday,
  'v' || CAST(year(o_orderdate) AS VARCHAR) || '_' || o_orderstatus AS version FROM orders"""


@query("asof_version", f"""WITH v AS (SELECT vday, max(version) AS version FROM ({_VERSIONS}) GROUP BY vday)
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, v.version FROM orders ASOF LEFT JOIN v ON CAST(o_orderdate AS DATE) >= v.vday""")
def asof_version(t):
    v = t.orders.select(F.date_add(F.to_date(F.date_trunc("quarter", "o_orderdate")), 20).alias("vday"),
                        F.concat_ws("_", F.concat(F.lit("v"), F.year("o_orderdate")), "o_orderstatus").alias("version")).distinct()
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return asof_backward(o, v, "day", "vday", ["version"], lambda c: F.trunc(c, "MM"), tie=["version"])


@query("scan_geojson_boundaries", """WITH b AS (SELECT n_name, (n_nationkey % 5) * 400.0::DOUBLE AS x0, (n_nationkey // 5) * 400.0::DOUBLE AS y0 FROM nation),
  e AS (SELECT n_name, x0, y0, unnest([{'a': 0, 'b': 0, 'c': 400, 'd': 0}, {'a': 400, 'b': 0, 'c': 400, 'd': 400}, {'a': 0, 'b': 400, 'c': 400, 'd': 400}, {'a': 0, 'b': 0, 'c': 0, 'd': 400}]) AS e FROM b)
  SELECT 'tract' AS geo_type, n_name AS geo_id, CAST(0 AS INTEGER) AS ring, x0 + e.a AS x1, y0 + e.b AS y1, x0 + e.c AS x2, y0 + e.d AS y2 FROM e""")
def scan_geojson_boundaries(t):
    path = scratch_path(t.spark, "geojson")
    g = P.areas_grid(t)
    pt = lambda a, b: F.array(F.col(a), F.col(b))
    # rings as they come: some closed, some open, some with a vertex twice or a spike that encloses nothing
    corners = [pt("x0", "y0"), pt("x1", "y0"), pt("x1", "y1"), pt("x0", "y1")]
    kind = F.pmod(F.xxhash64("geo_id"), F.lit(4))
    ring = (F.when(kind == 0, F.array(*corners, corners[0])).when(kind == 1, F.array(*corners)).when(kind == 2, F.array(*corners[:2], *corners[1:], corners[0]))
            .otherwise(F.array(*corners[:3], F.array(F.col("x1") + 50, F.col("y1")), *corners[2:], corners[0])))
    feat = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("geo_id").alias("GEOID")).alias("properties"),
                    F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    # One document per row of the grid and file, as boundary files come in pieces.
    doc = g.groupBy("y0").agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"),
                                                 F.collect_list(feat).alias("features"))).alias("value"))
    doc.repartition("y0").write.partitionBy("y0").text(path)
    return files.read_boundaries(t.spark, path, "tract", "GEOID", project=lambda lon, lat: (lon, lat))


@query("registry_lookup", """SELECT 'zcta' AS geo_type, CAST(s_nationkey AS VARCHAR) AS geo_id, variable, round(sum(estimate), 2) AS estimate, count(*) AS n FROM (
  UNPIVOT (SELECT s_suppkey, s_nationkey, s_acctbal AS balance, CAST(s_suppkey AS DOUBLE) AS ident FROM supplier) ON balance, ident INTO NAME variable VALUE estimate)
  GROUP BY 2, 3""")
def registry_lookup(t):
    from wardstat.operators.joins import by_area
    folder = scratch_path(t.spark, "components")
    s = t.supplier.select("s_nationkey", F.col("s_acctbal").alias("balance"), F.col("s_suppkey").cast("double").alias("ident"))
    long = s.unpivot(["s_nationkey"], ["balance", "ident"], "variable", "estimate")
    comp = by_area(long, {"citywide": F.lit("city"), "zcta": F.col("s_nationkey")}).groupBy("geo_type", "geo_id", "variable").agg(
        F.round(F.sum("estimate"), 2).alias("estimate"), F.count(F.lit(1)).alias("n"))
    comp.write.csv(f"{folder}/current", header=True)
    t.spark.createDataFrame([("current", "2024")], "file string, vintage string").write.csv(f"{folder}/registry.csv", header=True)
    path = files.current_component_file(t.spark, folder)
    c = files.read_csv(t.spark, path, "geo_type string, geo_id string, variable string, estimate double, n bigint")
    return files.components_for(c, "zcta")


@query("scan_official_counts", """SELECT CAST(year(l_shipdate) AS INTEGER) AS figure_id,
  round(sum(l_quantity) + sum(l_extendedprice) + count(*) + sum(l_tax), 2) AS value,
  CASE WHEN year(l_shipdate) < 1998 THEN 'kept ' || CAST(year(l_shipdate) AS VARCHAR) ELSE '' END AS gap_note FROM lineitem GROUP BY year(l_shipdate)""")
def scan_official_counts(t):
    path = scratch_path(t.spark, "bps")
    y = t.lineitem.groupBy(F.year("l_shipdate").alias("y"), "l_returnflag").agg(
        F.round(F.sum("l_quantity"), 2).alias("a"), F.round(F.sum("l_extendedprice"), 2).alias("b"),
        F.count(F.lit(1)).alias("c"), F.round(F.sum("l_tax"), 2).alias("d"))
    y.write.csv(path)                                     # position-named columns, no header
    rows = files.yearly_figure(t.spark.read.csv(path), F.col("_c1").isin("A", "N", "R"), ["_c2", "_c3", "_c4", "_c5"])
    fresh = rows.groupBy(F.col("_c0").cast("int").alias("figure_id")).agg(F.round(F.sum("value"), 2).alias("value"))
    old = fresh.where("figure_id < 1998").select("figure_id", F.concat(F.lit("kept "), "figure_id").alias("gap_note"))
    return files.keep_notes(fresh, old, "figure_id", "gap_note")


@query("epoch_ms_to_ts", "SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, CAST(timezone('America/Chicago', timezone('UTC', ts)) AS DATE) AS local_day FROM events")
def epoch_ms_to_ts(t):
    ts = from_epoch_ms(F.floor(F.unix_micros("ts") / 1000))
    return t.events.select("event_id", ts.alias("ts"), local_day(ts).alias("local_day"))


@query("archive_version_manifest", """SELECT CAST('2024-01-01' AS DATE) + CAST(length(source) AS INTEGER) AS day, sha256(text) AS sha, count(*) AS copies,
  strftime(CAST('2024-01-01' AS DATE) + CAST(length(source) AS INTEGER), '%Y-%m-%d') || '_' || substr(sha256(text), 1, 12) AS version
  FROM documents GROUP BY ALL""")
def archive_version_manifest(t):
    d = t.documents.select("text", F.date_add(day("2024-01-01"), F.length("source")).alias("_day"))
    return files.content_versions(d, F.col("_day"), "text")


def _ticket_metrics(t):
    """A small metrics table: median price of tickets per area."""
    m = metrics.median_days(P.tickets(t).where("exclusion is null and in_city"), P.levels(), day(P.THROUGH))
    return checks.citywide_reference(checks.as_metrics(m, "0.1", day(P.THROUGH), F.lit("2001-07-16 00:00:00").cast("timestamp")))


_KM_TICKETS = [("dw", P.sql_windows("base", "opened")),
               ("tm", "SELECT *, CASE WHEN is_closed THEN bd_to_close ELSE age_bd END AS time, CAST(is_closed AS INTEGER) AS ev FROM dw WHERE close_problem IS NULL"),
               ("lv", P.sql_levels("tm"))] + P.sql_km("lv", "type, geo_type, geo_id, window_start, window_end")


@query("sink_metrics_csv", sql("base", """SELECT a.geo_type, a.geo_id, a.type AS subgroup, a.window_start, a.window_end, a.value, a.ci_low, a.ci_high, a.n, a.suppressed,
  c.value AS citywide_median FROM km a LEFT JOIN km c ON c.geo_type = 'citywide' AND a.type = c.type AND a.window_start = c.window_start""", _KM_TICKETS))
def sink_metrics_csv(t):
    path = scratch_path(t.spark, "metrics")
    m = _ticket_metrics(t).select(*checks.METRIC_COLUMNS)
    sinks.write_metrics(m, path)
    back = sinks.read_metrics(t.spark, path)
    return back.select("geo_type", "geo_id", "subgroup", "window_start", "window_end", "value", "ci_low", "ci_high", "n",
                       "suppressed", "citywide_median")


@query("sink_points_geojson", """SELECT c_custkey AS id, c_mktsegment AS kind, round(-90.0 + ((c_custkey * 7919) % 1999) / 20000.0, 6) AS lon,
  round(35.0 + ((c_custkey * 104729) % 2003) / 20000.0, 6) AS lat, 'source_point' AS match_quality FROM customer WHERE c_acctbal >= 0""")
def sink_points_geojson(t):
    path = scratch_path(t.spark, "points")
    x, y = P.hashed_xy(F.col("c_custkey"))
    lon, lat = P.lon_lat(x, y)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"),
                          F.when(F.col("c_acctbal") >= 0, lon).alias("lon"), lat.alias("lat"), F.lit("source_point").alias("match_quality"))
    sinks.points_geojson(c, ["id", "kind"]).write.text(path)
    back = t.spark.read.schema("geometry struct<coordinates array<double>>, properties struct<id bigint, kind string, match_quality string>").json(path)
    return back.select("properties.*", F.col("geometry.coordinates")[0].alias("lon"), F.col("geometry.coordinates")[1].alias("lat"))


@query("sink_json_shards", sql("pl", """SELECT nation, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS keys,
  bool_and(true) AS ordered FROM orders JOIN pl ON o_custkey = custkey GROUP BY nation"""))
def sink_json_shards(t):
    path = scratch_path(t.spark, "shards")
    r = t.orders.join(P.places(t), F.col("o_custkey") == F.col("custkey")).select(
        "nation", F.to_date("o_orderdate").alias("opened"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("type"))
    sinks.shard_documents(r, "nation", ["opened", "id"], ["opened", "id", "type"], per_file=500).write.partitionBy("nation").json(path)
    back = t.spark.read.schema("nation string, part int, n bigint, document string").json(path).select(
        "nation", F.from_json("document", "opened array<date>, id array<bigint>, type array<string>").alias("d"))
    in_order = F.col("d.opened") == F.array_sort("d.opened")
    return back.groupBy("nation").agg(
        F.sum(F.size("d.id")).cast("bigint").alias("n"), F.sum(F.aggregate("d.id", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("key_sum"),
        F.sum(F.size(F.array_distinct("d.id"))).cast("bigint").alias("keys"), F.min(in_order).alias("ordered"))


@query("sink_validation_report", """SELECT 'fail' AS status, CAST(4 AS BIGINT) AS checks_run, CAST(1 AS BIGINT) AS failed, count(*) AS rows,
  count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) > 0 AS has_unknown FROM orders""")
def sink_validation_report(t):
    path = scratch_path(t.spark, "report")
    o = t.orders
    c = checks.collect_checks([
        checks.min_rows(o, 100), checks.unique_ids(o, "o_orderkey"),
        checks.value_ranges(o, {"price is not negative": F.col("o_totalprice") < 0}),
        checks.schema_checks(o.select("o_orderstatus"), {"o_orderstatus": {"allowed": ["F", "O"]}}).where("name like 'allowed%'")])
    sinks.report_document(c).write.text(path)
    doc = t.spark.read.text(path).select(F.from_json("value", "status string, checks_run bigint, checks array<struct<name string, passed boolean, detail string>>").alias("d"))
    bad = F.filter("d.checks", lambda x: ~x.passed)
    rows = F.filter("d.checks", lambda x: x["name"] == "minimum row count")[0]["detail"].cast("bigint")
    return doc.select("d.status", "d.checks_run", F.size(bad).cast("bigint").alias("failed"), rows.alias("rows"),
                      F.exists(bad, lambda x: x["name"] == "allowed values: o_orderstatus").alias("has_unknown"))


@query("sink_results_tables", sql("base", """SELECT nation AS geo_id, sum(CASE WHEN opened > DATE '2000-07-15' THEN 1 ELSE 0 END)::BIGINT AS n_recent,
  count(*) AS n_all, round(avg(price), 2) AS price FROM base GROUP BY nation"""))
def sink_results_tables(t):
    path = scratch_path(t.spark, "results")
    b = P.tickets(t).where("exclusion is null and in_city")
    recent = b.where(F.col("opened") > day("2000-07-15")).groupBy(F.col("nation").alias("geo_id")).agg(F.count(F.lit(1)).alias("n_recent"))
    whole = b.groupBy(F.col("nation").alias("geo_id")).agg(F.count(F.lit(1)).alias("n_all"), F.round(F.avg("price"), 2).alias("price"))
    sinks.write_tables({"recent": recent, "whole": whole}, path)
    read = lambda n, s: files.read_csv(t.spark, f"{path}/{n}", s)
    wide = read("whole", "geo_id string, n_all bigint, price double").join(read("recent", "geo_id string, n_recent bigint"), "geo_id", "left")
    return wide.fillna({"n_recent": 0})
