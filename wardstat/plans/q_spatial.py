"""Spatial and spatio-temporal joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardstat.functions import geo
from wardstat.operators import aggregates, polygons, spatial, tracks
from wardstat.plans import proxies as P
from wardstat.plans.proxies import rnd, sql
from wardstat.plans.registry import query
from wardstat.session import attach


def customer_points(t):
    x, y = P.hashed_xy(F.col("c_custkey"))
    return t.customer.select(F.col("c_custkey").alias("id"), x.alias("x"), y.alias("y"), F.col("c_mktsegment").alias("g"), "c_acctbal", "c_nationkey")


P.cte("cp", """SELECT c_custkey AS id, CAST((c_custkey * 7919) % 1999 AS DOUBLE) AS x, CAST((c_custkey * 104729) % 2003 AS DOUBLE) AS y, c_mktsegment AS g, c_acctbal, c_nationkey FROM customer""")
P.cte("grid", "SELECT n_name AS geo_id, (n_nationkey % 5) * 400.0 AS x0, (n_nationkey // 5) * 400.0 AS y0, n_nationkey, n_regionkey FROM nation")


@query("project_lcc", """WITH c AS (SELECT 6378137.0::DOUBLE AS a, sqrt(2 * (1/298.257222101::DOUBLE) - (1/298.257222101::DOUBLE) * (1/298.257222101::DOUBLE)) AS e, radians(36 + 25/60.0::DOUBLE) AS p1, radians(35.25) AS p2, radians(34 + 20/60.0::DOUBLE) AS p0),
  m AS (SELECT *, cos(p1)/sqrt(1-(e*sin(p1))**2) AS m1, cos(p2)/sqrt(1-(e*sin(p2))**2) AS m2, tan(pi()/4-p1/2)/pow((1-e*sin(p1))/(1+e*sin(p1)), e/2) AS t1,
    tan(pi()/4-p2/2)/pow((1-e*sin(p2))/(1+e*sin(p2)), e/2) AS t2, tan(pi()/4-p0/2)/pow((1-e*sin(p0))/(1+e*sin(p0)), e/2) AS t0 FROM c),
  n AS (SELECT *, (ln(m1)-ln(m2))/(ln(t1)-ln(t2)) AS nn FROM m), f AS (SELECT *, m1/(nn*pow(t1, nn)) AS ff FROM n),
  p AS (SELECT c_custkey, -90.0 + ((c_custkey*7919)%1999)/20000.0 AS lon, 35.0 + ((c_custkey*104729)%2003)/20000.0 AS lat FROM customer),
  q AS (SELECT p.*, f.*, a*ff*pow(tan(pi()/4-radians(lat)/2)/pow((1-e*sin(radians(lat)))/(1+e*sin(radians(lat))), e/2), nn) AS rho FROM p, f)
  SELECT c_custkey, round(600000 + rho*sin(nn*(radians(lon)-radians(-86.0))), 4) AS x_m, round(a*ff*pow(t0, nn) - rho*cos(nn*(radians(lon)-radians(-86.0))), 4) AS y_m FROM q""")
def project_lcc(t):
    lon, lat = P.lon_lat(*P.hashed_xy(F.col("c_custkey")))
    x, y = geo.project(lon, lat)
    return t.customer.select("c_custkey", F.round(x, 4).alias("x_m"), F.round(y, 4).alias("y_m"))


@query("points_from_lonlat", "SELECT c_custkey, c_acctbal >= 0 AND c_mktsegment <> 'BUILDING' AND (c_custkey * 104729) % 2003 <> 0 AS located FROM customer")
def points_from_lonlat(t):
    lon = F.when(F.col("c_acctbal") < -500, "west").when(F.col("c_acctbal") >= 0, "-90.1")
    lat = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("0")).otherwise(((F.col("c_custkey") * 104729) % 2003).cast("string"))
    return t.customer.select("c_custkey", geo.located(lon, lat).alias("located"))


P.cte("near", """SELECT p.id, x, y, geo_id, x BETWEEN x0 AND x0 + 400 AND y BETWEEN y0 AND y0 + 400 AS inside FROM cp p JOIN grid
  ON greatest(x0 - x, x - x0 - 400, 0) ** 2 + greatest(y0 - y, y - y0 - 400, 0) ** 2 <= 1""", "cp", "grid")
P.cte("assigned", """SELECT cp.*, CASE WHEN n_near > 1 OR n_in = 0 THEN low_near ELSE low_in END AS zcta, coalesce(n_near > 1 OR (n_in = 0 AND n_near > 0), false) AS zcta_on_boundary
  FROM cp LEFT JOIN (SELECT id, count(*) AS n_near, count(*) FILTER (WHERE inside) AS n_in, min(geo_id) AS low_near, min(geo_id) FILTER (WHERE inside) AS low_in FROM near GROUP BY id) n ON n.id = cp.id""", "near")


def city_edges(t):
    """City outline (a square with a square hole), regions as columns of the grid, nations as squares."""
    g = P.areas_grid(t)
    nat = spatial.rectangles_to_edges(g)
    cols = g.groupBy("x0", "x1").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1")).select(
        F.lit("super_district").alias("geo_type"), F.concat(F.lit("column "), F.floor("x0").cast("string")).alias("geo_id"), "x0", "y0", "x1", "y1")
    box = g.agg(F.min("x0").alias("a"), F.min("y0").alias("b"), F.max("x1").alias("c"), F.max("y1").alias("d"))
    outer = box.select(F.lit("citywide").alias("geo_type"), F.lit("city").alias("geo_id"), F.col("a").alias("x0"), F.col("b").alias("y0"), F.col("c").alias("x1"), F.col("d").alias("y1"))
    hole = box.select(F.lit("citywide").alias("geo_type"), F.lit("city").alias("geo_id"), (F.col("a") + 900).alias("x0"), (F.col("b") + 900).alias("y0"),
                      (F.col("a") + 1100).alias("x1"), (F.col("b") + 1100).alias("y1"))
    return nat.unionByName(spatial.rectangles_to_edges(cols)).unionByName(spatial.rectangles_to_edges(outer)).unionByName(spatial.rectangles_to_edges(hole))


@query("assign_geography", sql("assigned", "SELECT id, zcta, zcta_on_boundary FROM assigned"))
def assign_geography(t):
    e = spatial.rectangles_to_edges(P.areas_grid(t))
    return spatial.assign_geography(customer_points(t), e, ["zcta"]).select("id", "zcta", "zcta_on_boundary")


def tilted(t, radius: float = 1000.5):
    """A square on its corner around the middle of the city, as edges."""
    c = (t.nation.agg(F.count("*").alias("n")).withColumn("m", 200.0 * F.sqrt("n")))
    pts = F.array(*[F.struct((F.col("m") + dx * radius).alias("x"), (F.col("m") + dy * radius).alias("y")) for dx, dy in ((0, -1), (1, 0), (0, 1), (-1, 0), (0, -1))])
    return spatial.ring_edges(c.select(F.lit("tilted").alias("geo_type"), F.lit("core").alias("geo_id"), F.lit(0).alias("ring"), pts.alias("pts")))


@query("point_in_polygon", sql("cp", """SELECT id, x > 0 AND x < 2000 AND y > 0 AND y < 2000 AND NOT (x > 900 AND x < 1100 AND y > 900 AND y < 1100)
  OR ((x = 0 OR x = 2000) AND y <= 2000) OR ((y = 0 OR y = 2000) AND x <= 2000) OR ((x = 900 OR x = 1100) AND y BETWEEN 900 AND 1100) OR ((y = 900 OR y = 1100) AND x BETWEEN 900 AND 1100) AS inside,
  abs(x - 1000) + abs(y - 1000) < 1000.5 AS in_core FROM cp"""))
def point_in_polygon(t):
    rel = polygons.point_relations(customer_points(t), city_edges(t).where("geo_type = 'citywide'").unionByName(tilted(t))).where("inside")
    flags = rel.groupBy("x", "y").agg(F.bool_or(F.col("geo_type") == "citywide").alias("inside"), F.bool_or(F.col("geo_type") == "tilted").alias("in_core"))
    return customer_points(t).join(flags, ["x", "y"], "left").select("id", F.coalesce("inside", F.lit(False)).alias("inside"), F.coalesce("in_core", F.lit(False)).alias("in_core"))


@query("attach_geographies", sql("assigned", f"""WITH a AS ({P.sql_hex('assigned', 174.0, 'h9', 'h9')}),
  s AS (SELECT n_name, 'hood ' || r_name AS hood FROM nation JOIN region ON n_regionkey = r_regionkey),
  hole AS (SELECT id, x BETWEEN 0 AND 2001 AND y BETWEEN 0 AND 2001 AND NOT (x > 901 AND x < 1099 AND y > 901 AND y < 1099) AS in_city FROM cp)
  SELECT a.id, zcta, CASE WHEN y > 2001 OR x > 2001 THEN NULL WHEN x <= 1 THEN 'column 0' WHEN x <= 401 AND x >= 399 THEN 'column 0' WHEN x BETWEEN 799 AND 801 THEN 'column 400' WHEN x BETWEEN 1199 AND 1201 THEN 'column 1200'
    WHEN x BETWEEN 1599 AND 1601 THEN 'column 1200' ELSE 'column ' || CAST(CAST(floor(x / 400) * 400 AS INTEGER) AS VARCHAR) END AS super_district,
  in_city, s.hood AS reference_neighborhood, h9 FROM a JOIN hole ON hole.id = a.id LEFT JOIN s ON s.n_name = a.zcta""").replace("\nWITH a AS", ",\na AS", 1))
def attach_geographies(t):
    p = spatial.assign_geography(customer_points(t), city_edges(t), ["citywide", "super_district", "zcta"])
    hood = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("zcta"), F.concat(F.lit("hood "), "r_name").alias("reference_neighborhood"))
    p = p.join(hood, "zcta", "left").withColumn("h9", geo.hex_cell(F.col("x"), F.col("y"), "h9"))
    return p.select("id", "zcta", "super_district", F.col("citywide").isNotNull().alias("in_city"), "reference_neighborhood", "h9")


@query("invert_index", sql("near", "SELECT id, array_to_string(list_sort(list(DISTINCT geo_id)), ',') AS areas FROM near GROUP BY id"))
def invert_index(t):
    pts = customer_points(t)
    rel = polygons.point_relations(pts, spatial.rectangles_to_edges(P.areas_grid(t)))
    listed = pts.join(rel, ["x", "y"]).select("geo_id", "id")
    return listed.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("geo_id")), ",").alias("areas"))     # few areas per point


@query("assignment_summary", sql("assigned", """SELECT 'zcta' AS geo_type, count(*) AS total, count(*) FILTER (WHERE c_acctbal < 0) AS unlocated,
  count(*) FILTER (WHERE c_acctbal >= 0 AND zcta IS NULL) AS unassigned, count(*) FILTER (WHERE zcta_on_boundary AND c_acctbal >= 0) AS on_boundary FROM assigned"""))
def assignment_summary(t):
    ok = F.col("c_acctbal") >= 0
    pts = customer_points(t).withColumn("x", F.when(ok, F.col("x"))).withColumn("y", F.when(ok, F.col("y")))
    p = spatial.assign_geography(pts, spatial.rectangles_to_edges(P.areas_grid(t)), ["zcta"])
    return spatial.assignment_summary(p, "zcta", F.col("x").isNotNull())


_DAY = "CAST(o_orderdate AS DATE) - DATE '1990-01-01'"


def order_points(t):
    x, y = P.hashed_xy(F.col("o_orderkey"))
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("type"), x.alias("x"), y.alias("y"),
                           F.date_diff(F.to_date("o_orderdate"), F.lit("1990-01-01").cast("date")).cast("double").alias("t"))


P.cte("op", f"""SELECT o_orderkey AS id, o_orderpriority AS type, CAST((o_orderkey * 7919) % 1999 AS DOUBLE) AS x, CAST((o_orderkey * 104729) % 2003 AS DOUBLE) AS y, CAST({_DAY} AS DOUBLE) AS t FROM orders""")


@query("grid_pairs", sql("op", """SELECT a.id AS a_id, b.id AS b_id, round(sqrt((a.x-b.x)**2 + (a.y-b.y)**2), 6) AS dist, b.t - a.t AS lag FROM op a JOIN op b ON a.type = b.type AND b.t - a.t > 0 AND b.t - a.t <= 20
  AND (a.x-b.x)**2 + (a.y-b.y)**2 <= 10000"""))
def grid_pairs(t):
    p = order_points(t).withColumnRenamed("type", "g")
    return spatial.grid_pairs(p, p, 100, lag=(0, 20)).withColumn("dist", geo.round_distance(F.col("dist"), 6))


@query("within_radius", sql("op", """SELECT a.type, CAST(25 AS INTEGER) AS radius, count(*) FILTER (WHERE d <= 625) AS n, min(l) FILTER (WHERE d <= 625) AS min_lag FROM (SELECT a.type, (a.x-b.x)**2 + (a.y-b.y)**2 AS d, b.t - a.t AS l FROM op a JOIN op b ON a.type = b.type AND b.t - a.t > 0 AND b.t - a.t <= 20
  AND (a.x-b.x)**2 + (a.y-b.y)**2 <= 10000) a GROUP BY 1 UNION ALL SELECT a.type, 100, count(*), min(l) FROM (SELECT a.type, b.t - a.t AS l FROM op a JOIN op b ON a.type = b.type AND b.t - a.t > 0 AND b.t - a.t <= 20
  AND (a.x-b.x)**2 + (a.y-b.y)**2 <= 10000) a GROUP BY 1"""))
def within_radius(t):
    p = order_points(t).withColumnRenamed("type", "g")
    # a place brings the types of its id, and how often each is there, so that no pair is looked up
    kinds = p.groupBy("id", F.col("g").alias("type")).agg(F.count(F.lit(1)).alias("times"))
    a = p.join(kinds, "id").withColumn("id", F.struct("type", "times"))
    pairs = spatial.grid_pairs(a, p, 100, lag=(0, 20)).select("a_id.*", "dist", "lag")
    one = pairs.groupBy("type").agg(*[c for r in (25, 100) for c in (F.coalesce(F.sum(F.when(F.col("dist") <= r, F.col("times"))), F.lit(0)).alias(f"n{r}"), F.min(F.when(F.col("dist") <= r, F.col("lag"))).alias(f"l{r}"))])
    return one.select("type", F.inline(F.array(*[F.struct(F.lit(r).alias("radius"), F.col(f"n{r}").alias("n"), F.col(f"l{r}").alias("min_lag")) for r in (25, 100)])))


@query("near_duplicates", sql("op", "SELECT id, duplicate_of FROM dd", P.sql_dedupe("op", 50, 7)))
def near_duplicates(t):
    return spatial.near_duplicates(order_points(t), 50, 7)


@query("h3_cell", sql("cp", "SELECT id, h8, h9 FROM h2", [("h1", P.sql_hex("cp", 461.0, "h8", "h8")), ("h2", P.sql_hex("h1", 174.0, "h9", "h9"))]))
def h3_cell(t):
    return customer_points(t).select("id", geo.hex_cell(F.col("x"), F.col("y"), "h8").alias("h8"), geo.hex_cell(F.col("x"), F.col("y"), "h9").alias("h9"))


@query("hex_disk_pairs", sql("cp", f"SELECT DISTINCT h9 AS target, unnest({P.sql_disk('h9')}) AS member FROM h1", [("h1", P.sql_hex("cp", 174.0, "h9", "h9"))]))
def hex_disk_pairs(t):
    cells = customer_points(t).select(geo.hex_cell(F.col("x"), F.col("y"), "h9").alias("target")).distinct()
    return cells.select("target", F.explode(geo.hex_disk(F.col("target"))).alias("member"))


@query("hex_parent", sql("cp", "SELECT DISTINCT h9 AS cell, h6 AS parent FROM h3", [
    ("h1", P.sql_hex("cp", 174.0, "h9", "h9")),
    ("h2", "SELECT DISTINCT h9, 174.0 * sqrt(3) * (CAST(split_part(h9, ':', 2) AS BIGINT) + CAST(split_part(h9, ':', 3) AS BIGINT) / 2.0) AS x, 174.0 * 1.5 * CAST(split_part(h9, ':', 3) AS BIGINT) AS y FROM h1"),
    ("h3", P.sql_hex("h2", 3230.0, "h6", "h6"))]))
def hex_parent(t):
    cells = customer_points(t).select(geo.hex_cell(F.col("x"), F.col("y"), "h9").alias("cell")).distinct()
    return cells.select("cell", geo.hex_parent(F.col("cell"), "h9", "h6").alias("parent"))


@query("neighborhood_map", "SELECT c_custkey, r_name AS neighborhood FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'")
def neighborhood_map(t):
    names = t.nation.join(t.region.where("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("neighborhood"))
    return t.customer.join(names, "c_nationkey", "left").select("c_custkey", "neighborhood")


def _service_areas(t):
    """One box per region of the world, off every grid and over several nations' squares."""
    k = F.col("r_regionkey")
    return t.region.select(F.lit("service").alias("geo_type"), F.col("r_name").alias("geo_id"), (k * 300.0 + 103.37).alias("x0"), (k * 250.0 + 51.93).alias("y0"), (k * 300.0 + 897.11).alias("x1"), (k * 250.0 + 648.59).alias("y1"))


@query("area_overlap_shares", sql("grid", """SELECT r_name AS area, count(*) AS areas, round(max(share), 6) AS largest, round(sum(share), 6) AS covered, string_agg(geo_id || ' ' || CAST(CAST(round(100 * share) AS INTEGER) AS VARCHAR) || '%', '; ' ORDER BY share DESC, geo_id) AS shares FROM (
  SELECT r_name, geo_id, greatest(0, least(ax1, x0 + 400) - greatest(ax0, x0)) * greatest(0, least(ay1, y0 + 400) - greatest(ay0, y0)) / ((ax1 - ax0) * (ay1 - ay0)) AS share
  FROM (SELECT r_name, r_regionkey * 300.0 + 103.37 AS ax0, r_regionkey * 250.0 + 51.93 AS ay0, r_regionkey * 300.0 + 897.11 AS ax1, r_regionkey * 250.0 + 648.59 AS ay1 FROM region), grid) WHERE share >= 0.02 GROUP BY 1"""))
def area_overlap_shares(t):
    s = polygons.overlap_areas(spatial.rectangles_to_edges(_service_areas(t)), spatial.rectangles_to_edges(P.areas_grid(t))).where("share >= 0.02")
    item = F.concat("b_id", F.lit(" "), F.round(100 * F.col("share")).cast("int").cast("string"), F.lit("%"))
    return s.groupBy(F.col("a_id").alias("area")).agg(F.count(F.lit(1)).alias("areas"), F.round(F.max("share"), 6).alias("largest"), F.round(F.sum("share"), 6).alias("covered"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.round("share", 9)).alias("k"), "b_id", item.alias("t")))), lambda r: r.t), "; ").alias("shares"))


@query("clip_areas_to_city", sql("grid", """SELECT geo_id, round((400 * 400 - greatest(0, least(1100, x0 + 400) - greatest(900, x0)) * greatest(0, least(1100, y0 + 400) - greatest(900, y0))) / 1e6, 6) AS area_km2, round(coalesce(core, 0) / 1e6, 6) AS core_km2
  FROM grid LEFT JOIN (SELECT geo_id, sum((v + lead_v) / 2 * (lead_x - x)) AS core FROM (
    SELECT geo_id, x, v, lead(x) OVER w AS lead_x, lead(v) OVER w AS lead_v FROM (
      SELECT DISTINCT geo_id, x, greatest(0, least(y0 + 400, 1000 + (1000.5 - abs(x - 1000))) - greatest(y0, 1000 - (1000.5 - abs(x - 1000)))) AS v FROM (
        SELECT geo_id, y0, unnest(list_transform([x0, x0 + 400, 1000, 1000 - (1000.5 - (y0 - 600)), 1000 + (1000.5 - (y0 - 600)), 1000 - (1000.5 - (1000 - y0)), 1000 + (1000.5 - (1000 - y0)),
          1000 - (1000.5 - (y0 - 1000)), 1000 + (1000.5 - (y0 - 1000)), 1000 - (1000.5 - (600 - y0)), 1000 + (1000.5 - (600 - y0))], lambda b: least(greatest(b, x0), x0 + 400))) AS x FROM grid))
    WINDOW w AS (PARTITION BY geo_id ORDER BY x)) WHERE lead_x IS NOT NULL GROUP BY geo_id) USING (geo_id)"""))
def clip_areas_to_city(t):
    areas = spatial.rectangles_to_edges(P.areas_grid(t))
    city = polygons.overlap_areas(areas, city_edges(t).where("geo_type = 'citywide'")).select(F.col("a_id").alias("geo_id"), F.col("area").alias("city"))
    core = polygons.overlap_areas(areas, tilted(t)).select(F.col("a_id").alias("geo_id"), F.col("area").alias("core"))
    km2 = lambda c: F.round(F.coalesce(c, F.lit(0.0)) / 1e6, 6).alias(f"{'area' if c == 'city' else c}_km2")
    return city.join(core, "geo_id", "left").select("geo_id", km2("city"), km2("core"))


def supplier_points(t):
    x, y = P.hashed_xy(F.col("s_suppkey") * 31 + 7)
    return t.supplier.select(F.col("s_suppkey").alias("id"), x.alias("x"), y.alias("y"))


@query("nearest_neighbors", """WITH p AS (SELECT s_suppkey AS id, CAST(((s_suppkey*31+7) * 7919) % 1999 AS DOUBLE) AS x, CAST(((s_suppkey*31+7) * 104729) % 2003 AS DOUBLE) AS y FROM supplier)
  SELECT i, j, CAST(rank AS INTEGER) AS rank FROM (SELECT a.id AS i, b.id AS j, row_number() OVER (PARTITION BY a.id ORDER BY (a.x-b.x)**2 + (a.y-b.y)**2, b.id) AS rank FROM p a JOIN p b ON a.id <> b.id) WHERE rank <= 6""")
def nearest_neighbors(t):
    return spatial.nearest_neighbors(supplier_points(t), 6).select("i", "j", F.col("rank").cast("int").alias("rank"))


@query("contiguity_neighbors", sql("grid", """SELECT a.geo_id AS i, b.geo_id AS j FROM grid a JOIN grid b ON a.geo_id <> b.geo_id AND abs(a.x0 - b.x0) <= 400 AND abs(a.y0 - b.y0) <= 400"""))
def contiguity_neighbors(t):
    return spatial.contiguity_with_islands(spatial.rectangles_to_edges(P.areas_grid(t)))


def line_shapes(t):
    """Each part's shape: a bent line whose corners come from the part's own values."""
    k, s = F.col("p_partkey"), F.col("p_size").cast("double")
    pts = F.array(*[F.struct(F.lit(i).alias("seq"), x.alias("x"), y.alias("y"), d.alias("dist")) for i, x, y, d in (
        (1, F.lit(0.0), F.lit(0.0), F.lit(0.0)), (2, 100 + s * 10, F.lit(0.0), 101 + s * 10), (3, 100 + s * 10, 300 + s * 5, 403 + s * 15))])
    return t.part.select(k.alias("shape_id"), F.inline(pts))


@query("project_on_shape", """WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice, 100.0 + p_size * 10 AS a, 300.0 + p_size * 5 AS b, l_quantity * 15.0 AS x, CAST(l_suppkey % 400 AS DOUBLE) AS y FROM lineitem JOIN part ON l_partkey = p_partkey),
  d AS (SELECT *, sqrt((x - least(greatest(x, 0), a))**2 + y*y) AS o1, least(greatest(x, 0), a) AS s1, sqrt((x - a)**2 + (y - least(greatest(y, 0), b))**2) AS o2, a + least(greatest(y, 0), b) AS s2 FROM l)
  SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, round(CASE WHEN (o1, s1) <= (o2, s2) THEN s1 ELSE s2 END, 4) AS along, round(least(o1, o2), 4) AS off FROM d""")
def project_on_shape(t):
    shapes = tracks.shape_arrays(line_shapes(t))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", (F.col("l_quantity") * 15.0).alias("x"), (F.col("l_suppkey") % 400).cast("double").alias("y"))
    j = li.join(shapes, F.col("l_partkey") == F.col("shape_id"))
    p = tracks.shape_projection(F.col("px"), F.col("py"), F.col("cum"), F.col("x"), F.col("y"))
    return j.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.round(p["along"], 4).alias("along"), F.round(p["off"], 4).alias("off"))


def order_tracks(t):
    """Lines of an order as reports along its own straight shape, one per second."""
    r = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .groupBy(F.to_date("o_orderdate").alias("service_date"), F.col("l_orderkey").alias("trip_id"),
                  (F.col("l_linenumber") * 60 + F.col("l_partkey") % 40).alias("t"))
         .agg(F.max("l_quantity").alias("q"), F.max("l_suppkey").alias("s"), F.max("l_linenumber").alias("ln")))
    return r.select("service_date", "trip_id", F.col("trip_id").alias("shape_id"), F.col("t").cast("double").alias("t"),
                    (F.col("ln") * 100 + F.col("q") * 10 - 200).alias("x"), (F.col("s") % 80).cast("double").alias("y"))


def order_shapes(t):
    pts = F.array(F.struct(F.lit(1).alias("seq"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("dist")),
                  F.struct(F.lit(2).alias("seq"), F.lit(1000.0).alias("x"), F.lit(0.0).alias("y"), F.lit(1003.0).alias("dist")))
    return tracks.shape_arrays(t.orders.select(F.col("o_orderkey").alias("shape_id"), F.inline(pts)))


P.cte("trk", """SELECT CAST(o_orderdate AS DATE) AS service_date, l_orderkey AS trip_id, CAST(l_linenumber * 60 + l_partkey % 40 AS DOUBLE) AS t,
  max(l_linenumber) * 100 + max(l_quantity) * 10 - 200 AS x, CAST(max(l_suppkey) % 80 AS DOUBLE) AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""")
P.cte("prog", """SELECT service_date, trip_id, t, CASE WHEN off <= 60 AND a >= coalesce(prev, -1e9) - 300 THEN greatest(a, coalesce(prev, -1e9)) END AS along FROM (
  SELECT *, max(CASE WHEN off <= 60 THEN a END) OVER (PARTITION BY service_date, trip_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM (
  SELECT *, least(greatest(x, 0), 1000) AS a, sqrt((x - least(greatest(x, 0), 1000))**2 + y*y) AS off FROM trk))""", "trk")


@query("trip_progress", sql("prog", "SELECT service_date, trip_id, t, round(along, 6) AS along FROM prog"))
def trip_progress(t):
    return rnd(tracks.trip_progress(order_tracks(t), order_shapes(t)), 6, "along")


@query("geocoder_accuracy", sql("cp", """WITH p AS (SELECT id, x, y, x + (id * 37) % 300 AS gx, y + (id * 53) % 200 AS gy, c_acctbal >= 0 AS found FROM cp),
  a AS (SELECT * FROM (""" + P.sql_hex("p", 174.0, "h9", "tc") + """)), b AS (SELECT * FROM (""" + P.sql_hex("a", 174.0, "h9", "gc", "gx", "gy") + """)),
  d AS (SELECT *, round(sqrt((x-gx)**2 + (y-gy)**2), 1) AS dist FROM b)
  SELECT count(*) AS sample, round(avg(CAST(found AS INTEGER)), 6) AS found, round(quantile_cont(CASE WHEN found THEN dist END, 0.5), 4) AS p50, round(quantile_cont(CASE WHEN found THEN dist END, 0.9), 4) AS p90, round(quantile_cont(CASE WHEN found THEN dist END, 0.95), 4) AS p95,
  round(avg(CAST(found AND dist <= 100 AS INTEGER)), 6) AS within_100, round(avg(CAST(found AND tc = gc AS INTEGER)), 6) AS same_cell, round(avg(CAST(found AND list_contains(""" + P.sql_disk("tc") + """, gc) AS INTEGER)), 6) AS in_disk,
  count(*) FILTER (WHERE NOT found) AS no_result, count(*) FILTER (WHERE found AND dist > 250) AS over_250 FROM d""").replace("\nWITH p AS", ",\np AS", 1))
def geocoder_accuracy(t):
    c = customer_points(t).withColumn("gx", F.col("x") + (F.col("id") * 37) % 300).withColumn("gy", F.col("y") + (F.col("id") * 53) % 200)
    found = F.col("c_acctbal") >= 0
    dx, dy = F.col("x") - F.col("gx"), F.col("y") - F.col("gy")
    c = (c.withColumn("found", found).withColumn("dist", F.when(found, F.round(F.sqrt(dx * dx + dy * dy), 1)))
         .withColumn("tc", geo.hex_cell(F.col("x"), F.col("y"), "h9")).withColumn("gc", geo.hex_cell(F.col("gx"), F.col("gy"), "h9")))
    q = aggregates.quantiles(c, [], "dist", {"p50": 0.5, "p90": 0.9, "p95": 0.95}).drop("n")
    share = lambda cond: F.round(F.avg(F.coalesce(cond, F.lit(False)).cast("int")), 6)
    s = c.agg(F.count(F.lit(1)).alias("sample"), share(F.col("found")).alias("found"), share(F.col("dist") <= 100).alias("within_100"),
              share(F.col("found") & (F.col("tc") == F.col("gc"))).alias("same_cell"),
              share(F.col("found") & F.array_contains(geo.hex_disk(F.col("tc")), F.col("gc"))).alias("in_disk"),
              F.count_if(~F.col("found")).alias("no_result"), F.count_if(F.col("dist") > 250).alias("over_250"))
    return rnd(s.transform(attach, q), 4, "p50", "p90", "p95")
