"""The test tables in the roles of the civic sources, once in Spark and once in SQL.

The tables carry no coordinates or civic fields; each proxy derives them from
whole tables with arithmetic that is exact in both engines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions import geo
from wardstat.operators import normalize
from wardstat.operators.calendar import HOLIDAYS, calendar_dim
from wardstat.plans.registry import Tables

THROUGH, SYSTEM_START, BOX = "2001-07-15", "1995-03-01", (0.0, 0.0, 1980.0, 1980.0)
EVENTS_THROUGH = "2024-01-30"
STATES = {"F": "closed", "P": "closed", "O": "open"}
# The tables start before the city's list does, so the rules start earlier here.
RULES = [(n, r, 1998 if n == "juneteenth" else 1990, None) for n, r, _, _ in HOLIDAYS]
CAL_YEARS = (1994, 2004)


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def rnd(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def calendar(t: Tables) -> DataFrame:
    return calendar_dim(t.spark, RULES, *CAL_YEARS)


def hashed_xy(k: Column) -> tuple[Column, Column]:
    return ((k * 7919) % 1999).cast("double"), ((k * 104729) % 2003).cast("double")


def lon_lat(x: Column, y: Column) -> tuple[Column, Column]:
    return -90.0 + x / 20000.0, 35.0 + y / 20000.0


def places(t: Tables) -> DataFrame:
    """custkey, nation, region."""
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("custkey"), F.col("n_name").alias("nation"), F.col("r_name").alias("region")))


def tickets_raw(t: Tables) -> DataFrame:
    x, y = hashed_xy(F.col("o_orderkey"))
    opened = F.to_date("o_orderdate")
    shift = ((F.col("o_orderkey") * 7919) % 41 - 2).cast("int")
    return (t.orders.join(places(t), F.col("o_custkey") == F.col("custkey")).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("type"), F.col("o_orderstatus").alias("status"),
        opened.alias("opened"), F.when(F.col("o_orderstatus") != "O", F.date_add(opened, shift)).alias("closed"),
        (F.col("o_totalprice") < 5000).alias("city_duplicate"),
        F.when(F.col("o_totalprice") > 250000, "app").alias("app_url"), x.alias("x"), y.alias("y"),
        "custkey", "nation", "region", F.col("o_totalprice").alias("price")))


def tickets(t: Tables) -> DataFrame:
    """Clean requests with areas and cells; no near-duplicate links."""
    d = normalize.request_records(tickets_raw(t), calendar(t), STATES, day(THROUGH), day(SYSTEM_START), BOX)
    return (d.withColumn("in_city", F.col("x").isNotNull()).withColumn("city", F.lit("city"))
            .withColumn("h9", geo.hex_cell(F.col("x"), F.col("y"), "h9"))
            .withColumn("duplicate_of", F.lit(None).cast("bigint")))



def levels() -> dict[str, Column]:
    return {"citywide": F.col("city"), "super_district": F.col("region"), "zcta": F.col("nation")}


TARGETS = [("1-URGENT", 5, 10), ("2-HIGH", 10, 15), ("3-MEDIUM", None, 20), ("4-NOT SPECIFIED", 10, 20)]


def targets(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(TARGETS, "type string, low int, high int")


def population(t: Tables) -> DataFrame:
    """Customers x 40 stand for residents: one row per area of every level."""
    from wardstat.operators.joins import by_area
    p = places(t).withColumn("city", F.lit("city"))
    return by_area(p, levels()).groupBy("geo_type", "geo_id").agg((F.count(F.lit(1)) * 40).alias("population"))


def areas_grid(t: Tables) -> DataFrame:
    """Nations as 400 m squares of a 5 x 5 grid."""
    k = F.col("n_nationkey")
    x0, y0 = (k % 5 * 400).cast("double"), (F.floor(k / 5) * 400).cast("double")
    return t.nation.select(F.lit("zcta").alias("geo_type"), F.col("n_name").alias("geo_id"),
                           x0.alias("x0"), y0.alias("y0"), (x0 + 400).alias("x1"), (y0 + 400).alias("y1"))


# --- the same in SQL --------------------------------------------------------

_EASTER = {1994: "04-03", 1995: "04-16", 1996: "04-07", 1997: "03-30", 1998: "04-12", 1999: "04-04", 2000: "04-23",
           2001: "04-15", 2002: "03-31", 2003: "04-20", 2004: "04-11"}

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


def sql(needs: str, body: str, extra: list[tuple[str, str]] = ()) -> str:
    """Body preceded by the named CTEs, their own needs first, then the extra ones."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for m in CTES[n][0]:
            visit(m)
        order.append(n)
    for n in needs.split():
        visit(n)
    steps = [(n, CTES[n][1]) for n in order] + list(extra)
    # each step is computed once, however often it is named; one that names itself recurses and cannot be marked
    parts = [f"{n} AS {'' if re.search(rf'\\b{n}\\b', b) else 'MATERIALIZED '}({b})" for n, b in steps]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


cte("days", "SELECT CAST(g AS DATE) AS d FROM generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2004-12-31', INTERVAL 1 DAY) s(g)")
cte("wk", """SELECT d, year(d) AS y, month(d) AS m, isodow(d) AS w,
  row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d) AS nth,
  row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d DESC) AS back FROM days""", "days")
cte("easter", "SELECT CAST(e AS DATE) AS e FROM (VALUES "
    + ", ".join(f"('{y}-{md}')" for y, md in _EASTER.items()) + ") v(e)")
cte("fixed", """SELECT name, make_date(y, m, dd) AS d0 FROM (VALUES ('new_years_day', 1, 1), ('juneteenth', 6, 19),
  ('independence_day', 7, 4), ('veterans_day', 11, 11), ('christmas_day', 12, 25)) f(name, m, dd),
  range(1994, 2005) r(y) WHERE name <> 'juneteenth' OR y >= 1998""")
cte("hol", """SELECT d, min(holiday) AS holiday FROM (
  SELECT 'mlk_birthday' AS holiday, d FROM wk WHERE m = 1 AND w = 1 AND nth = 3
  UNION ALL SELECT 'presidents_day', d FROM wk WHERE m = 2 AND w = 1 AND nth = 3
  UNION ALL SELECT 'memorial_day', d FROM wk WHERE m = 5 AND w = 1 AND back = 1
  UNION ALL SELECT 'labor_day', d FROM wk WHERE m = 9 AND w = 1 AND nth = 1
  UNION ALL SELECT 'thanksgiving', d FROM wk WHERE m = 11 AND w = 4 AND nth = 4
  UNION ALL SELECT 'thanksgiving_holiday', d + 1 FROM wk WHERE m = 11 AND w = 4 AND nth = 4
  UNION ALL SELECT name, CASE isodow(d0) WHEN 6 THEN d0 - 1 WHEN 7 THEN d0 + 1 ELSE d0 END FROM fixed
  UNION ALL SELECT 'christmas_eve', CASE w WHEN 6 THEN d - 1 WHEN 7 THEN d - 2 ELSE d END FROM wk WHERE m = 12 AND day(d) = 24
  UNION ALL SELECT 'good_friday', e - 2 FROM easter
  UNION ALL SELECT 'mlk_memorial', CASE WHEN w = 7 THEN d + 1 WHEN w = 6 AND d - 1 IN (SELECT e - 2 FROM easter) THEN d + 2
    WHEN w = 6 THEN d - 1 ELSE d END FROM wk WHERE m = 4 AND day(d) = 4) GROUP BY d""", "wk", "easter", "fixed")
cte("cal", """SELECT days.d, hol.holiday, isodow(days.d) <= 5 AND hol.d IS NULL AS is_bd,
  CAST(sum(CASE WHEN isodow(days.d) <= 5 AND hol.d IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY days.d) AS BIGINT) AS cum
  FROM days LEFT JOIN hol ON days.d = hol.d""", "days", "hol")
cte("pl", """SELECT c_custkey AS custkey, n_name AS nation, r_name AS region FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
cte("tk_raw", """SELECT o_orderkey AS id, o_orderpriority AS type, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS opened,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST((o_orderkey * 7919) % 41 - 2 AS INTEGER) END AS closed,
  o_totalprice < 5000 AS city_duplicate, CASE WHEN o_totalprice > 250000 THEN 'app' END AS app_url,
  CAST((o_orderkey * 7919) % 1999 AS DOUBLE) AS x, CAST((o_orderkey * 104729) % 2003 AS DOUBLE) AS y,
  custkey, nation, region, o_totalprice AS price FROM orders JOIN pl ON o_custkey = custkey""", "pl")
cte("tk0", f"""SELECT *, CASE status WHEN 'O' THEN 'open' ELSE 'closed' END AS state,
  CASE WHEN status = 'O' THEN NULL WHEN closed < DATE '{SYSTEM_START}' THEN 'sentinel_close_date'
    WHEN closed IS NULL THEN 'missing_close_date' WHEN closed < opened THEN 'close_before_open'
    WHEN closed > DATE '{THROUGH}' + 1 THEN 'close_in_future' END AS close_problem,
  x BETWEEN 0 AND 1980 AND y BETWEEN 0 AND 1980 AS inside FROM tk_raw""", "tk_raw")
cte("tk", f"""SELECT t.id, type, status, state, opened, close_problem, state = 'closed' AND close_problem IS NULL AS is_closed,
  CASE WHEN state = 'closed' AND close_problem IS NULL THEN closed END AS close_date,
  CASE WHEN state = 'closed' AND close_problem IS NULL THEN ce.cum - cs.cum END AS bd_to_close,
  CASE WHEN opened <= DATE '{THROUGH}' THEN (SELECT cum FROM cal WHERE d = DATE '{THROUGH}') - cs.cum END AS age_bd,
  CASE WHEN app_url IS NULL THEN '311' ELSE 'seeclickfix' END AS origin,
  CASE WHEN inside THEN 'source_point' ELSE 'out_of_area' END AS match_quality,
  CASE WHEN inside THEN x END AS x, CASE WHEN inside THEN y END AS y,
  CASE WHEN opened < DATE '{SYSTEM_START}' THEN 'pre_migration' WHEN opened > DATE '{THROUGH}' THEN 'partial_day'
    WHEN city_duplicate THEN 'city_duplicate' END AS exclusion,
  inside AS in_city, custkey, nation, region, price FROM tk0 t JOIN cal cs ON cs.d = opened LEFT JOIN cal ce ON ce.d = closed""",
    "tk0", "cal")
cte("base", "SELECT * FROM tk WHERE exclusion IS NULL AND in_city", "tk")


def sql_levels(src: str, cols: str = "*") -> str:
    """One row per record and area level."""
    return " UNION ALL ".join(f"SELECT {cols}, '{g}' AS geo_type, {c} AS geo_id FROM {src} WHERE {c} IS NOT NULL"
                              for g, c in (("citywide", "'city'"), ("super_district", "region"), ("zcta", "nation")))


def sql_windows(src: str, col: str, days=(90, 365), through: str = THROUGH) -> str:
    return " UNION ALL ".join(
        f"SELECT *, DATE '{through}' - {n - 1} AS window_start, DATE '{through}' AS window_end FROM {src} "
        f"WHERE {col} BETWEEN DATE '{through}' - {n - 1} AND DATE '{through}'" for n in days)


Z = "1.959963984540054"


def w_low(x: str, n: str) -> str:
    x, n = f"CAST({x} AS DOUBLE)", f"CAST({n} AS DOUBLE)"
    return (f"greatest(0, ({x}/{n} + {Z}*{Z}/(2*{n}) - {Z}*sqrt(({x}/{n})*(1-{x}/{n})/{n} + {Z}*{Z}/(4*{n}*{n})))"
            f" / (1 + {Z}*{Z}/{n}))")


def w_high(x: str, n: str) -> str:
    x, n = f"CAST({x} AS DOUBLE)", f"CAST({n} AS DOUBLE)"
    return (f"least(1, ({x}/{n} + {Z}*{Z}/(2*{n}) + {Z}*sqrt(({x}/{n})*(1-{x}/{n})/{n} + {Z}*{Z}/(4*{n}*{n})))"
            f" / (1 + {Z}*{Z}/{n}))")


def sql_proportion(x: str = "x", n: str = "n", floor: int = 30, digits: int = 6) -> str:
    """value, ci_low, ci_high, suppressed columns."""
    def show(e: str) -> str:
        return f"CASE WHEN {n} >= {floor} THEN round({e}, {digits}) END"
    return (f"{show(f'CAST({x} AS DOUBLE)/{n}')} AS value, {show(w_low(x, n))} AS ci_low, "
            f"{show(w_high(x, n))} AS ci_high, {n} < {floor} AS suppressed")


def sql_km(src: str, cells: str, name: str = "km", floor: int = 20) -> list[tuple[str, str]]:
    """CTEs ending in <name>: cells, value, ci_low, ci_high, n, suppressed.

    ``src`` has the cells, time and ev (1 closed, 0 open).
    """
    p = f"PARTITION BY {cells}"
    cross = lambda s: (f"first(CASE WHEN abs({s} - 0.5) < 1.5e-8 AND nxt IS NOT NULL THEN (time + nxt) / 2.0 ELSE time END "  # noqa: E731
                       f"ORDER BY time) FILTER (WHERE {s} <= 0.5 + 1.5e-8)")
    sel = ", ".join(f"z.{c.strip()}" for c in cells.split(","))
    return [
        (f"{name}0", f"SELECT {cells}, time, CAST(sum(ev) AS BIGINT) AS d, count(*) AS a FROM {src} WHERE time IS NOT NULL GROUP BY {cells}, time"),
        (f"{name}1", f"SELECT *, CAST(sum(a) OVER ({p} ORDER BY time DESC) AS DOUBLE) AS r FROM {name}0"),
        (f"{name}2", f"SELECT *, sum(CASE WHEN d = r THEN 0 ELSE ln(1 - d / r) END) OVER ({p} ORDER BY time) AS ls, "
                     f"sum(CASE WHEN d = r THEN 0 ELSE d / (r * (r - d)) END) OVER ({p} ORDER BY time) AS gr, d = r AS gone "
                     f"FROM {name}1 WHERE d > 0"),
        (f"{name}3", f"SELECT *, lead(time) OVER ({p} ORDER BY time) AS nxt, CASE WHEN gone THEN 0 ELSE exp(ls) END AS s, "
                     f"CASE WHEN gone THEN 0 ELSE exp(-exp(ln(-ls) + {Z} * sqrt(gr) / abs(ls))) END AS sl, "
                     f"CASE WHEN gone THEN 0 ELSE exp(-exp(ln(-ls) - {Z} * sqrt(gr) / abs(ls))) END AS sh FROM {name}2 WHERE ls < 0 OR gone"),
        (f"{name}4", f"SELECT {cells}, {cross('s')} AS m, {cross('sl')} AS lo, {cross('sh')} AS hi FROM {name}3 GROUP BY {cells}"),
        (name, f"SELECT {sel}, CASE WHEN n >= {floor} THEN CAST(m AS DOUBLE) END AS value, "
               f"CASE WHEN n >= {floor} AND m IS NOT NULL THEN CAST(lo AS DOUBLE) END AS ci_low, "
               f"CASE WHEN n >= {floor} AND m IS NOT NULL THEN coalesce(CAST(hi AS DOUBLE), CAST('inf' AS DOUBLE)) END AS ci_high, "
               f"n, n < {floor} OR m IS NULL AS suppressed "
               f"FROM (SELECT {cells}, CAST(sum(a) AS BIGINT) AS n FROM {name}0 GROUP BY {cells}) z LEFT JOIN {name}4 q ON "
               + " AND ".join(f"z.{c.strip()} = q.{c.strip()}" for c in cells.split(",")))]


def sql_garwood(counts: str, name: str = "gw") -> list[tuple[str, str]]:
    """CTEs ending in <name>: n, lo, hi - exact Poisson bounds by bisection on the Poisson sums.

    ``counts`` is a relation with column n.
    """
    tail = lambda a, m: f"1 - list_sum(list_transform(range(CAST({a} AS BIGINT)), lambda k: exp(k * ln({m}) - {m} - lgamma(k + 1))))"
    return [
        (f"{name}_it", f"""SELECT n, 0 AS it, 0.0::DOUBLE AS l0, n + 10 * sqrt(n) + 20.0::DOUBLE AS l1, 0.0::DOUBLE AS h0,
  n + 10 * sqrt(n) + 20.0::DOUBLE AS h1 FROM (SELECT DISTINCT n FROM {counts} WHERE n IS NOT NULL)
  UNION ALL SELECT n, it + 1,
    CASE WHEN n > 0 AND {tail('n', '((l0+l1)/2)')} < 0.025 THEN (l0+l1)/2 ELSE l0 END,
    CASE WHEN n > 0 AND {tail('n', '((l0+l1)/2)')} < 0.025 THEN l1 ELSE (l0+l1)/2 END,
    CASE WHEN {tail('n+1', '((h0+h1)/2)')} < 0.975 THEN (h0+h1)/2 ELSE h0 END,
    CASE WHEN {tail('n+1', '((h0+h1)/2)')} < 0.975 THEN h1 ELSE (h0+h1)/2 END
  FROM {name}_it WHERE it < 48"""),
        (name, f"SELECT n, CASE WHEN n = 0 THEN 0 ELSE (l0 + l1) / 2 END AS lo, (h0 + h1) / 2 AS hi FROM {name}_it WHERE it = 48")]


def sql_median(src: str, cells: str, value: str, floor: int = 20, digits: int = 6) -> str:
    """cells, value, ci_low, ci_high, n, suppressed: median and its two bounding order statistics."""
    show = lambda e: f"CASE WHEN n >= {floor} THEN round({e}, {digits}) END"
    return (f"SELECT {cells}, {show('med')} AS value, "
            f"{show('vals[greatest(1, CAST(ceil(n/2.0 - ' + Z + '*sqrt(CAST(n AS DOUBLE))/2) AS BIGINT))]')} AS ci_low, "
            f"{show('vals[least(n, CAST(ceil(n/2.0 + ' + Z + '*sqrt(CAST(n AS DOUBLE))/2) AS BIGINT))]')} AS ci_high, n, n < {floor} AS suppressed "
            f"FROM (SELECT {cells}, median({value}) AS med, list({value} ORDER BY {value}) AS vals, count({value}) AS n "
            f"FROM {src} WHERE {value} IS NOT NULL GROUP BY {cells})")


HEX_SQL = {  # axial coordinates by cube rounding, edge length e
    "q": "(sqrt(3)/3 * {x} - {y}/3) / {e}", "r": "(2.0/3 * {y}) / {e}"}


def sql_hex(src: str, edge: float, level: str, col: str, x: str = "x", y: str = "y") -> str:
    """src plus a hexagon id column (null without a place)."""
    q, r = (HEX_SQL[k].format(x=x, y=y, e=edge) for k in "qr")
    return (f"SELECT * EXCLUDE (hq, hr, hs, fq, fr, fs), CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN '{level}:' || CAST(CAST("
            f"CASE WHEN abs(fq-hq) > abs(fr-hr) AND abs(fq-hq) > abs(fs-hs) THEN -fr-fs ELSE fq END AS BIGINT) AS VARCHAR) || ':' || "
            f"CAST(CAST(CASE WHEN abs(fq-hq) > abs(fr-hr) AND abs(fq-hq) > abs(fs-hs) THEN fr "
            f"WHEN abs(fr-hr) > abs(fs-hs) THEN -fq-fs ELSE fr END AS BIGINT) AS VARCHAR) END AS {col} "
            f"FROM (SELECT *, floor(hq+0.5) AS fq, floor(hr+0.5) AS fr, floor(hs+0.5) AS fs FROM "
            f"(SELECT *, {q} AS hq, {r} AS hr, -({q}) - ({r}) AS hs FROM {src}))")


def sql_disk(cell: str) -> str:
    """List of a cell and its six neighbours."""
    p = f"string_split({cell}, ':')"
    steps = ((0, 0), (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1))
    return "[" + ", ".join(f"{p}[1] || ':' || CAST(CAST({p}[2] AS BIGINT) + {a} AS VARCHAR) || ':' || CAST(CAST({p}[3] AS BIGINT) + {b} AS VARCHAR)"
                           for a, b in steps) + "]"


def sql_dedupe(src: str, meters: float, days: float, name: str = "dd") -> list[tuple[str, str]]:
    """CTEs ending in <name>: id, duplicate_of - the greedy rule, decided round by round until nothing is open.

    ``src``: id, type, x, y, t (days).
    """
    return [
        (f"{name}_pairs", f"SELECT a.id AS i, a.t AS ti, b.id AS j FROM {src} a JOIN {src} b ON a.type = b.type "
         f"AND (a.t < b.t OR (a.t = b.t AND a.id < b.id)) AND b.t - a.t <= {days} "
         f"AND (a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) <= {meters * meters}"),
        (f"{name}_r", f"""SELECT id, CASE WHEN id IN (SELECT j FROM {name}_pairs) THEN 'U' ELSE 'P' END AS st, 0 AS it
  FROM (SELECT i AS id FROM {name}_pairs UNION SELECT j FROM {name}_pairs)
  UNION ALL SELECT s.id, CASE WHEN s.st <> 'U' THEN s.st WHEN a.hp THEN 'D' WHEN NOT a.hu THEN 'P' ELSE 'U' END, s.it + 1
  FROM {name}_r s LEFT JOIN (SELECT j, bool_or(st = 'P') AS hp, bool_or(st = 'U') AS hu FROM {name}_pairs JOIN {name}_r ON i = id GROUP BY j) a ON a.j = s.id
  WHERE EXISTS (SELECT 1 FROM {name}_r WHERE st = 'U')"""),
        (f"{name}_p", f"SELECT id FROM {name}_r WHERE st = 'P' AND it = (SELECT max(it) FROM {name}_r)"),
        (name, f"SELECT s.id, d.p AS duplicate_of FROM {src} s LEFT JOIN (SELECT j, arg_min(i, (ti, i)) AS p FROM {name}_pairs "
               f"JOIN {name}_p ON i = id GROUP BY j) d ON d.j = s.id")]
