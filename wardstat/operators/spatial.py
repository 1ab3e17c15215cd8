"""Spatial joins built from explicit grid keys, so Spark always sees an equi-join."""

from __future__ import annotations

import itertools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.functions import geo
from wardstat.operators.polygons import point_relations
from wardstat.session import scratch_path, small_side, stored


def _steps(k: int) -> list[tuple[int, int]]:
    return [(dx, dy) for dx in range(-k, k + 1) for dy in range(-k, k + 1)]


def _cell_key(*parts: Column) -> Column:
    return F.xxhash64(*parts)


#: Radii along the edge of a cell and lags in its stretch of time; squares along a radius and in a lag; rows packed in one at most.
CELL_RADII, CELL_LAGS, SQUARES, PACKED_ROWS = 4, 4, 2, 512


def grid_pairs(a: DataFrame, b: DataFrame, meters: float, *, group: bool = True,
               lag: tuple[float, float] | None = None) -> DataFrame:
    """Pairs (a_id, b_id, dist[, lag]) within ``meters`` and, if given, lag_min < tb - ta <= lag_max.

    Both frames have id, x, y and optionally g (same group only) and t. Rows are
    sent to cells of four radii and four lags: an a row to each cell that its
    reach touches (2.8 on average with a lag), a b row to its own, so every true
    pair meets exactly once. In a cell, rows of one square (half a radius, half
    a lag) are packed into one, squares within reach of each other are joined,
    and their rows compared. The cell is one hashed number; an a row's copies
    differ in it, so where two cells share one, more squares are compared but no
    pair comes twice. The output holds true pairs only, but many records at one
    spot still pair up with each other, so callers that need less than the pairs
    (a minimum, a flag) collapse equal places first.
    """
    names = ["id", "x", "y"] + (["t"] if lag else [])
    keys = ["_cell"] + (["g"] if group else [])
    square = ["_sx", "_sy"] + (["_st"] if lag else [])
    sizes = [CELL_RADII, CELL_RADII] + ([CELL_LAGS] if lag else [])
    parts = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def places(since: float, per: int) -> list[Column]:
        out = [geo.cell_index(F.col(c), meters / per) for c in ("x", "y")]
        return out + ([F.floor((F.col("t") + since) / ((lag[1] - lag[0]) / per)).cast("bigint")] if lag else [])

    def packed(df: DataFrame, since: float, reach: list[tuple[int, ...]]) -> DataFrame:
        here = [f"_at{i}" for i in range(len(sizes))]
        out = df.select(*names, *keys[1:], *[c.alias(h) for h, c in zip(here, places(since, 1))]).dropna(subset=here)    # a hash passes over nulls
        cells = [_cell_key(*[F.floor((F.col(h) + d) / n).cast("bigint") for h, d, n in zip(here, step, sizes)]) for step in itertools.product(*reach)]
        out = out.select(*names, *keys[1:], (F.explode(F.array_distinct(F.array(*cells))) if len(cells) > 1 else cells[0]).alias("_cell"))
        # dealt by number, not by size: the pairs of a cell are far more than its rows
        out = out.repartition(parts, *keys).select(*keys, *[c.alias(s) for s, c in zip(square, places(since, SQUARES))], F.struct(*names).alias("_row"))
        out = out.sortWithinPartitions(*keys, *square).withColumn("_part", F.floor(F.monotonically_increasing_id() / PACKED_ROWS))
        return out.groupBy(*keys, *square, "_part").agg(F.collect_list("_row").alias("_rows"))

    l = packed(a, lag[0] if lag else 0, [(-1, 1), (-1, 1), *([(0, 1)] if lag else [])]).alias("l")
    r = packed(b, 0, [(0,)] * len(sizes)).alias("r")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    away = [F.greatest(F.abs(F.col(f"l.{c}") - F.col(f"r.{c}")) - 1, F.lit(0)) for c in square[:2]]
    cond = cond & (away[0] * away[0] + away[1] * away[1] <= SQUARES**2)
    if lag:
        cond = cond & (F.col("r._st") - F.col("l._st")).between(0, SQUARES)
    # neither side is known to be small: files say little of rows in memory
    met = l.join(r.hint("merge"), cond, "inner").select(F.explode("l._rows").alias("l"), F.col("r._rows").alias("_rows"))
    met = met.select("l", F.explode("_rows").alias("r"))
    dx, dy = F.col("l.x") - F.col("r.x"), F.col("l.y") - F.col("r.y")
    near = dx * dx + dy * dy <= float(meters) ** 2
    cols = [F.col("l.id").alias("a_id"), F.col("r.id").alias("b_id"), F.sqrt(dx * dx + dy * dy).alias("dist")]
    if lag:
        gap = F.col("r.t") - F.col("l.t")
        near = (gap > lag[0]) & (gap <= lag[1]) & near
        cols.append(gap.alias("lag"))
    return met.where(near).select(*cols)


# --- near duplicates ------------------------------------------------------

#: Edge of the smallest tile in search radii, how often it may double, and the places and times that one block should hold.
TILE_RADII, DOUBLINGS, BLOCK_ROWS = 2, 20, 400_000


def _tile(c: Column, side: float) -> Column:
    return F.floor(c / side).cast("long")


def _decide_block(meters: float, days: float):
    """Greedy rule for the rows of one block, given the primaries around it: the link of each row, null for primaries."""
    def run(rows: pa.Table, around: pa.Table) -> pa.Table:
        rows = rows.sort_by([("t", "ascending"), ("id", "ascending")])
        held: dict[tuple[int, int], list[tuple]] = {}       # primaries by every cell they can reach, in order

        def put(t, i, x, y):
            cx, cy = math.floor(x / meters), math.floor(y / meters)
            for dx, dy in _steps(1):
                held.setdefault((cx + dx, cy + dy), []).append((t, i, x, y))

        outside = sorted(zip(*(around[c].to_pylist() for c in ("t", "id", "x", "y"))))
        taken, link, near_enough = 0, [], meters * meters
        for t, i, x, y in zip(*(rows[c].to_pylist() for c in ("t", "id", "x", "y"))):
            while taken < len(outside) and outside[taken][:2] < (t, i):
                put(*outside[taken])
                taken += 1
            key, first = (math.floor(x / meters), math.floor(y / meters)), None
            near = held.get(key)
            if near:
                if near[0][0] < t - days:
                    near = held[key] = [p for p in near if p[0] >= t - days]
                for p in near:
                    dx, dy = x - p[2], y - p[3]
                    if dx * dx + dy * dy <= near_enough:
                        first = p
                        break
            link.append(None if first is None else first[1])
            if first is None:
                put(t, i, x, y)
        return rows.append_column("link", pa.array(link, rows.schema.field("id").type))

    return run


def near_duplicates(df: DataFrame, meters: float = 50.0, days: float = 7.0) -> DataFrame:
    """id, duplicate_of: the primary each record duplicates (null for primaries).

    Rule: in time order (ties by id) within a type, a record duplicates the
    earliest earlier *primary* within ``meters`` and ``days``; a duplicate never
    makes another record a duplicate. ``df``: id, type, x, y, t (days); rows
    without a place, time or type are primaries.

    Records of one type, place and time are decided as one. The rest is cut into
    blocks: a type, a tile, and as many windows of ``days`` as hold about
    ``BLOCK_ROWS`` rows. A type's tiles are as large as they can be without one
    window of a tile exceeding that, so most types have a single tile, and tiles shrink to ``TILE_RADII`` radii where
    places are dense. A type's windows form waves, and a wave decides when the one before it is settled: it needs of
    that one only the primaries of its last window, so each row is decided once however far a decision carries in time.
    Types and tiles of a wave decide in parallel; where a type has several tiles, those whose surroundings changed decide
    again, until none has. The greedy result is the only fixed point: the earliest wrong decision gets right in each round.
    """
    spark, side = df.sparkSession, meters * TILE_RADII
    ok = (F.col("type").isNotNull() & F.col("t").isNotNull()
          & F.col("x").isNotNull() & F.col("y").isNotNull())
    place = [F.col("type"), *(F.col(c).cast("double").alias(c) for c in ("t", "x", "y"))]
    heads = df.where(ok).groupBy(*place).agg(F.min("id").alias("id")).withColumns(
        {"gx": _tile(F.col("x"), side), "gy": _tile(F.col("y"), side), "tb": F.floor(F.col("t") / days)})
    heads = stored(heads, scratch_path(spark, "places"))
    block = ["type", "gx", "gy"]
    up = lambda c: F.expr(f"shiftright({c}, level)")
    weeks = heads.groupBy(*block, "tb").agg(F.count("*").alias("n"))
    fits = (weeks.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(DOUBLINGS)))).groupBy("type", "level", "tb", up("gx"), up("gy"))
            .agg(F.sum("n").alias("n")).groupBy("type", "level").agg(F.max("n").alias("n")))
    level = stored(fits.groupBy("type").agg(F.coalesce(F.max(F.when(F.col("n") <= BLOCK_ROWS, F.col("level"))), F.lit(0)).alias("level")),
                   scratch_path(spark, "levels"))
    tiles = weeks.join(small_side(level), "type").select("type", up("gx").alias("gx"), up("gy").alias("gy"), "tb", "n")
    tiles = stored(tiles.groupBy(*block, "tb").agg(F.sum("n").alias("n")), scratch_path(spark, "tiles"))
    # waves of a type: whole windows, until its largest tile is full
    windows = tiles.groupBy("type", "tb").agg(F.max("n").alias("n"))
    in_order = Window.partitionBy("type").orderBy("tb")
    before = F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    windows = windows.withColumn("full", F.floor(before / BLOCK_ROWS)).withColumn("slab", F.dense_rank().over(Window.partitionBy("type").orderBy("full")) - 1)
    windows = stored(windows.select("type", "tb", "slab", F.coalesce(F.lead("slab").over(in_order) > F.col("slab"), F.lit(False)).alias("last")),
                     scratch_path(spark, "waves"))
    own = heads.join(small_side(level), "type").withColumns({"gx": up("gx"), "gy": up("gy")}).join(small_side(windows), ["type", "tb"])
    own = own.select(*block, "slab", "id", "t", "x", "y", "level", "last")
    own = stored(own.repartition("slab", *block).sortWithinPartitions("slab"), scratch_path(spark, "places"))    # a wave reads its own pages
    blocks = stored(tiles.join(small_side(windows), ["type", "tb"]).select("slab", *block).distinct(), scratch_path(spark, "blocks"))
    waves = (blocks.agg(F.max("slab")).first()[0] or 0) + 1
    several = not blocks.select(*block).distinct().groupBy("type").count().where("count > 1").isEmpty()
    kinds = {c: own.schema[c].dataType.simpleString() for c in own.columns if c != "slab"}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + f", link {kinds['id']}"
    decide = _decide_block(float(meters), float(days))

    def reach(primaries: DataFrame, there: DataFrame) -> DataFrame:
        """Primaries at the blocks that they can reach."""
        level_of = lambda c: F.floor(_tile(c, side) / F.pow(F.lit(2.0), F.col("level"))).cast("long")
        ends = [F.array_distinct(F.array(level_of(F.col(c) - meters), level_of(F.col(c)), level_of(F.col(c) + meters))) for c in ("x", "y")]
        near = (primaries.withColumnsRenamed({c: f"own_{c}" for c in ("gx", "gy")})
                .withColumn("gx", F.explode(ends[0])).withColumn("gy", F.explode(ends[1])))
        return near.join(there, block, "left_semi")

    def seal(near: DataFrame) -> DataFrame:
        h = F.xxhash64("id", "t", "x", "y")
        return near.groupBy(*block).agg(F.count("*").alias("n"), F.sum(h % 1_000_000_007).alias("h"), F.sum(h % 998_244_353).alias("g"))

    def decided(rows: DataFrame, near: DataFrame) -> DataFrame:
        return rows.groupBy(*block).cogroup(near.groupBy(*block)).applyInArrow(decide, schema)

    home, point = scratch_path(spark, "decided"), [*block, "id", "t", "x", "y"]
    settled = None
    for wave in range(waves):
        rows, there = own.where(F.col("slab") == wave).drop("slab"), blocks.where(F.col("slab") == wave).drop("slab")
        earlier = (rows.limit(0) if settled is None else reach(settled.where("last and link is null"), there)).select(*point)
        if not several:
            settled = stored(decided(rows, earlier), f"{home}/slab={wave}")
            continue
        earlier = stored(earlier, scratch_path(spark, "earlier"))
        made, seals = stored(decided(rows, earlier), scratch_path(spark, "round")), None
        while True:
            moved = (F.col("gx") != F.col("own_gx")) | (F.col("gy") != F.col("own_gy"))
            near = stored(reach(made.where("link is null"), there).where(moved).select(*point), scratch_path(spark, "around"))
            new = stored(seal(near), scratch_path(spark, "seals"))
            if seals is None:
                todo = new.select(*block)
            else:
                changed = new.alias("a").join(seals.alias("b"), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in block], "full").where(
                    ~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.h").eqNullSafe(F.col("b.h")) & F.col("a.g").eqNullSafe(F.col("b.g"))))
                todo = changed.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in block])
            todo = stored(todo, scratch_path(spark, "todo"))
            if todo.isEmpty():
                break
            seals = new
            again = decided(rows.join(todo, block, "left_semi"), near.unionByName(earlier).join(todo, block, "left_semi"))
            made = stored(made.join(todo, block, "left_anti").unionByName(again), scratch_path(spark, "round"))
        settled = stored(made, f"{home}/slab={wave}")
    made = spark.read.schema(settled.schema).parquet(home)
    found = made.select("type", "t", "x", "y", F.col("id").alias("head"), "link")
    out = df.select("id", *place).join(found, ["type", "t", "x", "y"], "left")
    return out.select("id", F.when(F.col("id") == F.col("head"), F.col("link")).otherwise(F.coalesce("link", "head")).alias("duplicate_of"))


#: Reports of its cell and those around it that a closing should meet in the first stretch of days it looks at.
NEAR_REPORTS = 120


def first_rereport(closed: DataFrame, reports: DataFrame, radii: list[float], max_days: int = 60) -> DataFrame:
    """Days from each closing to the first later report of its type, per radius.

    ``closed``: id, g, x, y, t (closing day number); ``reports``: g, x, y, t
    (opening day number). Closings and reports of one type, place and day are
    interchangeable, so both sides shrink to distinct (type, place, day) before
    the range join and the answer is joined back. The days are searched in
    stretches that double, the first the shorter the denser reports lie; only
    closings still without a report in the smallest radius go on to the next.
    """
    place, names = ["g", "x", "y", "t"], [f"r{int(r)}" for r in radii]
    spark, reach = closed.sparkSession, max(radii)
    todo = stored(closed.select(*place).distinct(), scratch_path(spark, "closings"))
    b = stored(reports.select(*place).distinct(), scratch_path(spark, "reports"))
    # a first stretch of days in which a closing meets about NEAR_REPORTS reports, were they spread evenly over their cells and days
    cells = b.select("g", geo.cell_index(F.col("x"), reach).alias("cx"), geo.cell_index(F.col("y"), reach).alias("cy"))
    n, of = b.count(), cells.groupBy(*cells.columns).count().agg(F.sum(F.pow("count", F.lit(2.0)))).first()[0]
    days = b.agg(F.max("t") - F.min("t")).first()[0]
    met = 9 * (of or 0) / max(n, 1) / max(float(days or 0), 1.0)
    upto, step = 0, min(max_days, max(1, int(NEAR_REPORTS / met) if met else max_days))
    found, home = [], scratch_path(spark, "rereports")
    while True:
        since, upto = upto, min(max_days, upto + step)
        a = todo.select(F.struct(*place).alias("id"), *place)
        pairs = grid_pairs(a, b.withColumn("id", F.lit(0)), reach, lag=(since, upto))
        best = pairs.groupBy("a_id").agg(*[F.min(F.when(F.col("dist") <= r, F.col("lag"))).alias(c) for r, c in zip(radii, names)])
        found.append(stored(best.select("a_id.*", *names), f"{home}/step={len(found)}"))
        if upto >= max_days:
            break
        # the smallest radius is found last; who has it has all
        last = names[radii.index(min(radii))]
        todo = stored(todo.join(found[-1].where(F.col(last).isNotNull()).select(*place), place, "left_anti"), scratch_path(spark, "closings"))
        step *= 2
    best = spark.read.schema(found[0].schema).parquet(home).groupBy(*place).agg(*[F.min(c).alias(c) for c in names])
    return closed.join(best, place, "left")


# --- polygons -------------------------------------------------------------

def rectangles_to_edges(areas: DataFrame) -> DataFrame:
    """geo_type, geo_id, x0, y0, x1, y1 boxes to closed rings of four edges."""
    c = F.array(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y"))
                  for a, b in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0"))])
    return ring_edges(areas.select("geo_type", "geo_id", F.lit(0).alias("ring"), c.alias("pts")))


def ring_edges(rings: DataFrame) -> DataFrame:
    """Vertex arrays (pts of x, y) to one row per edge; zero-length edges are dropped."""
    pair = F.arrays_zip(F.slice("pts", 1, F.size("pts") - 1).alias("a"),
                        F.slice("pts", 2, F.size("pts") - 1).alias("b"))
    return (rings.withColumn("_e", F.explode(pair))
            .select("geo_type", "geo_id", "ring",
                    *[F.col(f"_e.{s}.{v}").cast("double").alias(f"{v}{i}")
                      for s, i in (("a", 1), ("b", 2)) for v in ("x", "y")])
            .where("x1 <> x2 or y1 <> y2"))


def assign_geography(points: DataFrame, edges: DataFrame, geo_types: list[str], tolerance: float = 1.0,
                     cell: float = 100.0) -> DataFrame:
    """Add <geo_type> and <geo_type>_on_boundary for every boundary set in one pass.

    More than one area within the tolerance, or none containing the point but
    one within it: the lowest geo_id of those, flagged. Else the containing area.
    """
    rel = point_relations(points, edges, cell, tolerance)
    aggs = []
    for g in geo_types:
        mine = F.col("geo_type") == g
        n_near, n_in = F.count_if(mine), F.count_if(mine & F.col("inside"))
        low_near = F.min(F.when(mine, F.col("geo_id")))
        low_in = F.min(F.when(mine & F.col("inside"), F.col("geo_id")))
        aggs += [F.when((n_near > 1) | (n_in == 0), low_near).otherwise(low_in).alias(g),
                 ((n_near > 1) | ((n_in == 0) & (n_near > 0))).alias(f"{g}_on_boundary")]
    found = rel.groupBy("x", "y").agg(*aggs)
    out = points.join(found, ["x", "y"], "left")
    return out.fillna({f"{g}_on_boundary": False for g in geo_types})


def assignment_summary(points: DataFrame, geo_type: str, located: Column) -> DataFrame:
    return points.agg(
        F.lit(geo_type).alias("geo_type"), F.count(F.lit(1)).alias("total"),
        F.count_if(~located).alias("unlocated"),
        F.count_if(located & F.col(geo_type).isNull()).alias("unassigned"),
        F.count_if(F.col(f"{geo_type}_on_boundary")).alias("on_boundary"))


# --- neighbours -----------------------------------------------------------

def nearest_neighbors(areas: DataFrame, k: int) -> DataFrame:
    """i, j, rank: the k nearest other areas by representative point (id breaks ties).

    Each point searches its own grid square and rings of squares around it. The
    square is sized so a few rings hold k points; rows still short of k after a
    ring, or whose k-th distance reaches beyond it, go on to a wider one.
    """
    pts = areas.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    box = pts.agg(F.count(F.lit(1)), F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    n, x0, x1, y0, y1 = box
    if n <= 1:
        return pts.select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1).alias("rank")).limit(0)
    span = max(x1 - x0, y1 - y0, 1e-9)
    side = max(math.sqrt(max((x1 - x0) * (y1 - y0), span * span / n) * (k + 1) / n), 1e-9)
    home, step = scratch_path(areas.sparkSession, "nearest"), 0
    pts = todo = stored(pts, f"{home}/points")
    width = side
    while True:
        step += 1
        pairs = grid_pairs(todo, pts, width, group=False).where("a_id <> b_id")
        # Bounded state per point: only the k closest candidates are kept.
        ranked = pairs.withColumn("rank", F.row_number().over(
            Window.partitionBy("a_id").orderBy("dist", "b_id"))).where(F.col("rank") <= k)
        if width > 2 * span:
            settled = ranked
        else:
            enough = ranked.groupBy("a_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
            settled = ranked.join(enough.select("a_id"), "a_id", "left_semi")
        settled = stored(settled.select(F.col("a_id").alias("i"), F.col("b_id").alias("j"), "rank"), f"{home}/settled/step={step}")
        todo = stored(todo.join(settled.select(F.col("i").alias("id")).distinct(), "id", "left_anti"), f"{home}/todo-{step}")
        if width > 2 * span or todo.isEmpty():
            return areas.sparkSession.read.schema(settled.schema).parquet(f"{home}/settled")
        width *= 2


def contiguity(edges: DataFrame, tolerance: float = 10.0, spacing: float = 20.0) -> DataFrame:
    """i, j: areas whose boundaries come within ``tolerance`` of each other.

    Boundaries are cut into pieces no longer than ``spacing``; a grid join of
    piece midpoints to pieces bounds the candidates and the exact distance
    decides. Areas without a neighbour are left out (link them with
    ``nearest_neighbors``).
    """
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    parts = F.greatest(F.lit(1), F.ceil(length / spacing).cast("int"))
    cut = (edges.withColumn("_n", parts).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
           .select("geo_id", *[(F.col(f"{v}1") + (F.col(f"{v}2") - F.col(f"{v}1")) * (F.col("_k") + s) / F.col("_n"))
                               .alias(f"{v}{e}") for v in ("x", "y") for s, e in ((0, "1"), (1, "2"))]))
    mids = cut.select(F.struct("geo_id", "x1", "y1", "x2", "y2").alias("id"),
                      ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    pairs = grid_pairs(mids, mids, tolerance + spacing, group=False).where("a_id.geo_id <> b_id.geo_id")
    ends = [geo.segment_distance(F.col(f"{p}_id.x{e}"), F.col(f"{p}_id.y{e}"),
                                 *[F.col(f"{q}_id.{c}") for c in ("x1", "y1", "x2", "y2")])
            for p, q in (("a", "b"), ("b", "a")) for e in (1, 2)]
    return (pairs.where(F.least(*ends) <= tolerance)
            .select(F.col("a_id.geo_id").alias("i"), F.col("b_id.geo_id").alias("j")).distinct())


def contiguity_with_islands(edges: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """``contiguity``, and for areas without a neighbour the nearest area by mean vertex."""
    nb = contiguity(edges, tolerance)
    centre = edges.groupBy(F.col("geo_id").alias("id")).agg(F.avg("x1").alias("x"), F.avg("y1").alias("y"))
    lonely = centre.select("id").join(nb.select(F.col("i").alias("id")), "id", "left_anti")
    if lonely.isEmpty():
        return nb
    near = nearest_neighbors(centre, 1).join(lonely.withColumnRenamed("id", "i"), "i", "left_semi")
    return nb.unionByName(near.select("i", "j"))
