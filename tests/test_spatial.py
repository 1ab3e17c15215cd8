"""Spatial joins against brute force, with hot spots and any partitioning."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wardstat.operators import spatial as S


def points(spark, n, seed, size=300.0, types="ab", span=40.0, hot=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = (50.0, 50.0) if rng.random() < hot else (round(rng.uniform(0, size), 1), round(rng.uniform(0, size), 1))
        rows.append((i, "a" if x == 50.0 and y == 50.0 else rng.choice(types), x, y, round(rng.uniform(0, span), 3)))
    return rows, spark.createDataFrame(rows, "id bigint, type string, x double, y double, t double")


def greedy(rows, meters, days):
    out, primaries = {}, []
    for i, g, x, y, t in sorted(rows, key=lambda r: (r[4], r[0])):
        hit = [p for p in primaries if p[1] == g and t - p[4] <= days and (x - p[2]) ** 2 + (y - p[3]) ** 2 <= meters ** 2]
        out[i] = min(hit, key=lambda p: (p[4], p[0]))[0] if hit else None
        if not hit:
            primaries.append((i, g, x, y, t))
    return out


@pytest.mark.parametrize("seed,hot,parts", [(1, 0.0, 1), (2, 0.4, 7), (3, 0.9, 3)])
def test_near_duplicates_equal_the_sequential_rule(spark, seed, hot, parts):
    rows, df = points(spark, 250, seed, hot=hot)
    got = {r["id"]: r["duplicate_of"] for r in S.near_duplicates(df.repartition(parts), 50, 7).collect()}
    assert got == greedy(rows, 50, 7)


def test_near_duplicates_edge_rows(spark):
    rows = [(1, "a", 0.0, 0.0, 0.0), (2, "a", 30.0, 0.0, 7.0), (3, "a", 30.0, 0.0, 7.5), (4, "b", 0.0, 0.0, 0.0), (5, "a", None, None, 0.0), (6, "a", 60.0, 0.0, 8.0)]
    df = spark.createDataFrame(rows, "id bigint, type string, x double, y double, t double")
    got = {r["id"]: r["duplicate_of"] for r in S.near_duplicates(df, 50, 7).collect()}
    # 2 lies exactly seven days after 1; 3 does not and becomes a primary; 6 is near 3 only.
    assert got == {1: None, 2: 1, 3: None, 4: None, 5: None, 6: 3}
    assert S.near_duplicates(df.where("id = 5"), 50, 7).collect()[0]["duplicate_of"] is None


def test_adding_a_copy_of_a_primary_changes_nothing_else(spark):
    rows, df = points(spark, 120, 9)
    before = greedy(rows, 50, 7)
    first = min(rows, key=lambda r: r[4])
    more = df.unionByName(spark.createDataFrame([(999, first[1], first[2], first[3], first[4] + 0.001)], df.schema))
    after = {r["id"]: r["duplicate_of"] for r in S.near_duplicates(more, 50, 7).collect()}
    assert after.pop(999) == first[0] and after == before


@pytest.mark.parametrize("lag", [None, (0, 5), (-1e-9, 7)])
def test_grid_pairs_equal_all_pairs(spark, lag):
    rows, df = points(spark, 150, 5)
    a = df.withColumnRenamed("type", "g")
    got = {(r["a_id"], r["b_id"]) for r in S.grid_pairs(a, a.repartition(5), 60, lag=lag).collect()}
    want = {(p[0], q[0]) for p in rows for q in rows if p[1] == q[1] and (p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2 <= 3600
            and (lag is None or lag[0] < q[4] - p[4] <= lag[1])}
    assert got == want


@pytest.mark.parametrize("lag", [None, (0, 5)])
def test_grid_pairs_where_cells_share_a_number(spark, monkeypatch, lag):
    monkeypatch.setattr(S, "_cell_key", lambda *parts: F.xxhash64(*parts) % 3)
    rows, df = points(spark, 90, 5)
    a = df.withColumnRenamed("type", "g").unionByName(spark.createDataFrame(
        [(90, None, 5.0, 5.0, 1.0), (91, "a", None, 5.0, 1.0), (92, "a", 5.0, None, 1.0)], "id bigint, g string, x double, y double, t double"))
    got = [(r["a_id"], r["b_id"]) for r in S.grid_pairs(a, a.repartition(5), 60, lag=lag).collect()]
    want = [(p[0], q[0]) for p in rows for q in rows if p[1] == q[1] and (p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2 <= 3600
            and (lag is None or lag[0] < q[4] - p[4] <= lag[1])]
    assert sorted(got) == sorted(want)


def test_grid_pairs_sorts_one_number_and_rounds_without_decimals(spark, tmp_path):
    """A row is joined by one number and its group, and F.round is left to near ties."""
    from wardstat.plans import q_spatial
    from wardstat.plans.registry import Tables
    rng = random.Random(43)
    rows = [(k, rng.choice("ab"), f"1995-01-{rng.randint(1, 28):02d}") for k in range(400)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderpriority string, o_orderdate string").write.parquet(f"{tmp_path}/orders.parquet")
    df = q_spatial.grid_pairs(Tables(spark, str(tmp_path)))
    at = [(k, g, k * 7919 % 1999, k * 104729 % 2003, int(d[-2:])) for k, g, d in rows]
    want = [(a[0], b[0], round(math.hypot(a[2] - b[2], a[3] - b[3]), 6), b[4] - a[4]) for a in at for b in at
            if a[1] == b[1] and 0 < b[4] - a[4] <= 20 and (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 <= 10000]
    assert want and sorted(map(tuple, df.collect())) == sorted(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):].splitlines()[0]
    assert join.startswith("SortMergeJoin [_cell#") and "_cx" not in join and "_tb" not in join
    assert "AS dist" in plan and plan.count("rint(") and "CASE WHEN" in plan


def shuffled(node):
    """Rows that each exchange of an executed plan wrote."""
    kind = node.getClass().getSimpleName()
    if kind == "ShuffleQueryStageExec":
        return [node.shuffle().metrics().apply("shuffleRecordsWritten").value()]
    inner = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind == "ResultQueryStageExec" else None
    return shuffled(inner) if inner else [n for i in range(node.children().size()) for n in shuffled(node.children().apply(i))]


@pytest.mark.parametrize("lag", [None, (0, 5)])
def test_grid_pairs_sends_few_copies(spark, lag):
    """Rows are copied to the cells they reach, not to each square: under four copies of a row on average, where there were 9 or 18."""
    rows, df = points(spark, 600, 21, size=6000.0, span=200.0)
    a = df.withColumnRenamed("type", "g")
    out = S.grid_pairs(a, a, 60, lag=lag)
    out.collect()
    sent = shuffled(out._jdf.queryExecution().executedPlan())
    assert len(sent) == 2 and min(sent) == 600 and max(sent) < 4 * 600


@pytest.mark.parametrize("lag", [None, (0, 5), (-3, 4)])
@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_grid_pairs_of_small_cells_and_packs(spark, monkeypatch, lag, hot):
    """Cells of two radii, three rows a pack, places below zero, ids that come twice, and two frames that differ."""
    for name, n in (("CELL_RADII", 2), ("CELL_LAGS", 2), ("PACKED_ROWS", 3)):
        monkeypatch.setattr(S, name, n)
    rows, _ = points(spark, 140, 23, size=500.0, hot=hot)
    rows = [(i // 2, g, x - 250.0, round(y / 60) * 60.0 - 240.0, float(round(t)) - 20) for i, g, x, y, t in rows]
    schema = "id bigint, g string, x double, y double, t double"
    a, b = rows[:90], rows[50:]
    got = [(r["a_id"], r["b_id"], round(r["dist"], 6)) for r in S.grid_pairs(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), 60, lag=lag).collect()]
    want = [(p[0], q[0], round(math.hypot(p[2] - q[2], p[3] - q[3]), 6)) for p in a for q in b
            if p[1] == q[1] and (p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2 <= 3600 and (lag is None or lag[0] < q[4] - p[4] <= lag[1])]
    assert want and sorted(got) == sorted(want)


def test_grid_pairs_plan_has_no_cross_join(spark):
    _, df = points(spark, 50, 5)
    a = df.withColumnRenamed("type", "g")
    plan = S.grid_pairs(a, a, 60, lag=(0, 5))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_rereport_known_answers(spark):
    # A closing on day 10 with later reports at 20 m after 31 days, at 40 m after 12 and at 90 m after 3.
    closed = spark.createDataFrame([(1, "pothole", 0.0, 0.0, 10)], "id bigint, g string, x double, y double, t int")
    rows = [("pothole", 20.0, 0.0, 41), ("pothole", 40.0, 0.0, 22), ("pothole", 90.0, 0.0, 13), ("graffiti", 0.0, 0.0, 11), ("pothole", 0.0, 0.0, 10), ("pothole", 0.0, 0.0, 71)]
    r = S.first_rereport(closed, spark.createDataFrame(rows, "g string, x double, y double, t int"), [25, 50, 100]).first()
    assert (r["r25"], r["r50"], r["r100"]) == (31, 12, 3)


def squares(spark):
    g = [("zcta", "A", 0.0, 0.0, 100.0, 100.0), ("zcta", "B", 100.0, 0.0, 200.0, 100.0), ("zcta", "C", 203.0, 0.0, 300.0, 100.0)]
    return S.rectangles_to_edges(spark.createDataFrame(g, "geo_type string, geo_id string, x0 double, y0 double, x1 double, y1 double"))


def test_boundary_rule(spark):
    pts = {1: (50.0, 50.0), 2: (100.0, 50.0), 3: (100.5, 50.0), 4: (102.0, 50.0), 5: (201.0, 50.0), 6: (201.5, 50.0), 7: (-0.5, 50.0), 8: (None, None)}
    df = spark.createDataFrame([(k, *v) for k, v in pts.items()], "id int, x double, y double")
    got = {r["id"]: (r["zcta"], r["zcta_on_boundary"]) for r in S.assign_geography(df, squares(spark), ["zcta"]).collect()}
    assert got == {1: ("A", False), 2: ("A", True), 3: ("A", True), 4: ("B", False), 5: ("B", True), 6: (None, False), 7: ("A", True), 8: (None, False)}


def test_holes_flip_parity(spark):
    g = [("c", "city", 0.0, 0.0, 300.0, 300.0), ("c", "city", 100.0, 100.0, 200.0, 200.0)]
    e = S.rectangles_to_edges(spark.createDataFrame(g, "geo_type string, geo_id string, x0 double, y0 double, x1 double, y1 double"))
    df = spark.createDataFrame([(1, 50.0, 150.0), (2, 150.0, 150.0), (3, 250.0, 150.0)], "id int, x double, y double")
    got = {r["id"]: r["c"] for r in S.assign_geography(df, e, ["c"]).collect()}
    assert got == {1: "city", 2: None, 3: "city"}


def test_polygon_against_even_odd_rule(spark):
    ring = [(0, 0), (400, 30), (250, 200), (380, 390), (120, 250), (20, 380), (0, 0)]
    pts = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ring])
    e = S.ring_edges(spark.range(1).select(F.lit("t").alias("geo_type"), F.lit("P").alias("geo_id"), F.lit(0).alias("ring"), pts.alias("pts")))
    rng = random.Random(4)
    rows = [(i, rng.uniform(-20, 420), rng.uniform(-20, 420)) for i in range(300)]
    got = {r["id"] for r in S.assign_geography(spark.createDataFrame(rows, "id int, x double, y double"), e, ["t"], tolerance=1e-9).where("t is not null").collect()}

    def inside(x, y):
        hit = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                hit = not hit
        return hit
    assert got == {i for i, x, y in rows if inside(x, y)}


def test_neighbours(spark):
    nb = {(r["i"], r["j"]) for r in S.contiguity(squares(spark)).collect()}
    assert nb == {("A", "B"), ("B", "A"), ("B", "C"), ("C", "B")}
    far = squares(spark).unionByName(S.rectangles_to_edges(spark.createDataFrame([("zcta", "Z", 900.0, 0.0, 950.0, 100.0)], "geo_type string, geo_id string, x0 double, y0 double, x1 double, y1 double")))
    nb = {(r["i"], r["j"]) for r in S.contiguity_with_islands(far).collect()}
    assert ("Z", "C") in nb and len(nb) == 5


def test_knn_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(39)] + [(39, 5000.0, 5000.0)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    got = {(r["i"], r["rank"]): r["j"] for r in S.nearest_neighbors(df, 4).collect()}
    for i, x, y in rows:
        order = sorted((math.hypot(x - a, y - b), j) for j, a, b in rows if j != i)
        assert [got[(i, k + 1)] for k in range(4)] == [j for _, j in order[:4]]


@pytest.mark.parametrize("block_rows", [50_000, 300])
def test_near_duplicates_over_years_at_one_spot(spark, monkeypatch, block_rows):
    """Ten years of reports every two days, and a dense place, take few rounds however the blocks are cut."""
    rng = random.Random(8)
    spot = [(k, "a", 10.0, 10.0, float(k * 2)) for k in range(1820)]
    dense = [(5000 + k, "b", rng.uniform(900, 1100), rng.uniform(900, 1100), float(rng.randint(0, 400))) for k in range(1500)]
    rounds = []
    keep = S.stored
    monkeypatch.setattr(S, "stored", lambda df, path: (rounds.append(path) if "/todo" in path else None, keep(df, path))[1])
    monkeypatch.setattr(S, "BLOCK_ROWS", block_rows)
    df = spark.createDataFrame(spot + dense, "id long, type string, x double, y double, t double")
    got = {r["id"]: r["duplicate_of"] for r in S.near_duplicates(df, 50, 7).collect()}
    primaries, want = {}, {}
    for i, g, x, y, t in sorted(spot + dense, key=lambda r: (r[4], r[0])):
        near = [p for p in primaries.setdefault(g, []) if p[4] >= t - 7 and (p[2] - x) ** 2 + (p[3] - y) ** 2 <= 2500]
        want[i] = near[0][0] if near else None
        if not near:
            primaries[g].append((i, g, x, y, t))
    assert got == want and len(rounds) < 10


def test_a_dense_tile_is_divided(spark, monkeypatch):
    """Thousands of reports within a few hundred metres and days are decided in blocks of bounded size."""
    monkeypatch.setattr(S, "BLOCK_ROWS", 150)
    rng = random.Random(11)
    rows = [(k, "a", rng.uniform(0, 600), rng.uniform(0, 600), float(rng.randint(0, 20))) for k in range(4000)] + [(9000 + k, "b", rng.uniform(0, 90_000), 5.0, float(k)) for k in range(50)]
    sizes, keep = [], S.stored

    def watch(df, path):
        out = keep(df, path)
        if "slab" in out.columns and "id" in out.columns and "link" not in out.columns and "/places" in path:
            sizes.extend(out.groupBy("type", "gx", "gy", "slab").count().collect())
        return out

    monkeypatch.setattr(S, "stored", watch)
    got = {r["id"]: r["duplicate_of"] for r in S.near_duplicates(spark.createDataFrame(rows, "id long, type string, x double, y double, t double"), 50, 7).collect()}
    assert got == greedy(rows, 50, 7)
    a = [r["count"] for r in sizes if r["type"] == "a"]
    assert len(a) > 20 and max(a) <= 300 and len({(r.gx, r.gy) for r in sizes if r["type"] == "b"}) <= 2


def test_near_duplicates_decide_each_row_once(spark, monkeypatch):
    """Where a decision carries on for years, blocks follow each other instead of all deciding again and again."""
    rng = random.Random(21)
    rows = [(k, "a", rng.uniform(0, 400), rng.uniform(0, 400), float(rng.randint(0, 350))) for k in range(2400)]
    decided, keep = [], S.stored

    def watch(df, path):
        out = keep(df, path)
        if "link" in out.columns:
            decided.append(out.count())
        return out

    monkeypatch.setattr(S, "stored", watch)
    monkeypatch.setattr(S, "BLOCK_ROWS", 300)
    got = {r["id"]: r["duplicate_of"] for r in S.near_duplicates(spark.createDataFrame(rows, "id long, type string, x double, y double, t double"), 50, 7).collect()}
    assert got == greedy(rows, 50, 7)
    assert len(decided) > 4 and sum(decided) <= 2 * len(rows)


def test_near_duplicates_in_waves_and_tiles(spark, monkeypatch):
    """Tiles of one wave settle before the next wave starts, for types of different length side by side."""
    monkeypatch.setattr(S, "BLOCK_ROWS", 40)
    rng = random.Random(22)
    rows = [(k, "a", rng.uniform(0, 500), rng.uniform(0, 500), float(rng.randint(0, 20))) for k in range(500)]
    rows += [(5000 + k, "b", rng.uniform(-200, 200), rng.uniform(-200, 200), rng.randint(0, 100) / 4) for k in range(200)]
    got = {r["id"]: r["duplicate_of"] for r in S.near_duplicates(spark.createDataFrame(rows, "id long, type string, x double, y double, t double"), 50, 7).collect()}
    assert got == greedy(rows, 50, 7)


@pytest.mark.parametrize("near", [1, 5, 10**9])
def test_rereport_in_stretches_equals_all_days(spark, monkeypatch, near):
    """However short the first stretch of days is, the first report of each radius is found up to the last day."""
    steps, keep = [], S.stored
    monkeypatch.setattr(S, "stored", lambda df, path: (steps.append(path) if "/step=" in path else None, keep(df, path))[1])
    monkeypatch.setattr(S, "NEAR_REPORTS", near)
    rng = random.Random(31)
    rows = [(k, rng.choice("ab"), round(rng.uniform(0, 500)) * 1.0, round(rng.uniform(0, 500)) * 1.0, rng.randint(0, 200)) for k in range(700)]
    rows += [(k, None, 1.0, 1.0, 5) for k in (701, 702)] + [(703, "a", None, 1.0, 5), (704, "a", 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, g string, x double, y double, t int")
    got = {r["id"]: (r["r25"], r["r50"], r["r100"]) for r in S.first_rereport(df, df.drop("id"), [25, 50, 100]).collect()}
    full = [r for r in rows if None not in r]
    for i, g, x, y, t in full:
        later = [(math.hypot(x - p[2], y - p[3]), p[4] - t) for p in full if p[1] == g and 0 < p[4] - t <= 60]
        assert got[i] == tuple(min((l for d, l in later if d <= r), default=None) for r in (25, 50, 100))
    assert len(got) == len(rows) and got[701] == got[703] == got[704] == (None, None, None)
    assert len(steps) == 1 if near == 10**9 else len(steps) > 1


def test_within_radius_looks_up_no_pair(spark, tmp_path):
    """The join of pairs comes last but for the counts; an id that comes twice counts with each of its types."""
    from wardstat.plans import q_spatial
    from wardstat.plans.registry import Tables
    rng = random.Random(41)
    rows = [(k % 380, rng.choice("ab"), f"1995-01-{rng.randint(1, 28):02d}") for k in range(400)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderpriority string, o_orderdate string").write.parquet(f"{tmp_path}/orders.parquet")
    df = q_spatial.within_radius(Tables(spark, str(tmp_path)))
    at = [(k, g, k * 7919 % 1999, k * 104729 % 2003, int(d[-2:])) for k, g, d in rows]
    hits = [(kind[1], math.hypot(a[2] - b[2], a[3] - b[3]), b[4] - a[4]) for a in at for b in at
            if a[1] == b[1] and 0 < b[4] - a[4] <= 20 and math.hypot(a[2] - b[2], a[3] - b[3]) <= 100 for kind in at if kind[0] == a[0]]
    want = {(g, r): (len(x), min(x, default=None)) for g in "ab" for r in (25, 100) for x in [[lag for h, d, lag in hits if h == g and d <= r]]}
    assert {(r["type"], r["radius"]): (r["n"], r["min_lag"]) for r in df.collect()} == want
    plan = S.grid_pairs(*[q_spatial.order_points(Tables(spark, str(tmp_path))).withColumnRenamed("type", "g")] * 2, 100, lag=(0, 20))
    assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()


def test_semi_anti_join_takes_parts_by_rows(spark, monkeypatch, tmp_path):
    from wardstat.plans import q_joins
    from wardstat.plans.registry import Tables
    monkeypatch.setattr(q_joins, "PART_ROWS", 50)
    spark.createDataFrame([(k,) for k in (*range(40), 3, None)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(k % 30, "R" if k % 30 < 10 and k > 300 else "N") for k in range(700)] + [(None, "R")]
    spark.createDataFrame(lines, "l_orderkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = q_joins.semi_anti_join(Tables(spark, str(tmp_path)))
    assert sorted((r["o_orderkey"], r["returned"]) for r in df.collect()) == sorted([(k, k < 10) for k in (*range(30), 3)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "hashpartitioning(l_orderkey#" in plan and ", 15), REPARTITION_BY_NUM" in plan
