"""Estimators against direct computation, on skewed cells and under repartitioning."""

import collections
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardstat.functions.md5 import numbered_md5
from wardstat.operators import aggregates as A
from wardstat.operators import spatial_stats as SS


def km_by_hand(records, min_n=20):
    """Product-limit median with log-log interval, straight from single records."""
    n = len(records)
    if n < min_n:
        return None
    z, s, g, curve = 1.959963984540054, 1.0, 0.0, []
    for t in sorted({t for t, e in records if e}):
        d = sum(1 for u, e in records if u == t and e)
        r = sum(1 for u, _ in records if u >= t)
        s *= 1 - d / r
        g = math.inf if d == r else g + d / (r * (r - d))
        if s <= 1e-12:
            curve.append((t, 0.0, 0.0, 0.0))
        else:
            half = z * math.sqrt(g) / abs(math.log(s))
            c = math.log(-math.log(s))
            curve.append((t, s, math.exp(-math.exp(c + half)), math.exp(-math.exp(c - half))))

    def cross(k):
        for i, row in enumerate(curve):
            if row[k] <= 0.5 + 1.5e-8:
                return (row[0] + curve[i + 1][0]) / 2 if abs(row[k] - 0.5) < 1.5e-8 and i + 1 < len(curve) else row[0]
        return None
    m = cross(1)
    return None if m is None else (m, cross(2), math.inf if cross(3) is None else cross(3))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_km_equals_single_record_form(spark, seed):
    rng = random.Random(seed)
    groups = {g: [(rng.randrange(12), rng.random() < p) for _ in range(n)] for g, n, p in (("a", 60, 0.9), ("b", 25, 0.5), ("c", 40, 0.15), ("d", 19, 1.0), ("e", 30, 1.0))}
    groups["half"] = [(1, True)] * 10 + [(3, True)] * 10          # exactly 0.5 at 1: midpoint 2
    rows = [(g, t, e) for g, rs in groups.items() for t, e in rs]
    df = spark.createDataFrame(rows, "g string, t int, e boolean").repartition(6)
    out = {r["g"]: r for r in A.km_median(A.km_counts(df, ["g"], "t", F.col("e")), ["g"]).collect()}
    for g, rs in groups.items():
        want, r = km_by_hand(rs), out[g]
        assert r["n"] == len(rs) and r["suppressed"] == (want is None)
        assert want is None and r["value"] is None or (r["value"], r["ci_low"], r["ci_high"]) == pytest.approx(want)
    assert out["half"]["value"] == 2


@pytest.mark.parametrize("opened", [50_000, 40])
def test_quantiles_equal_numpy(spark, monkeypatch, opened):
    monkeypatch.setattr(A, "OPENED", opened)
    rng = random.Random(5)
    vals = [("hot", 7.25)] * 300 + [("hot", round(rng.lognormvariate(2, 2), 2)) for _ in range(101)] + [("b", float(i)) for i in range(4)] + [("one", -3.5)]
    df = spark.createDataFrame(vals, "g string, v double").repartition(5)
    got = {r["g"]: r for r in A.quantiles(df, ["g"], "v", {"m": 0.5, "q": 0.99}).collect()}
    for g in ("hot", "b", "one"):
        x = [v for k, v in vals if k == g]
        assert got[g]["n"] == len(x) and got[g]["m"] == pytest.approx(np.median(x)) and got[g]["q"] == pytest.approx(np.quantile(x, 0.99))


def test_median_interval_matches_resampling(spark):
    rng = np.random.default_rng(7)
    x = np.sort(rng.gamma(2, 10, 101))
    r = A.median_metric(spark.createDataFrame([("g", float(v)) for v in x], "g string, v double"), ["g"], "v").first()
    sims = np.median(rng.choice(x, (20000, 101)), axis=1)
    lo, hi = np.quantile(sims, [0.025, 0.975])
    assert abs(np.searchsorted(x, r["ci_low"]) - np.searchsorted(x, lo)) <= 1 and abs(np.searchsorted(x, r["ci_high"]) - np.searchsorted(x, hi)) <= 1
    few = A.median_metric(spark.createDataFrame([("g", 1.0)] * 19, "g string, v double"), ["g"], "v").first()
    assert few["suppressed"] and few["value"] is None and few["n"] == 19


def test_total_intervals_agree(spark):
    rng = np.random.default_rng(11)
    x = rng.lognormal(8, 1.2, 400)
    df = spark.createDataFrame([("g", float(v)) for v in x], "g string, v double")
    boot = np.quantile(rng.choice(x, (20000, 400)).sum(axis=1), [0.025, 0.975])
    width = boot[1] - boot[0]
    sums = df.groupBy("g").agg(*A.power_sums(F.col("v")))
    for r in (A.bootstrap_total(df, ["g"], "v").first(), A.total_interval(sums).first()):
        assert r["total"] == pytest.approx(x.sum())
        assert abs(r["ci_low"] - boot[0]) < 0.05 * width and abs(r["ci_high"] - boot[1]) < 0.05 * width
    a = A.bootstrap_total(df.repartition(1), ["g"], "v").first()
    b = A.bootstrap_total(df.repartition(7), ["g"], "v").first()
    assert a["ci_low"] == pytest.approx(b["ci_low"], rel=1e-12)


def test_proportions_and_suppression(spark):
    df = spark.createDataFrame([("a", 30, 41), ("b", 29, 29), ("c", 0, 30)], "g string, x bigint, n bigint")
    got = {r["g"]: r for r in A.proportion(df).collect()}
    assert got["a"]["value"] == pytest.approx(30 / 41) and not got["a"]["suppressed"]
    assert got["b"]["suppressed"] and got["b"]["value"] is None
    assert got["c"]["value"] == 0 and got["c"]["ci_low"] == 0 and got["c"]["ci_high"] > 0.1


def test_rates_keep_zero(spark):
    df = spark.createDataFrame([("a", 3, 2000), ("b", 0, 2000)], "g string, n bigint, pop bigint")
    got = {r["g"]: r for r in A.poisson_rate(df, "n", F.col("pop"), 1000).collect()}
    assert got["a"]["value"] == 1.5 and got["b"]["value"] == 0 and got["b"]["ci_low"] == 0 and got["b"]["ci_high"] == pytest.approx(1.8444, abs=1e-3)


def test_odds(spark):
    df = spark.createDataFrame([(10, 30), (25, 0), (9, 10)], "d bigint, m bigint")
    got = {(r["d"], r["m"]): r for r in A.odds(df, "d", "m").collect()}
    assert got[(10, 30)]["value"] == pytest.approx(1 / 3) and got[(25, 0)]["suppressed"] and got[(9, 10)]["suppressed"]


def test_apportion_sums_pieces_before_squaring(spark):
    bg = spark.createDataFrame([("1", "pop", 100.0, 10.0), ("2", "pop", 50.0, None), ("3", "pop", 80.0, 8.0)], "bg string, variable string, estimate double, moe double")
    blocks = spark.createDataFrame([("1", 0.3, 0.5, "A"), ("1", 0.3, 0.5, "A"), ("1", 0.4, 0.0, "B"), ("2", 1.0, 1.0, "B"), ("3", 1.0, 1.0, "A"), ("3", 0.0, 0.0, None)],
                                   "bg string, weight_pop double, weight_hu double, zone string")
    got = {r["geo_id"]: r for r in A.apportion(bg, blocks, {"zone": "zone"}).collect()}
    assert got["A"]["estimate"] == pytest.approx(140) and got["A"]["moe"] == pytest.approx(10.0)
    assert got["B"]["estimate"] == pytest.approx(90) and got["B"]["moe"] is None


def test_derive_refuses_unknown_variables(spark):
    c = spark.createDataFrame([("z", "1", "a", 50.0, 10.0), ("z", "1", "b", 100.0, 12.0)], "geo_type string, geo_id string, variable string, estimate double, moe double")
    r = A.derive_measures(c, [("share", "proportion", "a", "b")]).first()
    assert r["value"] == 0.5 and r["moe"] == pytest.approx(math.sqrt(100 - 36) / 100) and r["reliability"] == "high"
    with pytest.raises(ValueError, match="missing variables: x"):
        A.derive_measures(c, [("share", "ratio", "a", "x")])


def test_bh_known_values(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.5]
    got = SS.bh_adjust(spark.createDataFrame(list(enumerate(p)), "id int, p double"), "p").orderBy("id").collect()
    assert [r["q"] for r in got] == pytest.approx([0.025, 0.05, 0.05, 0.025, 0.5])


def test_moran_and_lisa_find_a_planted_cluster(spark):
    n = 8
    ids = {(i, j): f"{i}-{j}" for i in range(n) for j in range(n)}
    areas = spark.createDataFrame([(v, 5.0 if i < 3 and j < 3 else float((i * 7 + j * 3) % 5) / 10) for (i, j), v in ids.items()], "id string, v double")
    nb = spark.createDataFrame([(ids[a], ids[b]) for a in ids for b in ids if a != b and abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1], "i string, j string")
    m = SS.moran_global(areas, nb, "v", nsim=499).first()
    assert m["moran_i"] > 0.5 and m["p_perm"] == pytest.approx(1 / 500) and m["expected"] == pytest.approx(-1 / 63)
    cls = {r["id"]: r["class"] for r in SS.lisa(areas, nb, "v", nsim=4999).collect()}
    assert cls["1-1"] == "HH" and cls["0-0"].startswith("HH") and cls["6-6"] not in ("HH", "HL")
    again = SS.lisa(areas.repartition(5), nb.repartition(3), "v", nsim=4999)
    assert {r["id"]: r["class"] for r in again.collect()} == cls


def test_selection_among_values_that_lie_close(spark, monkeypatch):
    """Clusters far apart, each within one part of the whole stretch, need several passes."""
    monkeypatch.setattr(A, "OPENED", 60)
    monkeypatch.setattr(A, "PARTS", 16)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(1e9, 1e-3, 3000), rng.normal(5.0, 1e-6, 3000), rng.exponential(1.0, 3000), np.full(500, -7.25)])
    df = spark.createDataFrame([(None if i % 2 else "g", float(v)) for i, v in enumerate(x)], "g string, v double").repartition(5)
    ranks = {"a": F.lit(1), "b": F.col("n") / 4, "c": F.col("n") / 2, "d": F.col("n"), "none": F.col("n") + 1}
    got = {r.g: r for r in A.order_statistics(df, ["g"], "v", ranks).collect()}
    for k, part in (("g", x[::2]), (None, x[1::2])):
        s, n = np.sort(part), len(part)
        assert [got[k].n, got[k].a, got[k].b, got[k].c, got[k].d, got[k].none] == [n, s[0], s[n // 4 - 1], s[n // 2 - 1], s[-1], None]
    assert A.order_statistics(df, [], "v", {"m": F.lit(4750)}).first().m == np.sort(x)[4749]


def test_bootstrap_draws_are_dealt_by_number(spark):
    """A few kilobytes of values are still many draws: they may not end up in one or two tasks."""
    df = spark.range(3000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    out = A.bootstrap_total(df, ["g"], "v", reps=40)
    plan = out._jdf.queryExecution().executedPlan().toString()
    cores = spark.sparkContext.defaultParallelism
    assert any("REPARTITION_BY_NUM" in line and f", {cores})" in line for line in plan.splitlines()), plan
    assert out.first()["n"] == 3000


def test_order_statistics_of_spread_rows(spark, monkeypatch):
    """Rows repeated for their cells after they are stored: the same values at the same ranks, one value being in more rows than are opened."""
    monkeypatch.setattr(A, "OPENED", 8)
    monkeypatch.setattr(A, "PARTS", 4)
    gs = F.array(F.lit("all"), F.when(F.col("id") % 3 == 0, "third"))
    df = spark.range(300).select(gs.alias("gs"), (F.col("id") % 20).alias("leaf"), F.when(F.col("id") < 150, 7.0).otherwise((F.col("id") * 37 % 101).cast("double")).alias("v"))
    df = df.unionByName(df.limit(1).select("gs", "leaf", F.lit(None).cast("double").alias("v")))
    cells = lambda d: d.withColumn("g", F.explode("gs"))
    ranks = {"low": F.lit(1), "mid": F.ceil(F.col("n") / 2), "odd": F.col("n") - 7, "high": F.col("n"), "beyond": F.col("n") + 1}
    plain = {r.g: r for r in A.order_statistics(cells(df), ["g"], "v", ranks).collect()}
    spread = {r.g: r for r in A.order_statistics(df, ["g"], "v", ranks, cells).collect()}
    assert spread == plain and spread["all"].n == 300 and spread["third"].n == 100


def test_numbered_md5_of_any_length():
    """Every place a number can take in a block, also across two, and numbers of one to four digits."""
    texts = ["x" * i + "\u00e9" * (i % 3) for i in range(200)] + ["", "a"]
    for array, want in ((pa.array(texts), texts), (pa.array(texts).slice(57, 9), texts[57:66]), (pa.array([], pa.string()), [])):
        order, digests = numbered_md5(array, 1002)
        seen = 0
        for b, words in digests:
            assert b == seen and words.shape == (4, len(want))
            seen += 1
            if b in (0, 9, 10, 57, 99, 100, 999, 1000, 1001):
                got = ["".join(f"{int(v):08x}" for v in words[:, i]) for i in range(len(want))]
                assert got == [hashlib.md5(f"{want[j]}{b}".encode()).hexdigest() for j in order]
        assert seen == 1002


def test_bootstrap_draws_in_arrays(spark, monkeypatch):
    """The digests, weights and sums of plain Python, for cells of two columns, repeats, long names and sums handed on in parts."""
    monkeypatch.setattr(A, "SUMS_ROWS", 10)
    rng = np.random.default_rng(5)
    rows = [("n" * int(rng.integers(1, 90)), k % 3, float(rng.integers(0, 4))) for k in range(120)]
    rows = [(g[:1] if k % 2 else g, h, v) for k, (g, h, v) in enumerate(rows)] + [("n", None, 1.5), ("n", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(3)
    out = A.bootstrap_total(df, ["g", "h"], "v", reps=30)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "md5(" not in plan
    steps, count, sums = A.poisson_steps(), collections.Counter(), collections.defaultdict(lambda: np.zeros((30, 2)))
    for g, h, v in rows[:-2]:
        count[g, h, v] += 1
        for rep in range(30):
            u = hashlib.md5(f"w:{A.SEED}:{g}:{h}:{v:.4f}:{count[g, h, v]}:{rep // 4}".encode()).hexdigest()[8 * (rep % 4):][:8]
            w = sum(u >= s for s in steps)
            sums[g, h][rep] += w, w * v
    got = {(r["g"], r["h"]): r for r in out.collect()}
    assert got.keys() == sums.keys()
    for k, s in sums.items():
        n = sum(c for (g, h, _), c in count.items() if (g, h) == k)
        want = [n * wx / w for w, wx in s if w]
        assert got[k]["n"] == n and got[k]["ci_low"] == pytest.approx(np.quantile(want, 0.025)) and got[k]["ci_high"] == pytest.approx(np.quantile(want, 0.975))
