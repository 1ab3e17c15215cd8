"""Permutation tests and adjustment against plain forms."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardstat.operators import spatial_stats as S


def ring(n, k):
    """Areas on a ring: the next k on either side are neighbours; area 0 has more."""
    links = {(i, (i + d) % n) for i in range(n) for d in range(-k, k + 1) if d}
    return sorted(links | {(0, j) for j in range(1, k + 5)})


@pytest.mark.parametrize("n", [12, 70])
def test_local_moran_counts_every_simulation(spark, monkeypatch, n):
    """With many areas only the first places are gathered; some simulations have to be drawn again."""
    rng = np.random.default_rng(n)
    v = rng.normal(size=n)
    areas = spark.createDataFrame([(f"a{i}", float(x)) for i, x in enumerate(v)], "id string, v double")
    nb = spark.createDataFrame([(f"a{i}", f"a{j}") for i, j in ring(n, 2)], "i string, j string")
    got = {r.id: r for r in S.lisa(areas, nb, "v", nsim=300).collect()}
    z, out = v - v.mean(), {}
    m2 = (z * z).mean()
    near = {i: [j for a, j in ring(n, 2) if a == i] for i in range(n)}
    lo, hi = np.zeros(n), np.zeros(n)
    for r in range(1, 301):
        order = sorted(range(n), key=lambda i: hashlib.md5(f"l:{S.SEED}:{r}:a{i}".encode()).hexdigest())
        for i in range(n):
            k = len(near[i])
            drawn = [j for j in order if j != i][:k]
            sim, ii = z[i] * z[drawn].mean() / m2, z[i] * z[near[i]].mean() / m2
            lo[i] += sim <= ii + 1e-9
            hi[i] += sim >= ii - 1e-9
    for i in range(n):
        assert abs(got[f"a{i}"].p - min(1, 2 * (min(lo[i], hi[i]) + 1) / 301)) < 1e-12, i


def test_simulations_left_short_are_drawn_again(spark, monkeypatch):
    z = spark.createDataFrame([(i, float(i)) for i in range(400)], "id long, z double")
    want = {r.r: [a.id for a in r.firsts] for r in S.first_places(z.where("id < 390"), 3, 60, 1, "x").collect()}
    real = S.small_side
    seen = []
    monkeypatch.setattr(S, "small_side", lambda d: (seen.append(d.count()), real(d))[1])
    assert {r.r: len(r.firsts) for r in S.first_places(z, 3, 2000, 1, "x").collect()} == {r: 3 for r in range(1, 2001)}
    assert all(len(v) == 3 for v in want.values()) and len(want) == 60 and seen and seen[0] < 40
    for r, ids in list(want.items())[:20]:
        order = sorted(range(390), key=lambda i: hashlib.md5(f"x:1:{r}:{i}".encode()).hexdigest())
        assert ids == order[:3]


def bh(p):
    order = np.argsort(p)
    adj = np.array(p)[order] * len(p) / np.arange(1, len(p) + 1)
    out = np.empty(len(p))
    out[order] = np.minimum(1, np.minimum.accumulate(adj[::-1])[::-1])
    return out


@pytest.mark.parametrize("ranges", [1, 7, 256])
def test_adjustment_over_ranges(spark, ranges):
    rng = np.random.default_rng(1)
    p = np.round(rng.beta(0.3, 1.0, 5000), 5)
    df = spark.createDataFrame([(i, "ab"[i % 2], float(x)) for i, x in enumerate(p)] + [(9999, "a", None)], "id long, g string, p double")
    got = {r.id: r.q for r in S.bh_adjust(df, "p", ranges=ranges).collect()}
    assert got.pop(9999) is None and np.allclose([got[i] for i in range(5000)], bh(p), rtol=1e-12)
    by = {r.id: r.q for r in S.bh_adjust(df, "p", within=["g"], ranges=ranges).collect()}
    for k in (0, 1):
        assert np.allclose([by[i] for i in range(k, 5000, 2)], bh(p[k::2]), rtol=1e-12)
    plan = S.bh_adjust(df, "p")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition, ENSURE" not in plan.split("percentile_approx")[0] and S.bh_adjust(df.where("false"), "p").count() == 0


@pytest.mark.parametrize("values,links", [([1.0], []), ([2.0, 2.0, 2.0], [("a0", "a1"), ("a1", "a2")]), ([1.0, 3.0], [("a0", "a1"), ("a1", "a0")])])
def test_few_or_equal_areas_have_no_statistic(spark, values, links):
    areas = spark.createDataFrame([(f"a{i}", v) for i, v in enumerate(values)], "id string, v double")
    nb = spark.createDataFrame(links, "i string, j string")
    assert S.moran_global(areas, nb, "v", nsim=9).first().z is None
    assert all(r["class"] is not None for r in S.lisa(areas, nb, "v", nsim=9).collect())
