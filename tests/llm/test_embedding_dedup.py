import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_minhash_dedup import roots
from wardstat.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    ok = [(k, np.array(v, np.float32).astype(float)) for k, (i, v, label) in enumerate(rows) if v and label is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    n, edges = [0] * len(rows), []
    for x in range(len(ok)):
        for y in range(x):
            (a, u), (b, w) = ok[x], ok[y]
            if rows[a][2] == rows[b][2] and len(u) == len(w) and ed.unit(u[None])[0] @ ed.unit(w[None])[0] >= least:
                n[a] += 1
                n[b] += 1
                edges.append((a, b))
    top, out = roots(range(len(rows)), edges), []
    ids = {}
    for k in range(len(rows)):
        if rows[k][0] is not None:
            ids[top[k]] = min(ids.get(top[k], rows[k][0]), rows[k][0])
    for k, (i, _, _) in enumerate(rows):
        c = None if i is None else ids[top[k]]
        out.append((i, n[k], c, i is None or c == i))
    return sorted(out, key=str)


def result(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("rep", F.lit("mine")).withColumn("v", F.lit(1))
    return sorted(map(tuple, ed.near_duplicates(df, **kw).collect()), key=str)


@pytest.mark.parametrize("block", [2000, 30])
def test_clusters_copies_and_odd_rows(spark, block):
    rng = np.random.default_rng(3)
    rows, centre = [], rng.standard_normal((12, 16))
    for i in range(400):
        c = centre[i % 12] if i % 3 else centre[0]
        v = c + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.12, 0.3])
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 2))
    rows += [(500 + i, rows[0][1], 0) for i in range(30)] + [(600, [2 * x for x in rows[0][1]], 0), (601, rows[0][1], 1)]
    rows += [(700, None, 0), (701, [], 0), (702, [0.0] * 16, 0), (703, [None] + [1.0] * 15, 0), (704, [float("nan")] * 16, 0), (705, [float("inf")] * 16, 0), (706, rows[0][1], None), (707, rows[0][1][:8], 0),
             (708, rows[0][1][:8], 0), (None, rows[0][1], 0), (709, [1e-30] * 16, 0), (710, [1e30] * 16, 0), (1, rows[1][1], 1)]
    assert result(spark, rows, block=block) == brute(rows)


def test_empty_tables(spark):
    assert result(spark, []) == [] and result(spark, [(1, None, None)]) == [(1, 0, 1, True)]


def test_recall_at_the_bound():
    half, count = ed.calibration(0.98)
    rng, hit, cell, n = np.random.default_rng(0), 0, 0, 3000
    a = ed.unit(rng.standard_normal((n, 64)))
    side = rng.standard_normal((n, 64))
    side = ed.unit(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.98001 * a + np.sqrt(1 - 0.98001**2) * side
    way = ed.directions(64)[0][:, : ed.COUNTED]
    hit = ((np.abs(a @ way - b @ way) <= half).sum(1) >= count).mean()
    cell = (ed.cells(a, 0.98) == ed.cells(b, 0.98)).any(1).mean()
    assert hit >= 0.999 and cell >= 0.999
