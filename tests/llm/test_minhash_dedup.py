import random
from collections import defaultdict

from tests.llm.common import documents, frame
from wardstat.llm import minhash_dedup as mh
from wardstat.llm.components import components


def shingles(text, size=5):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in (text or "").encode().split()]
    return {tuple(w[a : a + size]) for a in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    post = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            post[x].append(k)
    both = defaultdict(int)
    for ks in post.values():
        for a in range(len(ks)):
            for b in range(a):
                both[ks[b], ks[a]] += 1
    edges = [(sets[a][0], sets[b][0]) for (a, b), n in both.items() if 100 * n >= percent * (len(sets[a][1]) + len(sets[b][1]) - n)]
    top = roots({i for i, _ in rows if i is not None}, edges)
    return sorted([(i, len(s), top.get(i), i is None or top[i] == i) for i, s in sets], key=str)


def result(df, **kw):
    return sorted(map(tuple, mh.near_duplicates(df, **kw).collect()), key=str)


def test_real_texts(spark):
    rows = documents()
    assert result(frame(spark, rows)) == brute(rows)


def test_large_groups_in_blocks_and_odd_rows(spark):
    rng = random.Random(2)
    base = [f"word{i}" for i in range(120)]
    common = " ".join(f"shared{i}" for i in range(30))
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(i % 7):
            w[rng.randrange(len(w))] = f"new{rng.random()}"
        rows.append((1000 - i, " ".join(w)))
    rows += [(2000 + i, common + " " + " ".join(f"own{i}x{j}" for j in range(i % 9))) for i in range(120)]
    rows += [(3000 + i, rows[3][1]) for i in range(60)]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "two one"), (None, rows[0][1]), (7, "x " * 20_000), (8, "x " * 30_000)]
    rows += [(9, "a b c d e f"), (9, "p q r s t u"), (10, "A b c d e f"), (11, "p q r s t u")]
    assert result(frame(spark, rows), block_bytes=20_000) == brute(rows)


def test_empty_tables(spark):
    assert result(frame(spark, [])) == [] and result(frame(spark, [(1, None)])) == [(1, 0, 1, True)]
    df = frame(spark, [(1, "a b")]).withColumn("rep", mh.F.lit(5)).withColumn("id", mh.F.lit("z"))
    assert result(df) == [(1, 1, 1, True)]


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(0)
    path = list(range(100, 400))
    rng.shuffle(path)
    edges = list(zip(path, path[1:])) + [(7, i) for i in range(500, 900)] + [(7, 7), (3, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in roots({x for e in edges for x in e}, edges).items() if n != 3}
