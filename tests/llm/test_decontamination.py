import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import SF, documents, frame
from wardstat.llm import decontamination as dc


def tokens(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


def distance(item, words):
    """Least edit distance of the item to any run of the words."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=20))
def test_nearest_is_exact(item, words):
    d, a, b = dc.nearest(np.array(item, np.uint64), np.array(words, np.uint64))
    assert d == distance(item, words)
    full = list(range(len(words[a:b]) + 1))
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words[a:b], 1):
            new.append(min(full[j - 1] + (x != y), full[j] + 1, new[-1] + 1))
        full = new
    assert full[-1] == d


def items(spark):
    return spark.read.parquet(SF + "/benchmark.parquet")


def test_planted_edits_are_found_and_clean_texts_left(spark):
    rng = random.Random(4)
    bench = [(r.item_id, r.text) for r in items(spark).collect()]
    rows, want = [], set()
    for i in range(300):
        body = [f"own{rng.random()}" for _ in range(rng.randint(0, 200))]
        if i % 3:
            item, text = bench[i % len(bench)]
            w = tokens(text)
            n = len(w)
            edits = n // 5 if i % 3 == 1 else 2 * n // 3
            for _ in range(edits):
                p, kind = rng.randrange(len(w)), rng.randrange(3)
                w[p : p + (kind != 1)] = [] if kind == 2 else ["Edit" + str(rng.random())[2:]]
            at = rng.randint(0, len(body))
            body[at:at] = w
            if i % 3 == 1:
                want.add((i, item))
        rows.append((i, " ".join(body)))
    got = {(r.doc_id, r.item_id) for r in dc.find_leaks(frame(spark, rows), items(spark)).collect()}
    assert len(want & got) / len(want) >= 0.99 and {i for i, _ in got} <= {i for i, _ in want}


def test_real_texts_against_brute_force(spark):
    bench = [(r.item_id, tokens(r.text)) for r in items(spark).collect()]
    rows = documents()[:120]
    got = {(r.doc_id, r.item_id): r.distance for r in dc.find_leaks(frame(spark, rows), items(spark)).collect()}
    want = {}
    for i, t in rows:
        w = tokens(t)
        own = set(w)
        for item, x in bench:
            if len(x) >= 5 and sum(y in own for y in x) >= len(x) - len(x) // 5 and (d := distance(x, w)) <= len(x) // 5:
                want[i, item] = d
    assert got == want
    kept = {r.doc_id for r in dc.remove_leaking(frame(spark, rows), items(spark)).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in want}


def test_texts_that_end_with_the_beginning_of_an_item(spark):
    bench = [(n, " ".join(f"item{n}x{j}" for j in range(n))) for n in (16, 40)]
    rows = [(0, "some words and then " + bench[0][1]), (1, bench[1][1] + " and more"), (2, "the text breaks off " + " ".join(bench[1][1].split()[:5]))]
    df = frame(spark, rows).coalesce(1).orderBy("doc_id")
    found = dc.find_leaks(df, spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found.collect()) == [(0, 16, 0), (1, 40, 0)]


def test_windows_stay_in_the_text_of_their_pair():
    n = 40
    words = np.arange(1, n + 1).astype(np.uint64)
    items = dc.Items([0], [words], {n // dc.LENGTH_STEP: 1})
    for w in dc.slices(dc.pa.array(["a b c d e", "f " * 50])):
        pair, flags = np.zeros(54, np.uint64), np.zeros(54, bool)
        pair[3], flags[3] = dc.word_pairs(words)[0], True   # the first text's last pair
        flags[5:] = True
        item, first = items.begins(w, pair, flags, np.array([0, 5]), np.array([5, 55]))
        assert (first < 5).all()


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "in in"), (None, "one two three four five six")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "ALPHA, beta! gamma; delta: epsilon zeta"), (3, "ALPHA, beta! gamma; delta: epsilon zeta"), (None, "x one two three four five six"), (4, "in " * 30_000), (5, "alpha beta gamma " * 3)]
    df = frame(spark, rows).withColumn("item_id", dc.F.lit(99)).withColumn("start", dc.F.lit("s"))
    got = sorted([tuple(r) for r in dc.find_leaks(df, bench).collect()], key=str)
    assert got == sorted([(3, 1, 0, 6, 0), (None, None, 1, 7, 0)], key=str)
    assert sorted(str(r.doc_id) for r in dc.remove_leaking(df, bench).collect()) == ["1", "2", "4", "5"]
    assert dc.find_leaks(df, bench.filter("false")).count() == 0 and dc.find_leaks(frame(spark, []), bench).count() == 0


def test_recall_is_calibrated():
    rng = np.random.default_rng(1)
    short = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in range(16, 24)]
    half, most = dc.rounds_for(short, 0.5), dc.rounds_for(short, 0.999)
    assert 1 <= half <= most <= dc.MOST_ROUNDS
    # lengths whose target the rounds don't reach, and long ones, are verified without a lookup
    by_length = dc.rounds_by_length([rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (16, 60, 200, 800, 1500)], 0.999)
    assert by_length[16 // dc.LENGTH_STEP] and by_length[800 // dc.LENGTH_STEP] is None and by_length[1500 // dc.LENGTH_STEP] is None


@pytest.mark.parametrize("n,items,plants", [(16, 40, 600), (60, 20, 300), (200, 8, 96), (800, 3, 24), (1500, 2, 12)])
def test_long_items_are_found_end_to_end(n, items, plants):
    """Every planted item with all its allowed edits is found, whatever its length."""
    rng = np.random.default_rng(n)
    word = lambda k: [f"w{x}" for x in rng.integers(0, 5000, k)]
    bench = [word(n) for _ in range(items)]
    hashed = []
    for w in dc.slices(dc.plain(dc.pa.array([" ".join(b) for b in bench]))):
        hashed += np.split(w.hashes(), np.cumsum(w.counts())[:-1])
    part = dc.Items(list(range(items)), hashed, dc.rounds_by_length(hashed, 0.999))
    texts, want = [], []
    for i in range(plants):
        body = list(bench[i % items])
        for _ in range(dc.allowed(n)):
            p, kind = int(rng.integers(len(body))), int(rng.integers(3))
            body[p : p + (kind != 1)] = [] if kind == 2 else word(1)
        texts.append(" ".join(word(40) + body + word(40)))
        want.append(i % items)
    found = {row: {i for i, *_ in leaks} for row, leaks in dc._scan(part, dc.pa.array(texts))}
    assert sum(w in found.get(i, ()) for i, w in enumerate(want)) >= 0.999 * plants


def test_parts_of_the_benchmark_share_a_scan(spark, monkeypatch):
    bench = spark.createDataFrame([(k, " ".join(f"b{k}w{j}" for j in range(20 + 40 * (k % 3)))) for k in range(12)], "item_id long, text string")
    rows = [(k, f"before {r.text} after") for k, r in enumerate(bench.collect())]
    monkeypatch.setattr(dc, "PART_BYTES", 1500)
    out = dc.find_leaks(frame(spark, rows), bench)
    assert sorted((r.doc_id, r.item_id) for r in out.collect()) == [(k, k) for k in range(12)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 2
    assert dc.remove_leaking(frame(spark, rows + [(99, "clean")]), bench).count() == 1
