"""The divergence audit against direct sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardstat.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, min_docs, top=10):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        n[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        own = sorted(s for g, s in groups if g == lang)
        total = Counter()
        for s in own:
            total.update({t: n[lang, s][t] for t in kept})

        def share(c):
            size = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // size for t in kept}

        p, q = {s: share(n[lang, s]) for s in own}, share(total)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in own if o != s))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if n[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms)]
    return sorted(out)


def corpus(seed, n, sources=7):
    r = random.Random(seed)
    words = ["".join(r.choice("abcDEFéß") for _ in range(r.randrange(1, 5))) for _ in range(150)]
    rows = []
    for i in range(n):
        s = 0 if r.random() < 0.4 else r.randrange(sources)                # one source holds a third and more
        some = words[s * 5 :]
        rows.append((i, r.choice([" ", "1", "\x00", "_"]).join(r.choice(some[: r.choice([5, 40, 120])]) for _ in range(r.randrange(0, 60))), r.choice(["en", "de", None]), f"s{s}", 1))
    return rows


def run(spark, rows, parts=4, **settings):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumn("term", F.lit("clash")).withColumn("n", F.lit(1))
    return sorted(map(tuple, dv.audit(docs, **settings).collect()))


@pytest.mark.parametrize("seed,block,chunk", [(1, 2048, 32), (2, 16, 2), (3, 1, 3)])
def test_against_direct_sums(spark, monkeypatch, seed, block, chunk):
    monkeypatch.setattr(dv, "BLOCK", block)
    monkeypatch.setattr(dv, "CHUNK", chunk)
    rows = corpus(seed, 300)
    assert run(spark, rows, min_docs=10) == brute(rows, 10)


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, "", "", None, None), (2, "only digits 1", "xx", "a", 1), (3, None, "xx", "b", 1), (4, None, "xx", "c", 1), (None, "Wort " * 200_000, "de", "a", 1)]
    rows += [(5, "wort Ärger", "de", "b", 1)] * 12                          # repeated rows
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, rows, 1, min_docs=1) == brute(rows, 1) == run(spark, rows, 7, min_docs=1)
    assert run(spark, []) == []


def test_equal_subtrees_are_one_node():
    counts = np.array([[3, 0, 0, 0, 0, 0, 0, 0], [1, 2, 0, 0, 3, 0, 0, 0], [3, 0, 0, 0, 0, 0, 0, 0]])
    leaves, levels, roots = dv.consed(counts)
    assert len(leaves) == 4 and [len(a) for a, _ in levels] == [3, 3, 2] and roots[0] == roots[2] != roots[1]


def test_shares_are_exact():
    r = random.Random(5)
    c = np.array([r.randrange(2**52) for _ in range(2000)])
    t = np.array([int(x) + 2 + r.randrange(2**52) for x in c])
    assert dv.shares(c, np.minimum(t, 2**53 - 1)).tolist() == [1 + 10**9 * (int(x) + 2) // min(int(y), 2**53 - 1) for x, y in zip(c, t)]
    assert dv.shares(c[:5], t[:5] + 2**60).tolist() == [1 + 10**9 * (int(x) + 2) // (int(y) + 2**60) for x, y in zip(c[:5], t[:5])]


def test_node_pairs_are_priced_once(monkeypatch):
    seen = []
    plain = dv.shares
    monkeypatch.setattr(dv, "shares", lambda c, t: seen.append(len(c)) or plain(c, t))
    counts = np.zeros((10, 4096), np.int64)
    counts[:, :3] = np.arange(30).reshape(10, 3) % 4
    i, j = np.triu_indices(10, 1)
    value = dv.divergences(counts, np.full(10, 9000), i, j)
    assert max(seen) <= 16                                                 # at most 4 x 4 pairs of counts, not 45 x 4,096
    p = plain(counts.ravel(), np.full(counts.size, 9000)).reshape(counts.shape)
    assert value.tolist() == ((p[i] - p[j]) ** 2 // (p[i] + p[j])).sum(1).tolist()
