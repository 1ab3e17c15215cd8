import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from tests.llm.common import frame, words
from wardstat.llm import mixing


def fill(given, children):
    """Water filling by repeated proportional shares: {name: (weight, cap)} to budgets, before rounding."""
    out, open_ = {}, {n for n, (w, c) in children.items() if w and c}
    while open_:
        level = Fraction(given - sum(out.values())) / sum(children[n][0] for n in open_)
        full = {n for n in open_ if children[n][1] <= level * children[n][0]}
        if not full:
            out |= {n: int(level * children[n][0]) for n in open_}
            break
        out |= {n: children[n][1] for n in full}
        open_ -= full
    return out


def brute(rows, weights, share, epochs, seed):
    """rows: (id, text, domain, lang, source)."""
    leaves = defaultdict(list)
    for i, t, *path in rows:
        leaves[tuple("?" if p is None else p for p in path)].append((i, len(words(t))))
    size = {k: sum(n for _, n in v) for k, v in leaves.items()}
    w = lambda level, name: weights.get(level, {}).get(name, 1)
    live = {k: epochs * n for k, n in size.items() if n and w("domain", k[0]) and w("lang", k[1]) and w("source", k[2])}
    cap = Counter()
    for k, c in live.items():
        for d in range(4):
            cap[k[:d]] += c
    budget = {(): sum(size.values()) * share[0] // share[1]}
    for d, level in enumerate(mixing.LEVELS):
        for parent in {k[:d] for k in live}:
            kids = {k[d]: (w(level, k[d]), cap[k[: d + 1]]) for k in live if k[:d] == parent}
            budget |= {(*parent, n): b for n, b in fill(budget[parent], kids).items()}
    out = []
    for k, docs in leaves.items():
        b = budget.get(k, 0)
        whole, rest = divmod(b, size[k]) if size[k] else (0, 0)
        total = 0
        for _, i, n in sorted((hashlib.md5(f"{seed}:{whole}:{'' if i is None else i}".encode()).hexdigest(), -1 if i is None else i, n) for i, n in docs):
            total += n
            out.append((None if i == -1 else i, *k, n, whole + (total <= rest and b > 0)))
    return sorted(out, key=str)


def test_shortages_go_to_siblings_first(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        source = rng.choice(["hot"] * 5 + ["s1", "s2", "s3", "s4", None])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 30])), {"hot": "web", "s1": "web", "s2": "book"}.get(source, "small"), rng.choice(["en", "en", "de", None]), source))
    rows += [(None, "a b", "web", "en", "s9"), (700, None, "none", "xx", "zero"), (5, "q", "web", "en", "hot"), (5, "q", "web", "en", "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, dom string, lang string, source string").repartition(3).withColumn("id", F.lit("x")).withColumn("n_tokens", F.lit(3))
    weights = {"domain": {"web": 1, "small": 20, "book": 3}, "lang": {"en": 3, "de": 0}, "source": {"s3": 9, "hot": 2}}
    before = mixing.PART_DOCS
    mixing.PART_DOCS = 20
    try:
        for share, epochs in (((1, 2), 2), ((3, 1), 2), ((1, 1), 4), ((0, 1), 1)):
            got = sorted(map(tuple, mixing.mix(df, F.col("dom"), weights, share, epochs, 3).collect()), key=str)
            assert got == brute(rows, weights, share, epochs, 3)
    finally:
        mixing.PART_DOCS = before


def test_empty_table(spark):
    domain, weights = mixing.stage_settings()
    assert mixing.mix(frame(spark, []), domain, weights).collect() == []
    got = sorted(tuple(r) for r in mixing.mix(frame(spark, [(1, "a b"), (2, None)]), domain, weights).collect())
    assert got == [(1, "other", "en", "src", 2, 1), (2, "other", "en", "src", 0, 2)]      # no words: taken with the empty rest, too
