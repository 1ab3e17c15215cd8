"""The Merkle manifest against a plain recursive one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wardstat.llm import merkle_manifest as mm
from wardstat.llm.queries import op11
from wardstat.plans.registry import Tables

from .common import SCHEMA


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def climb(nodes):
    """(root, siblings of each node level by level as (left, right))."""
    paths, place, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for p, i in zip(paths, place):
            a = i // 8 * 8
            p.append(("".join(level[a:i]), "".join(level[i + 1 : a + 8])))
        level, place = [H(*level[a : a + 8]) for a in range(0, len(level), 8)], [i // 8 for i in place]
    return level[0], paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[("" if r[2] is None else "=" + r[2]).encode()].append(r)
    trees = {}
    for lang, own in groups.items():
        own.sort(key=lambda r: (-(2**63) if r[0] is None else r[0], leaf(r, r[1])))
        trees[lang] = (own, *climb([leaf(r, r[1]) for r in own]))
    if not rows:
        return []
    order = sorted(trees)
    root, above = climb([trees[k][1] for k in order])
    out = []
    for k, upper in zip(order, above):
        own, sub, paths = trees[k]
        for r, path in zip(own, paths):
            path = path + upper
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for left, right in path:
                node = H(left, node, right)
            out.append((r[0], leaf(r, r[1]), sub, root, H(*(x for p in path for x in p)), node, node == root))
    return out


def run(spark, rows, parts=5):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)

    class Own(Tables):
        documents = docs

    return sorted(map(tuple, op11(Own(spark, "")).collect()), key=repr)


def odd_rows(n, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        i = r.choice([r.randrange(200), r.randrange(10**6), r.randrange(-(2**63), 2**63)])
        rows.append((i, r.choice(["", "Über ABC", "abc", "X" * r.randrange(50)]), r.choice(["en", "de", "", "xx"]), r.choice(["s", None]), r.choice([1, None])))
    return rows


@pytest.mark.parametrize("n", [0, 1, 9, 65, 700])
def test_sizes(spark, n):
    rows = odd_rows(n, n)
    assert run(spark, rows) == sorted(brute(rows), key=repr)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, "A", None, None, None), (None, "A", None, None, None), (None, None, None, "s", 1), (3, None, None, "s", 1), (7, "B" * 3_000_000, "en", "s", 3_000_000)]
    rows += [(5, f"Text {i % 40}", "en", "s", i % 3) for i in range(900)]          # one id holds most rows
    assert run(spark, rows) == sorted(brute(rows), key=repr)
    assert run(spark, rows, 1) == run(spark, rows, 9)


def test_many_languages(spark):
    rows = [(i, "t", f"l{i % 90:03}é", "s", 1) for i in range(300)]
    assert run(spark, rows) == sorted(brute(rows), key=repr)


def test_every_change_is_seen(spark):
    rows = odd_rows(300, 1)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("leaf", F.lit("clash")).withColumn("path", F.lit(1))
    out = mm.manifest(docs, F.concat(F.coalesce("text", F.lit("")), F.lit("!")))
    assert out.filter(mm.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert out.filter(mm.fold(F.col("other"), F.col("path")) == F.col("root")).count() == 0 and out.count() == 300


def test_ranks_follow_the_ids(spark):
    r = random.Random(3)
    ids = sorted(r.sample(range(-(2**40), 2**40), 500) + list(range(700)))
    df = spark.createDataFrame([(i,) for i in ids], "k long").select(F.lit("=a").alias("lk"), "k", F.col("k").alias("doc_id"), F.col("k").cast("string").alias("leaf"), F.lit(None).cast("string").alias("other"), F.lit(1).cast("long").alias("copies"))
    rows, totals = mm.ranked(df)
    assert [x.doc_id for x in rows.orderBy("pos").collect()] == ids and [x.pos for x in rows.orderBy("pos").collect()] == list(range(len(ids)))
    assert totals.first().total == len(ids)
