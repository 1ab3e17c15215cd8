import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import documents, frame, words
from wardstat.llm import chunks, substring_dedup


def brute(rows, size=13):
    owner = {}
    for i, t in rows:
        w = words(t)
        for a in range(len(w) - size + 1) if i is not None else ():
            k = tuple(w[a : a + size])
            owner[k] = min(owner.get(k, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for a in range(len(w) - size + 1) if i is not None else ():
            if owner[tuple(w[a : a + size])] < i:
                gone.update(range(a, a + size))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return sorted(out, key=str)


def result(df, **kw):
    rows = substring_dedup.remove_repeats(df, **kw).collect()
    assert all(sum(s["end"] - s["start"] for s in r.spans) == r.n_removed for r in rows)
    assert all(a["end"] < b["start"] for r in rows for a, b in zip(r.spans, r.spans[1:]))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in rows), key=str)


@pytest.mark.parametrize("chunk_bytes, bucket_bytes", [(8 << 20, 16 << 20), (20_000, 30_000)])
def test_real_texts(spark, chunk_bytes, bucket_bytes):
    rows = documents()
    assert result(frame(spark, rows), chunk_bytes=chunk_bytes, bucket_bytes=bucket_bytes) == brute(rows)


def test_copies_gaps_in_ids_and_odd_rows(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for n in range(300):
        i = rng.choice([n, n * 1000, -n, 10**12 + n])
        own = " ".join(rng.choices("abcdefg", k=rng.randint(0, 40)))
        rows.append((i, own + "\n" + passage * (n % 3 == 0) + " " + own))
    rows += [(5, None), (6, ""), (7, " \t\n"), (None, passage), (None, None), (8, passage), (8, passage), (9, "x " * 3000), (10, "x " * 3000)]
    assert result(frame(spark, rows), chunk_bytes=2_000, bucket_bytes=4_000) == brute(rows)


def test_empty_table(spark):
    assert result(frame(spark, [])) == [] and result(frame(spark, [(None, "a b")])) == [(None, 2, 0, "a b")]


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=50), st.integers(1, 9))
def test_questions_round_trip(keys, buckets):
    plan = chunks.Layout((0, 1), 1, buckets)
    sorted_keys = np.array(sorted(keys), np.uint64)
    got = chunks.questions(3, sorted_keys, plan).to_pylist()
    back = [chunks.unpack(r["keys"], plan.bucket_starts()[r["bucket"]]) for r in got]
    assert np.array_equal(np.concatenate([np.zeros(0, np.uint64), *back]), sorted_keys) and len({r["bucket"] for r in got}) == len(got)


def test_chunks_hold_equal_amounts_however_the_ids_lie(spark):
    ids = [base * 10**15 + k for base in range(10) for k in range(2000)] + [2**62, -(2**62)]
    docs = spark.createDataFrame([(i, "x" * (500 + i % 7)) for i in ids], "doc_id long, text string")
    plan = chunks.layout(docs, "doc_id", "text", chunk_bytes=50_000)
    sizes = sorted(r["count"] for r in docs.groupBy(plan.chunk_column("doc_id", chunks.F.xxhash64("text")).alias("c")).count().collect())
    assert len(sizes) > 150 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    order = [(r.doc_id, r.c) for r in docs.select("doc_id", plan.chunk_column("doc_id", chunks.F.xxhash64("text")).alias("c")).orderBy("doc_id").collect()]
    assert [c for _, c in order] == sorted(c for _, c in order)


def test_a_chunk_visits_only_the_buckets_it_uses():
    plan = chunks.Layout((0, 1), 1, 1_000_000)
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 50).astype(np.uint64))
    runs = plan.bucket_runs(keys)
    assert len(runs) <= 50 and [k for _, a, b in runs for k in keys[a:b]] == keys.tolist() and plan.bucket_runs(keys[:0]) == []
    starts = plan.bucket_starts()
    assert all(starts[x] <= keys[a] and (x + 1 == len(starts) or keys[b - 1] < starts[x + 1]) for x, a, b in runs)
