import random
from collections import defaultdict

import pyarrow as pa
import pytest

from tests.llm.common import documents, frame
from wardstat.llm import line_dedup

ROOT = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(ROOT))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n") if i is not None else []:
            held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (i is not None and len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and max(held[key(x)]) != i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.dedupe_lines(df, **kw).collect()), key=str)


def test_real_texts(spark):
    rows = documents()
    assert result(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("parts", ["1", "7"])
def test_hot_lines_over_many_ranges(spark, parts):
    rng = random.Random(5)
    hot, warm = "THE line that a third of all rows hold", ["warm line number %03d of the set" % i for i in range(40)]
    rows = [(i, "\n".join(([hot.lower() + " \t"] if i % 3 == 0 else []) + rng.choices(warm + ["x", ""], k=rng.randint(0, 6)) + ([hot] if i % 7 == 0 else []))) for i in range(600)]
    rows += [(600, None), (601, ""), (None, hot), (602, hot + "\n" + hot), (602, hot + "\n" + hot), (603, "é" * 20), (604, "é" * 20), (605, "é" * 20), (606, "é" * 19)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(frame(spark, rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_stream_does_not_depend_on_batches():
    rows = [(h, h, d, 0, p) for h in (1, 2, 2, 3, 5) for d in (9, 8, 4) for p in (0, 1)]
    rows = sorted(set(rows), key=lambda r: (r[0], -r[2], r[4]))
    names = ["h1", "h2", "doc", "body", "pos"]
    t = pa.table({n: pa.array([r[i] for r in rows], pa.int32() if n == "pos" else pa.int64()) for i, n in enumerate(names)})
    runs = []
    for size in (1, 2, 5, 100):
        got = [tuple(r.values()) for b in line_dedup._decide(3)(iter(t.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        runs.append(sorted(got))
    assert all(r == runs[0] for r in runs)
    assert {r[0] for r in runs[0] if r[5] == 2} == {1, 5} and {r[0] for r in runs[0] if r[5] == 0} == {2, 3}


def test_empty_table_and_clashing_columns(spark):
    assert result(frame(spark, [])) == []
    df = frame(spark, [(1, "a")]).withColumn("n_lines", line_dedup.F.lit("old")).withColumn("doc", line_dedup.F.lit(7)).withColumn("key", line_dedup.F.lit("k"))
    row = line_dedup.dedupe_lines(df).collect()[0].asDict()
    assert row["n_lines"] == 1 and row["doc"] == 7 and row["key"] == "k" and row["lang"] == "en"
