import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.common import documents, frame
from wardstat.llm import lm_scoring as lm


def low(text):
    return [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in (text or "").encode().split()] + [None]


def train(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 != 2


def brute(rows):
    """Exact counts in place of the filter's quantised ones."""
    one, two = Counter(), Counter()
    for i, t in rows:
        if train(i):
            w = low(t)
            one.update(w)
            two.update(zip([0, *w], w))
    n, v, out = sum(one.values()), len(one), []
    for i, t in rows:
        w = low(t)
        logs = []
        for a in lm.WEIGHTS:
            s = 0.0
            for h, x in zip([0, *w], w):
                c, ch = two[h, x], one[None] if h == 0 else one[h]
                q = 2 ** (c.bit_length() - 1) if c else 0
                s += math.log10(a * (q / ch if ch else 0) + (1 - a) * (one[x] + 1) / (n + v + 1))
            logs.append(s)
        top = max(logs)
        out.append((i, len(w), sum(one[x] > 0 for x in w), n, logs[0], top + math.log10(sum(10 ** (x - top) for x in logs) / len(logs))))
    return out


def result(df, **kw):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return [tuple(r) for r in lm.score_texts(df, ~held, **kw).collect()]


@pytest.mark.parametrize("kw", [{}, {"broadcast_bytes": 0}, {"chunk_bytes": 30_000, "bucket_bytes": 50_000}, {"chunk_bytes": 30_000, "bucket_bytes": 20_000, "broadcast_bytes": 0}])
def test_counts_and_scores(spark, kw):
    rows = documents()[:100] + [(900, None), (901, ""), (None, "The the"), (902, "the " * 4000), (902, "the " * 4000)]
    key = lambda r: (str(r[0]), r[4])
    got, want = sorted(result(frame(spark, rows), **kw), key=key), sorted(brute(rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    # base scores are exact; a bigram never seen passes for a seen one in one of 2^PROBES cases, which can only raise a score
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-12) and all(w[5] - 1e-9 * abs(w[5]) <= g[5] <= w[5] + 4e-3 * abs(w[5]) for g, w in zip(got, want))
    held = [g for g in got if not train(g[0])]
    assert sum(g[5] for g in held) > sum(g[4] for g in held)


def test_broadcast_and_routed_shares_agree(spark):
    rows = documents()[:100]
    one, two = (sorted(result(frame(spark, rows), chunk_bytes=30_000, bucket_bytes=20_000, broadcast_bytes=b)) for b in (0, 1 << 30))
    assert one == two


@pytest.mark.parametrize("n", [2_000, 200_000])
def test_every_bigram_is_held_at_any_size_with_the_same_error(n):
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    counts = np.where(np.arange(len(keys)) % 10 == 0, 20, 1 + np.arange(len(keys)) % 3)
    starts = np.array([0, 1 << 61, 1 << 62], np.uint64)
    of = np.searchsorted(starts, keys, side="right") - 1
    f = lm.Filter([lm.build_share(keys[of == k], counts[of == k]) for k in range(3)], starts)
    got = f.levels(keys)
    assert (got >= lm.quantised(counts)).all() and (got > lm.quantised(counts)).mean() < 0.003
    assert (f.levels(rng.integers(0, 1 << 63, 100_000).astype(np.uint64)) > 0).mean() < 0.0015
    assert lm.Filter([lm.build_share(keys[:0], counts[:0])], starts[:1]).levels(keys[:9]).max() == 0


def test_empty_and_untaught(spark):
    assert result(frame(spark, [])) == []
    assert [r[:4] for r in result(frame(spark, [(None, "a b")]))] == [(None, 3, 0, 0)]
