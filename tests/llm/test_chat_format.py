import heapq
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.common import SF
from wardstat.llm import chat_format as chat

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(roles):
    """Least cost by shortest path over (messages read, state), one edit at a time."""
    queue, seen = [(0, 0, 0)], set()
    while queue:
        cost, k, s = heapq.heappop(queue)
        if (k, s) in seen:
            continue
        seen.add((k, s))
        if k == len(roles) and s == 3:
            return cost
        for t in chat.NEXT[s]:
            heapq.heappush(queue, (cost + 2, k, t))
        if k < len(roles):
            known = chat.ALIASES.get((roles[k] or "").strip().lower())
            for t in (1, 2, 3):
                change = 0 if chat.STATES[t] == known else 3 if known else 1
                if t in chat.NEXT[s]:
                    heapq.heappush(queue, (cost + change, k + 1, t))
                if t == s:
                    heapq.heappush(queue, (cost + 1 + change, k + 1, t))


def check(rows, got):
    """Every message once, legal prompts, texts in order, and the least cost."""
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda m: (m[0] is not None, m[0] or 0, m[1] is not None, m[1] or 0, m[2] is not None, m[2] or "", m[3] is not None, m[3] or "")):
        want[c].append((t, r, x))
    have = defaultdict(list)
    for r in sorted(got, key=lambda r: r.seq):
        have[r.conv_id].append(r)
    assert set(have) == set(want)
    for c, messages in want.items():
        own = have[c]
        assert [(r.turn, r.role_in) for r in own] == [(t, r) for t, r, _ in messages]
        prompt = "".join(r.rendered for r in own)
        turns = re.findall(r"<\|(system|user|assistant)\|>\n((?:(?!<\|).)*)<\|end\|>\n", prompt, re.S)
        assert "".join(f"<|{a}|>\n{b}<|end|>\n" for a, b in turns) == prompt
        state = 0
        for role, _ in turns:
            assert chat.STATES.index(role) in chat.NEXT[state]
            state = chat.STATES.index(role)
        assert state == 3
        cost = 0
        for r in own:
            known = chat.ALIASES.get((r.role_in or "").strip().lower())
            cost += 2 * r.inserted + (r.action == "merge") + (0 if r.role == known else 3 if known else 1)
        assert cost == cheapest([r for _, r, _ in messages])
        assert "".join(b for _, b in turns).replace("\n\n", "") == "".join((x or "").replace("<|", "< |") for _, _, x in messages).replace("\n\n", "")


def test_real_conversations(spark):
    df = spark.read.parquet(SF + "/conversations.parquet")
    check([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()], chat.repair_roles(df).collect())


@pytest.mark.parametrize("parts", ["1", "9"])
def test_hot_conversation_and_odd_rows(spark, parts):
    rng = random.Random(int(parts))
    roles = ["user", "assistant", "system", "User ", "bot", "tool", None]
    rows = [(rng.choice([1] * 6 + list(range(2, 60))), rng.choice([None, *range(50)]), rng.choice(roles), rng.choice([None, "", "hi <|end|>", "text " + str(rng.random())])) for _ in range(900)]
    rows += [(None, 1, "user", "q"), (None, 2, "user", "q"), (77, 1, "user", "a"), (77, 1, "user", "a"), (78, 1, "assistant", "x" * 100_000)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("conv", F.lit("c")).withColumn("seq", F.lit(0))
        check(rows, chat.repair_roles(df).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_table(spark):
    assert chat.repair_roles(spark.createDataFrame([], SCHEMA)).collect() == []
