"""Chat formatting with minimum-cost role repair.

The legal turns are an automaton: nothing, then at most one system message, then user and assistant in turn, ending with
an assistant. Each message is kept, merged into the message before it, or relabelled, and empty messages may be inserted;
dynamic programming over the automaton's states finds the cheapest repair, ties going to the earlier action in the order
keep, merge, insert, relabel, then to the earlier state. The repaired sequence is rendered message by message: the pieces of
a conversation, joined in order, are its prompt.

Messages are range-partitioned by conversation and turn, so one conversation may spread over many partitions. Whole
conversations of a partition are repaired as they stream by. A conversation that touches an edge of its partition is
summed up as a matrix of least costs between states; the matrices are folded in order, which fixes the states at the cuts,
and each part is then repaired between its two states. Ties at cuts go to the earlier state.

Order is by turn (nulls first), role and text. Null text is empty, unknown and null roles must be relabelled, all rows with a
null conversation are one conversation, repeated rows are messages of their own. Other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstat.session import scratch_path, small_side, stored

# Other names of the three roles.
ALIASES = {"system": "system", "user": "user", "human": "user", "assistant": "assistant", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
KEEP, MERGE, INSERT, RELABEL, RELABEL_UNKNOWN = 0, 1, 2, 3, 1
#: States are what came last.
STATES = ["start", "system", "user", "assistant"]
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FINAL = 3
NONE = 10**12


def _ways() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest run of inserted messages that leads from one state to another."""
    out = {(s, s): () for s in range(4)}
    for _ in range(4):
        for (a, b), path in list(out.items()):
            for c in NEXT[b]:
                if len(path) + 1 < len(out.get((a, c), (0,) * 9)):
                    out[a, c] = (*path, c)
    return out


WAYS = _ways()


def _steps(role: str | None) -> dict[tuple[int, int], tuple[int, int, tuple[int, ...], str]]:
    """For a message: {(from, to): (cost, rank of the action, inserted states, action)}, the best of each."""
    known = ALIASES.get((role or "").strip().lower())
    out: dict[tuple[int, int], tuple[int, int, tuple[int, ...], str]] = {}
    for a in range(4):
        for b in range(1, 4):
            change = 0 if STATES[b] == known else RELABEL if known else RELABEL_UNKNOWN
            choices = []
            for mid in range(4):
                if b in NEXT[mid] and (a, mid) in WAYS:
                    way = WAYS[a, mid]
                    action = "relabel" if change else "keep"
                    choices.append((INSERT * len(way) + change, (2 if way else 0) + (3 if change else 0), way, action))
            if a == b:
                choices.append((MERGE + change, 1 + (3 if change else 0), (), "merge"))
            if choices:
                out[a, b] = min(choices)
    return out


_CACHE: dict[str | None, dict] = {}


def steps(role: str | None) -> dict:
    if role not in _CACHE:
        if len(_CACHE) > 1000:
            _CACHE.clear()
        _CACHE[role] = _steps(role)
    return _CACHE[role]


def least_costs(roles: list[str | None]) -> list[int]:
    """The 16 least costs between states before and after these messages."""
    out = []
    for a in range(4):
        cost = [NONE] * 4
        cost[a] = 0
        for role in roles:
            new = [NONE] * 4
            for (x, y), step in steps(role).items():
                new[y] = min(new[y], cost[x] + step[0])
            cost = new
        out += cost
    return out


def closing(cost: list[int]) -> tuple[int, int]:
    """(total, state): the cheapest way to end, inserts included; the earlier state on ties."""
    return min((cost[s] + INSERT * len(WAYS[s, FINAL]), s) for s in range(4))


def repair(roles: list[str | None], start: int = 0, end: int | None = None) -> list[tuple[str, str, tuple[int, ...]]]:
    """For each message (action, role, states inserted before it), from ``start`` to ``end`` or the best last state."""
    cost, trail = [NONE] * 4, []
    cost[start] = 0
    for role in roles:
        new: list[tuple] = [(NONE, 9, 9)] * 4
        for (x, y), (c, rank, _, _) in steps(role).items():
            if cost[x] < NONE:
                new[y] = min(new[y], (cost[x] + c, rank, x))
        trail.append(new)
        cost = [n[0] for n in new]
    at = closing(cost)[1] if end is None else end
    out = []
    for role, new in zip(reversed(roles), reversed(trail)):
        came = new[at][2]
        _, _, way, action = steps(role)[came, at]
        out.append((action, STATES[at], way))
        at = came
    return out[::-1]


def head(state: int | str) -> str:
    return f"<|{state if isinstance(state, str) else STATES[state]}|>\n"


def render(action: str, role: str, before: tuple[int, ...], text: str | None, first: bool, last: bool, tail: tuple[int, ...]) -> str:
    """The piece of a prompt that one message adds; marks inside texts are broken up."""
    text = (text or "").replace("<|", "< |")
    if action == "merge":
        piece = "\n\n" + text
    else:
        piece = ("" if first else "<|end|>\n") + "".join(head(s) + "<|end|>\n" for s in before) + head(role) + text
    return piece + ("<|end|>\n" + "".join(head(s) + "<|end|>\n" for s in tail) if last else "")


NAMES = ["conv", "turn", "seq", "role_in", "action", "role", "inserted", "rendered"]


def _repaired(conv, turns: list, seqs: list, roles: list, texts: list, start: int, end: int | None, first: bool, last: bool) -> list[tuple]:
    done = repair(roles, start, end)
    state = STATES.index(done[-1][1])
    tail = WAYS[state, FINAL] if last else ()
    out = []
    for k, (action, role, before) in enumerate(done):
        here = last and k == len(done) - 1
        out.append((conv, turns[k], seqs[k], roles[k], action, role, len(before) + len(tail if here else ()), render(action, role, before, texts[k], first and k == 0, here, tail)))
    return out


def repair_roles(messages: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conversation, turn, seq, role_in, action, role, inserted, rendered) of each message.

    ``seq`` orders the messages of a conversation; ``inserted`` counts the empty messages rendered with this one.
    """
    spark = messages.sparkSession
    kind, turn_kind = messages.schema[id_col].dataType.simpleString(), messages.schema[turn_col].dataType.simpleString()
    rows = messages.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role_in"), F.col(text_col).alias("text"))
    # spreads messages of one turn as well; any fixed order of them will do, so equal rows need none
    order = ["conv", "turn", "role_in", "text"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), scratch_path(spark, "chat"))
    schema = f"conv {kind}, turn {turn_kind}, seq long, role_in string, action string, role string, inserted int, rendered string"
    # conversations that a partition's edge cuts: at most the first and the last of each partition
    edge = ranged.groupBy("part").agg(F.min_by("conv", "seq").alias("a"), F.max_by("conv", "seq").alias("b"))
    ends = edge.select("part", "a").union(edge.select("part", "b")).distinct().groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("a").alias("cut"))
    ends = stored(ends, scratch_path(spark, "chat-cuts"))
    cut = F.col("conv").eqNullSafe(F.col("cut"))
    whole = ranged.join(small_side(ends), cut, "left_anti")
    parts = ranged.join(small_side(ends), cut, "left_semi")

    def types(b) -> list[pa.DataType]:
        return [b.schema.field("conv").type, b.schema.field("turn").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]

    def out(found: list[tuple], kinds: list[pa.DataType]) -> pa.Table:
        return pa.table([pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 8, kinds)], NAMES)

    def stream(table: pa.Table) -> pa.Table:
        """All whole conversations of one bucket, in order."""
        table = table.sort_by("seq")
        conv, turn, seq, role, text = (table[c].to_pylist() for c in ("conv", "turn", "seq", "role_in", "text"))
        groups: dict = {}
        for k, c in enumerate(conv):
            groups.setdefault(c, []).append(k)
        found = []
        for c, ks in groups.items():
            pick = lambda x: [x[k] for k in ks]  # noqa: E731, B023
            found += _repaired(c, pick(turn), pick(seq), pick(role), pick(text), 0, None, True, True)
        return out(found, types(table))

    def sums(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        return pa.table({"conv": table["conv"].slice(0, 1), "part": table["part"].slice(0, 1), "matrix": pa.array([least_costs(table["role_in"].to_pylist())], pa.list_(pa.int64()))})

    def fold(table: pa.Table) -> pa.Table:
        """The states at a conversation's cuts, from its parts' matrices."""
        table = table.sort_by("part")
        matrices, cost, trail = table["matrix"].to_pylist(), [0, NONE, NONE, NONE], []
        for m in matrices:
            new = [min((min(NONE, cost[a] + m[4 * a + b]), a) for a in range(4)) for b in range(4)]
            trail.append(new)
            cost = [c for c, _ in new]
        at, bounds = closing(cost)[1], []
        for new in reversed(trail):
            bounds.append((new[at][1], at))
            at = new[at][1]
        bounds = bounds[::-1]
        n = len(bounds)
        return pa.table({"conv": table["conv"], "part": table["part"], "enters": pa.array([a for a, _ in bounds], pa.int32()), "leaves": pa.array([b for _, b in bounds], pa.int32()),
                         "first": pa.array([k == 0 for k in range(n)]), "last": pa.array([k == n - 1 for k in range(n)])})

    def between(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        one = {c: table[c][0].as_py() for c in ("conv", "enters", "leaves", "first", "last")}
        found = _repaired(one["conv"], *(table[c].to_pylist() for c in ("turn", "seq", "role_in", "text")), one["enters"], one["leaves"], one["first"], one["last"])
        return out(found, types(table))

    buckets = max(1, -(-ranged.count() // 20_000))
    done = whole.withColumn("bucket", F.pmod(F.xxhash64("conv"), F.lit(buckets))).groupBy("bucket").applyInArrow(stream, schema)
    matrix = parts.groupBy("conv", "part").applyInArrow(sums, f"conv {kind}, part int, matrix array<long>")
    bounds = matrix.groupBy("conv").applyInArrow(fold, f"conv {kind}, part int, enters int, leaves int, first boolean, last boolean")
    bounds = stored(bounds, scratch_path(spark, "chat-bounds")).withColumnsRenamed({"conv": "at", "part": "of"})
    placed = parts.join(small_side(bounds), F.col("conv").eqNullSafe(F.col("at")) & (F.col("part") == F.col("of"))).drop("at", "of")
    late = placed.groupBy("conv", "part").applyInArrow(between, schema)
    return done.union(late).withColumnsRenamed({"conv": id_col, "turn": turn_col})
