"""Ordered operators that stay parallel when one key holds most of the rows.

A plain window puts a whole key into one task. Here each key is cut into
chunks along its order (a day, a month, an hour): the window runs inside the
chunks, one summary row per chunk carries state from chunk to chunk, and a
join puts the carried state back. The result equals the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(df: DataFrame, keys: list[str], chunk: str, order: list[str], *,
            lag: list[str] = (), lead: list[str] = (), running: list[str] = (),
            last_seen: list[str] = ()) -> DataFrame:
    """Add prev_<c>, next_<c>, run_<c> (running sum), last_<c> (last non-null so far).

    ``order`` must be a total order within a key, and ``chunk`` must not
    decrease along it.
    """
    part = [*keys, chunk]
    w = Window.partitionBy(*part).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rank = F.struct(*order)
    out = df.withColumn("_edge_lo", F.row_number().over(w) == 1)
    if lead:
        out = out.withColumn("_edge_hi", F.lead(F.lit(1)).over(w).isNull())
    aggs, carry = [], []
    by_chunk = Window.partitionBy(*keys).orderBy(chunk)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    for c in lag:
        out = out.withColumn(f"prev_{c}", F.lag(c).over(w))
        aggs.append(F.max_by(c, rank).alias(f"_t_{c}"))
        carry.append(F.lag(f"_t_{c}").over(by_chunk).alias(f"_p_{c}"))
    for c in lead:
        out = out.withColumn(f"next_{c}", F.lead(c).over(w))
        aggs.append(F.min_by(c, rank).alias(f"_h_{c}"))
        carry.append(F.lead(f"_h_{c}").over(by_chunk).alias(f"_n_{c}"))
    for c in running:
        out = out.withColumn(f"run_{c}", F.sum(F.coalesce(F.col(c), F.lit(0))).over(upto))
        aggs.append(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"_s_{c}"))
        carry.append(F.coalesce(F.sum(f"_s_{c}").over(earlier), F.lit(0)).alias(f"_r_{c}"))
    for c in last_seen:
        out = out.withColumn(f"last_{c}", F.last(c, ignorenulls=True).over(upto))
        aggs.append(F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(f"_l_{c}"))
        carry.append(F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_k_{c}"))
    # An aggregate used as both lag and lead source would clash by name only
    # across kinds, so every kind has its own prefix.
    state = df.groupBy(*part).agg(*aggs).select(*part, *carry)
    out = out.join(state, part, "left")
    for c in lag:
        out = out.withColumn(f"prev_{c}", F.when(F.col("_edge_lo"), F.col(f"_p_{c}")).otherwise(F.col(f"prev_{c}")))
    for c in lead:
        out = out.withColumn(f"next_{c}", F.when(F.col("_edge_hi"), F.col(f"_n_{c}")).otherwise(F.col(f"next_{c}")))
    for c in running:
        out = out.withColumn(f"run_{c}", F.col(f"run_{c}") + F.col(f"_r_{c}"))
    for c in last_seen:
        out = out.withColumn(f"last_{c}", F.coalesce(f"last_{c}", f"_k_{c}"))
    return out.drop("_edge_lo", "_edge_hi", *[f"_p_{c}" for c in lag], *[f"_n_{c}" for c in lead],
                    *[f"_r_{c}" for c in running], *[f"_k_{c}" for c in last_seen])


def covered_spans(polls: DataFrame, keys: list[str], t: str, max_gap: float, chunk_s: int = 86400) -> DataFrame:
    """Spans of uninterrupted polling: a gap longer than ``max_gap`` seconds breaks them.

    ``t`` is epoch seconds. Spans of zero length are dropped.
    """
    p = (polls.select(*keys, t).distinct()
         .withColumn("_chunk", F.floor(F.col(t) / chunk_s)))
    p = ordered(p, keys, "_chunk", [t], lag=[t])
    p = p.withColumn("_brk", F.when(F.col(t) - F.col(f"prev_{t}") <= max_gap, 0).otherwise(1))
    p = ordered(p.drop(f"prev_{t}"), keys, "_chunk", [t], running=["_brk"])
    return (p.groupBy(*keys, "run__brk").agg(F.min(t).alias("span_start"), F.max(t).alias("span_end"))
            .where("span_end > span_start").drop("run__brk"))


def poll_index(polls: DataFrame, t: str, chunk_s: int = 86400) -> DataFrame:
    """Distinct polls with a dense index from 1 and the times of the two polls after each."""
    p = (polls.select(t).distinct().withColumn("_all", F.lit(0)).withColumn("_one", F.lit(1))
         .withColumn("_chunk", F.floor(F.col(t) / chunk_s)))
    p = ordered(p, ["_all"], "_chunk", [t], running=["_one"], lead=[t])
    p = p.withColumnsRenamed({"run__one": "i", f"next_{t}": "after1"})
    p = ordered(p, ["_all"], "_chunk", [t], lead=["after1"])
    return p.select(t, "i", "after1", F.col("next_after1").alias("after2"))


# Seconds after which a vanished outage is a new event, and the
# age and tolerance of the "estimate after one hour".
REAPPEAR_S, ESTIMATE_AT_S, ESTIMATE_SLACK_S = 7200, 3600, 600


def outage_events(obs: DataFrame, polls: DataFrame, chunk_s: int = 86400) -> DataFrame:
    """Follow each outage through the polls and fold its sightings into events.

    ``obs``: outage, t, start_ts, etr (epoch seconds), cust, planned, lon, lat;
    one row per outage and poll. ``polls``: t of every successful poll.
    """
    ix = poll_index(polls, "t", chunk_s)
    o = obs.join(ix, "t").withColumn("_chunk", F.floor(F.col("t") / chunk_s))
    o = ordered(o, ["outage"], "_chunk", ["t"], lag=["i", "after1"])
    absent = F.col("i") - F.col("prev_i") - 1
    gone_for = F.col("t") - F.col("prev_after1")
    o = (o.withColumn("new_event", F.coalesce((absent >= 2) & (gone_for > REAPPEAR_S), F.lit(True)).cast("int"))
         .withColumn("back", (F.col("new_event") == 0) & (absent >= 2)).drop("prev_i", "prev_after1"))
    o = ordered(o, ["outage"], "_chunk", ["t"], running=["new_event"], lead=["i", "new_event"])
    o = (o.withColumnRenamed("run_new_event", "event")
         .withColumn("certain", F.coalesce((F.col("next_i") == F.col("i") + 1) & (F.col("next_new_event") == 0),
                                           F.lit(False)))
         .withColumn("cust_s", F.col("cust") * F.coalesce(F.col("after1") - F.col("t"), F.lit(0))))
    key = ["outage", "event"]
    ev = o.groupBy(*key).agg(
        F.coalesce(F.min("start_ts"), F.min("t")).alias("start"),
        F.min("t").alias("first_seen"), F.max("t").alias("last_seen"),
        F.max_by(F.struct("after1", "after2"), "t").alias("_gone"),
        F.max("back").alias("reappeared"), F.max("cust").alias("max_cust"),
        (F.coalesce(F.sum(F.when(F.col("certain"), F.col("cust_s"))), F.lit(0)) / 3600).alias("cust_hours_lo"),
        (F.coalesce(F.sum("cust_s"), F.lit(0)) / 3600).alias("cust_hours_hi"),
        F.min_by("etr", F.when(F.col("etr").isNotNull(), F.col("t"))).alias("first_etr"),
        F.max_by("etr", F.when(F.col("etr").isNotNull(), F.col("t"))).alias("final_etr"),
        F.max("planned").alias("planned"),
        F.min_by(F.struct("lon", "lat"), F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(),
                                                 F.col("t"))).alias("_loc"))
    # The estimate shown an hour in depends on the event's start, so it takes
    # a second pass over the sightings.
    hour = (o.select(*key, "t", "etr").join(ev.select(*key, "start"), key)
            .where(F.col("t") <= F.col("start") + ESTIMATE_AT_S)
            .groupBy(*key).agg(F.max_by(F.struct("t", "etr"), "t").alias("_at")))
    confirmed = F.col("_gone.after2").isNotNull()
    ev = ev.join(hour, key, "left").select(
        F.concat_ws("-", F.col("outage").cast("string"), F.col("event").cast("string")).alias("event_id"),
        "outage", "start", "first_seen", "last_seen", confirmed.alias("confirmed"),
        F.when(confirmed, F.col("last_seen")).alias("restored_lo"),
        F.when(confirmed, F.col("_gone.after1")).alias("restored_hi"),
        "reappeared", "max_cust", "cust_hours_lo", "cust_hours_hi", "first_etr",
        F.when(F.col("_at.t") >= F.col("start") + ESTIMATE_AT_S - ESTIMATE_SLACK_S, F.col("_at.etr")).alias("etr_60m"),
        "final_etr", "planned", F.col("_loc.lon").alias("lon"), F.col("_loc.lat").alias("lat"))
    mid = (F.col("restored_lo") + F.col("restored_hi")) / 2
    return (ev.withColumn("restored_mid", mid)
            .withColumn("restoration_span_s", F.col("restored_hi") - F.col("restored_lo"))
            .withColumn("duration_s", F.coalesce(mid, F.col("last_seen")) - F.col("start")))


def headway_gaps(events: DataFrame, keys: list[str], chunk: Column | None = None) -> DataFrame:
    """Observed gaps between consecutive arrivals at a stop, in scheduled order.

    Confirmed ghosts are skipped, so a gap spans them; anything whose outcome
    is unknown breaks the chain. Times are epoch seconds.
    """
    seen = F.col("measurable") & (F.col("status") == "observed")
    e = (events.where(~F.coalesce(F.col("measurable") & (F.col("status") == "ghost"), F.lit(False)))
         .withColumn("arr", F.when(seen, F.col("arrival")))
         .withColumn("_chunk", chunk if chunk is not None else F.floor(F.col("scheduled") / 3600)))
    e = ordered(e, keys, "_chunk", ["scheduled", "trip_id"], lag=["arr"])
    return (e.withColumn("gap", F.col("arr") - F.col("prev_arr")).where("gap > 0")
            .select(*keys, "scheduled", "gap"))


def scheduled_gaps(events: DataFrame, keys: list[str], chunk: Column | None = None) -> DataFrame:
    e = events.withColumn("_chunk", chunk if chunk is not None else F.floor(F.col("scheduled") / 3600))
    e = ordered(e, keys, "_chunk", ["scheduled", "trip_id"], lag=["scheduled"])
    return (e.withColumn("gap", F.col("scheduled") - F.col("prev_scheduled")).where("gap is not null")
            .select(*keys, "scheduled", "gap"))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column], cols: list[str]) -> DataFrame:
    """The row of each key with the greatest order tuple; combined map-side, no sort."""
    pick = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                          F.struct(*cols).alias("_row"))).alias("_pick")
    return df.groupBy(*keys).agg(pick).select(*keys, "_pick._row.*")
