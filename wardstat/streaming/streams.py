"""Structured Streaming forms of the collectors: files land, streams read them.

Functions on streaming DataFrames are plain DataFrame -> DataFrame code; only
``drain`` starts a query. Batch operators stay the ground truth.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from wardstat.operators.sequences import poll_index
from wardstat.session import cut_lineage, scratch_path

# Properties an outage feature must carry.
OUTAGE_PROPERTIES = ("OUTAGE_NO", "TIME_STAMP", "STATUS", "EST_REPAIR_TIME", "CUR_CUST_AFF")


# --- running a stream over landed files ---------------------------------------

def drain(stream: DataFrame, name: str, mode: str = "append", keys: list[str] | None = None, progress: list | None = None) -> DataFrame:
    """Run a stream over everything that has landed and read the result table back.

    In update mode every micro-batch writes its rows with the batch number and
    the reader keeps the newest row per key. The checkpoint makes a restarted
    run go on where it stopped; a repeated batch is written to the same folder.
    ``progress`` gets, for each micro-batch, the rows in, the rows dropped as late
    and the rows of state each operator holds after it.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    out, state = f"{base}/table", f"{base}/checkpoint"
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True)
    if mode == "append":
        q = w.format("parquet").option("path", out).start()
    else:
        def save(batch: DataFrame, n: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
        q = w.foreachBatch(save).start()
    q.awaitTermination()
    if progress is not None:
        for p in q.recentProgress:
            ops = p["stateOperators"]
            progress.append({"rows": p["numInputRows"], "late": sum(o["numRowsDroppedByWatermark"] for o in ops), "state": {o["operatorName"]: o["numRowsTotal"] for o in ops}})
    schema = stream.schema
    if mode == "append":
        return spark.read.schema(schema).parquet(out)
    rows = spark.read.parquet(out)
    cols = [c for c in schema.names if c not in (keys or [])]
    return rows.groupBy(*keys).agg(F.max(F.struct("batch", *cols)).alias("r")).select(*keys, *[f"r.{c}" for c in cols])


def land(df: DataFrame, name: str, by: str, files: int = 4, fmt: str = "parquet", tail: DataFrame | None = None) -> str:
    """Write a table as ordered files in a landing folder, the ``tail`` rows (a closing tick) last."""
    path = scratch_path(df.sparkSession, name)
    df.repartitionByRange(files, by).write.format(fmt).save(path)
    if tail is not None:
        tail.coalesce(1).write.mode("append").format(fmt).save(path)
    return path


def land_in_order(df: DataFrame, name: str, by: str, files: int = 4) -> str:
    """Files of equal shares that land one after the other along ``by``, as a collector's do."""
    path, df = scratch_path(df.sparkSession, name), cut_lineage(df)
    cuts = df.agg(F.percentile_approx(by, [k / files for k in range(1, files)], 1000)).first()[0] or []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = df.where((F.col(by) > low) if low is not None else F.lit(True)).where((F.col(by) <= high) if high is not None else F.lit(True))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def read_landed(spark: SparkSession, path: str, schema, fmt: str = "parquet", per_trigger: int = 2) -> DataFrame:
    r = spark.readStream.option("maxFilesPerTrigger", per_trigger).format(fmt)
    return (r.schema(schema) if schema is not None else r).load(path)


# --- operators -------------------------------------------------------------------

def dedupe_reports(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """First report per key within the watermark; state older than the delay is dropped."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


VEHICLE_SCHEMA = ("entity_id string, vehicle struct<id string, label string>, trip struct<trip_id string, route_id string>, "
                  "position struct<latitude double, longitude double>, timestamp bigint")
ALERT_SCHEMA = ("id string, alert struct<header string, effect string, "
                "active_period array<struct<start bigint, end bigint>>, "
                "informed_entity array<struct<route_id string, stop_id string>>>")


def decode_vehicles(lines: DataFrame, col: str = "value") -> DataFrame:
    v = lines.select(F.from_json(col, VEHICLE_SCHEMA).alias("v")).where("v is not null")
    return v.select("v.entity_id", F.col("v.vehicle.id").alias("vehicle_id"), F.col("v.vehicle.label").alias("vehicle_label"),
                    "v.trip.trip_id", "v.trip.route_id", F.col("v.position.latitude").alias("lat"),
                    F.col("v.position.longitude").alias("lon"), "v.timestamp")


def decode_alerts(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row per alert, active period and informed entity; alerts without either are kept."""
    a = lines.select(F.from_json(col, ALERT_SCHEMA).alias("a")).where("a is not null")
    a = a.select(F.col("a.id").alias("alert_id"), "a.alert.*")
    a = a.select("alert_id", "header", "effect", F.explode_outer("active_period").alias("p"), "informed_entity")
    return (a.select("alert_id", "header", "effect", F.col("p.start").alias("period_start"), F.col("p.end").alias("period_end"),
                     F.explode_outer("informed_entity").alias("e"))
            .select("alert_id", "header", "effect", "period_start", "period_end", "e.route_id", "e.stop_id"))


def parse_outages(docs: DataFrame, poll: str, body: str) -> DataFrame:
    """Feature collections to (poll, ok, problem, feature columns).

    A document that is not a feature collection, or has a feature without a
    required property, is a failed poll: one row with ok = false and no feature.
    """
    schema = ("type string, features array<struct<properties map<string,string>, "
              "geometry struct<coordinates array<double>>>>")
    d = docs.select(poll, F.from_json(body, schema).alias("d"))
    need = F.array(*[F.lit(p) for p in OUTAGE_PROPERTIES])
    lacking = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "d.features", lambda f: F.array_except(need, F.map_keys(f.properties))))))
    problem = (F.when(F.col("d").isNull() | F.col("d.type").isNull() | (F.col("d.type") != "FeatureCollection")
                      | F.col("d.features").isNull(), "not_features")
               .when(F.size(lacking) > 0, F.concat(F.lit("properties_absent: "), F.array_join(lacking, ", "))))
    d = d.withColumn("problem", problem)
    d = d.withColumn("f", F.explode_outer(F.when(F.col("problem").isNull(), F.col("d.features"))))
    prop = lambda p: F.trim(F.col("f.properties")[p]).alias(p.lower())
    return d.select(poll, F.col("problem").isNull().alias("ok"), "problem", *[prop(p) for p in OUTAGE_PROPERTIES],
                    F.try_element_at("f.geometry.coordinates", F.lit(1)).alias("lon"),
                    F.try_element_at("f.geometry.coordinates", F.lit(2)).alias("lat"))


def page_text(html: Column) -> Column:
    """Tags removed, blanks collapsed, common entities decoded."""
    t = F.regexp_replace(html, r"<[^>]+>", " ")
    t = F.regexp_replace(t, r"\s+", " ")
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "(c)"), ("&middot;", "|"), ("&amp;", "&")):
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return t


# The labels on the utility's summary page. A share stands before a label, a count after it.
SUMMARY_LABELS = {"with_power": "Customers With Power", "without_power": "Customers Without Power"}
SUMMARY_TIME_LABEL = "CURRENT AS OF"


def parse_summary(pages: DataFrame, html: str = "html") -> DataFrame:
    """Totals stated in a page's text. ``ok`` is false, and ``problem`` names it, where a figure is not found."""
    t = page_text(F.col(html))
    # The words next to a label: the last before it and the first after it.
    side = lambda label, k: F.split(t, label, 2)[k]
    has = lambda label: t.contains(label)
    share = lambda x: F.when(has(x), F.regexp_replace(F.element_at(F.split(F.trim(side(x, 0)), " "), -1), "%$", "").try_cast("double"))
    count = lambda x: F.when(has(x), F.replace(F.split(F.trim(side(x, 1)), " ")[0], F.lit(","), F.lit("")).try_cast("bigint"))
    stamp = F.when(has(SUMMARY_TIME_LABEL), F.array_join(F.slice(F.split(F.trim(side(SUMMARY_TIME_LABEL, 1)), " "), 1, 3), " "))
    found = {}
    for name, label in SUMMARY_LABELS.items():
        found |= {f"pct_{name}": share(label), f"customers_{name}": count(label)}
    found["current_as_of_local"] = F.when(F.try_to_timestamp(stamp, F.lit("MM/dd/yyyy h:mm a")).isNotNull(), stamp)
    absent = F.array_join(F.filter(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in found]), lambda x: x.isNotNull()), ", ")
    rest = [c for c in pages.columns if c != html]
    out = pages.withColumns(found).select(*rest, *found)
    return out.withColumn("problem", F.when(absent != "", F.concat(F.lit("figures_absent: "), absent))).withColumn("ok", F.col("problem").isNull())


def uptime_windows(polls: DataFrame, keys: list[str], ts: str, gap: str, delay: str) -> DataFrame:
    """Spans of uninterrupted polling. A session ends one gap after its last poll; that is taken off again."""
    w = F.session_window(ts, gap)
    s = polls.withWatermark(ts, delay).groupBy(*keys, w.alias("w")).agg(F.min(ts).alias("span_start"), F.max(ts).alias("span_end"))
    return s.where("span_end > span_start").select(*keys, "span_start", "span_end")


def poll_counts(obs: DataFrame, ts: str, width: str, delay: str, customers: str) -> DataFrame:
    """Reports and customers affected per tumbling window."""
    g = obs.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"))
    a = g.agg(F.count(F.lit(1)).alias("reports"), F.sum(customers).alias("customers"))
    return a.select(F.col("w.start").alias("window_start"), "reports", "customers")


CHAIN_SCHEMA = ("outage string, event bigint, first_seen bigint, last_seen bigint, restored_hi bigint, "
                "reappeared boolean, max_cust double")
#: One open or idle event of an outage: its number, sightings, the two polls after the last one, and whether it was reported.
CHAIN_STATE = "event bigint, first bigint, last bigint, i bigint, after1 bigint, after2 bigint, back boolean, most double, reported boolean"
#: Seconds after which an outage without a sighting is forgotten, number and all.
FORGET_S = 30 * 86_400


def poll_notes(polls: DataFrame) -> DataFrame:
    """What each poll says of the poll two before it: after2 (its own time), after1, t and the number i of that poll."""
    return poll_index(polls, "t").where("after2 is not null").select("t", "i", "after1", "after2")


def with_heartbeats(sightings: DataFrame, polls: DataFrame) -> DataFrame:
    """Sightings and one row without an outage for each poll, so that time goes on where nothing is out."""
    return sightings.select("t", "outage", "cust").unionByName(polls.select("t", F.lit(None).cast("string").alias("outage"), F.lit(None).cast("double").alias("cust")))


def with_next_polls(sightings: DataFrame, notes: DataFrame, delay: str) -> DataFrame:
    """Stream of sightings ``with_heartbeats`` with the number of their poll and the times of the two polls after it.

    A sighting waits in the join's state until the second poll after it has landed, and both sides are dropped once the
    watermark has passed them.
    """
    s = sightings.withColumn("ts", F.timestamp_seconds("t")).withWatermark("ts", delay)
    n = notes.select(F.timestamp_seconds("t").alias("poll_ts"), "i", "after1", "after2").withWatermark("poll_ts", delay)
    return s.join(n, F.col("ts") == F.col("poll_ts")).select("ts", "outage", "t", "cust", "i", "after1", "after2")


def polls_seen(frames: list[pd.DataFrame]) -> Iterator[tuple]:
    """t, i, after1, after2 and cust of an outage's sightings in order, one for each poll: the largest of each (no customers: left out)."""
    t, *rest = (np.concatenate([f[c].to_numpy() for f in frames]) for c in ("t", "i", "after1", "after2", "cust"))
    order = np.argsort(t, kind="stable")
    t = t[order]
    first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    return zip(t[first].tolist(), *(np.fmax.reduceat(c[order], first).tolist() for c in rest))


def event_chains(rows: DataFrame, reappear_s: int = 7200, forget_s: int = FORGET_S) -> DataFrame:
    """Finished outage events from a stream of sightings ``with_next_polls``; state is kept per outage.

    A sighting continues its outage's event unless two polls or more were without it and it was gone for more than
    ``reappear_s``. An event is finished by the watermark: once that is past ``reappear_s`` after the poll that first
    lacked the outage, and past a second poll, no sighting to come can continue it. After ``forget_s`` without a sighting
    the outage's state is removed. Sightings behind the watermark are dropped by the join and counted in the query's
    progress (see ``drain``).
    """
    def ends(st: dict) -> int:
        return 1000 * max(st["after1"] + reappear_s + 1, st["after2"])

    def report(outage: str, st: dict) -> tuple:
        st["reported"] = True
        return outage, st["event"], st["first"], st["last"], st["after1"], st["back"], st["most"]

    def step(key, frames, state):
        if key[0] is None:                                  # heartbeats
            return
        names = [c.split()[0] for c in CHAIN_STATE.split(", ")]
        st = dict(zip(names, state.get)) if state.exists else None
        now, done = state.getCurrentWatermarkMs(), []
        if state.hasTimedOut:
            if st["reported"]:
                state.remove()
                return
            done.append(report(key[0], st))
        # an outage has few sightings in a micro-batch: a data frame of its own would cost more than all the rest
        for t, i, after1, after2, cust in () if state.hasTimedOut else polls_seen(list(frames)):
            absent = i - st["i"] - 1 if st else 0
            if st is None or absent >= 2 and t - st["after1"] > reappear_s:
                if st and not st["reported"]:
                    done.append(report(key[0], st))
                st = {"event": (st["event"] if st else 0) + 1, "first": int(t), "back": False, "most": float(cust), "reported": False}
            else:
                st |= {"back": bool(st["back"] or absent >= 2), "most": max(st["most"], float(cust))}
            st |= {"last": int(t), "i": int(i), "after1": int(after1), "after2": int(after2)}
        if not st["reported"] and ends(st) <= now:
            done.append(report(key[0], st))
        wake = ends(st) if not st["reported"] else 1000 * (st["last"] + forget_s)
        if wake <= now:
            state.remove()
        else:
            state.update(tuple(st[n] for n in names))
            state.setTimeoutTimestamp(wake)
        if done:
            yield pd.DataFrame(done, columns=["outage", "event", "first_seen", "last_seen", "restored_hi", "reappeared", "max_cust"])

    return rows.groupBy("outage").applyInPandasWithState(step, CHAIN_SCHEMA, CHAIN_STATE, "append", GroupStateTimeout.EventTimeTimeout)
