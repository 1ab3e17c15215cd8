"""Streams against the batch operators, and readers and writers on small files."""

import gzip
import json

import pytest

import pandas as pd
from pyspark.sql import functions as F

from wardstat import session
from wardstat.operators import polygons
from wardstat.operators.sequences import covered_spans, outage_events
from wardstat.sources import files, sinks
from wardstat.streaming import streams

from tests.test_sequences import at, outage_case


def chains(spark, obs, polls, files, tail, name, **kw):
    """Events of the stream, ``tail`` being poll times after the last, and the progress of its micro-batches."""
    last = polls.agg(F.max("t")).first()[0]
    polls = polls.unionByName(spark.createDataFrame([(last + k,) for k in tail], "t bigint"))
    obs, notes = streams.with_heartbeats(obs, polls), streams.poll_notes(polls)
    paths = [streams.land_in_order(d, name, "t", files) for d in (obs, notes)]
    s, n = (streams.read_landed(spark, p, d.schema, per_trigger=1) for p, d in zip(paths, (obs, notes)))
    progress = []
    out = streams.drain(streams.event_chains(streams.with_next_polls(s, n, "0 seconds"), **kw), name, progress=progress).collect()
    return out, progress, paths


@pytest.mark.parametrize("files", [1, 5])
def test_stream_chains_equal_batch_events(spark, files):
    obs, polls = outage_case(spark)
    # Forty more empty polls after the scenario, so that every event can finish.
    polls = polls.unionByName(spark.range(1, 41).select((F.lit(at("12:00")) + F.col("id") * 300).alias("t")))
    got, progress, _ = chains(spark, obs, polls, files, (1, 2, 3), f"chains{files}")
    want = {r["event_id"]: r for r in outage_events(obs, polls).collect()}
    assert {f"{r['outage']}-{r['event']}" for r in got} == set(want) and sum(p["rows"] > 0 for p in progress) >= files
    for r in got:
        w = want[f"{r['outage']}-{r['event']}"]
        assert (r["first_seen"], r["last_seen"], r["restored_hi"], r["reappeared"], r["max_cust"]) == (w["first_seen"], w["last_seen"], w["restored_hi"], w["reappeared"], w["max_cust"])


def test_state_is_removed_after_the_last_event_and_late_sightings_are_counted(spark):
    obs, polls = outage_case(spark)
    far = (86_400, 86_401, 86_402, 20 * 86_400, 20 * 86_400 + 1, 20 * 86_400 + 2, 20 * 86_400 + 3)
    got, progress, _ = chains(spark, obs, polls, 4, far, "forget", forget_s=10 * 86_400)
    assert {f"{r['outage']}-{r['event']}" for r in got} == {r["event_id"] for r in outage_events(obs, polls).collect()}
    join, events = (next(k for k in progress[-1]["state"] if ("Join" in k) == j) for j in (True, False))
    assert max(p["state"][events] for p in progress) > 0 == progress[-1]["state"][events] and not any(p["late"] for p in progress)
    assert progress[-1]["state"][join] <= 2                                 # the last two polls wait for the ones after them
    # a sighting long before what has been read is dropped and counted, and changes no event
    early = spark.createDataFrame([(at("09:00"), "999", 1.0)], "t bigint, outage string, cust double")
    polls = polls.unionByName(spark.createDataFrame([(at("20:00") + k,) for k in range(9)], "t bigint"))
    rows, notes = streams.with_heartbeats(obs, polls), streams.poll_notes(polls)
    path = streams.land_in_order(rows, "late", "t", 3)
    n = streams.land_in_order(notes, "late-polls", "t", 3)
    early.coalesce(1).write.mode("append").parquet(path)
    s, n = (streams.read_landed(spark, p, d.schema, per_trigger=1) for p, d in ((path, rows), (n, notes)))
    progress = []
    out = streams.drain(streams.event_chains(streams.with_next_polls(s, n, "0 seconds")), "late", progress=progress).collect()
    assert sum(p["late"] for p in progress) == 1 and not [r for r in out if r.outage == "999"]


def test_stream_spans_equal_batch_spans(spark):
    t = [0, 90, 180, 271, 361, 1000, 1100]
    p = spark.createDataFrame([("f", x) for x in t], "feed string, t bigint").withColumn("ts", F.timestamp_seconds("t"))
    tick = spark.createDataFrame([("end", 10**9)], "feed string, t bigint").withColumn("ts", F.timestamp_seconds("t"))
    path = streams.land(p, "spans", "t", files=1, tail=tick)
    got = streams.drain(streams.uptime_windows(streams.read_landed(spark, path, p.schema, per_trigger=5), ["feed"], "ts", "90 seconds", "1 day"), "spans")
    batch = covered_spans(p, ["feed"], "t", 90)
    assert sorted((int(r[1].timestamp()), int(r[2].timestamp())) for r in got.collect()) == sorted((r["span_start"], r["span_end"]) for r in batch.collect())


def test_outage_documents(spark):
    good = {"type": "FeatureCollection", "features": [{"properties": {"OUTAGE_NO": " 7 ", "TIME_STAMP": "x", "STATUS": "s", "EST_REPAIR_TIME": "", "CUR_CUST_AFF": "5"}, "geometry": {"coordinates": [-90.1, 35.2]}}]}
    lacking = {"type": "FeatureCollection", "features": [{"properties": {"OUTAGE_NO": "8"}, "geometry": None}]}
    docs = spark.createDataFrame([(1, json.dumps(good)), (2, json.dumps(lacking)), (3, "<html>"), (4, '{"type":"FeatureCollection","features":[]}')], "poll int, body string")
    got = {r["poll"]: r for r in streams.parse_outages(docs, "poll", "body").collect()}
    assert got[1]["ok"] and got[1]["outage_no"] == "7" and (got[1]["lon"], got[1]["lat"]) == (-90.1, 35.2)
    assert got[2]["problem"] == "properties_absent: CUR_CUST_AFF, EST_REPAIR_TIME, STATUS, TIME_STAMP" and not got[3]["ok"]
    assert got[4]["ok"] and got[4]["outage_no"] is None          # an empty snapshot is still a poll


def test_summary_page(spark):
    html = "<p>99.5% <b>Customers With Power</b> 437,100</p><p>0.5% Customers Without Power 2,200</p> foo CURRENT AS OF 09/24/2026 10:05 AM"
    r = streams.parse_summary(spark.createDataFrame([(1, html), (2, "<p>down</p>")], "id int, html string")).orderBy("id").collect()
    assert tuple(r[0])[1:] == (99.5, 437100, 0.5, 2200, "09/24/2026 10:05 AM", None, True)
    assert r[1]["customers_with_power"] is None and not r[1]["ok"] and r[1]["problem"].startswith("figures_absent: pct_with_power")


def test_broken_last_line_is_left_out(spark, tmp_path):
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as f:
        f.write('{"poll_time":"t1","ok":true}\n{"poll_time":"t2"}\n{"poll_ti')
    got = files.read_json_lines(spark, str(tmp_path), "poll_time string, ok boolean").collect()
    assert sorted((r["poll_time"], r["ok"]) for r in got) == [("t1", True), ("t2", None)]


def test_positions_snapshots_and_log(spark):
    rows = [("e1", "", 1.0, 2.0, 100), ("e1", None, 1.0, 2.0, 100), ("e2", "v9", 1.0, 2.0, 100), ("e3", "v1", None, 2.0, 100)]
    p = files.vehicle_positions(spark.createDataFrame(rows, "entity_id string, vehicle_id string, lat double, lon double, timestamp bigint"))
    assert sorted(r["vehicle"] for r in p.collect()) == ["e1", "v9"] and str(p.first()["service_date"]) == "1969-12-31"
    snap = spark.createDataFrame([("p1", [(1, 5)]), ("p1", [(1, 5)]), ("p2", [])], "poll string, outages array<struct<no:int,cust:int>>")
    polls, obs = files.snapshots(snap, "poll", "outages", "no")
    assert polls.count() == 2 and [tuple(r) for r in obs.collect()] == [("p1", 1, 5)]


def test_csv_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "x.csv").write_text("geo_id,n\n00017,3\nNA,\n")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path), "geo_id string, n int").collect()] == [("00017", 3), (None, None)]


def test_canonical_table_reports_absent_fields(spark):
    raw = spark.createDataFrame([(" a ", "09/01/2026"), (" a ", "09/01/2026"), ("b", "x")], "`Permit Name` string, `When` string")
    t, rep = files.canonical(raw, {"name": "Permit Name", "date": "When", "score": "Score", "risk": None}, ["score"], {"date": [("MM/dd/yyyy", 10)]})
    assert sorted((r["name"], str(r["date"])) for r in t.collect()) == [("a", "2026-09-01"), ("b", "None")]
    assert rep == {"absent": ["score", "risk"], "missing_required": ["score"]}


def test_shards_keep_every_row_of_a_hot_shard(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("p"), "id", (F.col("id") * 2).alias("v"))
    d = sinks.shard_documents(df, "p", ["id"], ["id", "v"], per_file=100).collect()
    ids = [i for r in d for i in json.loads(r["document"])["id"]]
    assert sorted(ids) == list(range(1000)) and len([r for r in d if r["p"] == "hot"]) == 9 and len([r for r in d if r["p"] == "cold"]) == 1


def test_bad_rings_are_repaired(spark, tmp_path):
    rings = {"open": [[0, 0], [10, 0], [10, 10], [0, 10]], "twice": [[0, 0], [10, 0], [10, 0], [10, 10], [0, 10], [0, 0]], "bow": [[0, 0], [10, 10], [10, 0], [0, 10], [0, 0]],
             "spike": [[0, 0], [10, 0], [10, 10], [15, 10], [10, 10], [0, 10], [0, 0]], "none": []}
    doc = {"features": [{"properties": {"GEOID": k}, "geometry": {"type": "Polygon", "coordinates": [r]}} for k, r in rings.items()]}
    doc["features"].append({"properties": {"GEOID": "two"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [4, 0], [4, 4]]], [[[6, 0], [9, 0], [9, 4]]]]}})
    doc["features"].append({"properties": {"GEOID": "half over"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [4, 0], [4, 4], [0, 4]]], [[[4, 1], [8, 1], [8, 3], [4, 3]]], [[[2, 2], [3, 2], [3, 6], [2, 6]]]]}})
    (tmp_path / "b.json").write_text(json.dumps(doc))
    e = files.read_boundaries(spark, str(tmp_path), "t", "GEOID", project=lambda lon, lat: (lon, lat))
    got = {r.geo_id: round(r.area, 9) for r in polygons.polygon_areas(e, 3.0).collect()}
    assert got == {"open": 100, "twice": 100, "bow": 50, "spike": 100, "two": 14, "half over": 16 + 8 + 4 - 4}
    assert e.where("geo_id = 'bow'").count() == 6


def test_shared_folder_and_size_check(spark):
    assert session.shared_folder(spark) == session.shared_folder(spark)
    small, big = spark.range(10), spark.range(100)
    plan = lambda d: big.join(session.small_side(d, max_rows=50), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(small) and "broadcast" not in plan(big)


def test_polls_seen_merges_repeated_sightings():
    """One row per poll and in order over all frames; the largest of each, customers missing left out."""
    nan = float("nan")
    cols = ["t", "i", "after1", "after2", "cust"]
    frames = [pd.DataFrame([(20, 2, 30, 40, nan), (10, 1, 20, 30, 5.0)], columns=cols), pd.DataFrame([(20, 2, 30, 40, 3.0), (30, 3, 40, 50, nan), (10, 1, 20, 30, 4.0)], columns=cols)]
    got = [*streams.polls_seen(frames)]
    assert got[:2] == [(10, 1, 20, 30, 5.0), (20, 2, 30, 40, 3.0)] and got[2][:4] == (30, 3, 40, 50) and got[2][4] != got[2][4]
    assert all(isinstance(x, int) for r in got for x in r[:4])
