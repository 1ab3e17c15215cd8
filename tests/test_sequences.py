"""Ordered operators: chunked windows against plain ones, outages and transit scenarios with known answers."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardstat.operators import joins as J
from wardstat.operators import sequences as Q
from wardstat.operators import tracks as T

DAY = "2026-09-24"


def at(hms: str) -> int:
    """Local clock time on the scenario day (UTC-5) as epoch seconds."""
    h, m, *s = map(int, hms.split(":"))
    base = dt.datetime(2026, 9, 24, 5, tzinfo=dt.timezone.utc).timestamp()
    return int(base + h * 3600 + m * 60 + (s[0] if s else 0))


@pytest.mark.parametrize("parts", [1, 9])
def test_chunks_equal_plain_windows_on_a_hot_key(spark, parts):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("xyz"), i, rng.choice([None, 1, 2, 3])) for i in rng.sample(range(5000), 400)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(parts).withColumn("c", F.floor(F.col("t") / 300))
    got = Q.ordered(df, ["k"], "c", ["t"], lag=["v"], lead=["t"], running=["v"], last_seen=["v"])
    w = Window.partitionBy("k").orderBy("t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "t", F.lag("v").over(w), F.lead("t").over(w), F.sum(F.coalesce("v", F.lit(0))).over(upto), F.last("v", True).over(upto))
    assert sorted(map(tuple, got.select("k", "t", "prev_v", "next_t", "run_v", "last_v").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_spans_break_after_a_long_gap_only(spark):
    t = [0, 90, 180, 271, 361, 1000]
    s = Q.covered_spans(spark.createDataFrame([("f", x) for x in t + t], "feed string, t bigint"), ["feed"], "t", 90, chunk_s=100)
    assert sorted((r["span_start"], r["span_end"]) for r in s.collect()) == [(0, 180), (271, 361)]


def outage_case(spark):
    clock = [f"{h:02d}:{m:02d}" for h in range(8, 13) for m in range(0, 60, 5) if (h, m) <= (12, 0)]
    clock = [c for c in clock if not "10:00" < c < "10:35"]
    plan = [("101", "08:05", "08:30", "08:02", 10.0, "08:20", False), ("101", "11:00", "11:10", "10:58", 3.0, None, False),
            ("102", "09:00", "09:10", "08:55", 5.0, None, False), ("102", "09:30", "09:40", "08:55", 5.0, None, False),
            ("103", "09:50", "10:00", "09:45", 20.0, "10:15", False), ("104", "08:00", "08:20", "07:30", 50.0, None, True),
            ("105", "11:30", "11:55", "11:00", 2.0, "12:30", False), ("105", "12:00", "12:00", "11:00", 2.0, "13:00", False)]
    rows = []
    for no, a, b, start, cust, etr, planned in plan:
        for c in clock:
            if a <= c <= b:
                first = "08:58" if (no, c) == ("102", "09:00") else start
                lon = -90.05 if c <= "08:15" else -90.049
                rows.append((no, at(c), at(first), at(etr) if etr else None, cust, planned, lon, 35.1))
    obs = spark.createDataFrame(rows, "outage string, t bigint, start_ts bigint, etr bigint, cust double, planned boolean, lon double, lat double")
    return obs, spark.createDataFrame([(at(c),) for c in clock], "t bigint")


@pytest.mark.parametrize("chunk_s", [86400, 900])
def test_outage_scenario(spark, chunk_s):
    obs, polls = outage_case(spark)
    ev = {r["event_id"]: r for r in Q.outage_events(obs.repartition(5), polls, chunk_s).collect()}
    assert set(ev) == {"101-1", "101-2", "102-1", "103-1", "104-1", "105-1"}
    assert [k for k, r in ev.items() if r["reappeared"]] == ["102-1"] and [k for k, r in ev.items() if r["planned"]] == ["104-1"]
    a = ev["101-1"]
    assert a["confirmed"] and (a["restored_lo"], a["restored_hi"]) == (at("08:30"), at("08:35"))
    assert a["restoration_span_s"] == 300 and a["duration_s"] / 60 == 30.5 and (a["restored_mid"] - a["first_etr"]) / 60 == 12.5
    assert a["lon"] == -90.05 and ev["102-1"]["start"] == at("08:55")
    assert a["cust_hours_lo"] == pytest.approx(5 * 5 * 10 / 60) and a["cust_hours_hi"] == pytest.approx(6 * 5 * 10 / 60)
    assert ev["102-1"]["cust_hours_lo"] == pytest.approx(4 * 5 * 5 / 60) and ev["102-1"]["cust_hours_hi"] == pytest.approx(6 * 5 * 5 / 60)
    assert ev["103-1"]["cust_hours_hi"] - ev["103-1"]["cust_hours_lo"] == pytest.approx(35 * 20 / 60)
    e = ev["105-1"]
    assert not e["confirmed"] and e["restored_mid"] is None and e["cust_hours_hi"] == pytest.approx(6 * 5 * 2 / 60)
    assert (e["first_etr"], e["final_etr"], e["etr_60m"]) == (at("12:30"), at("13:00"), at("13:00"))


TRIPS = {"T1": ("08:00", "B1"), "T2": ("09:00", "B1"), "T3": ("08:30", "B2"), "T4": ("10:00", "B3"), "T5": ("12:00", "B4")}
STOPS = {"A": (0, 0), "B": (1000, 4), "C": (2500, 10), "D": (5000, 20)}


def transit_case(spark):
    d = dt.date.fromisoformat(DAY)
    sched = spark.createDataFrame([(d, k, "R1", "0", "S1", b, at(s), at(s) + 1200) for k, (s, b) in TRIPS.items()],
                                  "service_date date, trip_id string, route_id string, direction_id string, shape_id string, block_id string, first_t bigint, last_t bigint")
    stops = spark.createDataFrame([(d, k, stop, i + 1, stop != "B", float(m), at(s) + mins * 60) for k, (s, _) in TRIPS.items() for i, (stop, (m, mins)) in enumerate(STOPS.items())],
                                  "service_date date, trip_id string, stop_id string, stop_sequence int, timepoint boolean, dist double, scheduled bigint")
    rows = []
    for trip, mid, speed, a, b in (("T1", "08:11", 2500 / 630, "07:58", "08:23"), ("T3", "08:46", 2500 / 960, "08:28", "09:05")):
        for t in range(at(a) + 15, at(b) + 1, 30):
            rows.append((d, trip, t, max(0.0, min(5000.0, 2500 + speed * (t - at(mid)))), 0.0))
    reports = spark.createDataFrame(rows + rows[:10], "service_date date, trip_id string, t bigint, x double, y double")
    shape = spark.createDataFrame([("S1", i, 100.0 * i, 0.0, 100.0 * i) for i in range(51)], "shape_id string, seq int, x double, y double, dist double")
    spans = spark.createDataFrame([(at("07:30"), at("11:00"))], "span_start bigint, span_end bigint")
    return sched, stops, reports, T.shape_arrays(shape), spans


def test_transit_scenario(spark):
    sched, stops, reports, shapes, spans = transit_case(spark)
    cls = J.classify_trips(J.match_trips(sched, reports, spans, [15]))
    got = {r["trip_id"]: (r["status"], r["measurable"]) for r in cls.collect()}
    assert {k: v[0] for k, v in got.items() if k != "T5"} == {"T1": "observed", "T2": "ghost", "T3": "observed", "T4": "unobserved"}
    assert {k: v[1] for k, v in got.items()} == {"T1": True, "T2": True, "T3": True, "T4": True, "T5": False}
    arr = {(r["trip_id"], r["stop_id"]): r for r in T.infer_arrivals(cls, stops, reports, shapes).collect()}
    assert not any(s in ("A", "B") for _, s in arr)
    assert arr[("T1", "C")]["arrival"] == pytest.approx(at("08:11"), abs=1) and arr[("T1", "D")]["arrival"] == pytest.approx(at("08:21:30"), abs=16)   # reports every 30 s
    assert arr[("T1", "C")]["delay_s"] == pytest.approx(60, abs=1) and arr[("T3", "C")]["delay_s"] == pytest.approx(360, abs=1)


def test_track_rules():
    px, py, cum = np.array([0.0, 2500, 5000]), np.zeros(3), np.array([0.0, 2500, 5000])
    p = T._progress(T.Segments(px, py, cum), np.array([1000.0, 2000, 3000]), np.array([0.0, 1100, 0]))
    assert np.isnan(p[1]) and p[2] == 3000
    assert T._crossings(np.array([0.0, 400]), np.array([2000.0, 3000]), [2500]) == [None]
    assert T._crossings(np.array([0.0, 100]), np.array([2000.0, 3000]), [2500]) == [50.0]
    # Halting 20 m short counts as an arrival; being past the stop at first sight does not.
    assert T._crossings(np.array([0.0, 60, 120]), np.array([0.0, 480, 480]), [500, 0]) == [60.0, None]


def test_headway_scenario(spark):
    clock = ["07:00", "07:15", "07:30", "07:45", "08:00", "08:15"]
    arrival = ["07:01", None, "07:31", "07:46", None, "08:17"]
    status = ["observed", "ghost"] + ["observed"] * 4
    rows = [(dt.date.fromisoformat(DAY), "R1", "0", "C", f"X{i}", at(c), at(a) if a else None, s, True) for i, (c, a, s) in enumerate(zip(clock, arrival, status))]
    ev = spark.createDataFrame(rows, "service_date date, route_id string, direction_id string, stop_id string, trip_id string, scheduled bigint, arrival bigint, status string, measurable boolean")
    key = ["service_date", "route_id", "direction_id", "stop_id"]
    assert sorted(r["gap"] for r in Q.headway_gaps(ev, key).collect()) == [900, 1800]
    assert {r["gap"] for r in Q.scheduled_gaps(ev, key).collect()} == {900}


def test_asof(spark):
    v = spark.createDataFrame([("2026-09-20", "a"), ("2026-09-24", "b"), ("2026-09-24", "c"), ("2026-09-26", "d")], "vday string, name string").withColumn("vday", F.col("vday").cast("date"))
    d = spark.createDataFrame([("2026-09-19",), ("2026-09-24",), ("2026-09-25",), ("2026-10-25",)], "day string").withColumn("day", F.col("day").cast("date"))
    out = J.asof_backward(d, v, "day", "vday", ["name"], lambda c: F.trunc(c, "MM"), tie=["name"])
    assert {str(r["day"]): r["name"] for r in out.collect()} == {"2026-09-19": None, "2026-09-24": "c", "2026-09-25": "c", "2026-10-25": "d"}


def _plain_progress(px, py, cum, x, y):
    """Every segment for every report."""
    dx, dy = np.diff(px), np.diff(py)
    l2 = dx * dx + dy * dy
    out, reached = np.full(len(x), np.nan), -np.inf
    for i in range(len(x)):
        u = np.clip(((x[i] - px[:-1]) * dx + (y[i] - py[:-1]) * dy) / np.where(l2 == 0, 1.0, l2), 0.0, 1.0)
        along, off = cum[:-1] + u * np.sqrt(l2), np.hypot(x[i] - px[:-1] - u * dx, y[i] - py[:-1] - u * dy)
        off[along < reached - T.BACKTRACK_M] = np.inf
        if off.min() <= T.OFF_SHAPE_M:
            reached = out[i] = max(reached, along[off.argmin()])
    return out


@pytest.mark.parametrize("seed", range(5))
def test_segment_index_finds_the_nearest_segment(seed):
    rng = np.random.default_rng(seed)
    n = 400
    px, py = np.cumsum(rng.normal(3, 40, n)), np.cumsum(rng.normal(0, 40, n))
    px[50:53], py[50:53] = px[50], py[50]                                     # a vertex that is repeated
    px[200:], py[200:] = px[200:] + 3000, py[200:] - 900                     # one long segment
    cum = np.concatenate([[0.0], np.cumsum(np.hypot(np.diff(px), np.diff(py)))])
    k = np.sort(rng.integers(0, n, 300))
    x, y = px[k] + rng.normal(0, 45, 300), py[k] + rng.normal(0, 45, 300)
    got, want = T._progress(T.Segments(px, py, cum), x, y), _plain_progress(px, py, cum, x, y)
    assert np.array_equal(got, want, equal_nan=True) and np.isnan(want).any() and (~np.isnan(want)).sum() > 40


def test_work_per_report_does_not_grow_with_the_shape():
    met = {}
    for n in (100, 20_000):
        px = np.arange(n) * 25.0
        shape = T.Segments(px, np.zeros(n), px)
        met[n] = max(len(shape.near(x, 10.0)) for x in px[:90])
    assert met[100] == met[20_000] <= 16


def test_a_trip_is_gathered_once(spark):
    shapes = T.shape_arrays(spark.createDataFrame([("s", float(i), 0.0, i, float(i)) for i in range(3)], "shape_id string, x double, y double, seq int, dist double"))
    reports = spark.createDataFrame([("2026-01-01", "t", "s", float(i), float(i), 0.0) for i in range(3)], "service_date string, trip_id string, shape_id string, t double, x double, y double")
    stops = spark.createDataFrame([("2026-01-01", "t", "a", 1.5)], "service_date string, trip_id string, stop_id string, stop_along double")
    out = T.crossing_times(reports, stops, shapes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.split("ArrowEvalPython")[0].count("Exchange") == 0 and out.count() == 1


def _plain_crossings(t, a, stops):
    keep = ~np.isnan(a)
    t, a = t[keep], a[keep]
    out = []
    for s in stops:
        j, c = int((a < s - T.STOP_SLACK_M).sum()), int((a < s - T.NEAR_STOP_M).sum())
        hit = j if j < len(a) else c
        if hit >= len(a) or hit == 0 or t[hit] - t[hit - 1] > T.BRACKET_S:
            out.append(None)
        elif j == len(a) or a[j] <= a[j - 1]:
            out.append(float(t[hit]))
        else:
            out.append(float(t[j - 1] + (min(s, a[j]) - a[j - 1]) / (a[j] - a[j - 1]) * (t[j] - t[j - 1])))
    return out


@pytest.mark.parametrize("pairs", [40, 500_000])
def test_a_batch_of_trips_matches_together(monkeypatch, pairs):
    """Trips on shapes with few segments are placed together without an index of each; the rest shares one index a shape."""
    import pyarrow as pa
    rng, built, make = np.random.default_rng(5), [], T.Segments
    monkeypatch.setattr(T, "PAIRS", pairs)
    trips = []
    for k in range(60):
        corners = 30 if k % 20 == 7 else int(rng.integers(2, 6))
        seed = np.random.default_rng(77) if corners == 30 else rng
        px, py = (np.cumsum(seed.uniform(-50, 300, corners)) for _ in range(2))
        cum = np.concatenate(([0.0], np.cumsum(np.hypot(np.diff(px), np.diff(py)))))
        n = int(rng.integers(0, 12))
        w = np.sort(rng.uniform(0, cum[-1], n))
        x, y = (np.interp(w, cum, p) + rng.normal(0, 40, n) for p in (px, py))
        trips.append((corners if corners == 30 else 100 + k, px, py, cum, x, y, np.cumsum(rng.uniform(20, 150, n)), np.sort(rng.uniform(0, cum[-1] + 40, k % 4))))
    names = ["shape_id", "px", "py", "cum", "x", "y", "t", "d"]
    batch = pa.StructArray.from_arrays([pa.array([v if c == "shape_id" else v.tolist() for v in col], pa.int64() if c == "shape_id" else pa.list_(pa.float64()))
                                        for c, col in zip(names, zip(*trips))], names)
    monkeypatch.setattr(T, "Segments", lambda *a: (built.append(1), make(*a))[1])
    got, (t, reports), (d, wanted) = T._tracks(batch), T._lists(batch, "t"), T._lists(batch, "d")
    assert len(built) == 1
    cross = T._as_lists(T._all_crossings(t, got, reports, d, wanted), wanted).to_pylist()
    for k, (_, px, py, cum, x, y, when, stops) in enumerate(trips):
        mine, want = got[reports[k]:reports[k + 1]], T._progress(make(px, py, cum), x, y)
        assert np.array_equal(mine, want, equal_nan=True)
        assert cross[k] == pytest.approx(_plain_crossings(when, mine, stops), nan_ok=True) if stops.size else cross[k] == []
    later = batch.slice(9, 30)
    assert np.array_equal(T._tracks(later), got[reports[9]:reports[39]], equal_nan=True)
