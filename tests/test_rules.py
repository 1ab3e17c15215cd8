"""Contracts, gate, food rules and metric shapes with stated answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardstat.operators import checks, gate, metrics, normalize

D = dt.date
TH = lambda: F.lit("2026-09-24").cast("date")


def test_schema_contract(spark):
    df = spark.createDataFrame([(1.0, "Open", None), (2.0, "Closed", ""), (3.0, "Paused", "x")], "id double, status string, note string")
    c = {"id": {"type": "integer", "nullable": False}, "status": {"allowed": ["Open", "Closed"]}, "note": {"nullable": False}, "gone": {"type": "date"}, "maybe": {"required": False}}
    got = {r["name"]: (r["passed"], r["severity"]) for r in checks.schema_checks(df, c).collect()}
    assert got["column type: id"] == (True, "error") and got["not null: note"] == (False, "error")
    assert got["allowed values: status"] == (False, "error") and got["column present: gone"] == (False, "error")
    assert got["column present: maybe"] == (True, "warning") and got["no unexpected columns"] == (True, "warning")
    with pytest.raises(RuntimeError, match="allowed values: status"):
        checks.stop_if_failed(checks.schema_checks(df, c))


def test_contract_type_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "d string")
    assert checks.schema_checks(df, {"d": {"type": "date"}}).where("name like '%type%'").first()["passed"]


def metric_rows(spark, **over):
    row = dict(geo_type="zcta", geo_id="1", metric="m", value=0.5, ci_low=0.4, ci_high=0.6, n=40, suppressed=False, window_start=D(2026, 1, 1), window_end=D(2026, 3, 31)) | over
    return checks.as_metrics(spark.createDataFrame([row], "geo_type string, geo_id string, metric string, value double, ci_low double, ci_high double, n bigint, suppressed boolean, window_start date, window_end date"), "0.1", TH())


def problems(m):
    return {r["problem"]: r["rows"] for r in checks.metrics_problems(m).collect()}


def test_metrics_contract(spark):
    good = metric_rows(spark)
    assert problems(good) == {} and good.columns == checks.METRIC_COLUMNS
    assert problems(good.unionByName(good)) == {"repeated_key": 1}
    assert problems(metric_rows(spark, geo_type="moon", n=-1)) == {"area_kind_unlisted": 1, "count_invalid": 1}
    assert problems(metric_rows(spark, value=0.7)) == {"interval_misses_value": 1}
    assert problems(metric_rows(spark, ci_high=None)) == {"shown_value_incomplete": 1}
    s = metric_rows(spark, suppressed=True)
    assert s.first()["value"] is None and problems(s) == {}
    assert problems(metric_rows(spark, ci_high=float("inf"))) == {}


def test_citywide_reference(spark):
    m = metric_rows(spark).unionByName(metric_rows(spark, geo_type="citywide", geo_id="c", value=0.45))
    assert {r["citywide_median"] for r in checks.citywide_reference(m).collect()} == {0.45}
    assert {r["citywide_median"] for r in checks.citywide_reference(m, skip=("m",)).collect()} == {None}


def test_daily_volume(spark):
    days = [D(2026, 9, 24) - dt.timedelta(days=k) for k in range(1, 62)]
    rows = [(d,) for d in days for _ in range(100 if d.weekday() < 5 else 10)]
    df = spark.createDataFrame(rows, "d date")
    ok = checks.daily_volume(df, F.col("d"), TH()).first()
    assert ok["in_band"] and ok["median"] == 100 and ok["mad"] == 1 and (ok["low"], ok["high"]) == (97, 103)
    quiet = checks.daily_volume(df.where(F.col("d") != days[0]), F.col("d"), TH()).first()
    assert quiet["count"] == 0 and not quiet["in_band"]


def test_reconciliation_tolerance(spark):
    f = spark.createDataFrame([("a", 1000.0, 1.0, "", 1019.0), ("b", 1000.0, 1.0, "", 1021.0), ("c", 1000.0, 1.0, "why", 1021.0), ("d", 10.0, 10.0, "", 15.0), ("e", 10.0, 1.0, "", None)],
                              "figure_id string, value double, precision double, gap_note string, our_value double")
    got = {r["figure_id"]: (r["within_tolerance"], r["documented"]) for r in gate.reconcile(f).collect()}
    assert got == {"a": (True, True), "b": (False, False), "c": (False, True), "d": (True, True), "e": (False, False)}


def test_gate_lists_everything_missing(spark):
    row = dict(id="m", blocked=None, frozen_valid=True, report_status="pass", tests_passed=True, published_cells=3, cells_without_interval=0,
               reconciled_on=D(2026, 8, 1), gap_documented=True, audit_problem="")
    ddl = "id string, blocked string, frozen_valid boolean, report_status string, tests_passed boolean, published_cells bigint, cells_without_interval bigint, reconciled_on date, gap_documented boolean, audit_problem string"
    ev = lambda **o: gate.publish_gate(spark.createDataFrame([row | o], ddl), TH()).first()
    assert ev()["publishable"] and ev()["missing"] == []
    assert ev(reconciled_on=D(2026, 6, 23))["missing"] == ["official_comparison_stale"]
    assert ev(reconciled_on=D(2026, 6, 24))["publishable"]
    bad = ev(blocked=" no source", frozen_valid=False, report_status=None, tests_passed=None, published_cells=0, gap_documented=False, audit_problem=None)
    assert bad["missing"] == ["on_hold: no source", "definition_open", "source_checks_failed",
                              "tests_open", "nothing_publishable",
                              "official_gap_unexplained", "audit_absent"]


def test_blank_sheet_is_no_audit(spark):
    blank = spark.range(100).select(F.lit("audit_2026-09-01").alias("sheet"), F.lit("").alias("auditor"), F.lit("").alias("notes"), F.lit("").alias("1_found"))
    r = gate.audit_summary(blank, ["1_found"]).first()
    assert r["problems"] == ["rows_without_auditor", "100 unusable answers"]
    done = spark.range(100).select(F.lit("audit_2026-09-02").alias("sheet"), F.lit("ann").alias("auditor"), F.when(F.col("id") == 0, "moved").alias("notes"),
                                   F.when(F.col("id") == 0, " No").otherwise("YES").alias("1_found"))
    assert gate.audit_summary(done, ["1_found"]).first()["problems"] == []
    both = gate.audit_summary(blank.unionByName(done), ["1_found"])
    assert gate.newest_audit(both).first()["sheet"] == "audit_2026-09-02"


def test_feed_status(spark):
    rows = [("bad", i, i < 7) for i in range(10)] + [("warn", i, i % 5 != 0) for i in range(12)] + [("ok", i, i != 3) for i in range(10)] + [("never", 1, False)]
    got = {r["feed"]: r["status"] for r in gate.feed_status(spark.createDataFrame(rows, "feed string, t int, ok boolean"), "feed", "t", "ok").collect()}
    assert got == {"bad": "fail", "warn": "warn", "ok": "ok", "never": "warn"}


def requests(spark, rows):
    """(type, opened, closed or None, bd, age)"""
    df = spark.createDataFrame(rows, "type string, opened date, close_date date, bd_to_close int, age_bd int")
    return (df.withColumn("is_closed", F.col("close_date").isNotNull()).withColumn("close_problem", F.lit(None).cast("string")).withColumn("city", F.lit("c")))


def test_target_counts_only_observed_deadlines(spark):
    d = D(2026, 8, 3)
    rows = [("potholes", d, d, 8, 37)] * 30 + [("potholes", d, d, 12, 37)] * 10 + [("potholes", d, None, None, 37)] + [("potholes", D(2026, 9, 21), None, None, 3)]
    t = spark.createDataFrame([("potholes", 5, 10)], "type string, low int, high int")
    got = {(r["variant"], str(r["window_start"])): r for r in metrics.within_target(requests(spark, rows), t, {"citywide": F.col("city")}, TH()).collect()}
    r = got[("primary", "2026-06-27")]
    assert r["n"] == 41 and r["value"] == pytest.approx(30 / 41) and got[("lower_bound", "2026-06-27")]["value"] == 0


def test_rates_have_every_area(spark):
    rows = [("a", D(2026, 9, 1), None, None, 1)] * 3
    b = requests(spark, rows).withColumn("zip", F.lit("38104"))
    pop = spark.createDataFrame([("zcta", "38104", 2000), ("zcta", "38105", 2000), ("zcta", "38131", 40)], "geo_type string, geo_id string, population bigint")
    got = {r["geo_id"]: r for r in metrics.requests_per_1000(b, pop, {"zcta": F.col("zip")}, TH()).where("window_start = '2026-06-27'").collect()}
    assert got["38104"]["value"] == 1.5 and got["38105"]["value"] == 0 and got["38105"]["ci_high"] > 0 and not got["38105"]["suppressed"]
    assert got["38131"]["suppressed"] and got["38131"]["value"] is None


def test_permit_subgroups(spark):
    df = spark.createDataFrame([("new", "residential"), ("accessory", None)], "c string, s string")
    got = [sorted(r["n"]) for r in df.select(metrics.subgroup_names(F.col("c"), F.col("s")).alias("n")).collect()]
    assert got == [["all", "all_residential", "new", "new_residential"], ["accessory", "all"]]


def test_food_overdue(spark):
    places = spark.createDataFrame([("p1", None), ("p2", None), ("p3", D(2026, 9, 1)), ("p4", None)], "place string, closed_date date")
    rows = [("p1", D(2026, 3, 1), "routine"), ("p2", D(2026, 6, 1), "follow_up"), ("p2", D(2026, 7, 1), "complaint"), ("p3", D(2026, 1, 1), "routine"), ("p4", D(2020, 1, 1), "routine")]
    ins = spark.createDataFrame(rows, "place string, date date, kind string").withColumn("exclusion", F.lit(None).cast("string"))
    got = {(r["place"], r["variant"]): r for r in metrics.overdue_rows(places, ins, TH()).collect()}
    assert {p for p, _ in got} == {"p1", "p2"}                     # closed and long unseen places are left out
    assert got[("p1", "primary")]["due"] == D(2026, 9, 1) and got[("p1", "primary")]["overdue"] and not got[("p1", "grace_30d")]["overdue"]
    assert got[("p2", "primary")]["ref"] == D(2026, 6, 1) and not got[("p2", "primary")]["overdue"]


def test_latest_score_same_day_keeps_the_higher(spark):
    places = spark.createDataFrame([("p", "c")], "place string, city string")
    rows = [("p", D(2026, 9, 1), "routine", 80.0), ("p", D(2026, 9, 1), "routine", 95.0), ("p", D(2026, 8, 1), "routine", 100.0), ("p", D(2026, 9, 9), "routine", None)]
    ins = spark.createDataFrame(rows, "place string, date date, kind string, score double").withColumn("exclusion", F.lit(None).cast("string"))
    start = metrics.month_windows(ins.where("score is not null"), "date", TH(), [{"months": 12}])
    from wardstat.operators.sequences import latest_per_key
    assert latest_per_key(start, ["place"], [F.col("date"), F.col("score")], ["score"]).first()["score"] == 95.0
    assert metrics.food_scores(places, ins, {"citywide": F.col("city")}, TH()).where("metric = 'median_latest_score'").first()["n"] == 1


def test_address_cache_and_annotations(spark):
    rows = spark.createDataFrame([(1, "1 A St."), (2, "2 B St"), (3, "3 C St")], "id int, a string")
    cache = spark.createDataFrame([("1 A ST", -90.0, 35.0, "exact"), ("2 B ST", -90.1, 35.0, "tie")], "address_key string, longitude double, latitude double, match_quality string")
    from wardstat.functions.text import address_key
    got = {r["id"]: (r["longitude"], r["match_quality"]) for r in normalize.geocoded(rows, cache, address_key(F.col("a"))).collect()}
    assert got == {1: (-90.0, "exact"), 2: (None, "tie"), 3: (None, "no_match")}
    assert [r["address_key"] for r in normalize.addresses_to_geocode(rows, cache, address_key(F.col("a"))).collect()] == ["3 C ST"]
    df = spark.createDataFrame([(1, -1.0, -555555555.0), (2, 5.0, -555555555.0), (3, 5.0, -222222222.0)], "id int, estimate double, moe double")
    got = {r["id"]: (r["estimate"], r["moe"]) for r in normalize.code_annotations(df).collect()}
    assert got == {1: (None, 0.0), 2: (5.0, 0.0), 3: (5.0, None)}


def test_declared_value_keeps_cells_that_a_variant_makes_small(spark):
    # 202 permits, three of them above the 99th percentile of the window: 199 remain in the trimmed variant.
    rows = [(i, "new", "residential", 1000.0 + (i % 50) if i >= 3 else 9e6 + i, D(2026, 9, 1), "c") for i in range(202)]
    df = spark.createDataFrame(rows, "id int, category string, sector string, value double, issue_date date, city string")
    par = spark.createDataFrame([("citywide", "c", 1000)], "geo_type string, geo_id string, parcels bigint")
    out = metrics.declared_value(df, par, {"citywide": F.col("city")}, TH())
    got = {r["variant"]: r for r in out.where("subgroup = 'all' and window_start = '2025-09-25'").collect()}
    kept = sorted(r[3] for r in rows)
    assert got["primary"]["n"] == 202 and got["excl_top1pct"]["n"] == 199 and not got["excl_top1pct"]["suppressed"]
    assert got["primary"]["value"] == pytest.approx(sum(kept)) and got["excl_top1pct"]["value"] == pytest.approx(sum(kept[:-3]))
    for r in got.values():
        assert r["ci_low"] <= r["value"] <= r["ci_high"]


def test_address_report_joins_addresses_once(spark):
    """Areas may be missing and ids may repeat; no join or pivot of addresses by type, only one with their areas."""
    addr = spark.createDataFrame([(1, "h1", "A", "N"), (2, "h1", "A", "N"), (3, "h2", None, "N"), (4, None, "B", None), (2, "h1", "A", "N")],
                                 "id bigint, cell string, zcta string, district string")
    rows = "type string, geo_type string, geo_id string, value double, n bigint"
    near = spark.createDataFrame([("p", "hex_174m", "h1", 1.0, 10)], rows)
    area = spark.createDataFrame([("p", "citywide", "city", 2.0, 20), ("q", "citywide", "city", 3.0, 30), ("p", "zcta", "A", 4.0, 40),
                                  ("q", "zcta", "B", 5.0, 50), ("p", "super_district", "N", None, 60)], rows)
    out = metrics.address_report(addr, near, area)
    assert out.columns == ["id", "type"] + [f"{lab}_{c}" for lab in ("near", "city", "zip", "district") for c in ("value", "n")]
    none = (None, 0)
    assert sorted(tuple(r) for r in out.collect()) == sorted(
        [(i, "p", 1.0, 10, 2.0, 20, 4.0, 40, None, 60) for i in (1, 2)] + [(i, "q", *none, 3.0, 30, *none, *none) for i in (1, 2)]
        + [(3, "p", *none, 2.0, 20, *none, None, 60), (3, "q", *none, 3.0, 30, *none, *none)]
        + [(4, "p", *none, 2.0, 20, *none, *none), (4, "q", *none, 3.0, 30, 5.0, 50, *none)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "pivotfirst" not in plan and "Generate" not in plan


END = lambda: F.lit("2024-06-30").cast("date")


def test_windows_drop_other_days_before_rows_are_repeated(spark):
    """The condition on the date must stand below the repeat, where joins and tables can use it."""
    d = spark.range(400).select(F.expr("date_sub(date'2024-06-30', cast(id as int))").alias("d"))
    for out, n in ((metrics.day_windows(d, "d", END(), [{"days": 5}, {"days": 9}]), 14), (metrics.month_windows(d, "d", END(), [{"months": 1}, {"months": 2}]), 91),
                   (metrics.month_windows(d, "d", END(), [{"months": 1}, {"months": 2}], F.lit("2024-06-10").cast("date")), 42)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert ">=" in plan[plan.index("Generate"):]
        assert out.count() == n


def test_rereports_answer_closings_of_the_windows_only(spark):
    """Closings before the longest window are in no rate; reports up to 60 days after the data's last day still answer."""
    rows = [(1, "p", 0.0, 0.0, "2023-01-01", "2023-01-05"), (2, "p", 0.0, 10.0, "2023-01-20", None),       # closed before the window
            (3, "p", 500.0, 0.0, "2023-01-01", "2023-07-02"), (4, "p", 500.0, 30.0, "2023-07-03", None),   # its first day
            (5, "p", 900.0, 0.0, "2024-01-01", "2024-06-30"), (6, "p", 900.0, 0.0, "2024-08-29", None), (7, "p", 900.0, 5.0, "2024-08-30", None)]
    pts = spark.createDataFrame(rows, "id int, type string, x double, y double, opened string, close_date string").select(
        "id", "type", "x", "y", F.to_date("opened").alias("opened"), F.to_date("close_date").alias("close_date"), F.col("close_date").isNotNull().alias("is_closed"),
        F.lit(None).cast("int").alias("duplicate_of"), F.lit(None).cast("string").alias("exclusion"), F.lit(True).alias("in_city"))
    got = {r.id: (r.r25, r.r50, r.r100) for r in metrics.rereports(pts, END()).collect()}
    assert got == {3: (None, 1, 1), 5: (60, 60, 60)}


def test_headway_ratio_is_missing_where_the_schedule_has_no_gap(spark):
    """Trips scheduled within one second: no ratio, as in SQL, and no failure."""
    day, cells = "date'2024-06-28'", spark.createDataFrame([("s", "h")], "stop_id string, h8 string")
    ev = spark.range(60).select(F.expr(day).alias("service_date"), F.when(F.col("id") < 30, "a").otherwise("b").alias("route_id"), F.lit("0").alias("direction_id"),
                                F.lit("s").alias("stop_id"), F.format_string("%02d", "id").alias("trip_id"), F.when(F.col("id") < 30, 1000).otherwise(1000 + F.col("id") * 600).alias("scheduled"),
                                (5000 + F.col("id") * 300).alias("arrival"), F.lit("observed").alias("status"), F.lit(True).alias("measurable"))
    got = {r.geo_id: r for r in metrics.headway_ratio(ev, cells, END()).where("geo_type = 'route' and window_start = date'2024-06-01'").collect()}
    assert got["a"].value is None and got["a"].n == 29 and got["b"].value == 0.5


def test_ghost_rate_reads_stop_times_of_its_windows(spark):
    """Other days are dropped on both sides before trips meet their stops."""
    days = spark.createDataFrame([("2024-06-30", "t1"), ("2024-06-29", "t2"), ("2023-01-01", "t3")], "d string, trip_id string").select(F.to_date("d").alias("service_date"), "trip_id")
    cls = days.select("*", F.lit("r").alias("route_id"), F.lit("city").alias("city"), F.lit(15).alias("tolerance"), F.lit(True).alias("measurable"),
                      F.when(F.col("trip_id") == "t1", "ghost").otherwise("observed").alias("status"))
    times = days.select("*", F.lit("s").alias("stop_id")).repartition(2)
    out = metrics.ghost_rate(cls, times, spark.createDataFrame([("s", "h")], "stop_id string, h8 string"), END())
    got = {(r.geo_type, r.geo_id): r.n for r in out.where("window_start = date'2024-06-01'").collect()}
    assert got == {("citywide", "city"): 2, ("route", "r"): 2, ("stop", "s"): 2, ("hex_461m", "h"): 2}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Filter" in x and ">= 2024-04-02" in x for x in plan.splitlines()) >= 3, plan       # trips twice, stop times
