"""Column functions against hand-computed values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wardstat.functions import dates, geo, intervals, text

D = dt.date


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("day,months,want", [
    ("2025-08-31", 6, D(2026, 3, 3)), ("2024-02-29", 12, D(2025, 3, 1)), ("2026-01-15", -3, D(2025, 10, 15))])
def test_months_roll_over(spark, day, months, want):
    assert one(spark, dates.roll_months(F.lit(day).cast("date"), months)) == want


def test_windows_are_inclusive(spark):
    th = F.lit("2026-09-24").cast("date")
    assert one(spark, dates.window_start_days(th, 90)) == D(2026, 6, 27)
    assert one(spark, dates.window_start_months(th, 12)) == D(2025, 9, 25)


def test_local_time(spark):
    # The repeated autumn hour is read as daylight time; an empty text is null.
    assert one(spark, dates.local_clock_to_utc(F.lit("11/01/2026 01:30:00 AM"))) == dt.datetime(2026, 11, 1, 6, 30)
    assert one(spark, dates.local_clock_to_utc(F.lit(" "))) is None
    assert one(spark, dates.local_day_from_text(F.lit("2026-09-05T03:00:00Z"))) == D(2026, 9, 4)
    assert one(spark, dates.local_day_from_text(F.lit("2026-09-05T03:00:00"))) == D(2026, 9, 5)
    assert one(spark, dates.local_day_from_text(F.lit("2026-09-05"))) == D(2026, 9, 5)


def test_scheduled_instant_is_dst_safe(spark):
    # On the spring change day, 08:00 is still 08:00 local time.
    at = dates.scheduled_instant(F.lit("2026-03-08").cast("date"), F.lit(8 * 3600))
    assert one(spark, at) == dt.datetime(2026, 3, 8, 13, 0)
    assert one(spark, dates.hms_seconds(F.lit("25:10:05"))) == 90605


def test_dates_in_order_and_plausible(spark):
    f = lambda s: one(spark, dates.parse_first_date(F.lit(s), [("yyyy-MM-dd", 10), ("MM/dd/yyyy", 10)]))
    assert f("2026-01-02 10:00") == D(2026, 1, 2) and f("01/02/2026") == D(2026, 1, 2)
    assert f("01/02/1826") is None and f("soon") is None and f("") is None


def test_text(spark):
    assert one(spark, text.address_key(F.lit(" 12  Main St., #4 "))) == "12 MAIN ST 4"
    assert one(spark, text.street_part(F.lit("12 Main St, City"))) == "12 Main St"
    assert one(spark, text.street_part(F.lit("Main St, City"))) is None
    assert one(spark, text.place_key(F.lit(""), F.lit("Joe's"), F.lit("1 A St."))) == "name_address:JOE'S 1 A ST"
    assert one(spark, text.codes_to_state(F.lit(None).cast("string"), {"": "unknown"})) == "unknown"
    assert one(spark, text.codes_to_state(F.lit("new code"), {"": "unknown"})) == "unmapped"


def test_close_problem_order(spark):
    start, through = F.lit("2023-10-16").cast("date"), F.lit("2026-09-24").cast("date")
    f = lambda s, o, c: one(spark, text.close_problem(F.lit(s), F.lit(o).cast("date"), F.lit(c).cast("date"), through, start))
    assert f("closed", "2024-01-02", None) == "missing_close_date"
    assert f("closed", "2024-01-02", "0001-01-01") == "sentinel_close_date"
    assert f("closed", "2024-01-02", "2024-01-01") == "close_before_open"
    assert f("closed", "2024-01-02", "2026-09-26") == "close_in_future"
    assert f("closed", "2024-01-02", "2026-09-25") is None
    assert f("open", "2024-01-02", None) is None


def test_wilson_and_poisson(spark):
    lo, hi = intervals.wilson(F.lit(30), F.lit(41))
    assert one(spark, lo) == pytest.approx(0.580, abs=1e-3) and one(spark, hi) == pytest.approx(0.843, abs=1e-3)
    lo, hi = intervals.wilson(F.lit(0), F.lit(10))
    assert one(spark, lo) == 0 and one(spark, hi) == pytest.approx(0.2775, abs=1e-3)
    g = {r["n"]: r["g"] for r in spark.createDataFrame([(0.0,), (3.0,), (100.0,), (5000.0,)], "n double").select("n", intervals.garwood(F.col("n")).alias("g")).collect()}
    assert g[0]["low"] == 0 and g[0]["high"] == pytest.approx(3.688879, abs=1e-5)
    assert g[3]["low"] == pytest.approx(0.618672, abs=1e-5) and g[3]["high"] == pytest.approx(8.767273, abs=1e-5)
    assert g[100]["low"] == pytest.approx(81.3636, abs=1e-3) and g[100]["high"] == pytest.approx(121.6272, abs=1e-3)
    assert g[5000]["low"] == pytest.approx(4862.4, abs=1)


def test_acs(spark):
    c = [F.lit(float(v)) for v in (50, 100, 10, 12)]
    assert one(spark, intervals.acs_moe_ratio(*c)) == pytest.approx(math.sqrt(100 + 36) / 100)
    assert one(spark, intervals.acs_moe_proportion(*c)) == pytest.approx(math.sqrt(100 - 36) / 100)
    c[3] = F.lit(40.0)       # negative radicand: the ratio form
    assert one(spark, intervals.acs_moe_proportion(*c)) == pytest.approx(math.sqrt(100 + 400) / 100)
    rel = lambda e, m: one(spark, intervals.acs_reliability(F.lit(e), F.lit(m)))
    assert [rel(100.0, 10.0), rel(100.0, 40.0), rel(100.0, 90.0), rel(0.0, 5.0), rel(0.0, 0.0)] == ["high", "medium", "low", None, "high"]


def test_projection_origin(spark):
    x, y = geo.project(F.lit(-86.0), F.lit(34 + 20 / 60))
    assert one(spark, x) == pytest.approx(600000, abs=1e-6) and one(spark, y) == pytest.approx(0, abs=1e-6)
    # One kilometre north at a standard parallel is one kilometre on the map.
    (_, y1), (_, y2) = geo.project(F.lit(-86.0), F.lit(36 + 25 / 60)), geo.project(F.lit(-86.0), F.lit(36 + 25 / 60 + 0.009))
    assert one(spark, y2 - y1) == pytest.approx(998.7, abs=0.5)


def test_hexagons(spark):
    cell = one(spark, geo.hex_cell(F.lit(1000.0), F.lit(500.0), "h9"))
    q, r = geo.hex_parts(F.lit(cell))
    cx, cy = geo.hex_center(q, r, geo.HEX_EDGE["h9"])
    assert math.hypot(one(spark, cx) - 1000, one(spark, cy) - 500) <= 174.0
    disk = one(spark, geo.hex_disk(F.lit(cell)))
    assert len(set(disk)) == 7 and disk[0] == cell
    for other in disk[1:]:      # neighbourhood is symmetric
        assert cell in one(spark, geo.hex_disk(F.lit(other)))


def test_segment_distance(spark):
    d = lambda *v: one(spark, geo.segment_distance(*[F.lit(float(x)) for x in v]))
    assert d(0, 5, -1, 0, 1, 0) == 5 and d(4, 4, 0, 0, 1, 0) == 5 and d(3, 4, 0, 0, 0, 0) == 5


def test_round_distance_is_round(spark):
    # multiples of half a unit are ties, or doubles next to one; then roots, large values and what is no number
    odd = [0.0, 1e-300, 4.9e-7, 1.0000005, 2.5e-6, 2 ** 40 * 1e-6, 2.0 ** 40, 1e15 + 0.125, 1e300, math.inf, math.nan, None]
    ties = [math.nextafter(k * 5e-7, to) for k in range(1, 4000, 7) for to in (0.0, k * 5e-7, 1.0)]
    rows = [(v,) for v in odd + ties + [math.sqrt(n) for n in range(10_001)] + [n + 0.0000005 for n in range(0, 1_000_000, 997)]]
    v = F.col("v")
    df = spark.createDataFrame(rows, "v double").select(
        v, *[f(v, d).alias(f"{n}{d}") for d in (0, 2, 6) for n, f in (("fast", geo.round_distance), ("slow", F.round))])
    got = df.collect()
    assert len(got) == len(rows)
    assert [r for r in got if any(repr(r[f"fast{d}"]) != repr(r[f"slow{d}"]) for d in (0, 2, 6))] == []


def test_poisson_bounds_have_one_formula_at_every_size():
    import numpy as np

    from wardstat.functions.intervals import _gamma_quantile, _lower_gamma
    a = np.array([1.0, 2, 5, 30, 199, 200, 9_999, 1_000_000, 1_000_001, 50_000_000])
    for p in (0.025, 0.975):
        x = _gamma_quantile(a, p)
        assert np.allclose(_lower_gamma(a, x)[0], p, rtol=1e-7)
        assert abs((x[8] - x[7]) - 1.0) < 0.01
    assert abs(_gamma_quantile(np.array([1.0]), 0.025)[0] - 0.0253178) < 1e-6 and abs(_gamma_quantile(np.array([4.0]), 0.975)[0] - 8.76727) < 1e-4
