"""Holiday rules and business days, against known dates and a day-by-day count."""

import datetime as dt
import random

from pyspark.sql import functions as F

from wardstat.operators import calendar as C

D = dt.date


def test_2026_holidays(spark):
    years = spark.createDataFrame([(2026,)], "year int")
    got = {r["holiday"]: r["date"] for r in C.holidays(years).collect()}
    assert got == {
        "new_years_day": D(2026, 1, 1), "mlk_birthday": D(2026, 1, 19), "presidents_day": D(2026, 2, 16), "good_friday": D(2026, 4, 3),
        "mlk_memorial": D(2026, 4, 6), "memorial_day": D(2026, 5, 25), "juneteenth": D(2026, 6, 19), "independence_day": D(2026, 7, 3),
        "labor_day": D(2026, 9, 7), "veterans_day": D(2026, 11, 11), "thanksgiving": D(2026, 11, 26), "thanksgiving_holiday": D(2026, 11, 27),
        "christmas_eve": D(2026, 12, 24), "christmas_day": D(2026, 12, 25)}


def test_first_year_and_explicit_dates(spark):
    years = spark.createDataFrame([(2019,), (2020,)], "year int")
    got = {(r["holiday"], r["date"]) for r in C.holidays(years, explicit=[("storm", "2020-03-03"), ("other", "2021-03-03")]).collect()}
    assert ("storm", D(2020, 3, 3)) in got and not any(h in ("juneteenth", "other") for h, _ in got)


def test_easter(spark):
    known = {1961: D(1961, 4, 2), 2000: D(2000, 4, 23), 2008: D(2008, 3, 23), 2011: D(2011, 4, 24), 2025: D(2025, 4, 20), 2038: D(2038, 4, 25)}
    df = spark.createDataFrame([(y,) for y in known], "y int").select("y", C.easter(F.col("y")).alias("e"))
    assert {r["y"]: r["e"] for r in df.collect()} == known


def test_business_days_match_a_day_by_day_count(spark):
    cal = C.calendar_dim(spark)
    off = {r["date"] for r in cal.where("holiday is not null").collect()}
    work = lambda d: d.weekday() < 5 and d not in off
    rng = random.Random(1)
    rows = []
    for i in range(200):
        s = D(2023, 10, 16) + dt.timedelta(days=rng.randrange(1000))
        rows.append((i, s, s + dt.timedelta(days=rng.randrange(-3, 60)), rng.randrange(12)))
    df = spark.createDataFrame(rows, "id int, s date, e date, n int")
    df = C.with_deadline(C.with_business_days(df, "s", "e", cal, "bd"), "s", "n", cal, "due")
    for r in df.collect():
        span = [r["s"] + dt.timedelta(days=k) for k in range(1, (r["e"] - r["s"]).days + 1)]
        assert r["bd"] == (sum(map(work, span)) if r["e"] >= r["s"] else None)
        d, k = r["s"], r["n"]
        while k > 0:
            d += dt.timedelta(days=1)
            k -= work(d)
        assert r["due"] == d


def test_labor_day_weekend(spark):
    df = spark.createDataFrame([(D(2026, 9, 4), D(2026, 9, 8)), (D(2026, 9, 4), None)], "s date, e date")
    out = C.with_business_days(df, "s", "e", C.calendar_dim(spark), "bd").orderBy("e").collect()
    assert [r["bd"] for r in out] == [None, 1]
