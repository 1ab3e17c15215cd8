"""Business-day calendar as a dimension table, and joins against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstat.session import cut_lineage

# Holiday name, date rule, first year and last year it is kept
# (None: still kept).
HOLIDAYS = [
    ("new_years_day", "new_years_day", 2015, None),
    ("mlk_birthday", "mlk_day", 2015, None),
    ("presidents_day", "presidents_day", 2015, None),
    ("good_friday", "good_friday", 2015, None),
    ("mlk_memorial", "mlk_memorial", 2015, None),
    ("memorial_day", "memorial_day", 2015, None),
    ("juneteenth", "juneteenth", 2021, None),
    ("independence_day", "independence_day", 2015, None),
    ("labor_day", "labor_day", 2015, None),
    ("veterans_day", "veterans_day", 2015, None),
    ("thanksgiving", "thanksgiving", 2015, None),
    ("thanksgiving_holiday", "day_after_thanksgiving", 2015, None),
    ("christmas_eve", "christmas_eve", 2015, None),
    ("christmas_day", "christmas_day", 2015, None),
]

# The dimension spans these years unless told otherwise: some 110,000 rows, a
# size set here and not by the data, so it is always safe to broadcast. A date
# outside is an error, never a silent null.
FIRST_YEAR, LAST_YEAR = 1900, 2200


def _within(day: Column, found: Column) -> Column:
    outside = F.raise_error(F.concat(F.lit("outside the calendar's years: "), day.cast("string"))).cast("bigint")
    return F.when(day.isNotNull() & found.isNull(), outside).otherwise(found)


def _on(y: Column, month: int, day: int) -> Column:
    return F.make_date(y, F.lit(month), F.lit(day))


def _nth(y: Column, month: int, weekday: int, n: int) -> Column:
    """n-th (or, for -1, last) weekday of a month; weekday 0 is Monday."""
    if n > 0:
        first = _on(y, month, 1)
        return F.date_add(first, F.pmod(weekday - F.weekday(first), F.lit(7)) + 7 * (n - 1))
    last = F.last_day(_on(y, month, 1))
    return F.date_sub(last, F.pmod(F.weekday(last) - weekday, F.lit(7)))


def _shift(d: Column, saturday: Column | int, sunday: Column | int) -> Column:
    as_col = lambda v: F.lit(v) if isinstance(v, int) else v
    w = F.weekday(d)
    return F.date_add(d, F.when(w == 5, as_col(saturday)).when(w == 6, as_col(sunday)).otherwise(0))


def easter(y: Column) -> Column:
    """Gregorian Easter: golden number, epact and the Sunday after full moon."""
    golden = y % 19
    century = F.floor(y / 100)
    epact_shift = century - F.floor(century / 4) - F.floor((8 * century + 13) / 25)
    moon = (19 * golden + epact_shift + 15) % 30
    full = moon - F.floor(moon / 28) * (1 - F.floor(29 / (moon + 1)) * F.floor((21 - golden) / 11))
    sunday = (y + F.floor(y / 4) + full + 2 - century + F.floor(century / 4)) % 7
    return F.date_add(_on(y, 3, 28), (full - sunday).cast("int"))


def rule_dates(y: Column) -> dict[str, Column]:
    """Observed date of every rule in year ``y``."""
    good_friday = F.date_sub(easter(y), 2)
    april4 = _on(y, 4, 4)
    friday_taken = F.date_sub(april4, 1) == good_friday
    return {
        "new_years_day": _shift(_on(y, 1, 1), -1, 1),
        "mlk_day": _nth(y, 1, 0, 3),
        "presidents_day": _nth(y, 2, 0, 3),
        "good_friday": good_friday,
        "mlk_memorial": _shift(april4, F.when(friday_taken, 2).otherwise(-1), 1),
        "memorial_day": _nth(y, 5, 0, -1),
        "juneteenth": _shift(_on(y, 6, 19), -1, 1),
        "independence_day": _shift(_on(y, 7, 4), -1, 1),
        "labor_day": _nth(y, 9, 0, 1),
        "columbus_day": _nth(y, 10, 0, 2),
        "veterans_day": _shift(_on(y, 11, 11), -1, 1),
        "thanksgiving": _nth(y, 11, 3, 4),
        "day_after_thanksgiving": F.date_add(_nth(y, 11, 3, 4), 1),
        "christmas_eve": _shift(_on(y, 12, 24), -1, -2),
        "christmas_day": _shift(_on(y, 12, 25), -1, 1),
    }


def holidays(years: DataFrame, rules=HOLIDAYS, explicit: list[tuple[str, str]] = ()) -> DataFrame:
    """Holiday dates for the years in ``years.year``; one row per date.

    ``explicit`` lists (holiday, ISO date) pairs outside the rules. When two
    holidays fall on one date the alphabetically first name is kept.
    """
    dates = rule_dates(F.col("year"))
    entries = [F.struct(F.lit(name).alias("holiday"), dates[rule].alias("date"),
                        F.col("year").between(first, 9999 if last is None else last).alias("kept"))
               for name, rule, first, last in rules]
    entries += [F.struct(F.lit(n).alias("holiday"), F.lit(d).cast("date").alias("date"),
                         (F.year(F.lit(d).cast("date")) == F.col("year")).alias("kept"))
                for n, d in explicit]
    return (years.select(F.explode(F.array(*entries)).alias("h")).where("h.kept")
            .groupBy(F.col("h.date").alias("date")).agg(F.min("h.holiday").alias("holiday")))


_BUILT: dict[tuple, DataFrame] = {}


def calendar_dim(spark: SparkSession, rules=HOLIDAYS, first_year: int = FIRST_YEAR,
                 last_year: int = LAST_YEAR) -> DataFrame:
    """date, holiday, is_bd, cum (business days up to and including the date).

    Built once per application and kept as a checkpoint, since every request
    metric joins it several times.
    """
    key = (spark.sparkContext.applicationId, tuple(rules), first_year, last_year)
    if key not in _BUILT:
        _BUILT[key] = cut_lineage(_calendar(spark, rules, first_year, last_year))
    return _BUILT[key]


def _calendar(spark: SparkSession, rules, first_year: int, last_year: int) -> DataFrame:
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    days = spark.range(1).select(F.explode(F.sequence(
        F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
        F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))).alias("date"))
    marked = (days.join(F.broadcast(holidays(years, rules)), "date", "left")
              .withColumn("is_bd", (F.weekday("date") < 5) & F.col("holiday").isNull()))
    # Per-year running counts plus the total of earlier years.
    by_year = Window.partitionBy(F.year("date")).orderBy("date")
    totals = marked.groupBy(F.year("date").alias("y")).agg(F.count_if("is_bd").alias("in_year"))
    before = totals.withColumn("before", F.coalesce(F.sum("in_year").over(
        Window.partitionBy(F.lit(0)).orderBy("y").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (marked.withColumn("in_year", F.sum(F.col("is_bd").cast("int")).over(by_year))
            .join(F.broadcast(before.select("y", "before")), F.year("date") == F.col("y"))
            .select("date", "holiday", "is_bd", (F.col("in_year") + F.col("before")).alias("cum")))


def with_business_flag(df: DataFrame, day: str, cal: DataFrame, out: str = "is_bd") -> DataFrame:
    side = F.broadcast(cal.select(F.col("date").alias("_d"), F.col("is_bd").alias(out)))
    return df.join(side, F.col(day) == F.col("_d"), "left").drop("_d")


def with_business_days(df: DataFrame, start: str, end: str, cal: DataFrame, out: str) -> DataFrame:
    """Business days d with start < d <= end; null if an end is missing or they are reversed."""
    lo = F.broadcast(cal.select(F.col("date").alias("_ds"), F.col("cum").alias("_cs")))
    hi = F.broadcast(cal.select(F.col("date").alias("_de"), F.col("cum").alias("_ce")))
    return (df.join(lo, F.col(start) == F.col("_ds"), "left").join(hi, F.col(end) == F.col("_de"), "left")
            .withColumn(out, F.when(F.col(end) >= F.col(start), _within(F.col(end), F.col("_ce")) - _within(F.col(start), F.col("_cs"))))
            .drop("_ds", "_cs", "_de", "_ce"))


def with_business_age(df: DataFrame, start: str, through: Column, cal: DataFrame, out: str) -> DataFrame:
    """Business days from ``start`` to one fixed day; null when it starts later.

    The fixed day's running count is a scalar, so only the start is joined.
    """
    upto = cal.where(F.col("date") == through).select("cum").scalar()
    lo = F.broadcast(cal.select(F.col("date").alias("_ds"), F.col("cum").alias("_cs")))
    return (df.join(lo, F.col(start) == F.col("_ds"), "left")
            .withColumn(out, F.when(through >= F.col(start), upto - _within(F.col(start), F.col("_cs")))).drop("_ds", "_cs"))


def with_deadline(df: DataFrame, start: str, n: str, cal: DataFrame, out: str) -> DataFrame:
    """The date ``n`` business days after ``start``; the start itself for n = 0."""
    lo = F.broadcast(cal.select(F.col("date").alias("_ds"), F.col("cum").alias("_cs")))
    hi = F.broadcast(cal.where("is_bd").select(F.col("cum").alias("_ct"), F.col("date").alias("_dt")))
    ends = F.raise_error(F.concat(F.lit("the deadline is outside the calendar's years: "), F.col(start).cast("string"))).cast("date")
    return (df.join(lo, F.col(start) == F.col("_ds"), "left")
            .join(hi, F.col("_cs") + F.col(n) == F.col("_ct"), "left")
            .withColumn(out, F.when(F.col(n) == 0, F.col(start)).when(F.col(start).isNotNull() & (F.col(n) > 0) & F.col("_dt").isNull(), ends)
                        .otherwise(F.col("_dt")))
            .drop("_ds", "_cs", "_ct", "_dt"))
