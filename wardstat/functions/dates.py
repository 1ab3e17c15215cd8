"""Column functions on dates, clock times and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_TZ = "America/Chicago"


def roll_months(d: Column, months) -> Column:
    """Add calendar months; a day the target month lacks rolls into the next month."""
    n = months if isinstance(months, Column) else F.lit(months)
    first = F.trunc(d, "MM")
    return F.date_add(F.add_months(first, n.cast("int")), F.dayofmonth(d) - 1)


def window_start_days(through: Column, days) -> Column:
    """First day of the trailing window of ``days`` days that ends on ``through``."""
    n = days if isinstance(days, Column) else F.lit(days)
    return F.date_sub(through, (n - 1).cast("int"))


def window_start_months(through: Column, months) -> Column:
    """First day of the trailing window of calendar months that ends on ``through``."""
    n = months if isinstance(months, Column) else F.lit(months)
    return roll_months(F.date_add(through, 1), -n)


def last_complete_month(last_edit: Column, as_of: Column) -> Column:
    """Data are complete through the month before the last edit, never past as_of - 1."""
    return F.least(F.date_sub(F.trunc(last_edit, "MM"), 1), F.date_sub(as_of, 1))


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def local_day(ts: Column, tz: str = LOCAL_TZ) -> Column:
    """Calendar date of an instant in the local zone."""
    return F.to_date(F.from_utc_timestamp(ts, tz))


def _first_parse(text: Column, patterns: list[str]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


# Accepted timestamp spellings, tried in this order.
TIMESTAMP_PATTERNS = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]",
                      "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd"]


def local_day_from_text(text: Column, tz: str = LOCAL_TZ) -> Column:
    """Text ending in Z is UTC and is moved to local time; other text is already local."""
    utc = _first_parse(F.regexp_replace(text, "Z$", ""), TIMESTAMP_PATTERNS)
    return F.when(F.endswith(text, F.lit("Z")), local_day(utc, tz)).otherwise(
        F.to_date(_first_parse(text, TIMESTAMP_PATTERNS)))


def local_clock_to_utc(text: Column, pattern: str = "MM/dd/yyyy hh:mm:ss a", tz: str = LOCAL_TZ) -> Column:
    """Zone-less clock text read as local time; the repeated autumn hour is daylight time."""
    clean = F.nullif(F.trim(text), F.lit(""))
    return F.to_utc_timestamp(F.try_to_timestamp(clean, F.lit(pattern)), tz)


def parse_first_date(text: Column, patterns: list[tuple[str, int]],
                     min_year: int = 1990, max_year: int = 2100) -> Column:
    """First pattern that reads the text as a date in a plausible year.

    Each pattern comes with the number of leading characters it reads, so
    trailing text (a time of day, say) does not stop it; 0 reads everything.
    """
    clean = F.trim(text)
    tries = []
    for p, width in patterns:
        part = F.substring(clean, 1, width) if width else clean
        d = F.to_date(F.try_to_timestamp(part, F.lit(p)))
        tries.append(F.when(F.year(d).between(min_year, max_year), d))
    return F.coalesce(*tries)


def hms_seconds(hms: Column) -> Column:
    """HH:MM:SS to seconds; hours may pass 24."""
    p = F.split(hms, ":")
    return p[0].cast("int") * 3600 + p[1].cast("int") * 60 + p[2].cast("int")


def scheduled_instant(day: Column, seconds: Column, tz: str = LOCAL_TZ) -> Column:
    """Schedule time as an instant: local noon less twelve hours plus the offset.

    Counting from noon keeps the clock right on days when daylight time changes.
    """
    noon = F.to_utc_timestamp(F.to_timestamp(F.date_format(day, "yyyy-MM-dd 12:00:00")), tz)
    return F.timestamp_seconds(F.unix_timestamp(noon) - 12 * 3600 + seconds)


# Weekday peak hours, local time.
PEAK_HOURS = ((6, 9), (15, 18))


def in_peak(ts: Column, tz: str = LOCAL_TZ) -> Column:
    t = F.from_utc_timestamp(ts, tz)
    h = F.hour(t) + F.minute(t) / 60
    inside = F.lit(False)
    for lo, hi in PEAK_HOURS:
        inside = inside | ((h >= lo) & (h < hi))
    return (F.weekday(t) < 5) & inside
