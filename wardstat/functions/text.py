"""Column functions on text, codes and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a missing cell in exported files.
NA_TEXT = ("", "NA", "NULL")


def na_text(c: Column, spellings: Sequence[str] = NA_TEXT) -> Column:
    return F.when(~c.isin(*spellings), c)


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def address_key(text: Column) -> Column:
    """Upper-case, punctuation and repeated blanks removed: the key of an address."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(text), "[.,#]", " "), r"\s+", " "))


def place_key(place_id: Column, name: Column, address: Column) -> Column:
    """Stable key of a place: its permit number, else its name and address."""
    by_text = F.concat(F.lit("name_address:"), address_key(F.concat_ws(" ", name, address)))
    return F.when(place_id.isNotNull() & (place_id != ""),
                  F.concat(F.lit("permit:"), place_id)).otherwise(by_text)


def street_part(location: Column) -> Column:
    """Street line of a location text; null when it does not start with a house number."""
    first = F.trim(F.split(location, ",")[0])
    return F.when(first.rlike(r"^[1-9][0-9]*\s+\S"), first)


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds; null when none does.

    A rule whose condition is unknown does not hold, so it never masks a later one.
    """
    out = None
    for name, cond in rules:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def codes_to_state(code: Column, mapping: dict[str, str], other: str = "unmapped") -> Column:
    """Look a code up in a small fixed mapping; a missing code is looked up as ''."""
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.try_element_at(m, F.coalesce(code, F.lit(""))), F.lit(other))


def match_quality(lon: Column, lat: Column, located: Column) -> Column:
    return (F.when(located, "source_point")
            .when(lon.isNull() | lat.isNull(), "missing").otherwise("out_of_area"))


def geocode_quality(status: Column, kind: Column) -> Column:
    """Match class of one geocoder response line."""
    s, k = F.upper(status), F.upper(kind)
    return (F.when((s == "MATCH") & (k == "EXACT"), "exact").when(s == "MATCH", "non_exact")
            .when(s == "TIE", "tie").otherwise("no_match"))


def lon_lat_pair(text: Column) -> tuple[Column, Column]:
    """Split 'lon,lat'; anything that is not exactly two numbers gives nulls."""
    parts = F.split(text, ",")
    two = F.size(parts) == 2
    return (F.when(two, parts[0].try_cast("double")), F.when(two, parts[1].try_cast("double")))


def in_box(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Inside [xmin, xmax] x [ymin, ymax]; unknown coordinates are not inside."""
    return F.coalesce(x.between(box[0], box[2]) & y.between(box[1], box[3]), F.lit(False))


def ratio_class(r: Column, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open bin [b(i-1), b(i)) holding ``r``."""
    out = F.when(r.isNull(), F.lit(None).cast("string"))
    for b, lab in zip(breaks, labels):
        out = out.when(r < b, lab)
    return out.otherwise(labels[-1])


def close_problem(state: Column, opened: Column, closed: Column, through: Column, system_start: Column) -> Column:
    """Why a closed record's close date cannot be used; null when it can.

    A date before the system start is a placeholder and wins over every other
    reason; one day of slack after ``through`` covers the run day itself.
    """
    is_closed = state == "closed"
    return first_reason([
        ("sentinel_close_date", is_closed & (closed < system_start)),
        ("missing_close_date", is_closed & closed.isNull()),
        ("close_before_open", is_closed & (closed < opened)),
        ("close_in_future", is_closed & (closed > F.date_add(through, 1)))])


def suppression(reported: Column, n: Column, suppressed: Column, min_n: int,
                population: tuple[Column, int] | None = None, parcels: tuple[Column, int] | None = None) -> Column:
    """Why a cell is blank ('' when it is not), most specific reason first."""
    rules = [("not reported for this kind of area", ~reported), ("no records in this window", n.isNull())]
    enough = n >= min_n
    if population:
        rules.append((f"fewer than {population[1]} residents", suppressed & enough & (population[0] < population[1])))
    if parcels:
        rules.append((f"fewer than {parcels[1]} parcels", suppressed & enough & (parcels[0] < parcels[1])))
    rules.append(("too few records", suppressed))
    return F.coalesce(first_reason(rules), F.lit(""))
