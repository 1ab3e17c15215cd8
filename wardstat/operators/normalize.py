"""Raw source rows to clean records. Exclusions are flagged, never dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstat.functions import text
from wardstat.operators.calendar import with_business_age, with_business_days
from wardstat.operators.sequences import latest_per_key


def request_records(raw: DataFrame, cal: DataFrame, states: dict[str, str], through: Column, system_start: Column,
                    box: tuple[float, float, float, float]) -> DataFrame:
    """One clean row per request.

    ``raw``: id, type, status, opened, closed (dates), city_duplicate, app_url, x, y.
    """
    d = raw.withColumn("state", text.codes_to_state(F.col("status"), states))
    d = d.withColumn("close_problem", text.close_problem(F.col("state"), F.col("opened"), F.col("closed"),
                                                         through, system_start))
    d = d.withColumn("is_closed", (F.col("state") == "closed") & F.col("close_problem").isNull())
    d = d.withColumn("close_date", F.when(F.col("is_closed"), F.col("closed")))
    d = with_business_days(d, "opened", "close_date", cal, "bd_to_close")
    d = with_business_age(d, "opened", through, cal, "age_bd")
    here = text.in_box(F.col("x"), F.col("y"), box)
    reason = text.first_reason([
        ("missing_request_type", text.blank(F.col("type"))),
        ("pre_migration", F.col("opened") < system_start),
        ("partial_day", F.col("opened") > through),
        ("city_duplicate", F.col("city_duplicate")),
        ("unknown_status", F.col("state").isin("unknown", "unmapped"))])
    return (d.withColumn("origin", F.when(text.blank(F.col("app_url")), "311").otherwise("seeclickfix"))
            .withColumn("match_quality", text.match_quality(F.col("x"), F.col("y"), here))
            .withColumn("x", F.when(here, F.col("x"))).withColumn("y", F.when(here, F.col("y")))
            .withColumn("exclusion", reason))


def permit_records(raw: DataFrame, sectors: DataFrame, categories: DataFrame, through: Column,
                   box: tuple[float, float, float, float]) -> DataFrame:
    """``raw``: id, issued, sub_type, work_type, value, x, y.

    Maps: sectors (sub_type, sector) and categories (work_type, work, category);
    both are config tables. A type mapped to 'excluded' is not a permit.
    """
    d = (raw.withColumn("sub_type", F.trim("sub_type")).withColumn("work_type", F.trim("work_type"))
         .join(F.broadcast(sectors), "sub_type", "left").join(F.broadcast(categories), "work_type", "left"))
    here = text.in_box(F.col("x"), F.col("y"), box)
    reason = text.first_reason([
        ("missing_issue_date", F.col("issued").isNull()),
        ("not_a_permit", F.coalesce(F.col("sector") == "excluded", F.lit(False))
         | F.coalesce(F.col("category") == "excluded", F.lit(False))),
        ("unmapped_type", F.col("sector").isNull() | F.col("category").isNull()),
        ("after_data_through", F.col("issued") > through)])
    return d.select("id", F.col("issued").alias("issue_date"), "sector", "work", "category",
                    F.when(F.col("value") > 0, F.col("value")).alias("value"),
                    F.when(here, F.col("x")).alias("x"), F.when(here, F.col("y")).alias("y"),
                    text.match_quality(F.col("x"), F.col("y"), here).alias("match_quality"), reason.alias("exclusion"))


def demolition_records(raw: DataFrame, through: Column, box: tuple[float, float, float, float]) -> DataFrame:
    """Permit-shaped rows from the demolition source; the latest status date per permit wins.

    ``raw``: id, status_date, cost, x, y (numbers may be text).
    """
    last = latest_per_key(raw, ["id"], [F.col("status_date"), F.col("cost")], ["status_date", "cost", "x", "y"])
    x, y, cost = (F.col(c).try_cast("double") for c in ("x", "y", "cost"))
    here = text.in_box(x, y, box)
    reason = text.first_reason([("missing_status_date", F.col("status_date").isNull()),
                                ("after_data_through", F.col("status_date") > through)])
    return last.select("id", F.col("status_date").alias("issue_date"), F.lit(None).cast("string").alias("sector"),
                       F.lit("demolition").alias("work"), F.lit("demolition").alias("category"),
                       F.when(cost > 0, cost).alias("value"), F.when(here, x).alias("x"), F.when(here, y).alias("y"),
                       text.match_quality(x, y, here).alias("match_quality"), reason.alias("exclusion"))


def inspection_records(raw: DataFrame, kinds: dict[str, str], through: Column, data_from: Column | None = None) -> DataFrame:
    """``raw``: place_id, name, address, date, kind_text, score_text plus any id columns."""
    m = F.create_map(*[F.lit(v) for kv in kinds.items() for v in kv])
    kind = F.try_element_at(m, F.col("kind_text"))
    rules = [("missing_inspection_date", F.col("date").isNull()), ("unmapped_inspection_type", kind.isNull()),
             ("after_data_through", F.col("date") > through)]
    if data_from is not None:
        rules.append(("before_data_from", F.col("date") < data_from))
    return (raw.withColumn("place", text.place_key(F.col("place_id"), F.col("name"), F.col("address")))
            .withColumn("kind", kind).withColumn("score", F.col("score_text").try_cast("double"))
            .withColumn("exclusion", text.first_reason(rules)))


def place_records(listed: DataFrame, inspections: DataFrame, excluded_types: list[str]) -> DataFrame:
    """Listed places first, then places seen only in inspections, from their latest record.

    Both: place, name, address, place_type; inspections also date. A missing
    type is kept; listed rows repeated under one key keep the first by name.
    """
    cols = ["name", "address", "place_type"]
    a = listed.groupBy("place").agg(F.min(F.struct(*cols)).alias("r")).select("place", "r.*")
    seen = latest_per_key(inspections, ["place"], [F.col("date"), F.col("name")], cols)
    only = seen.join(a.select("place"), "place", "left_anti")
    return a.unionByName(only).where(~F.coalesce(F.col("place_type").isin(*excluded_types), F.lit(False)))


def geocoded(rows: DataFrame, cache: DataFrame, key: Column, accepted=("exact", "non_exact")) -> DataFrame:
    """Serve coordinates from the cache by address key; rejected or missing matches stay unlocated.

    ``cache``: address_key (unique), longitude, latitude, match_quality.
    """
    d = rows.withColumn("address_key", key).join(cache, "address_key", "left")
    ok = F.col("match_quality").isin(*accepted)
    return (d.withColumn("longitude", F.when(ok, F.col("longitude")))
            .withColumn("latitude", F.when(ok, F.col("latitude")))
            .withColumn("match_quality", F.coalesce("match_quality", F.lit("no_match"))))


def addresses_to_geocode(rows: DataFrame, cache: DataFrame, key: Column) -> DataFrame:
    """Distinct address keys the cache does not hold yet."""
    return rows.select(key.alias("address_key")).distinct().join(cache.select("address_key"), "address_key", "left_anti")


def base_records(df: DataFrame) -> DataFrame:
    """Records every metric counts: not excluded, not a duplicate, inside the city."""
    return df.where(F.col("exclusion").isNull() & F.col("duplicate_of").isNull()
                    & F.coalesce(F.col("in_city"), F.lit(False)))


def program_rows(df: DataFrame, include: DataFrame, program: str) -> DataFrame:
    """Rows of included programs; a source without the field is kept whole."""
    if program not in df.columns:
        return df
    return df.join(include.select(program).distinct(), program, "left_semi")


def code_annotations(df: DataFrame) -> DataFrame:
    """Survey annotation codes: a negative estimate is missing; a margin of -555555555
    means the estimate is controlled (margin 0), other negative margins are missing."""
    return (df.withColumn("moe", F.when(F.col("moe") == -555555555, 0.0).when(F.col("moe") >= 0, F.col("moe")))
            .withColumn("estimate", F.when(F.col("estimate") >= 0, F.col("estimate"))))


def subgroup_condition(subgroup: str, type_col: Column, category_col: Column) -> Column:
    """'' = all; 'a|b' = listed types; 'category:x' = every type of that category."""
    if not subgroup:
        return F.lit(True)
    if subgroup.startswith("category:"):
        return F.coalesce(category_col == subgroup.split(":", 1)[1], F.lit(False))
    return F.coalesce(type_col.isin(*subgroup.split("|")), F.lit(False))


def fill_empty_areas(long: DataFrame, empty: DataFrame, key: str) -> DataFrame:
    """In areas without residents an unavailable estimate is truly zero; elsewhere it stays missing."""
    z = long.join(empty.select(key).distinct().withColumn("_empty", F.lit(True)), key, "left")
    fill = F.col("estimate").isNull() & F.coalesce("_empty", F.lit(False))
    return (z.withColumn("moe", F.when(fill, 0.0).otherwise(F.col("moe")))
            .withColumn("estimate", F.when(fill, 0.0).otherwise(F.col("estimate"))).drop("_empty"))
