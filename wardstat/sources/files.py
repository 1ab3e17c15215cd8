"""Landed files to DataFrames: exports, JSON lines, schedules, boundaries, snapshots."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.functions.dates import LOCAL_TZ, local_day
from wardstat.functions.text import na_text


def read_csv(spark: SparkSession, path: str, schema: str, na: tuple[str, ...] = ("", "NA")) -> DataFrame:
    """Typed CSV; ids stay text so leading zeros survive, and every NA spelling becomes null."""
    from pyspark.sql import types as T
    want = T.StructType.fromDDL(schema)
    raw = spark.read.csv(path, schema=T.StructType([T.StructField(f.name, T.StringType()) for f in want]), header=True)
    return raw.select(*[na_text(F.col(f.name), na).cast(f.dataType).alias(f.name) for f in want])


def read_export(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """All-text columns of the export files whose name matches a glob (any case)."""
    glob = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in pattern)
    raw = spark.read.option("pathGlobFilter", glob).csv(folder, header=True, inferSchema=False)
    return raw.select(*[na_text(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def canonical(raw: DataFrame, mapping: dict[str, str | None], required: list[str] = (),
              dates: dict[str, list] | None = None) -> tuple[DataFrame, dict]:
    """Rename to canonical fields, trim, parse dates, keep repeated source rows once.

    Returns the table and a report of absent and missing required fields. Exact
    repeats are removed over ALL source columns, before the projection.
    """
    from wardstat.functions.dates import parse_first_date
    absent = [f for f, s in mapping.items() if s is None or s not in raw.columns]
    uniq = raw.dropDuplicates()
    cols = []
    for field, src in mapping.items():
        if field in absent:
            continue
        c = F.trim(F.col(f"`{src}`"))
        if dates and field in dates:
            c = parse_first_date(c, dates[field])
        cols.append(c.alias(field))
    return uniq.select(*cols), {"absent": absent, "missing_required": [f for f in required if f in absent]}


def read_json_lines(spark: SparkSession, path: str, schema: str, still_open: bool = False) -> DataFrame:
    """JSON lines (gzip or plain); lines that are not complete objects are left out.

    ``still_open`` reads a file whose last gzip member may be cut short.
    """
    lines = spark.read.option("ignoreCorruptFiles", str(still_open).lower()).text(path)
    return parse_json_lines(lines, "value", schema)


def parse_json_lines(lines: DataFrame, col: str, schema: str) -> DataFrame:
    whole = lines.where(F.endswith(F.col(col), F.lit("}")))
    return (whole.select(F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}).alias("r"))
            .where("r is not null").select("r.*"))


def vehicle_positions(reports: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Usable reports, one per (vehicle, timestamp), with UTC time and local service date.

    Of repeated reports the one with the lowest entity, trip and place is kept.
    """
    p = reports.where("timestamp is not null and lat is not null and lon is not null")
    p = p.withColumn("vehicle", F.coalesce(F.nullif(F.col("vehicle_id"), F.lit("")), F.col("entity_id")))
    rest = [c for c in p.columns if c not in ("vehicle", "timestamp")]
    p = p.groupBy("vehicle", "timestamp").agg(F.min(F.struct(*rest)).alias("r")).select("vehicle", "timestamp", "r.*")
    p = p.withColumn("time", F.timestamp_seconds("timestamp"))
    return p.withColumn("service_date", local_day(F.col("time"), tz))


def snapshots(raw: DataFrame, poll: str, items: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(polls, observations) of nested snapshots. An empty snapshot still is a poll.

    A repeated poll time keeps one snapshot, a repeated key in a poll one row.
    """
    s = raw.where(F.col(poll).isNotNull())
    polls = s.select(poll).distinct()
    obs = s.select(poll, F.explode(items).alias("o"))
    obs = obs.groupBy(poll, F.col(f"o.{key}").alias(key)).agg(F.min("o").alias("o"))
    return polls, obs.select(poll, "o.*")


def poll_log(raw: DataFrame, feed: str) -> DataFrame:
    return raw.where(F.col("feed") == feed).select("time", F.coalesce("ok", F.lit(False)).alias("ok"))


# The columns of the schedule text files that are typed.
GTFS = {
    "trips": "route_id string, service_id string, trip_id string, direction_id string, block_id string, shape_id string",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int, "
                  "shape_dist_traveled double, timepoint int",
    "stops": "stop_id string, stop_name string, stop_lat double, stop_lon double",
    "shapes": "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, shape_dist_traveled double",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, "
                "sunday int, start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type int",
}


def read_gtfs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Unzipped schedules landed as <folder>/version=<date>/<table>.txt; the version is a column."""
    out = {}
    for name, ddl in GTFS.items():
        cols = [c.strip().split(" ") for c in ddl.split(",")]
        raw = spark.read.option("basePath", folder).csv(f"{folder}/version=*/{name}.txt", header=True, inferSchema=False)
        have = set(raw.columns)
        t = raw.select("version", *[(F.col(c) if c in have else F.lit(None)).cast(ty).alias(c) for c, ty in cols])
        out[name] = t.withColumn("timepoint", F.col("timepoint") == 1) if name == "stop_times" else t
    return out


def active_services(days: DataFrame, calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(day, service_id) running: weekday pattern in range, plus added, minus removed dates.

    ``calendar``: service_id, weekdays (array of 0-6), start_date, end_date;
    ``exceptions``: service_id, day, exception_type (1 added, 2 removed).
    """
    span = calendar.withColumn("day", F.explode(F.sequence("start_date", "end_date"))).where(
        F.array_contains("weekdays", F.weekday("day"))).select("day", "service_id")
    on = span.unionByName(exceptions.where("exception_type = 1").select("day", "service_id")).distinct()
    on = on.join(exceptions.where("exception_type = 2").select("day", "service_id"), ["day", "service_id"], "left_anti")
    return on.join(days.select("day").distinct(), "day", "left_semi")


def read_boundaries(spark: SparkSession, path: str, geo_type: str, id_field: str, project=None) -> DataFrame:
    """GeoJSON polygons to edge rows in metres (geo_type, geo_id, ring, x1, y1, x2, y2).

    Open rings are closed, repeated vertices dropped, and rings that cross or touch themselves cut into edges that bound
    the same even-odd region (``polygons.repair``).
    """
    from wardstat.functions import geo
    from wardstat.operators.polygons import repair
    from wardstat.operators.spatial import ring_edges
    ring = "array<array<array<double>>>"
    schema = (f"features array<struct<properties map<string,string>, geometry struct<type string, coordinates string>>>")
    doc = spark.read.option("multiLine", True).schema(schema).json(path)
    f = doc.select(F.explode("features").alias("f")).select(
        F.col("f.properties")[id_field].alias("geo_id"), "f.geometry.*")
    one = F.from_json("coordinates", ring)
    many = F.from_json("coordinates", f"array<{ring}>")
    rings = F.when(F.col("type") == "Polygon", one).otherwise(F.flatten(many))
    r = f.select("geo_id", F.posexplode(rings).alias("ring", "c"))
    r = r.where(F.size("c") > 0)
    closed = F.element_at("c", 1) == F.element_at("c", -1)
    r = r.withColumn("c", F.when(closed, F.col("c")).otherwise(F.concat("c", F.slice("c", 1, 1))))

    def xy(p):
        x, y = (project or geo.project)(p[0], p[1])
        return F.struct(x.alias("x"), y.alias("y"))
    return repair(ring_edges(r.select(F.lit(geo_type).alias("geo_type"), "geo_id", "ring", F.transform("c", xy).alias("pts"))))


def current_component_file(spark: SparkSession, folder: str) -> str:
    """File named by the first row of a registry.csv (a config file of a few rows)."""
    row = spark.read.csv(os.path.join(folder, "registry.csv"), header=True, inferSchema=False).select("file").first()
    return os.path.join(folder, row["file"])


def components_for(components: DataFrame, geo_type: str) -> DataFrame:
    out = components.where(F.col("geo_type") == geo_type)
    if out.isEmpty():
        raise ValueError(f"no components for geo_type: {geo_type}")
    return out


def content_versions(files: DataFrame, day: Column, content: str) -> DataFrame:
    """Equal content of a day is stored once: date and hash prefix name the version."""
    sha = F.sha2(F.col(content).cast("binary"), 256)
    return files.select(day.alias("day"), sha.alias("sha")).groupBy("day", "sha").agg(
        F.count(F.lit(1)).alias("copies")).withColumn("version", F.concat_ws("_", "day", F.substring("sha", 1, 12)))


def yearly_figure(table: DataFrame, row: Column, sum_columns: list[str]) -> DataFrame:
    """One figure per group from position-named columns of an official text table."""
    total = sum((F.col(c).cast("double") for c in sum_columns[1:]), F.col(sum_columns[0]).cast("double"))
    return table.where(row).withColumn("value", total)


def keep_notes(fresh: DataFrame, existing: DataFrame, key: str, note: str) -> DataFrame:
    """Refresh figures but keep hand-written notes of rows that were there before."""
    old = existing.select(key, F.col(note).alias("_old"))
    out = fresh.drop(note).join(old, key, "left")
    return out.withColumn(note, F.coalesce("_old", F.lit(""))).drop("_old")
