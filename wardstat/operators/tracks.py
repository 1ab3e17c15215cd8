"""Vehicle tracks: projection onto a route shape, progress and stop arrivals.

Reports are unique per trip, service date and second, so one trip's track is at
most a day of seconds and normally a few hundred reports. A trip is one row
with its reports, stops and shape as arrays; Spark shuffles and balances trips
and numpy matches a batch of trips together: the sequence that counts is within a trip.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values, metres and seconds.
OFF_SHAPE_M, BACKTRACK_M, BRACKET_S, STOP_SLACK_M, NEAR_STOP_M = 60.0, 300.0, 180.0, 0.5, 30.0


def shape_arrays(points: DataFrame) -> DataFrame:
    """shape_id, x, y, seq, published distance -> arrays px, py, cum and the distance rescale.

    Published distances run slightly longer than the projected line, so stop
    distances are multiplied by ``rescale``.
    """
    s = points.groupBy("shape_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("v"), F.max("dist").alias("published"))
    step = F.transform(F.sequence(F.lit(1), F.size("v") - 1), lambda i: F.sqrt(
        F.pow(F.col("v")[i].x - F.col("v")[i - 1].x, 2) + F.pow(F.col("v")[i].y - F.col("v")[i - 1].y, 2)))
    s = s.where(F.size("v") >= 2).withColumn("_st", step)
    cum = F.aggregate("_st", F.array(F.lit(0.0)), lambda acc, d: F.concat(acc, F.array(F.element_at(acc, -1) + d)))
    s = s.withColumn("cum", cum)
    return s.select("shape_id", F.col("v.x").alias("px"), F.col("v.y").alias("py"),
                    "cum", (F.element_at("cum", -1) / F.col("published")).alias("rescale"))


def shape_projection(px: Column, py: Column, cum: Column, x: Column, y: Column) -> Column:
    """Nearest point of a polyline: struct(off, along), by built-in array functions."""
    def one(i):
        x1, y1, dx, dy = px[i], py[i], px[i + 1] - px[i], py[i + 1] - py[i]
        l2 = dx * dx + dy * dy
        u = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - x1) * dx + (y - y1) * dy)
                                           / F.when(l2 == 0, 1.0).otherwise(l2)))
        off = F.sqrt(F.pow(x - x1 - u * dx, 2) + F.pow(y - y1 - u * dy, 2))
        return F.struct(off.alias("off"), (cum[i] + u * F.sqrt(l2)).alias("along"))
    return F.array_min(F.transform(F.sequence(F.lit(0), F.size(px) - 2), one))


class Segments:
    """A shape's segments by grid cell: each cell lists those within ``OFF_SHAPE_M`` of some place in it."""

    def __init__(self, px, py, cum):
        self.px, self.py, self.cum = (np.asarray(v, float) for v in (px, py, cum))
        self.dx, self.dy = np.diff(self.px), np.diff(self.py)
        self.l2 = self.dx**2 + self.dy**2
        self.length, self.safe = np.sqrt(self.l2), np.where(self.l2 == 0, 1.0, self.l2)
        # steps no longer than a cell along each segment; what is within a cell's width of one lies at most two cells off
        n = np.maximum(1, np.ceil(self.length / OFF_SHAPE_M)).astype(int)
        seg = np.repeat(np.arange(len(n)), n)
        part = (np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n) + 0.5) / n[seg]
        cx, cy = (np.floor((p[seg] + part * d[seg]) / OFF_SHAPE_M).astype(int) for p, d in ((self.px, self.dx), (self.py, self.dy)))
        self.cells: dict[tuple[int, int], list[int]] = {}
        for i, x, y in zip(seg.tolist(), cx.tolist(), cy.tolist()):
            for key in [(x + a, y + b) for a in range(-2, 3) for b in range(-2, 3)]:
                held = self.cells.setdefault(key, [])
                if not held or held[-1] != i:
                    held.append(i)

    def near(self, x: float, y: float) -> list[int]:
        return self.cells.get((math.floor(x / OFF_SHAPE_M), math.floor(y / OFF_SHAPE_M)), [])


def _progress(shape: Segments, x, y) -> np.ndarray:
    """Distance along the shape for each report, in time order; nan when off the shape.

    A report looks at the segments of its cell only: no other one can be near enough.
    """
    out, reached = np.full(len(x), np.nan), -np.inf
    for i in range(len(x)):
        s = shape.near(x[i], y[i])
        if not s:
            continue
        u = np.clip(((x[i] - shape.px[s]) * shape.dx[s] + (y[i] - shape.py[s]) * shape.dy[s]) / shape.safe[s], 0.0, 1.0)
        along = shape.cum[s] + u * shape.length[s]
        off = np.hypot(x[i] - shape.px[s] - u * shape.dx[s], y[i] - shape.py[s] - u * shape.dy[s])
        off[along < reached - BACKTRACK_M] = np.inf
        k = int(off.argmin())
        if off[k] <= OFF_SHAPE_M:
            reached = out[i] = max(reached, along[k])
    return out


#: Segments of a shape that needs no index, and pairs of a report and a segment or stop that are held at once.
SHORT_SHAPE, PAIRS = 16, 500_000


def _lists(batch: pa.StructArray, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column in one array (nulls as nan), and where each list starts; one more entry for the end."""
    lists = batch.field(name)
    n = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
    return pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(n)))


def _within(starts: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the elements of lists ``k``, list after list, and how many each has."""
    n = starts[k + 1] - starts[k]
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[k], n), n


def _cuts(weight: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbours that weigh about ``PAIRS`` together."""
    if not len(weight):
        return []
    part = (np.cumsum(weight) - weight) // PAIRS
    at = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(weight)])).tolist()
    return list(zip(at[:-1], at[1:]))


def _short_progress(px, py, cum, points, x, y, reports, k) -> np.ndarray:
    """``_progress`` of trips ``k``, whose shapes have few segments, all together: the j-th reports of all trips at once."""
    at, n = _within(reports, k)
    out, first = np.full(len(at), np.nan), np.cumsum(n) - n
    reached, segments = np.full(len(k), -np.inf), points[k + 1] - points[k] - 1
    column = np.arange(segments.max(initial=1))
    i = np.minimum(points[k][:, None] + column, np.maximum(points[k + 1] - 2, points[k])[:, None])
    end = np.minimum(i + 1, len(px) - 1)
    dx, dy = px[end] - px[i], py[end] - py[i]
    l2 = dx**2 + dy**2
    length, safe, none = np.sqrt(l2), np.where(l2 == 0, 1.0, l2), column >= segments[:, None]
    order = np.argsort(-n, kind="stable")
    for j in range(int(n.max(initial=0))):
        now = order[:int(np.count_nonzero(n > j))]          # trips that have a j-th report
        r = first[now] + j
        ax, ay = x[at[r]][:, None] - px[i[now]], y[at[r]][:, None] - py[i[now]]
        u = np.clip((ax * dx[now] + ay * dy[now]) / safe[now], 0.0, 1.0)
        along = cum[i[now]] + u * length[now]
        off = np.hypot(ax - u * dx[now], ay - u * dy[now])
        off[none[now] | (along < reached[now][:, None] - BACKTRACK_M)] = np.inf
        best = off.argmin(axis=1)
        rows = np.arange(len(now))
        hit = off[rows, best] <= OFF_SHAPE_M
        to = np.maximum(reached[now], along[rows, best])
        out[r[hit]] = to[hit]
        reached[now[hit]] = to[hit]
    return out


def _tracks(batch: pa.StructArray) -> np.ndarray:
    """Progress of the reports of a batch of trips, trip after trip; a shape with many segments is indexed once."""
    (px, points), (py, _), (cum, _) = (_lists(batch, c) for c in ("px", "py", "cum"))
    (x, reports), (y, _) = (_lists(batch, c) for c in ("x", "y"))
    out, segments = np.full(len(x), np.nan), np.diff(points) - 1
    short = np.flatnonzero(segments <= SHORT_SHAPE)
    for a, b in _cuts((np.diff(reports) * np.maximum(segments, 1))[short]):
        k = short[a:b]
        out[_within(reports, k)[0]] = _short_progress(px, py, cum, points, x, y, reports, k)
    shapes: dict = {}
    for k in np.flatnonzero(segments > SHORT_SHAPE).tolist():
        shape_id, own, rows = batch.field("shape_id")[k].as_py(), slice(points[k], points[k + 1]), slice(reports[k], reports[k + 1])
        if shape_id not in shapes:
            shapes[shape_id] = Segments(px[own], py[own], cum[own])
        out[rows] = _progress(shapes[shape_id], x[rows], y[rows])
    return out


def _all_crossings(t, a, reports, stops, wanted) -> np.ndarray:
    """Time each stop distance of each trip is first reached; nan where the track cannot tell.

    ``t``, ``a``: times and progress of all trips, ``stops``: stop distances; ``reports`` and ``wanted`` say where a trip's start.
    """
    keep = ~np.isnan(a)
    reports = np.concatenate(([0], np.cumsum(keep)))[reports]
    t, a = t[keep], a[keep]
    trip = np.repeat(np.arange(len(wanted) - 1), np.diff(wanted))
    n, out = np.diff(reports)[trip], np.full(len(stops), np.nan)
    for lo, hi in _cuts(n):
        if not n[lo:hi].any():
            continue
        m, k, s = n[lo:hi], trip[lo:hi], stops[lo:hi]
        at, _ = _within(reports, k)
        stop = np.repeat(np.arange(hi - lo), m)
        # a trip's progress never falls, so reports short of a stop are those before it
        j, c = (np.bincount(stop[a[at] < (s - d)[stop]], minlength=hi - lo) for d in (STOP_SLACK_M, NEAR_STOP_M))
        hit = np.where(j < m, j, c)
        ok = (hit < m) & (hit > 0)
        now, before = (reports[k] + np.where(ok, hit - e, 0) for e in (0, 1))
        now, before = np.minimum(now, len(t) - 1), np.minimum(before, len(t) - 1)
        ok &= t[now] - t[before] <= BRACKET_S
        step = a[now] - a[before]
        between = t[before] + (np.minimum(s, a[now]) - a[before]) / np.where(step > 0, step, 1.0) * (t[now] - t[before])
        out[lo:hi] = np.where(ok, np.where((j == m) | (step <= 0), t[now], between), np.nan)
    return out


def _crossings(t, a, stops) -> list[float | None]:
    """``_all_crossings`` of one trip; None where the track cannot tell."""
    found = _all_crossings(t, a, np.array([0, len(t)]), np.asarray(stops, float), np.array([0, len(stops)]))
    return [None if np.isnan(v) else float(v) for v in found]


def _as_lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The other way round: lists again, nan as null."""
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.float64(), from_pandas=True))


#: Shape points that may be sent to every executor.
MOST_POINTS = 1_000_000


def _trips(reports: DataFrame, shapes: DataFrame) -> DataFrame:
    """One row per (service_date, trip_id): sorted reports and the trip's shape.

    Shapes are broadcast if their points are counted to be few; beyond that a shape that many trips share is left to the
    join's skew splitting. Either way trips stay where their reports were gathered or are dealt one by one.
    """
    r = (reports.dropDuplicates(["service_date", "trip_id", "t"])
         .groupBy("service_date", "trip_id", "shape_id")
         .agg(F.sort_array(F.collect_list(F.struct("t", "x", "y"))).alias("r")))
    few = (shapes.agg(F.sum(F.size("px"))).first()[0] or 0) <= MOST_POINTS
    return r.join(F.broadcast(shapes) if few else shapes, "shape_id").select("service_date", "trip_id", "shape_id", "px", "py", "cum", *[F.col("r")[c].alias(c) for c in ("t", "x", "y")])


def trip_progress(reports: DataFrame, shapes: DataFrame) -> DataFrame:
    """service_date, trip_id, t, along. ``reports``: service_date, trip_id, shape_id, t, x, y."""
    @F.arrow_udf("array<double>")
    def along(trip: pa.Array) -> pa.Array:
        return _as_lists(_tracks(trip), _lists(trip, "x")[1])

    trips = _trips(reports, shapes).withColumn("along", along(F.struct("shape_id", "px", "py", "cum", "x", "y")))
    return (trips.withColumn("_z", F.explode(F.arrays_zip("t", "along")))
            .select("service_date", "trip_id", "_z.t", "_z.along"))


def crossing_times(reports: DataFrame, stops: DataFrame, shapes: DataFrame) -> DataFrame:
    """service_date, trip_id, stop_id, stop_along, arrival. ``stops``: service_date, trip_id, stop_id, stop_along.

    One pass over a trip: its reports are placed on the shape and searched for its stops where they are. Trips without
    reports have no arrivals.
    """
    s = (stops.groupBy("service_date", "trip_id").agg(F.sort_array(F.collect_set(F.struct("stop_id", "stop_along"))).alias("s"))
         .select("service_date", "trip_id", F.col("s.stop_id").alias("stop_id"), F.col("s.stop_along").alias("d")))

    @F.arrow_udf("array<double>")
    def reach(trip: pa.Array) -> pa.Array:
        (t, reports), (d, wanted) = _lists(trip, "t"), _lists(trip, "d")
        return _as_lists(_all_crossings(t, _tracks(trip), reports, d, wanted), wanted)

    j = _trips(reports, shapes).join(s, ["service_date", "trip_id"])
    j = j.withColumn("arrival", reach(F.struct("shape_id", "px", "py", "cum", "x", "y", "t", "d")))
    return (j.withColumn("_z", F.explode(F.arrays_zip("stop_id", "d", "arrival")))
            .select("service_date", "trip_id", "_z.stop_id", F.col("_z.d").alias("stop_along"), "_z.arrival"))


def timepoints_after_first(stop_times: DataFrame) -> DataFrame:
    """Timepoint stops of each trip except its first: a bus waits at the start before it leaves."""
    key = ["service_date", "trip_id"]
    tp = stop_times.where("timepoint")
    first = tp.groupBy(*key).agg(F.min("stop_sequence").alias("_first"))
    return tp.join(first, key).where("stop_sequence > _first").drop("_first")


def infer_arrivals(matched: DataFrame, stop_times: DataFrame, reports: DataFrame, shapes: DataFrame) -> DataFrame:
    """Arrivals at timepoints of observed, measurable trips, with delay in seconds.

    ``matched``: service_date, trip_id, route_id, direction_id, shape_id, observed, measurable;
    ``stop_times``: service_date, trip_id, stop_id, stop_sequence, timepoint, dist, scheduled.
    """
    key = ["service_date", "trip_id"]
    trips = matched.where("observed and measurable").select(*key, "route_id", "direction_id", "shape_id")
    stops = (timepoints_after_first(stop_times).join(trips, key).join(shapes.select("shape_id", "rescale"), "shape_id")
             .withColumn("stop_along", F.col("dist") * F.col("rescale")))
    arr = crossing_times(reports.join(trips.select(*key, "shape_id"), key), stops, shapes).select(*key, "stop_id", "arrival", "stop_along")
    return (stops.join(arr, [*key, "stop_id", "stop_along"], "left")
            .select(*key, "route_id", "direction_id", "stop_id", "stop_sequence", "scheduled", "arrival",
                    (F.col("arrival") - F.col("scheduled")).alias("delay_s")))
