"""Column functions on coordinates: projection, hexagons, segment distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# EPSG:32136, Lambert conformal conic with two standard parallels.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
LAT_1 = math.radians(36 + 25 / 60)
LAT_2 = math.radians(35.25)
LAT_0 = math.radians(34 + 20 / 60)
LON_0 = math.radians(-86.0)
FALSE_EASTING = 600000.0

_ECC = math.sqrt(FLATTENING * (2 - FLATTENING))


def _conic(lat: float) -> float:
    s = _ECC * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) * ((1 + s) / (1 - s)) ** (_ECC / 2)


def _parallel(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (_ECC * math.sin(lat)) ** 2)


CONE = math.log(_parallel(LAT_1) / _parallel(LAT_2)) / math.log(_conic(LAT_1) / _conic(LAT_2))
SCALE = SEMI_MAJOR * _parallel(LAT_1) / (CONE * _conic(LAT_1) ** CONE)
RADIUS_0 = SCALE * _conic(LAT_0) ** CONE
ECCENTRICITY = _ECC


def project(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Longitude / latitude in degrees to metres east and north."""
    phi = F.radians(lat)
    s = ECCENTRICITY * F.sin(phi)
    conic = F.tan(math.pi / 4 - phi / 2) * F.pow((1 + s) / (1 - s), F.lit(ECCENTRICITY / 2))
    rho = SCALE * F.pow(conic, F.lit(CONE))
    theta = CONE * (F.radians(lon) - LON_0)
    return FALSE_EASTING + rho * F.sin(theta), RADIUS_0 - rho * F.cos(theta)


def located(lon: Column, lat: Column) -> Column:
    """Usable coordinates: both numbers present and neither zero."""
    x, y = lon.try_cast("double"), lat.try_cast("double")
    return F.coalesce((x != 0) & (y != 0), F.lit(False))


def cell_index(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("bigint")


def round_distance(v: Column, digits: int) -> Column:
    """``F.round`` of a double that is not below zero, for rows by the million.

    ``F.round`` writes each value as a decimal. The nearest whole multiple gives
    the same double wherever it is beyond doubt; near ties and above 2^40
    multiples, where the product is not exact enough, ``F.round`` decides.
    """
    scaled = v * 10.0 ** digits
    whole = F.rint(scaled)
    sure = (F.abs(scaled - whole) < 0.499) & (scaled < 2.0 ** 40)
    return F.when(sure, whole / 10.0 ** digits).otherwise(F.round(v, digits))


# --- hexagons -------------------------------------------------------------
# Axial (q, r) coordinates of pointy-top hexagons with the given edge length.
# Ids are this project's own: no hexagon library is assumed on the cluster.

_SQRT3 = math.sqrt(3.0)

# Edge lengths in metres of the two cell sizes in use, and of
# the coarse cell that groups output files.
HEX_EDGE = {"h8": 461.0, "h9": 174.0, "h6": 3230.0}

# Axial steps from a cell to itself and its six neighbours.
HEX_DISK = ((0, 0), (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1))


def hex_axial(x: Column, y: Column, edge: float) -> tuple[Column, Column]:
    """Axial coordinates of the hexagon holding a point, by cube rounding."""
    q = (_SQRT3 / 3 * x - y / 3) / edge
    r = (2.0 / 3 * y) / edge
    s = -q - r
    rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(s + 0.5)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    fq = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fr = F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr)
    return fq.cast("bigint"), fr.cast("bigint")


def hex_center(q: Column, r: Column, edge: float) -> tuple[Column, Column]:
    return edge * _SQRT3 * (q + r / 2.0), edge * 1.5 * r


def hex_id(level: str, q: Column, r: Column) -> Column:
    return F.concat(F.lit(level + ":"), q.cast("string"), F.lit(":"), r.cast("string"))


def hex_cell(x: Column, y: Column, level: str) -> Column:
    q, r = hex_axial(x, y, HEX_EDGE[level])
    return F.when(x.isNotNull() & y.isNotNull(), hex_id(level, q, r))


def hex_parts(cell: Column) -> tuple[Column, Column]:
    p = F.split(cell, ":")
    return p[1].cast("bigint"), p[2].cast("bigint")


def hex_disk(cell: Column) -> Column:
    """Array of a cell and its six neighbours."""
    q, r = hex_parts(cell)
    level = F.split(cell, ":")[0]
    return F.array(*[F.concat_ws(":", level, (q + dq).cast("string"), (r + dr).cast("string"))
                     for dq, dr in HEX_DISK])


def hex_parent(cell: Column, level: str, parent: str) -> Column:
    """Coarse cell holding the centre of a cell."""
    q, r = hex_parts(cell)
    cx, cy = hex_center(q, r, HEX_EDGE[level])
    return hex_cell(cx, cy, parent)


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance from a point to a segment; a zero-length segment is its end point."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    u = F.when(length2 == 0, 0.0).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / length2)))
    ex, ey = px - x1 - u * dx, py - y1 - u * dy
    return F.sqrt(ex * ex + ey * ey)

