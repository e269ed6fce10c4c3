"""Geometry as column expressions: vectors, polylines, polygons, envelopes, map projections and tiles.

A polyline is an array of structs with x, y (and z). Nulls give nulls; degenerate input gives the documented value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def distance3(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    return F.sqrt(sum(((p - q) * (p - q) for p, q in zip(a, b)), F.lit(0.0)))


def dot(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * bx + ay * by


def cross(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return ax * by - ay * bx


def angle_between(ax: Column, ay: Column, bx: Column, by: Column, acute: bool = False) -> Column:
    """Degrees between two vectors, null for a zero vector; acute folds it to at most 90."""
    norm = F.sqrt((ax * ax + ay * ay) * (bx * bx + by * by))
    out = F.when(norm > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(ax, ay, bx, by) / norm)))))
    return F.least(out, 180 - out) if acute else out


def lateral(px: Column, py: Column, ox: Column, oy: Column, dx: Column, dy: Column) -> Column:
    """Signed distance of p to the left of the line through o along d."""
    return cross(dx, dy, px - ox, py - oy) / F.sqrt(dx * dx + dy * dy)


def longitudinal(px: Column, py: Column, ox: Column, oy: Column, dx: Column, dy: Column) -> Column:
    return dot(dx, dy, px - ox, py - oy) / F.sqrt(dx * dx + dy * dy)


def perpendicular(dx: Column, dy: Column) -> tuple[Column, Column]:
    return -dy, dx


def rotate(x: Column, y: Column, radians: Column) -> tuple[Column, Column]:
    return x * F.cos(radians) - y * F.sin(radians), x * F.sin(radians) + y * F.cos(radians)


def offset(px: Column, py: Column, dx: Column, dy: Column, along: Column, left: Column) -> tuple[Column, Column]:
    n = F.sqrt(dx * dx + dy * dy)
    return px + (dx * along - dy * left) / n, py + (dy * along + dx * left) / n


def line_crossing(a: tuple, b: tuple, c: tuple, d: tuple, extend: bool = False) -> tuple[Column, Column]:
    """Where lines ab and cd meet; null if parallel or, unless extended, outside either segment. Points are (x, y)."""
    rx, ry, sx, sy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    den = cross(rx, ry, sx, sy)
    t, u = cross(c[0] - a[0], c[1] - a[1], sx, sy) / den, cross(c[0] - a[0], c[1] - a[1], rx, ry) / den
    ok = F.abs(den) > 1e-12
    if not extend:
        ok = ok & t.between(0, 1) & u.between(0, 1)
    return F.when(ok, a[0] + t * rx), F.when(ok, a[1] + t * ry)


def gaussian(x: Column, sigma: float, mu: float = 0.0) -> Column:
    """Unnormalised Gaussian score."""
    return F.exp(-F.pow(x - mu, 2) / (2 * sigma * sigma))


def feature_score(x: Column, y: Column) -> Column:
    return F.sqrt(gaussian(x, 20, 2) * gaussian(F.abs(y), 4, 0))


def interval_iou(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    inter = F.greatest(F.lit(0.0), F.least(a2, b2) - F.greatest(a1, b1))
    union = F.greatest(a2, b2) - F.least(a1, b1)
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def _pairs(points: Column) -> Column:
    """Array of {a, b} of neighbouring vertices."""
    return F.zip_with(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _total(parts: Column, value) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda s, p: s + value(p))


def polyline_length(points: Column) -> Column:
    return _total(_pairs(points), lambda p: distance(p["a"]["x"], p["a"]["y"], p["b"]["x"], p["b"]["y"]))


def signed_area(ring: Column) -> Column:
    """Shoelace area, positive for anticlockwise; the ring is closed if it isn't."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    return _total(_pairs(closed), lambda p: cross(p["a"]["x"], p["a"]["y"], p["b"]["x"], p["b"]["y"])) / 2


def is_concave(ring: Column) -> Column:
    """Whether turns of the ring go both ways; false for fewer than four vertices."""
    last_repeated = (F.element_at(ring, 1)["x"] == F.element_at(ring, -1)["x"]) & (F.element_at(ring, 1)["y"] == F.element_at(ring, -1)["y"])
    open_ring = F.when((F.size(ring) > 1) & last_repeated, F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(1)))).otherwise(ring)
    around = F.concat(open_ring, F.slice(open_ring, 1, 2))
    sides = _pairs(around)
    turns = F.zip_with(
        F.slice(sides, 1, F.greatest(F.size(sides) - 1, F.lit(0))), F.slice(sides, 2, F.greatest(F.size(sides) - 1, F.lit(0))),
        lambda p, q: F.signum(cross(p["b"]["x"] - p["a"]["x"], p["b"]["y"] - p["a"]["y"], q["b"]["x"] - q["a"]["x"], q["b"]["y"] - q["a"]["y"])),
    )
    return F.when(F.size(ring) < 4, F.lit(False)).otherwise(F.exists(turns, lambda t: t > 0) & F.exists(turns, lambda t: t < 0))


def point_in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Even-odd test; points on the border may fall either way."""
    closed = F.concat(ring, F.slice(ring, 1, 1))
    hit = lambda p: ((p["a"]["y"] > py) != (p["b"]["y"] > py)) & (px < (p["b"]["x"] - p["a"]["x"]) * (py - p["a"]["y"]) / (p["b"]["y"] - p["a"]["y"]) + p["a"]["x"])
    return F.aggregate(_pairs(closed), F.lit(False), lambda s, p: F.when(F.coalesce(hit(p), F.lit(False)), ~s).otherwise(s))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    n = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)
    t = F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / n))).otherwise(F.lit(0.0))
    return distance(px, py, ax + t * (bx - ax), ay + t * (by - ay))


def polyline_distance(px: Column, py: Column, points: Column) -> Column:
    return F.array_min(F.transform(_pairs(points), lambda p: segment_distance(px, py, p["a"]["x"], p["a"]["y"], p["b"]["x"], p["b"]["y"])))


def point_at(points: Column, measure: Column) -> Column:
    """Struct x, y at a distance along the polyline; null outside it."""
    start = F.struct(F.lit(0.0).alias("done"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))

    def step(s: Column, p: Column) -> Column:
        n = distance(p["a"]["x"], p["a"]["y"], p["b"]["x"], p["b"]["y"])
        here = s["x"].isNull() & (measure >= s["done"]) & (measure <= s["done"] + n) & (n > 0)
        t = (measure - s["done"]) / n
        return F.struct((s["done"] + n).alias("done"), F.when(here, p["a"]["x"] + t * (p["b"]["x"] - p["a"]["x"])).otherwise(s["x"]).alias("x"), F.when(here, p["a"]["y"] + t * (p["b"]["y"] - p["a"]["y"])).otherwise(s["y"]).alias("y"))

    return F.aggregate(_pairs(points), start, step, lambda s: F.when(s["x"].isNotNull(), F.struct(s["x"].alias("x"), s["y"].alias("y"))))


def drop_repeats(points: Column, tolerance: float) -> Column:
    """Drop vertices within the tolerance of the last kept one; at least the first two vertices stay."""
    empty = F.slice(points, 1, 0)
    far = lambda kept, p: distance(F.element_at(kept, -1)["x"], F.element_at(kept, -1)["y"], p["x"], p["y"]) > tolerance
    kept = F.aggregate(points, empty, lambda k, p: F.when((F.size(k) == 0) | far(k, p), F.concat(k, F.array(p))).otherwise(k))
    return F.when(F.size(kept) < 2, F.slice(points, 1, 2)).otherwise(kept)


def envelope(points: Column) -> Column:
    """Struct x0, y0, x1, y1."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def envelopes_meet(a: Column, b: Column) -> Column:
    return (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])


def without_z(points: Column) -> Column:
    return F.transform(points, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))


def azimuth(dx: Column, dy: Column) -> Column:
    """Degrees clockwise from north, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(dx, dy)) + 360, F.lit(360.0))


def quaternion_yaw(w: Column, x: Column, y: Column, z: Column) -> Column:
    """Degrees of the last rotation of a zyx decomposition."""
    return F.degrees(F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z)))


def rotate_by_quaternion(q: tuple, p: tuple) -> tuple[Column, Column, Column]:
    """p rotated by the unit quaternion q = (w, x, y, z)."""
    w, x, y, z = q
    a, b, c = p
    return (
        (1 - 2 * (y * y + z * z)) * a + 2 * (x * y - w * z) * b + 2 * (x * z + w * y) * c,
        2 * (x * y + w * z) * a + (1 - 2 * (x * x + z * z)) * b + 2 * (y * z - w * x) * c,
        2 * (x * z - w * y) * a + 2 * (y * z + w * x) * b + (1 - 2 * (x * x + y * y)) * c,
    )


#: The WGS84 ellipsoid.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
_E2 = WGS84_F * (2 - WGS84_F)


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def to_ecef(lat: Column, lon: Column, alt: Column) -> tuple[Column, Column, Column]:
    p, q = F.radians(lat), F.radians(lon)
    n = WGS84_A / F.sqrt(1 - _E2 * F.sin(p) * F.sin(p))
    return (n + alt) * F.cos(p) * F.cos(q), (n + alt) * F.cos(p) * F.sin(q), (n * (1 - _E2) + alt) * F.sin(p)


def to_enu(lat: Column, lon: Column, alt: Column, lat0: float, lon0: float, alt0: float = 0.0) -> tuple[Column, Column, Column]:
    """East, north, up of a point seen from an origin."""
    p, q = math.radians(lat0), math.radians(lon0)
    n = WGS84_A / math.sqrt(1 - _E2 * math.sin(p) ** 2)
    x0, y0, z0 = (n + alt0) * math.cos(p) * math.cos(q), (n + alt0) * math.cos(p) * math.sin(q), (n * (1 - _E2) + alt0) * math.sin(p)
    x, y, z = to_ecef(lat, lon, alt)
    dx, dy, dz = x - x0, y - y0, z - z0
    return (
        -math.sin(q) * dx + math.cos(q) * dy,
        -math.sin(p) * math.cos(q) * dx - math.sin(p) * math.sin(q) * dy + math.cos(p) * dz,
        math.cos(p) * math.cos(q) * dx + math.cos(p) * math.sin(q) * dy + math.sin(p) * dz,
    )


def to_utm(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Easting and northing in the zone of the longitude, by the series to the sixth order; southern northings are offset."""
    e2 = _E2
    ep2 = e2 / (1 - e2)
    p = F.radians(lat)
    lon0 = F.radians((F.floor((lon + 180) / 6) * 6 - 177).cast("double"))
    n = WGS84_A / F.sqrt(1 - e2 * F.sin(p) * F.sin(p))
    t, c, a = F.tan(p) * F.tan(p), ep2 * F.cos(p) * F.cos(p), F.cos(p) * (F.radians(lon) - lon0)
    m = WGS84_A * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * p)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * p) - (35 * e2**3 / 3072) * F.sin(6 * p)
    )
    east = 0.9996 * n * (a + (1 - t + c) * F.pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(a, 5) / 120) + 500000
    north = 0.9996 * (m + n * F.tan(p) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(a, 6) / 720))
    return east, F.when(lat < 0, north + 10_000_000).otherwise(north)


def tile(lat: Column, lon: Column, zoom: int = 13) -> tuple[Column, Column]:
    """Slippy-map tile numbers; null where the latitude has none."""
    n = 1 << zoom
    p = F.radians(lat)
    y = (1 - F.ln(F.tan(p) + 1 / F.cos(p)) / math.pi) / 2 * n
    return ((lon + 180) / 360 * n).cast("int"), F.when(F.abs(lat) < 90, y.cast("int"))


def tile_id(lat: Column, lon: Column, zoom: int = 13) -> Column:
    x, y = tile(lat, lon, zoom)
    return F.concat(x.cast("string"), F.lit("_"), y.cast("string"))


def tile_neighbours(x: Column, y: Column) -> Column:
    """Ids of the eight tiles around one."""
    return F.array(*[F.concat((x + dx).cast("string"), F.lit("_"), (y + dy).cast("string")) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy])


def integer_tile(lat: Column, lon: Column, level: int = 13) -> Column:
    """The quadrant code of a position: the bits of its cell numbers (cells of 180 / 2^level degrees), latitude before longitude.

    West of Greenwich a sign bit leads the code.
    """
    cells = 1 << level
    cx, cy = F.pmod(F.floor(lon * cells / 180), F.lit(cells)), F.pmod(F.floor(lat * cells / 180), F.lit(cells))
    code = sum((F.getbit(c, F.lit(b)).cast("bigint") * (1 << (2 * b + o)) for b in range(level) for c, o in ((cx, 0), (cy, 1))), F.lit(0).cast("bigint"))
    return code + F.when(lon < 0, F.lit(1 << (2 * level))).otherwise(F.lit(0))


def integer_tile_centre(code: Column, level: int = 13) -> tuple[Column, Column]:
    """Latitude and longitude of a tile's centre; cells south or west of zero count from the top."""
    out = []
    for o in (1, 0):
        cell = sum((F.getbit(code, F.lit(2 * b + o)).cast("bigint") * (1 << b) for b in range(level)), F.lit(0).cast("bigint"))
        signed = F.when(cell >= 1 << (level - 1), cell - (1 << level)).otherwise(cell) if o else F.when(code >= 1 << (2 * level), cell - (1 << level)).otherwise(cell)
        out.append((signed + 0.5) * 180 / (1 << level))
    return out[0], out[1]


def clip_range(ax: Column, ay: Column, bx: Column, by: Column, area: list[tuple[float, float]]) -> Column:
    """Struct t0, t1: the part of a segment inside a convex anticlockwise area, as shares of its length; null if none.

    Each side of the area raises the start or lowers the end of the range.
    """
    low, high, out = F.lit(0.0), F.lit(1.0), F.lit(False)
    lows, highs = [low], [high]
    for (px, py), (qx, qy) in zip(area, area[1:] + area[:1]):
        start = (qx - px) * (ay - py) - (qy - py) * (ax - px)
        rise = (qx - px) * (by - ay) - (qy - py) * (bx - ax)
        lows.append(F.when(rise > 0, -start / rise).otherwise(F.lit(0.0)))
        highs.append(F.when(rise < 0, -start / rise).otherwise(F.lit(1.0)))
        out = out | ((rise == 0) & (start < 0))
    t0, t1 = F.greatest(*lows), F.least(*highs)
    return F.when(~out & (t0 <= t1), F.struct(t0.alias("t0"), t1.alias("t1")))


def polyline_gap(a: Column, b: Column) -> Column:
    """Smallest distance between the vertices of either polyline and the other one; exact unless they cross."""
    there = F.array_min(F.transform(a, lambda p: polyline_distance(p["x"], p["y"], b)))
    back = F.array_min(F.transform(b, lambda p: polyline_distance(p["x"], p["y"], a)))
    return F.least(there, back)


def triangle_slope(a: tuple, b: tuple, c: tuple) -> tuple[Column, Column]:
    """Slope (degrees from level) and aspect (degrees clockwise from north of the downhill direction) of a triangle."""
    ux, uy, uz, vx, vy, vz = b[0] - a[0], b[1] - a[1], b[2] - a[2], c[0] - a[0], c[1] - a[1], c[2] - a[2]
    nx, ny, nz = uy * vz - uz * vy, uz * vx - ux * vz, ux * vy - uy * vx
    sign = F.when(nz < 0, -1.0).otherwise(1.0)
    return F.degrees(F.atan2(F.sqrt(nx * nx + ny * ny), F.abs(nz))), azimuth(nx * sign, ny * sign)


def endpoints(points: Column) -> Column:
    """First and last point of a polyline; null for an empty one."""
    return F.when(F.size(points) > 0, F.array(F.get(points, F.lit(0)), F.element_at(points, -1)))


def is_endpoint(points: Column, px: Column, py: Column, tolerance: float = 1e-8) -> Column:
    return F.exists(endpoints(points), lambda e: distance(e["x"], e["y"], px, py) <= tolerance)


def line_parts(geom: Column) -> Column:
    """The polylines of a geometry: the parts of lines and multilines of two points or more; none of anything else."""
    lines = F.lower(geom["kind"]).isin("line", "linestring", "multilinestring")
    return F.when(lines, F.filter(geom["parts"], lambda p: F.size(p) >= 2)).otherwise(F.slice(geom["parts"], 1, 0))


def ring_is_valid(ring: Column) -> Column:
    """Whether a ring is closed, has at least three different points and an area, and no two of its edges meet but at their common point.

    Every pair of edges of a ring is looked at, so this is for rings of up to some hundreds of points.
    """
    edges = F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    edges = F.filter(edges, lambda e: (e["ax"] != e["bx"]) | (e["ay"] != e["by"]))

    def side(e: Column, x: Column, y: Column) -> Column:
        return F.signum(cross(e["bx"] - e["ax"], e["by"] - e["ay"], x - e["ax"], y - e["ay"]))

    def on(e: Column, x: Column, y: Column) -> Column:
        return (side(e, x, y) == 0) & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))

    def meet(e: Column, f: Column) -> Column:
        proper = (side(e, f["ax"], f["ay"]) * side(e, f["bx"], f["by"]) < 0) & (side(f, e["ax"], e["ay"]) * side(f, e["bx"], e["by"]) < 0)
        return proper | on(e, f["ax"], f["ay"]) | on(e, f["bx"], f["by"]) | on(f, e["ax"], e["ay"]) | on(f, e["bx"], e["by"])

    n = F.size(edges)
    numbered = F.transform(edges, lambda e, i: F.struct(e.alias("e"), i.alias("i")))

    def clash(a: Column, b: Column) -> Column:
        apart = b["i"] - a["i"]
        # Neighbours meet at one point; they clash where one turns back onto the other.
        back = on(a["e"], b["e"]["bx"], b["e"]["by"]) | on(b["e"], a["e"]["ax"], a["e"]["ay"])
        closing = on(b["e"], a["e"]["bx"], a["e"]["by"]) | on(a["e"], b["e"]["ax"], b["e"]["ay"])
        return F.when(apart <= 0, False).when(apart == 1, back).when(apart == n - 1, closing).otherwise(meet(a["e"], b["e"]))

    first, last = F.get(ring, F.lit(0)), F.element_at(ring, -1)
    closed = (first["x"] == last["x"]) & (first["y"] == last["y"])
    return F.when(F.size(ring) < 4, False).otherwise(closed & (n >= 3) & (signed_area(ring) != 0) & ~F.exists(numbered, lambda a: F.exists(numbered, lambda b: clash(a, b))))
