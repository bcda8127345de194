"""Vectors, angles, polygons, planes and matrices as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geodesy as G
from .geodesy import Vector

# The planes a polygon is projected to, by the axis of its normal and that axis' sign.
PLANES = {"x": ("YZ", "YZNEG"), "y": ("XZ", "XZNEG"), "z": ("XY", "XYNEG")}

# The 22 directions of a camera; the last has no x, as those that read the result expect.
DIRECTIONS = {
    "XPOS": (1, 0, 0), "XNEG": (-1, 0, 0), "ZPOS": (0, 0, 1), "ZNEG": (0, 0, -1), "YPOS": (0, 1, 0), "YNEG": (0, -1, 0),
    "XPOS_ZNEG": (1, 0, -1), "XNEG_ZNEG": (-1, 0, -1), "XNEG_ZPOS": (-1, 0, 1), "XPOS_ZPOS": (1, 0, 1),
    "YPOS_ZNEG": (0, 1, -1), "YPOS_ZPOS": (0, 1, 1), "YNEG_ZNEG": (0, -1, -1), "YNEG_ZPOS": (0, -1, 1),
    "XPOS_YPOS_ZNEG": (1, 1, -1), "XPOS_YNEG_ZNEG": (1, -1, -1), "XNEG_YPOS_ZNEG": (-1, 1, -1), "XNEG_YNEG_ZNEG": (-1, -1, -1),
    "XPOS_YPOS_ZPOS": (1, 1, 1), "XPOS_YNEG_ZPOS": (1, -1, 1), "XNEG_YPOS_ZPOS": (-1, 1, 1), "XNEG_YNEG_ZPOS": (0, -1, 1),
}


def to_sphere(lon: Column, lat: Column) -> Vector:
    """Unit vector of a direction on the sphere, in degrees."""
    return F.cos(lat * G.DEGREE) * F.cos(lon * G.DEGREE), F.cos(lat * G.DEGREE) * F.sin(lon * G.DEGREE), F.sin(lat * G.DEGREE)


def from_sphere(v: Vector) -> tuple[Column, Column]:
    """Longitude and latitude of a direction, in degrees."""
    return F.degrees(F.atan2(v[1], v[0])), F.degrees(F.atan2(v[2], F.sqrt(v[0] * v[0] + v[1] * v[1])))


def cosine(a: Vector, b: Vector) -> Column:
    """Cosine of the angle between unit vectors, within -1 and 1."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), G.dot(a, b)))


def angle(a: Vector, b: Vector) -> Column:
    """Angle between two vectors in radians, null if one is zero."""
    return F.acos(cosine(G.unit(a), G.unit(b)))


def corner_angle(a: tuple[Column, Column], b: tuple[Column, Column], c: tuple[Column, Column]) -> Column:
    """Angle at b of the plane corner a-b-c in radians."""
    flat = lambda p: (p[0] - b[0], p[1] - b[1], F.lit(0.0))
    return angle(flat(a), flat(c))


def cross2(a: tuple[Column, Column], b: tuple[Column, Column], c: tuple[Column, Column]) -> Column:
    """Sine of the turn from a-b to b-c: the cross product of unit vectors, null if points fall together."""
    ux, uy, vx, vy = b[0] - a[0], b[1] - a[1], c[0] - b[0], c[1] - b[1]
    size = F.sqrt(ux * ux + uy * uy) * F.sqrt(vx * vx + vy * vy)
    return (ux * vy - uy * vx) / F.nullif(size, F.lit(0.0))


def aspect_ratio(a: Column, b: Column, c: Column) -> Column:
    """A triangle's longest side over the height on it, null without area."""
    from ..operators.mesh import area

    longest = F.greatest(a, b, c)
    return longest / F.nullif(2.0 * area(a, b, c) / F.nullif(longest, F.lit(0.0)), F.lit(0.0))


def alike(a: tuple[Column, ...], b: tuple[Column, ...], error: float) -> Column:
    """Is every difference below error?"""
    out = F.lit(True)
    for p, q in zip(a, b):
        out = out & (F.abs(p - q) < error)
    return out


def ring_index(k: Column, step: int, n: Column) -> Column:
    """The place step further along a ring of n."""
    return F.pmod(k + step, n)


def is_invalid(v: Vector) -> Column:
    """Has a vector a NaN, or is it zero?"""
    return F.isnan(v[0]) | F.isnan(v[1]) | F.isnan(v[2]) | ((v[0] == 0) & (v[1] == 0) & (v[2] == 0))


def is_ceiling(normal: Vector, least: float = 0.9) -> Column:
    """Does a unit normal point nearly straight up?"""
    return normal[2] > least


def best_plane(normal: Vector) -> Column:
    """The plane that a polygon of this normal is projected to: across the axis of the largest share, x first, then y."""
    x, y, z = (F.abs(c.cast("float")) for c in normal)
    name = lambda axis, c: F.when(c >= 0, PLANES[axis][0]).otherwise(PLANES[axis][1])
    return F.when((x >= y) & (x >= z), name("x", normal[0])).when((y >= x) & (y >= z), name("y", normal[1])).otherwise(name("z", normal[2]))


def polygon_normal(ring: Column) -> Column:
    """Unit normal (x, y, z) of a ring of (x, y, z) structs: the corners' unit normals, weighed by their angles. Corners
    without a direction count for nothing; null if nothing is left."""
    # Each step is a pass over an array of its own, so that no expression holds another many times.
    n = F.size(ring)
    every = F.sequence(F.lit(0), n - 1)
    struct = lambda x, y, z, **more: F.struct(x.alias("x"), y.alias("y"), z.alias("z"), *(c.alias(k) for k, c in more.items()))
    pair = lambda items, step: F.transform(every, lambda k: F.struct(F.get(items, k).alias("a"), F.get(items, F.pmod(k + step, n)).alias("b")))
    sized = lambda items: F.transform(items, lambda v: struct(v["x"], v["y"], v["z"], size=F.sqrt(v["x"] * v["x"] + v["y"] * v["y"] + v["z"] * v["z"])))
    units = lambda items: F.transform(sized(items), lambda v: F.when(v["size"] > 0, struct(v["x"] / v["size"], v["y"] / v["size"], v["z"] / v["size"])))
    sides = units(F.transform(pair(ring, 1), lambda p: struct(*(p["b"][c] - p["a"][c] for c in "xyz"))))

    def turn(p: Column) -> Column:
        u, v = (tuple(p[k][c] for c in "xyz") for k in "ab")
        return F.struct(struct(*G.cross(u, v)).alias("cross"), F.acos(cosine(u, v)).alias("angle"))

    turns = F.filter(F.transform(pair(sides, 1), turn), lambda t: t["angle"].isNotNull())
    weighed = F.transform(F.arrays_zip(units(F.transform(turns, lambda t: t["cross"])).alias("c"), F.transform(turns, lambda t: t["angle"]).alias("w")), lambda t: struct(*(F.coalesce(t["c"][c] * t["w"], F.lit(0.0)) for c in "xyz")))
    total = F.aggregate(weighed, struct(*(F.lit(0.0) for _ in "xyz")), lambda a, b: struct(*(a[c] + b[c] for c in "xyz")))
    return F.when(n >= 3, F.get(units(F.array(total)), F.lit(0)))


def is_solid_ring(ring: Column) -> Column:
    """Has any point of a ring a finite height other than zero?"""
    return F.exists(ring, lambda p: p["z"].isNotNull() & ~F.isnan(p["z"]) & (F.abs(p["z"]) < float("inf")) & (p["z"] != 0))


def oblique_direction(normal: Vector) -> Column:
    """The slanting camera direction that looks most straight at a face of this normal; the first of the list on a tie (of
    nine decimals)."""
    slanting = {k: v for k, v in DIRECTIONS.items() if "_" in k}
    best = None
    for k, (name, d) in enumerate(slanting.items()):
        size = sum(x * x for x in d) ** 0.5
        dot = -(normal[0] * (d[0] / size) + normal[1] * (d[1] / size) + normal[2] * (d[2] / size))
        one = F.struct(F.round(dot, 9).alias("dot"), F.lit(-k).alias("first"), F.lit(name).alias("name"))
        best = one if best is None else F.greatest(best, one)
    return best["name"]


def plane_distance(plane: tuple[Column, Column, Column, Column], p: Vector) -> Column:
    """Signed distance of a point from the plane a x + b y + c z + d = 0."""
    a, b, c, d = plane
    return (a * p[0] + b * p[1] + c * p[2] + d) / F.nullif(F.sqrt(a * a + b * b + c * c), F.lit(0.0))


def plane_height(plane: tuple[Column, Column, Column, Column], x: Column, y: Column) -> Column:
    """z of a plane at x and y, null if it stands upright."""
    a, b, c, d = plane
    return -(a * x + b * y + d) / F.nullif(c, F.lit(0.0))


def applied(matrix: Column, p: Vector, w: float = 1.0) -> Vector:
    """A column-major 4 x 4 matrix times a point (w = 1) or a direction (w = 0)."""
    return tuple(F.get(matrix, F.lit(i)) * p[0] + F.get(matrix, F.lit(4 + i)) * p[1] + F.get(matrix, F.lit(8 + i)) * p[2] + F.get(matrix, F.lit(12 + i)) * w for i in range(3))


def multiplied(a: Column, b: Column) -> Column:
    """The product of two column-major 4 x 4 matrices."""
    cell = lambda k: sum((F.get(a, F.lit(4 * j + k % 4)) * F.get(b, F.lit(4 * (k // 4) + j)) for j in range(1, 4)), F.get(a, F.lit(k % 4)) * F.get(b, F.lit(4 * (k // 4))))
    return F.array(*(cell(k) for k in range(16)))


def identity() -> Column:
    return F.array(*(F.lit(1.0 if k % 5 == 0 else 0.0) for k in range(16)))


def is_identity(matrix: Column) -> Column:
    return matrix == identity()


def up_axis(turn: int) -> Column:
    """Matrix that turns by 90 degrees about the x axis: 1 takes y to z, -1 takes z to y."""
    return F.array(*(F.lit(float(v)) for v in (1, 0, 0, 0, 0, 0, turn, 0, 0, -turn, 0, 0, 0, 0, 0, 1)))


def frame_along(direction: Vector) -> Column:
    """Matrix whose z axis is a unit direction; its x axis is level, and east where the direction stands upright."""
    upright = (F.abs(direction[0]) < 1e-8) & (F.abs(direction[1]) < 1e-8)
    level = G.unit((-direction[1], direction[0], F.lit(0.0)))
    x = tuple(F.when(upright, F.lit(e)).otherwise(c) for e, c in zip((1.0, 0.0, 0.0), level))
    y = G.cross(direction, x)
    zero = F.lit(0.0)
    return F.array(*x, zero, *y, zero, *direction, zero, zero, zero, zero, F.lit(1.0))
