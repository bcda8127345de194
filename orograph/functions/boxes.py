"""Boxes (min_x .. max_z), rectangles and cells of grids and octrees as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = dict[str, Column]
SIDES = [f"{m}_{axis}" for m in ("min", "max") for axis in "xyz"]


def box(prefix: str = "") -> Box:
    """The box of columns {prefix}min_x .. {prefix}max_z."""
    return {s: F.col(f"{prefix}{s}") for s in SIDES}


def as_struct(b: Box) -> Column:
    return F.struct(*(b[s].alias(s) for s in SIDES if s in b))


def size(b: Box) -> dict[str, Column]:
    return {a: b[f"max_{a}"] - b[f"min_{a}"] for a in "xyz" if f"min_{a}" in b}


def centre(b: Box) -> dict[str, Column]:
    return {a: (b[f"min_{a}"] + b[f"max_{a}"]) / 2.0 for a in "xyz" if f"min_{a}" in b}


def volume(b: Box) -> Column:
    x, y, z = size(b).values()
    return x * y * z


def diagonal(b: Box) -> Column:
    """Length from corner to corner; of a rectangle, in its plane."""
    return F.sqrt(sum((s * s for s in size(b).values()), F.lit(0.0)))


def flat_diagonal(b: Box) -> Column:
    s = size(b)
    return F.sqrt(s["x"] * s["x"] + s["y"] * s["y"])


def is_sound(b: Box) -> Column:
    """Has a box numbers only, and an extent along every axis?"""
    out = F.lit(True)
    for a in "xyz":
        out = out & ~F.isnan(b[f"min_{a}"]) & ~F.isnan(b[f"max_{a}"]) & (b[f"min_{a}"] < b[f"max_{a}"])
    return out


def grown(b: Box, by: float | Column) -> Box:
    return {s: c - by if s[:3] == "min" else c + by for s, c in b.items()}


def cube(b: Box) -> Box:
    """The cube on a box's least corner that is as large as its largest side."""
    side = F.greatest(*size(b).values())
    return {s: b[f"min_{s[4]}"] + (side if s[:3] == "max" else 0.0) for s in b}


def joined(a: Box, b: Box) -> Box:
    return {s: (F.least if s[:3] == "min" else F.greatest)(a[s], b[s]) for s in a}


def with_point(b: Box, p: tuple[Column, ...]) -> Box:
    at = dict(zip("xyz", p))
    return {s: (F.least if s[:3] == "min" else F.greatest)(c, at[s[4]]) for s, c in b.items()}


def shared(a: Box, b: Box) -> Column:
    """The box that two share, as a struct; null if it has no extent along an axis."""
    both = {s: (F.greatest if s[:3] == "min" else F.least)(a[s], b[s]) for s in a}
    there = F.lit(True)
    for s in both:
        if s[:3] == "min":
            there = there & (both[s] < both[f"max_{s[4:]}"])
    return F.when(there, as_struct(both))


def contains(a: Box, b: Box) -> Column:
    out = F.lit(True)
    for s in a:
        out = out & (a[s] <= b[s] if s[:3] == "min" else a[s] >= b[s])
    return out


def holds(b: Box, p: tuple[Column, ...]) -> Column:
    """Is a point in a box or on its border? Two coordinates ask for x and y alone."""
    out = F.lit(True)
    for a, c in zip("xyz", p):
        out = out & (c >= b[f"min_{a}"]) & (c <= b[f"max_{a}"])
    return out


def meets_plane(b: Box, plane: tuple[Column, Column, Column, Column]) -> Column:
    """Has a box corners on both sides of a plane, or one on it?"""
    corners = [tuple(b[f"{m}_{a}"] for m, a in zip(ms, "xyz")) for ms in ((x, y, z) for x in ("min", "max") for y in ("min", "max") for z in ("min", "max"))]
    off = [plane[0] * x + plane[1] * y + plane[2] * z + plane[3] for x, y, z in corners]
    return (F.least(*off) <= 0) & (F.greatest(*off) >= 0)


def meets_triangle(b: Box, corners: list[tuple[Column, Column, Column]]) -> Column:
    """Do a box and a triangle meet? By the thirteen axes that could part them."""
    from . import geodesy as G

    c, half = centre(b), {a: s / 2.0 for a, s in size(b).items()}
    p = [tuple(v - c[a] for a, v in zip("xyz", corner)) for corner in corners]
    edges = [G.minus(p[1], p[0]), G.minus(p[2], p[1]), G.minus(p[0], p[2])]
    unit = [tuple(F.lit(1.0 if i == k else 0.0) for i in range(3)) for k in range(3)]
    axes = [*unit, G.cross(edges[0], edges[1]), *(G.cross(u, e) for u in unit for e in edges)]
    out = F.lit(True)
    for axis in axes:
        reach = sum((half[a] * F.abs(axis[k]) for k, a in enumerate("xyz")), F.lit(0.0))
        along = [G.dot(q, axis) for q in p]
        slack = 1e-9 * (reach + F.abs(axis[0]) + F.abs(axis[1]) + F.abs(axis[2]))  # what only touches meets, whatever rounding does
        out = out & (F.least(*along) <= reach + slack) & (F.greatest(*along) >= -reach - slack)
    return out


def rectangle_area(b: Box) -> Column:
    s = size(b)
    return s["x"] * s["y"]


def rectangle_perimeter(b: Box) -> Column:
    s = size(b)
    return 2.0 * (s["x"] + s["y"])


def quantisation(values: Column) -> Column:
    """What maps points (x, y, z structs) to the unit cube: the largest of their three ranges, and their least corner."""
    at = lambda axis, pick: pick(F.transform(values, lambda p: p[axis]))
    low, high = {a: at(a, F.array_min) for a in "xyz"}, {a: at(a, F.array_max) for a in "xyz"}
    return F.struct(F.greatest(*(high[a] - low[a] for a in "xyz")).alias("scale"), *(low[a].alias(a) for a in "xyz"))


def quantised(v: Column, low: Column, scale: Column) -> Column:
    """A coordinate as a signed 16-bit number that stands for 0 to 65535; computed in floats."""
    share = ((v.cast("float") - low.cast("float")) / F.nullif(scale.cast("float"), F.lit(0.0).cast("float"))).cast("float")
    q = (share * F.lit(65535.0).cast("float")).cast("int")
    return F.coalesce(F.when(q > 32767, q - 65536).otherwise(q), F.lit(0))


def voxel_position(low: dict[str, float], step: dict[str, float], i: Column, j: Column, k: Column) -> tuple[Column, ...]:
    return tuple(c * step[a] + low[a] for a, c in zip("xyz", (i, j, k)))


def alpha_share(alpha: Column) -> Column:
    """A byte of opacity as 0 to 1."""
    return F.pmod(alpha, F.lit(256)) / 255.0


# Octree coordinates: (depth, x, y, z)


def octree_parent(c: tuple[Column, Column, Column, Column]) -> tuple[Column, ...]:
    """The coordinate one depth up, nulls above depth 0."""
    return tuple(F.when(c[0] > 0, v) for v in (c[0] - 1, *(F.floor(x / 2).cast("int") for x in c[1:])))


def octree_number(c: tuple[Column, Column, Column, Column]) -> Column:
    """The place of a coordinate among those of its depth, x first; -1 beyond the octree."""
    n = F.shiftleft(F.lit(1).cast("long"), c[0]) if isinstance(c[0], int) else F.pow(F.lit(2), c[0]).cast("long")
    inside = F.lit(True)
    for v in c[1:]:
        inside = inside & (v >= 0) & (v < n)
    return F.when(inside, c[1] + c[2] * n + c[3] * n * n).otherwise(-1)


def octree_child(c: tuple[Column, Column, Column, Column]) -> Column:
    """Which of its parent's children a coordinate is: counter-clockwise from the left front, then the upper four."""
    odd = [F.pmod(v, F.lit(2)) for v in c[1:]]
    flat = F.when(odd[0] > 0, F.when(odd[1] > 0, 2).otherwise(1)).otherwise(F.when(odd[1] > 0, 3).otherwise(0))
    return F.when(c[0] == 0, 0).otherwise(flat + 4 * odd[2]).cast("int")


def octree_path(c: tuple[Column, Column, Column, Column]) -> Column:
    """All coordinates (depth, x, y, z) from the root to this one."""
    up = lambda v, d: F.floor(v / F.pow(F.lit(2), c[0] - d)).cast("int")
    return F.transform(F.sequence(F.lit(0), c[0]), lambda d: F.struct(d.alias("depth"), *(up(v, d).alias(a) for a, v in zip("xyz", c[1:]))))


def octree_neighbours(c: tuple[Column, Column, Column, Column]) -> Column:
    """The six coordinates beside one by name; some may lie beyond the octree."""
    names = {"left": (-1, 0, 0), "right": (1, 0, 0), "front": (0, -1, 0), "rear": (0, 1, 0), "top": (0, 0, 1), "bottom": (0, 0, -1)}
    return F.array(*(F.struct(F.lit(n).alias("side"), *((v + s).alias(a) for a, v, s in zip("xyz", c[1:], step))) for n, step in names.items()))


def cell_box(i: tuple[Column, ...], low: dict[str, float], step: float) -> Box:
    """The box of a cell of a grid."""
    return {f"{m}_{a}": F.lit(low[a]) + (v + int(m == "max")) * step for m in ("min", "max") for a, v in zip("xyz", i)}
