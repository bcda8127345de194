"""Lines, segments, boxes and strings as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[Column, Column]


def side_of_line(a: Point, b: Point, p: Point, error: float = 1e-8) -> Column:
    """0 if p is on the line from a to b, 1 left of it, 2 right of it; the error is a distance."""
    dx, dy = b[0] - a[0], b[1] - a[1]
    off = (dx * (p[1] - a[1]) - dy * (p[0] - a[0])) / F.nullif(F.sqrt(dx * dx + dy * dy), F.lit(0.0))
    return F.when(off.isNull() | (F.abs(off) <= error), 0).when(off > 0, 1).otherwise(2)


def in_triangle(a: Point, b: Point, c: Point, p: Point, error: float = 1e-8) -> Column:
    """Is p within a counter-clockwise triangle or on its border?"""
    return (side_of_line(a, b, p, error) != 2) & (side_of_line(b, c, p, error) != 2) & (side_of_line(c, a, p, error) != 2)


def segments_cross(a: Point, b: Point, c: Point, d: Point) -> Column:
    """Do two segments cross in a point that is an end of neither?"""
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return (F.signum(turn(a, b, c)) * F.signum(turn(a, b, d)) < 0) & (F.signum(turn(c, d, a)) * F.signum(turn(c, d, b)) < 0)


def crossing(a: Point, b: Point, c: Point, d: Point) -> Point:
    """Where the lines a-b and c-d meet, null if they are parallel."""
    rx, ry, sx, sy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    t = ((c[0] - a[0]) * sy - (c[1] - a[1]) * sx) / F.nullif(rx * sy - ry * sx, F.lit(0.0))
    return a[0] + t * rx, a[1] + t * ry


def box_meets(a: str, b: str, tolerance: float = 0.0) -> Column:
    """Do the boxes of columns {a}_min_x.. and {b}_min_x.. meet within a tolerance? Over the axes x, y and z."""
    out = F.lit(True)
    for axis in "xyz":
        out = out & (F.col(f"{a}_min_{axis}") <= F.col(f"{b}_max_{axis}") + tolerance) & (F.col(f"{b}_min_{axis}") <= F.col(f"{a}_max_{axis}") + tolerance)
    return out


def padded(text: Column, to: int) -> Column:
    """Text filled with blanks to a multiple of to characters."""
    return F.rpad(text, (F.ceil(F.length(text) / to) * to).cast("int"), " ")


def packed_colour(r: Column, g: Column, b: Column, a: Column) -> Column:
    """Four bytes as one signed 32-bit integer, r lowest."""
    whole = r.cast("long") + g.cast("long") * 256 + b.cast("long") * 65536 + a.cast("long") * 16777216
    return F.when(whole >= 1 << 31, whole - (1 << 32)).otherwise(whole).cast("int")


def unpacked_colour(c: Column) -> tuple[Column, ...]:
    whole = F.pmod(c.cast("long"), F.lit(1 << 32))
    return tuple((F.shiftright(whole, 8 * k).bitwiseAND(F.lit(255))).cast("int") for k in range(4))


def tile_path(depth: Column, x: Column, y: Column) -> Column:
    return F.concat_ws("/", depth.cast("string"), x.cast("string"), F.concat(y.cast("string"), F.lit(".terrain")))
