"""Triangles cut by planes across an axis, and by a grid of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAMES = [f"{c}{k}" for k in range(3) for c in "xyz"]


def _between(a: int, b: int, axis: str, at: float) -> dict[str, Column]:
    """The point of edge a-b on the plane."""
    t = (F.lit(at) - F.col(f"{axis}{a}")) / F.nullif(F.col(f"{axis}{b}") - F.col(f"{axis}{a}"), F.lit(0.0))
    return {c: F.lit(at) if c == axis else F.col(f"{c}{a}") + t * (F.col(f"{c}{b}") - F.col(f"{c}{a}")) for c in "xyz"}


def cut_by_plane(triangles: DataFrame, axis: str, at: float) -> DataFrame:
    """Triangles (id, x0.. z2, other columns) with those that cross a plane replaced by their three parts.

    Column class is 2 beyond the plane and 1 otherwise. Corners on the plane cut nothing.
    """
    beyond = [F.col(f"{axis}{k}") > at for k in range(3)]
    before = [F.col(f"{axis}{k}") < at for k in range(3)]
    corner = lambda k: {c: F.col(f"{c}{k}") for c in "xyz"}
    one = lambda *p: F.struct(*(q[c].alias(f"{c}{k}") for k, q in enumerate(p) for c in "xyz"))
    parts = F.array(one(corner(0), corner(1), corner(2)))
    for a in range(3):
        b, c = (a + 1) % 3, (a + 2) % 3
        ab, ac = _between(a, b, axis, at), _between(a, c, axis, at)
        three = F.array(one(corner(a), ab, ac), one(ab, corner(b), corner(c)), one(ab, corner(c), ac))
        alone = (beyond[a] & before[b] & before[c]) | (before[a] & beyond[b] & beyond[c])
        middle = _between(b, c, axis, at)
        two = F.array(one(corner(a), corner(b), middle), one(corner(a), middle, corner(c)))
        through = ~beyond[a] & ~before[a] & ((beyond[b] & before[c]) | (before[b] & beyond[c]))
        parts = F.when(alone, three).when(through, two).otherwise(parts)
    keep = [c for c in triangles.columns if c not in _NAMES]
    cut = triangles.select(*keep, F.explode(parts).alias("__p")).select(*keep, "__p.*")
    mean = (F.col(f"{axis}0") + F.col(f"{axis}1") + F.col(f"{axis}2")) / 3.0
    return cut.withColumn("class", F.when(mean > at, 2).otherwise(1))


def cut_by_grid(triangles: DataFrame, axis: str, planes: list[float]) -> DataFrame:
    """Triangles cut by several planes across one axis; cell numbers the slab of each part."""
    out = triangles
    for at in planes:
        out = cut_by_plane(out, axis, at).drop("class")
    mean = (F.col(f"{axis}0") + F.col(f"{axis}1") + F.col(f"{axis}2")) / 3.0
    return out.withColumn("cell", sum(((mean > at).cast("int") for at in planes), F.lit(0)))


def regular_net(spark, columns: int, rows: int) -> DataFrame:
    """The triangles (face, v0, v1, v2) of a net of columns x rows vertices, numbered row by row."""
    at = spark.range((columns - 1) * (rows - 1)).select((F.col("id") % (columns - 1)).alias("i"), F.expr(f"id div {columns - 1}").alias("j"))
    a = F.col("j") * columns + F.col("i")
    two = F.array(F.struct(F.lit(0).alias("k"), a.alias("v0"), (a + 1).alias("v1"), (a + columns + 1).alias("v2")), F.struct(F.lit(1).alias("k"), a.alias("v0"), (a + columns + 1).alias("v1"), (a + columns).alias("v2")))
    return at.select(((F.col("j") * (columns - 1) + F.col("i")) * 2).alias("f"), F.explode(two).alias("t")).select((F.col("f") + F.col("t.k")).alias("face"), "t.v0", "t.v1", "t.v2")


def skirt(edges: DataFrame, depth: float) -> DataFrame:
    """Two triangles (edge, k, x0.. z2) below each border edge (edge, ax, ay, az, bx, by, bz), depth down."""
    p = {n: tuple(F.col(f"{n}{c}") for c in "xyz") for n in "ab"}
    low = {n: (x, y, z - depth) for n, (x, y, z) in p.items()}
    one = lambda k, *q: F.struct(F.lit(k).alias("k"), *(v.alias(f"{c}{i}") for i, t in enumerate(q) for c, v in zip("xyz", t)))
    return edges.select("edge", F.explode(F.array(one(0, p["a"], low["a"], low["b"]), one(1, p["a"], low["b"], p["b"]))).alias("t")).select("edge", "t.*")
