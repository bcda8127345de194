"""Models and features as tables: legends, attributes, walls, voxels, cells and isosurface cases."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import spread

LEGEND_ROWS = 10_000


def legend_colour(df: DataFrame, legend: DataFrame, value: str) -> DataFrame:
    """df with r, g, b mixed linearly between the legend's nearest lower and higher keys; an exact key wins. Beyond
    its ends the last colour counts.

    A legend is a table of keys for people to read: one of more than LEGEND_ROWS is an error.
    """
    found = legend.select("value", "r", "g", "b").orderBy("value").limit(LEGEND_ROWS + 1).collect()
    if len(found) > LEGEND_ROWS:
        raise ValueError(f"a legend of more than {LEGEND_ROWS} keys")
    if not found:
        return df.withColumns({c: F.lit(None).cast("double") for c in "rgb"})
    keys = F.from_json(F.lit(json.dumps([r.asDict() for r in found])), "array<struct<value:double,r:double,g:double,b:double>>")
    low = F.try_element_at(F.filter(keys, lambda k: k["value"] <= F.col(value)), F.lit(-1))
    high = F.try_element_at(F.filter(keys, lambda k: k["value"] >= F.col(value)), F.lit(1))
    rows = df.withColumns({"__a": low, "__b": high}).withColumns({"__low": F.coalesce("__a", "__b"), "__high": F.coalesce("__b", "__a")})
    span = F.col("__high.value") - F.col("__low.value")
    t = F.when(span == 0, 0.0).otherwise((F.col(value) - F.col("__low.value")) / F.nullif(span, F.lit(0.0)))
    return rows.withColumns({c: F.col(f"__low.{c}") * (1.0 - t) + F.col(f"__high.{c}") * t for c in "rgb"}).drop("__a", "__b", "__low", "__high")


def any_attribute(conditions: list[tuple[str, str]]) -> Column:
    """Is one of the attributes the value that goes with it? A null attribute reads 'null'."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c).cast("string"), F.lit("null")) == v for c, v in conditions])


def attribute_names(columns: list[str]) -> dict[str, str]:
    """Attribute names as output knows them: one that begins with a digit gets an underscore."""
    return {c: f"_{c}" if c[:1].isdigit() else c for c in columns}


def number_attribute(column: str, default: float) -> Column:
    """An attribute as a number, the default where it is none."""
    return F.coalesce(F.expr(f"try_cast(`{column}` AS DOUBLE)"), F.lit(default))


def walls(features: DataFrame, bottom: str = "bottom", top: str = "top") -> DataFrame:
    """One row (id, k, ax, ay, bx, by, low, high) for each side of each ring: the wall from bottom to top."""
    n = F.size("ring")
    sides = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(k.alias("k"), F.get("ring", k).alias("a"), F.get("ring", F.pmod(k + 1, n)).alias("b")))
    rows = features.where(n >= 2).select("id", bottom, top, F.explode(sides).alias("s"))
    return rows.select("id", "s.k", F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"), F.least(bottom, top).alias("low"), F.greatest(bottom, top).alias("high"))


def ring_area(ring: Column) -> Column:
    """Signed area of a ring of (x, y) structs, positive if it runs counter-clockwise."""
    n = F.size(ring)
    term = lambda k: F.get(ring, k)["x"] * F.get(ring, F.pmod(k + 1, n))["y"] - F.get(ring, F.pmod(k + 1, n))["x"] * F.get(ring, k)["y"]
    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0.0), lambda a, b: a + b) / 2.0


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Is a point inside a ring? By the number of sides that a ray to the east crosses."""
    n = F.size(ring)

    def crosses(k: Column) -> Column:
        a, b = F.get(ring, k), F.get(ring, F.pmod(k + 1, n))
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])

    return F.size(F.filter(F.sequence(F.lit(0), n - 1), crosses)) % 2 == 1


def simplified(ring: Column, least: float = 0.01) -> Column:
    """A line without points closer than least to the last one kept."""
    far = lambda a, p: F.sqrt(F.pow(F.element_at(a, -1)["x"] - p["x"], F.lit(2)) + F.pow(F.element_at(a, -1)["y"] - p["y"], F.lit(2))) >= least
    return F.aggregate(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1), lambda a, p: F.when(far(a, p), F.concat(a, F.array(p))).otherwise(a))


def densest(voxels: DataFrame) -> DataFrame:
    """Each voxel's largest alpha and the first that set it."""
    best = voxels.groupBy("ix", "iy", "iz").agg(F.max(F.struct("alpha", (-F.col("seq")).alias("first"))).alias("m"))
    return best.select("ix", "iy", "iz", "m.alpha", (-F.col("m.first")).alias("seq"))


def cube_cases(voxels: DataFrame, iso: float) -> DataFrame:
    """ix, iy, iz and the 8-bit case of each cube that a surface at iso passes: bit x + 2 y + 4 z is set above it.

    A corner without voxel is 0. Each voxel is sent to the eight cubes it is a corner of.
    """
    corners = F.array(*(F.struct((F.col("ix") - i).alias("ix"), (F.col("iy") - j).alias("iy"), (F.col("iz") - k).alias("iz"), F.lit(1 << (i + 2 * j + 4 * k)).alias("bit")) for i in (0, 1) for j in (0, 1) for k in (0, 1)))
    rows = voxels.where(F.col("alpha") > iso).select(F.explode(corners).alias("c"))
    return rows.groupBy("c.ix", "c.iy", "c.iz").agg(F.sum("c.bit").cast("int").alias("cube")).where("cube < 255")


def cell_of(x: Column, y: Column, low: tuple[float, float], size: tuple[float, float], n: tuple[int, int]) -> tuple[Column, Column]:
    """Column and row of a point in a grid of n cells, null outside."""
    i, j = F.floor((x - low[0]) / size[0]).cast("int"), F.floor((y - low[1]) / size[1]).cast("int")
    inside = i.between(0, n[0] - 1) & j.between(0, n[1] - 1)
    return F.when(inside, i), F.when(inside, j)


def compacted(faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertex, index) of the corners that faces use, numbered without gaps, and the faces by those numbers.

    Numbers come from per-part counts and ranks within parts, so no task numbers all corners.
    """
    used = faces.select(F.explode(F.array("v0", "v1", "v2")).alias("vertex")).distinct()
    parts = 64
    by = used.withColumn("__p", F.pmod(F.xxhash64("vertex"), F.lit(parts)))
    before = by.groupBy("__p").count().withColumn("__before", F.sum("count").over(Window.orderBy("__p")) - F.col("count")).select("__p", "__before")  # parts rows
    index = by.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy("vertex")) - 1).join(F.broadcast(before), "__p").select("vertex", (F.col("__before") + F.col("__n")).alias("index"))
    out = faces
    for k in range(3):
        out = out.join(index.select(F.col("vertex").alias(f"v{k}"), F.col("index").alias(f"i{k}")), f"v{k}")
    return index, out.select("face", *(F.col(f"i{k}").alias(f"v{k}") for k in range(3)))


MOST_IN_A_ROW = 10_000
"""Points of a feature that are found within one row; those of features that ask for more are rows from the start."""


def scattered(features: DataFrame, n: Column, seed: int = 0, tries: int = 16, keep: tuple[str, ...] = ()) -> DataFrame:
    """id, k, x, y and the features' columns keep: up to n points within each feature's outer ring (id, ring), the same for
    equal ids and seeds on every run.

    Candidates are dealt over the ring's box by a hash, tries for each point wanted; the first n of those inside count. A ring
    that fills a small part of its box may get fewer. Candidates are made n at a time, and none once n are inside; features that want
    more than MOST_IN_A_ROW points make them all, as rows, which give the same points.
    """
    at = lambda pick, c: pick(F.transform("ring", lambda p: p[c]))
    rows = spread(features.withColumn("__n", n).select("id", "ring", "__n", *keep)).withColumns({"__x": at(F.array_min, "x"), "__y": at(F.array_min, "y"), "__w": at(F.array_max, "x") - at(F.array_min, "x"), "__h": at(F.array_max, "y") - at(F.array_min, "y")})
    share = lambda k, axis: F.pmod(F.xxhash64(F.lit(seed), "id", k, F.lit(axis)), F.lit(1 << 30)) / float(1 << 30)
    candidate = lambda k: F.struct((F.col("__x") + share(k, 0) * F.col("__w")).alias("x"), (F.col("__y") + share(k, 1) * F.col("__h")).alias("y"))
    inside = lambda p: in_ring(F.col("ring"), p["x"], p["y"])

    few = rows.where((F.col("__n") > 0) & (F.col("__n") <= MOST_IN_A_ROW))
    some = lambda t: F.filter(F.transform(F.sequence(t * F.col("__n"), (t + 1) * F.col("__n") - 1), candidate), inside)
    found = F.aggregate(F.sequence(F.lit(0), F.lit(tries - 1)), F.filter(F.array(candidate(F.lit(0))), lambda p: F.lit(False)), lambda got, t: F.when(F.size(got) >= F.col("__n"), got).otherwise(F.concat(got, some(t))))
    out = few.select("id", *keep, F.posexplode(F.slice(found, F.lit(1), F.col("__n").cast("int"))).alias("k", "p")).select("id", "k", "p.x", "p.y", *keep)

    each = rows.where(F.col("__n") > MOST_IN_A_ROW).withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__n") * tries - 1))).withColumn("__p", candidate(F.col("__k")))
    ranked = each.where(inside(F.col("__p"))).withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("__k")) - 1)
    return out.unionByName(ranked.where(F.col("k") < F.col("__n")).select("id", "k", F.col("__p.x").alias("x"), F.col("__p.y").alias("y"), *keep))
