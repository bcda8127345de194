"""Joins of extents and points by grid cells: equi-joins with a residual test, never nested loops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def _cell(v: Column, size: float, low: float) -> Column:
    return F.floor((v - low) / size).cast("long")


def cell_size(*tables: DataFrame) -> float:
    """Cells about as large as half of the extents are at most, so that a cell's extents are mostly neighbours; and not so small that
    the largest extent lies in more than 100 by 100 of them."""
    side = F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat"))
    sides = [t.select(F.lit(k).alias("k"), side.alias("side")) for k, t in enumerate(tables)]
    found = reduce(DataFrame.union, sides).groupBy("k").agg(F.percentile_approx("side", 0.5, 1000).alias("half"), F.max("side").alias("most")).collect()  # a row a table
    return max([1e-6, *(max(r["half"], r["most"] / 100) for r in found if r["most"] is not None)])


def _in_cells(df: DataFrame, size: float) -> DataFrame:
    xs = F.sequence(_cell(F.col("min_lon"), size, -180.0), _cell(F.col("max_lon"), size, -180.0))
    ys = F.sequence(_cell(F.col("min_lat"), size, -90.0), _cell(F.col("max_lat"), size, -90.0))
    return df.withColumn("__cx", F.explode(xs)).withColumn("__cy", F.explode(ys))


def _small(df: DataFrame) -> DataFrame:
    """df, broadcast if it is checked to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def extents_meet(a: DataFrame, b: DataFrame, size: float | None = None) -> DataFrame:
    """Pairs of rows whose extents meet; touching counts. b's columns get the prefix b_. Cells of size degrees (None: as the
    extents ask for) are joined by equality, and Spark splits those that hold more than others.

    A pair is found in one cell only, the one that holds the lower corner of what both share.
    """
    size = size or cell_size(a, b)
    left = _in_cells(a, size).alias("a")
    right = _in_cells(b, size).select(*(F.col(c).alias(c if c.startswith("__") else f"b_{c}") for c in [*b.columns, "__cx", "__cy"])).alias("b")
    meet = (F.col("min_lon") <= F.col("b_max_lon")) & (F.col("b_min_lon") <= F.col("max_lon")) & (F.col("min_lat") <= F.col("b_max_lat")) & (F.col("b_min_lat") <= F.col("max_lat"))
    once = (F.col("__cx") == _cell(F.greatest("min_lon", "b_min_lon"), size, -180.0)) & (F.col("__cy") == _cell(F.greatest("min_lat", "b_min_lat"), size, -90.0))
    return left.join(right, ["__cx", "__cy"]).where(meet & once).drop("__cx", "__cy")


def points_in_extents(points: DataFrame, extents: DataFrame, size: float | None = None) -> DataFrame:
    """Pairs of a point (lon, lat) and an extent that holds it, both ends inclusive; extents' columns get the prefix e_."""
    size = size or cell_size(extents)
    right = _in_cells(extents, size).select(*(F.col(c).alias(c if c.startswith("__") else f"e_{c}") for c in [*extents.columns, "__cx", "__cy"]))
    left = points.withColumns({"__cx": _cell(F.col("lon"), size, -180.0), "__cy": _cell(F.col("lat"), size, -90.0)})
    inside = F.col("lon").between(F.col("e_min_lon"), F.col("e_max_lon")) & F.col("lat").between(F.col("e_min_lat"), F.col("e_max_lat"))
    return left.join(_small(right), ["__cx", "__cy"]).where(inside).drop("__cx", "__cy")
