"""Elevation of positions from many rasters: block lookup by equi-join, the finest raster first.

A raster is rows (raster, row, values): row 0 is the north. Metadata rows carry the extent, width and height, and, if they
have these columns, ``crs`` (EPSG number: rows of 3857 are evenly spaced in Mercator's y, not in latitude) and ``no_data``.

Rasters are cut into blocks that overlap by a row and a column, so a position finds all four cells around it in one
block, by one join, and no more than a block is ever read for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geodesy as G
from . import spatial

NO_DATA = -9999.0
BLOCK = 64


def pixel_area() -> Column:
    """A raster's native pixel area in square degrees: the smaller, the higher its priority."""
    return (F.col("max_lon") - F.col("min_lon")) / F.col("width") * ((F.col("max_lat") - F.col("min_lat")) / F.col("height"))


def _placed(points: DataFrame, rasters: DataFrame) -> DataFrame:
    """Each point with each raster that holds it, and its fractional column and row there."""
    hit = spatial.points_in_extents(points, rasters.withColumn("area", pixel_area()))
    u = (F.col("lon") - F.col("e_min_lon")) / (F.col("e_max_lon") - F.col("e_min_lon"))
    v = F.lit(1.0) - (F.col("lat") - F.col("e_min_lat")) / (F.col("e_max_lat") - F.col("e_min_lat"))
    if "crs" in rasters.columns:
        y = lambda c: G.mercator(F.lit(0.0), F.col(c))[1]
        v = F.when(F.col("e_crs") == 3857, F.lit(1.0) - (y("lat") - y("e_min_lat")) / (y("e_max_lat") - y("e_min_lat"))).otherwise(v)
    return hit.withColumns({"fx": u * F.col("e_width"), "fy": v * F.col("e_height")})


def _within(i: Column, n: Column) -> Column:
    return F.greatest(F.lit(0), F.least(i, n - 1)).cast("int")


def blocks(cells: DataFrame, size: int = BLOCK) -> DataFrame:
    """Rows as blocks (raster, by, bx, data) of size + 1 rows and columns, the last of which the next block has too."""
    wide = F.col("size")
    rows = cells.select("raster", "row", "values", F.size("values").alias("size"))
    cut = rows.select("raster", "row", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((wide - 1) / size).cast("int")), lambda k: F.slice("values", k * size + 1, F.lit(size + 1)))).alias("bx", "part"))
    own = F.floor(F.col("row") / size).cast("int")
    places = F.when((F.col("row") % size == 0) & (F.col("row") > 0), F.array(own, own - 1)).otherwise(F.array(own))
    each = cut.withColumn("by", F.explode(places))
    data = F.transform(F.array_sort(F.collect_list(F.struct("row", "part"))), lambda r: r["part"])  # size + 1 rows
    return each.groupBy("raster", "by", "bx").agg(data.alias("data"))


def _in_blocks(hit: DataFrame, cells: DataFrame, size: int = BLOCK) -> DataFrame:
    """Each placed point with its first column and row (x, y) and with the block that holds these and the next ones."""
    at = hit.withColumns({"__x": _within(F.floor("fx"), F.col("e_width")), "__y": _within(F.floor("fy"), F.col("e_height"))})
    at = at.withColumns({"__bx": F.floor(F.col("__x") / size).cast("int"), "__by": F.floor(F.col("__y") / size).cast("int")})
    b = blocks(cells, size).select(F.col("raster").alias("__r"), F.col("by").alias("__rby"), F.col("bx").alias("__rbx"), F.col("data").alias("__data"))
    return at.join(b, (F.col("e_raster") == F.col("__r")) & (F.col("__by") == F.col("__rby")) & (F.col("__bx") == F.col("__rbx")), "left")


def _cell(i: int, j: int, size: int = BLOCK) -> Column:
    """The cell j columns and i rows on from a point's first, within its raster."""
    row = _within(F.col("__y") + i, F.col("e_height")) - F.col("__by") * size
    return F.get(F.get("__data", row), _within(F.col("__x") + j, F.col("e_width")) - F.col("__bx") * size)


_HELD = ["__x", "__y", "__bx", "__by", "__r", "__rby", "__rbx", "__data", "fx", "fy"]


def _hole(rasters: DataFrame, z: Column, no_data: float) -> Column:
    """Is a cell without data: by the common value, by its raster's own, or no number?"""
    own = z == F.col("e_no_data") if "no_data" in rasters.columns else F.lit(False)
    return z.isNull() | F.isnan(z) | (z <= no_data) | F.coalesce(own, F.lit(False))


def nearest(points: DataFrame, rasters: DataFrame, cells: DataFrame, no_data: float = NO_DATA) -> DataFrame:
    """Each point with each raster's cell value z, no_data for a cell without data; on the far edges the last cell counts."""
    z = _cell(0, 0)
    return _in_blocks(_placed(points, rasters), cells).withColumn("z", F.when(_hole(rasters, z, no_data), no_data).otherwise(z)).drop(*_HELD)


def bilinear(points: DataFrame, rasters: DataFrame, cells: DataFrame, no_data: float = NO_DATA) -> DataFrame:
    """Each point with the value between four cells of each raster; next to a cell without data the first cell's value, and
    no_data if that has none."""
    rows = _in_blocks(_placed(points, rasters), cells)
    rows = rows.withColumns({f"__{n}": c for n, c in zip("abcd", (_cell(0, 0), _cell(0, 1), _cell(1, 0), _cell(1, 1)))})
    a, b, c, d = (F.col(f"__{n}") for n in "abcd")
    dx, dy = F.col("fx") - F.floor("fx"), F.col("fy") - F.floor("fy")
    mixed = (a * (1.0 - dx) + b * dx) * (1.0 - dy) + (c * (1.0 - dx) + d * dx) * dy
    hole = [_hole(rasters, v, no_data) for v in (a, b, c, d)]
    z = F.when(hole[0], no_data).when(hole[1] | hole[2] | hole[3], a).otherwise(mixed)
    return rows.withColumn("z", z).drop(*_HELD, *(f"__{n}" for n in "abcd"))


def with_hits(points: DataFrame, sampled: DataFrame, key: str = "id") -> DataFrame:
    """Each point with the finest raster's sample and whether any raster holds it; z is null where none does."""
    best = sampled.groupBy(key).agg(F.min_by("z", F.struct("e_area", "e_raster")).alias("z"), F.lit(True).alias("hit"))
    return points.join(best, key, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def by_priority(points: DataFrame, sampled: DataFrame, key: str = "id") -> DataFrame:
    """Each point with the sample of the finest raster (the least raster on a tie), 0.0 where there is none."""
    best = sampled.groupBy(key).agg(F.min_by("z", F.struct("e_area", "e_raster")).alias("z"))
    return points.join(best, key, "left").withColumn("z", F.coalesce("z", F.lit(0.0)))


def highest(points: DataFrame, sampled: DataFrame, key: str = "id") -> DataFrame:
    """Each point with its highest sample, at least 0.0."""
    best = sampled.groupBy(key).agg(F.max("z").alias("z"))
    return points.join(best, key, "left").withColumn("z", F.greatest(F.coalesce("z", F.lit(0.0)), F.lit(0.0)))


def tile_samples(tiles: DataFrame, samples: int) -> DataFrame:
    """The sample positions (id, l, x, y, i, j, lon, lat) of tiles: centres of samples x samples pixels, row 0 in the south."""
    from ..functions import tiles as T

    box = T.extent(F.col("l"), F.col("x"), F.col("y"))
    step = T.angle(F.col("l")) / float(samples)
    grid = tiles.select("l", "x", "y", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("j")).select("l", "x", "y", "j", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("i"))
    return grid.select(F.struct("l", "x", "y", "j", "i").alias("id"), "l", "x", "y", "i", "j", (box["min_lon"] + (F.col("i") + 0.5) * step).alias("lon"), (box["min_lat"] + (F.col("j") + 0.5) * step).alias("lat"))


def tile_rasters(tiles: DataFrame, rasters: DataFrame, cells: DataFrame, samples: int = 256) -> DataFrame:
    """Elevations (l, x, y, i, j, z as float) of every sample of the tiles."""
    at = tile_samples(tiles, samples)
    return by_priority(at, bilinear(at, rasters, cells)).select("l", "x", "y", "i", "j", F.col("z").cast("float").alias("z"))


def windows(df: DataFrame, size: int = 4096) -> DataFrame:
    """Windows (x0, x1, y0, y1, ends exclusive) of at most size pixels and a margin that cover each raster (width, height)."""
    margin = F.greatest(F.lit(4), F.floor(F.lit(size) * 0.01)).cast("int")
    n = lambda c: F.sequence(F.lit(0), F.ceil(F.col(c) / size).cast("int") - 1)
    cut = df.withColumn("i", F.explode(n("width"))).withColumn("j", F.explode(n("height")))
    low = lambda k: F.greatest(F.col(k) * size - margin, F.lit(0))
    high = lambda k, c: F.least((F.col(k) + 1) * size + margin, F.col(c))
    return cut.withColumns({"x0": low("i"), "x1": high("i", "width"), "y0": low("j"), "y1": high("j", "height")})


def downscaled(cells: DataFrame, factor: int) -> DataFrame:
    """Every factor-th cell (raster, row, col, z), taken at the middle of its block."""
    mid = factor // 2
    own = cells.where((F.col("row") % factor == mid) & (F.col("col") % factor == mid))
    return own.select("raster", F.expr(f"row div {factor}").cast("int").alias("row"), F.expr(f"col div {factor}").cast("int").alias("col"), "z")


def with_geoid(cells: DataFrame, geoid: DataFrame, lowest: float = NO_DATA) -> DataFrame:
    """Cells plus the geoid's height in the same cell; no-data stays, a cell without geoid keeps its height."""
    g = geoid.select("raster", "row", "col", F.col("z").alias("g"))
    none = F.isnan("z") | (F.col("z") <= lowest)
    return cells.join(g, ["raster", "row", "col"], "left").select("raster", "row", "col", F.when(none, lowest).otherwise(F.col("z") + F.coalesce("g", F.lit(0.0))).alias("z"))


def rows_of(cells: DataFrame) -> DataFrame:
    """Cells (raster, row, col, z) gathered into rows (raster, row, values)."""
    return cells.groupBy("raster", "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "z"))), lambda c: c["z"]).alias("values"))


def numbered(df: DataFrame, by: str, order: str, name: str) -> DataFrame:
    """df with dense numbers from 0 within each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1)
