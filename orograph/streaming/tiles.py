"""New points or rasters as a stream: running tile statistics and the tiles that a new raster touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tiles as T
from ..operators import ranges as R


def tile_statistics(points: DataFrame, depth: int, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Count and heights by tile and event-time window of a stream (ts, lon, lat, h); what is later than late is left out."""
    d = F.lit(depth)
    p = points.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), T.tile_x(F.col("lon"), d).alias("x"), T.tile_y(F.col("lat"), d).alias("y"))
    return p.agg(F.count("*").alias("n"), F.min("h").alias("min_h"), F.max("h").alias("max_h")).select(F.col("w.start").alias("start"), "x", "y", "n", "min_h", "max_h")


def touched_tiles(rasters: DataFrame, depth: int) -> DataFrame:
    """The tiles at a depth that each raster (extent columns) of a stream or table asks to be made again."""
    return R.tiles(R.expanded(R.of_extents(rasters, F.lit(depth)))).select("raster", "depth", "x", "y")
