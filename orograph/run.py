"""A run from rasters to a tree of tiles: all depths, only what is missing, only what new rasters touch, or the descriptor alone.

``python -m orograph.run -i dem -o tiles -max 12``. Each depth is written before the next begins, and a tile is written whole or
not at all, so a run that ends early goes on where it stopped with ``--continue``.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import tiles as T
from .operators import pyramid as P
from .operators import ranges as R
from .operators import rasters as Q
from .options import Options, parsed
from .sources import geotiff, vectors


def prepared(spark: SparkSession, options: Options, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rasters of a folder in degrees, over the geoid if the options name a grid for it."""
    rasters, cells = geotiff.read(spark, folder or options.input)
    geoid = None if options.geoid == "Ellipsoid" else geotiff.read(spark, options.geoid)
    return Q.standardised(rasters, cells, geoid, options.nodata)


def wanted(rasters: DataFrame, depth: int) -> DataFrame:
    """The tiles (l, x, y) of a depth that rasters touch."""
    cover = R.of_extents(rasters.select("min_lon", "min_lat", "max_lon", "max_lat"), F.lit(depth)).select("depth", *R.BOUNDS)
    return R.union(cover).select(F.col("depth").alias("l"), "x", "y")


def _depths(rasters: DataFrame, options: Options) -> range:
    return range(options.min_depth, (options.max_depth if options.max_depth >= 0 else P.max_depth_of(rasters)) + 1)


def _written(rasters: DataFrame, cells: DataFrame, options: Options, depth: int, tiles: DataFrame) -> int:
    if tiles.isEmpty():
        return 0
    meshes = P.levels(rasters, cells, [depth], tiles, options.intensity)
    return vectors.write_tree(P.blobs(meshes, options.calculate_normals), options.output)


def described(spark: SparkSession, options: Options) -> str:
    """Writes layer.json for the tiles that the output holds; its text. What only has a name there is listed, not written."""
    from pyarrow.fs import FileSystem

    ranges = vectors.tree_ranges(vectors.tile_tree(spark, options.output))
    more = [n for n, on in (("octvertexnormals", options.calculate_normals), ("metadata", options.metadata), ("watermask", options.water_mask)) if on]
    text = R.layer_json(ranges, extensions=more).first()["json"]
    files, base = FileSystem.from_uri(options.output if "://" in options.output or options.output.startswith("file:") else f"file://{options.output}")
    with files.open_output_stream(f"{base}/layer.json", compression=None) as out:
        out.write(text.encode())
    return text


def convert(spark: SparkSession, options: Options) -> dict[int, int]:
    """All tiles of all depths, or with resume those that the output does not hold; how many were written by depth."""
    options = options.checked()
    if options.json:
        described(spark, options)
        return {}
    rasters, cells = prepared(spark, options)
    out = {}
    for depth in _depths(rasters, options):
        tiles = wanted(rasters, depth)
        if options.resume:
            done = vectors.tile_tree_or_none(spark, options.output)
            if done is not None:
                tiles = vectors.missing(tiles.withColumnRenamed("l", "depth"), done).withColumnRenamed("depth", "l")
        out[depth] = _written(rasters, cells, options, depth, tiles)
    described(spark, options)
    return out


def state(spark: SparkSession, options: Options, depth: int) -> DataFrame:
    """The meshes (l, x, y, u, v, h, indices) of a depth as the output's finished tiles hold them."""
    tree = vectors.tile_tree(spark, options.output).where(F.col("depth") == depth)
    return P.decoded(tree.withColumnRenamed("depth", "l"))


def modify(spark: SparkSession, options: Options, added: str) -> dict[int, int]:
    """Tiles that the rasters of a further folder touch, and those beside them, made again from the old rasters and the new;
    a new raster without data in a place leaves the old ones' heights there. How many were written by depth."""
    options = options.checked()
    rasters, cells = prepared(spark, options)
    new, new_cells = prepared(spark, options, added)
    name = F.concat(F.lit("added/"), F.col("raster"))
    new, new_cells = new.withColumn("raster", name), new_cells.withColumn("raster", name)
    every, all_cells = rasters.unionByName(new), cells.unionByName(new_cells)
    out = {}
    for depth in _depths(every, options):
        touched = R.tiles(R.expanded(R.of_extents(new.select("min_lon", "min_lat", "max_lon", "max_lat"), F.lit(depth)).select("depth", *R.BOUNDS)))
        tiles = touched.select(F.col("depth").alias("l"), "x", "y").distinct().join(wanted(every, depth), ["l", "x", "y"], "left_semi")
        out[depth] = _written(every, all_cells, options, depth, tiles)
    described(spark, options)
    return out


def register(spark: SparkSession) -> None:
    """The tile functions for SQL users, as temporary SQL functions: tile_x, tile_y, tile_angle, tile_size."""
    bodies = {
        "tile_angle(l INT) RETURNS DOUBLE": "CASE WHEN l BETWEEN 0 AND 28 THEN 180D / pow(2D, l) ELSE -1D END",
        "tile_x(lon DOUBLE, l INT) RETURNS INT": "CAST(greatest(0, least(floor((lon + 180D) / (180D / pow(2D, l))), pow(2D, l + 1) - 1)) AS INT)",
        "tile_y(lat DOUBLE, l INT) RETURNS INT": "CAST(greatest(0, least(floor((lat + 90D) / (180D / pow(2D, l))), pow(2D, l) - 1)) AS INT)",
        "tile_size(l INT) RETURNS DOUBLE": f"180D / pow(2D, l) * {T.DEGREE!r}D * {T.EQUATORIAL_RADIUS!r}D",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def main(arguments: list[str]) -> None:
    options = parsed(arguments)
    spark = SparkSession.builder.appName("orograph").getOrCreate()
    for depth, n in convert(spark, options).items():
        print(f"depth {depth}: {n} tiles")


if __name__ == "__main__":
    main(sys.argv[1:])

__all__ = ["Options", "convert", "described", "main", "modify", "parsed", "prepared", "register", "state", "wanted"]
