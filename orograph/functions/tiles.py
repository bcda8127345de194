"""Geographic tile algebra: 2^(L+1) x 2^L square tiles of 180 / 2^L degrees, row 0 in the south."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .geodesy import DEGREE, EQUATORIAL_RADIUS
from .numbers import half_up

MAX_DEPTH = 28
SAMPLES = 256


def angle(depth: Column) -> Column:
    """Degrees of a tile's side; -1 beyond depths 0 to 28."""
    return F.when(depth.between(0, MAX_DEPTH), F.lit(180.0) / F.pow(F.lit(2.0), depth)).otherwise(-1.0)


def size_metres(depth: Column) -> Column:
    return angle(depth) * DEGREE * EQUATORIAL_RADIUS


def _clamped(c: Column, n: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.floor(c), n - 1)).cast("int")


def _columns(depth: Column) -> Column:
    return F.pow(F.lit(2.0), depth + 1).cast("long")


def _rows(depth: Column) -> Column:
    return F.pow(F.lit(2.0), depth).cast("long")


def tile_x(lon: Column, depth: Column) -> Column:
    return _clamped((lon + 180.0) / (F.lit(360.0) / _columns(depth)), _columns(depth))


def tile_y(lat: Column, depth: Column) -> Column:
    return _clamped((lat + 90.0) / (F.lit(180.0) / _rows(depth)), _rows(depth))


def extent(depth: Column, x: Column, y: Column) -> dict[str, Column]:
    a = angle(depth)
    return {"min_lon": a * x - 180.0, "min_lat": a * y - 90.0, "max_lon": a * (x + 1) - 180.0, "max_lat": a * (y + 1) - 90.0}


def is_valid(depth: Column, x: Column, y: Column) -> Column:
    return (x >= 0) & (y >= 0) & (x < _columns(depth)) & (y < _rows(depth))


def range_of(depth: Column, min_lon: Column, min_lat: Column, max_lon: Column, max_lat: Column) -> dict[str, Column]:
    """Tile range of an extent: its upper sides go on to the nearest boundary, unclamped, below depth 0."""
    a = angle(depth)
    side = lambda v, low: half_up((v + low) / a).cast("int")
    low_x, high_x, low_y, high_y = tile_x(min_lon, depth), tile_x(max_lon, depth), tile_y(min_lat, depth), tile_y(max_lat, depth)
    deep = depth > 0
    return {
        "min_x": F.when(deep, F.least(low_x, side(min_lon, 180.0))).otherwise(low_x),
        "max_x": F.when(deep, F.greatest(high_x, side(max_lon, 180.0))).otherwise(high_x),
        "min_y": F.when(deep, F.least(low_y, side(min_lat, 90.0))).otherwise(low_y),
        "max_y": F.when(deep, F.greatest(high_y, side(max_lat, 90.0))).otherwise(high_y),
    }


def thresholds(spark: SparkSession, intensity: float = 4.0) -> DataFrame:
    """Per depth: tile size, sides between which a triangle may stay, deviation allowed and pixel wanted, in metres."""
    depths = spark.range(0, MAX_DEPTH + 1).select(F.col("id").cast("int").alias("depth"))
    d, size = F.col("depth"), F.col("tile_size")
    # The share of a tile's size that a triangle may deviate, and the factors of the least side.
    share = F.when(d < 5, 0.01).when(d <= 8, 0.015).when(d == 9, 0.02).when(d == 10, 0.03).when(d == 11, 0.04).when(d == 12, 0.05).when(d <= 15, 0.06).when(d == 16, 0.065).otherwise(0.07)
    least = F.when(d <= 10, 1.0).when(d <= 14, 1.25).when(d == 15, 1.125).when(d <= 17, 1.0).otherwise(0.75)
    return (
        depths.withColumn("tile_size", size_metres(d))
        .withColumn("max_side", size / 2.5 * F.when(d < 11, 0.2).otherwise(1.0))
        .withColumn("min_side", size * 0.1 / intensity * least)
        .withColumn("max_diff", size * share / intensity)
        .withColumn("pixel", size / float(SAMPLES))
    )


def depth_of_pixel(pixel: Column) -> Column:
    """One more than the first depth whose tiles are no larger than 256 pixels; 28 at most."""
    sizes = F.transform(F.sequence(F.lit(0), F.lit(MAX_DEPTH)), lambda d: F.struct(d.alias("d"), size_metres(d).alias("s")))
    fit = F.filter(sizes, lambda e: e["s"] <= pixel * float(SAMPLES))
    return F.least(F.coalesce(F.try_element_at(fit, F.lit(1))["d"] + 1, F.lit(MAX_DEPTH)), F.lit(MAX_DEPTH)).cast("int")


def children(x: Column, y: Column) -> Column:
    """The four tiles one depth below, as (x, y) structs."""
    return F.array(*(F.struct((x * 2 + i).alias("x"), (y * 2 + j).alias("y")) for i in (0, 1) for j in (0, 1)))


def neighbours(x: Column, y: Column) -> Column:
    """The eight tiles around one, as (x, y) structs; some may lie beyond the grid."""
    return F.array(*(F.struct((x + i).alias("x"), (y + j).alias("y")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j))


def plain_tile(lon: Column, lat: Column, depth: Column, from_top: bool = False) -> tuple[Column, Column]:
    """Column and row of a position without regard to the grid's ends; from_top counts rows from the north."""
    a = angle(depth)
    return F.floor((lon + 180.0) / a).cast("int"), F.floor((90.0 - lat if from_top else lat + 90.0) / a).cast("int")


def extent_from_top(depth: Column, x: Column, y: Column) -> dict[str, Column]:
    """Extent of a tile whose rows count from the north."""
    a = angle(depth)
    return {"min_lon": a * x - 180.0, "min_lat": F.lit(90.0) - a * (y + 1), "max_lon": a * (x + 1) - 180.0, "max_lat": F.lit(90.0) - a * y}


def mercator_extent(depth: Column, x: Column, y: Column) -> dict[str, Column]:
    """Extent in degrees of a Web Mercator tile (2^L x 2^L, rows from the north)."""
    n = F.pow(F.lit(2.0), depth)
    lat = lambda row: F.degrees(F.atan(F.sinh(F.lit(3.141592653589793) * (F.lit(1.0) - F.lit(2.0) * row / n))))
    return {"min_lon": x * (F.lit(360.0) / n) - 180.0, "min_lat": lat(y + 1), "max_lon": (x + 1) * (F.lit(360.0) / n) - 180.0, "max_lat": lat(y)}


def square_tile(lon: Column, lat: Column, level: Column) -> tuple[Column, Column]:
    """Column and row (from the north) of a position in the scheme of 2^L x 2^L tiles over the whole globe, clamped."""
    n = F.pow(F.lit(2.0), level)
    at = lambda share: F.least(F.floor(share * n), n - 1).cast("int")
    within = lambda v, end: F.greatest(F.lit(-end), F.least(F.lit(end), v))
    return at((within(lon, 180.0) + 180.0) / 360.0), at(F.lit(1.0) - (within(lat, 90.0) + 90.0) / 180.0)


def square_extent(level: Column, x: Column, y: Column) -> dict[str, Column]:
    """Extent of a tile of that scheme."""
    wide, high = F.lit(360.0) / F.pow(F.lit(2.0), level), F.lit(180.0) / F.pow(F.lit(2.0), level)
    return {"min_lon": wide * x - 180.0, "min_lat": F.lit(90.0) - high * (y + 1), "max_lon": wide * (x + 1) - 180.0, "max_lat": F.lit(90.0) - high * y}


def sweeps(depth: Column) -> Column:
    """Refinement sweeps of a depth: fixed values."""
    return F.when(depth.between(0, MAX_DEPTH), 15).otherwise(5)
