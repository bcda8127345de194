"""Preparing rasters: crop, reproject, align, resize, and what is asked of a tile's own raster.

Rasters are metadata rows (raster, width, height, extent, perhaps crs and no_data) and rows (raster, row, values). A raster's
columns stay together in a row, so turning, cutting and resizing are one join of rows and expressions within them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geodesy as G
from ..functions import tiles as T
from . import sampling as S

LEAST_SIDE = 24
EXTENT = ["min_lon", "min_lat", "max_lon", "max_lat"]


def same_crs(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(4326)) == F.coalesce(b, F.lit(4326))


def to_degrees(x: Column, y: Column, meta: str = "") -> tuple[Column, Column]:
    """Longitude and latitude of a raster's column and row (fractions allowed; 0, 0 is its north-west corner)."""
    col = lambda c: F.col(f"{meta}{c}")
    lon = col("min_lon") + x / col("width") * (col("max_lon") - col("min_lon"))
    return lon, col("max_lat") - y / col("height") * (col("max_lat") - col("min_lat"))


def corner_extent(corners: Column) -> dict[str, Column]:
    """The extent of corner positions (lon, lat structs)."""
    of = lambda pick, c: pick(F.transform(corners, lambda p: p[c]))
    return {"min_lon": of(F.array_min, "lon"), "min_lat": of(F.array_min, "lat"), "max_lon": of(F.array_max, "lon"), "max_lat": of(F.array_max, "lat")}


def touching(rasters: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    """The rasters that touch a window (west, south, east, north); the others need not be read."""
    w, s, e, n = window
    return rasters.where((F.col("min_lon") <= e) & (F.col("max_lon") >= w) & (F.col("min_lat") <= n) & (F.col("max_lat") >= s))


def cropped(rasters: DataFrame, cells: DataFrame, window: tuple[float, float, float, float]) -> tuple[DataFrame, DataFrame]:
    """Rasters and rows cut to the whole pixels that touch a window; rasters beside it go."""
    w, s, e, n = window
    px, py = (F.col("max_lon") - F.col("min_lon")) / F.col("width"), (F.col("max_lat") - F.col("min_lat")) / F.col("height")
    clip = lambda v, end: F.greatest(F.lit(0), F.least(v, F.col(end))).cast("int")
    meta = touching(rasters, window).withColumns({"__px": px, "__py": py})
    meta = meta.withColumns(
        {
            "__x0": clip(F.floor((w - F.col("min_lon")) / F.col("__px")), "width"),
            "__x1": clip(F.ceil((e - F.col("min_lon")) / F.col("__px")), "width"),
            "__y0": clip(F.floor((F.col("max_lat") - n) / F.col("__py")), "height"),
            "__y1": clip(F.ceil((F.col("max_lat") - s) / F.col("__py")), "height"),
        }
    ).where("__x1 > __x0 AND __y1 > __y0")
    place = meta.select(F.col("raster").alias("__r"), "__x0", "__x1", "__y0", "__y1")
    rows = cells.join(place, (F.col("raster") == F.col("__r")) & (F.col("row") >= F.col("__y0")) & (F.col("row") < F.col("__y1")))
    rows = rows.select("raster", (F.col("row") - F.col("__y0")).alias("row"), F.slice("values", F.col("__x0") + 1, F.col("__x1") - F.col("__x0")).alias("values"))
    west, north = F.col("min_lon") + F.col("__x0") * F.col("__px"), F.col("max_lat") - F.col("__y0") * F.col("__py")
    size = {"width": F.col("__x1") - F.col("__x0"), "height": F.col("__y1") - F.col("__y0")}
    ends = {"min_lon": west, "max_lon": F.col("min_lon") + F.col("__x1") * F.col("__px"), "max_lat": north, "min_lat": F.col("max_lat") - F.col("__y1") * F.col("__py")}
    return meta.withColumns({**size, **ends}).select(*rasters.columns), rows


def _each_row(rasters: DataFrame, height: Column) -> DataFrame:
    return rasters.withColumn("__row", F.explode(F.sequence(F.lit(0), height - 1)))


def reprojected(rasters: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rasters and rows with rows evenly spaced in latitude: of Mercator rasters each row takes the nearest one, at the same
    size and extent; others stay as they are."""
    turned = rasters.where("crs = 3857")
    y = lambda lat: G.mercator(F.lit(0.0), lat)[1]
    lat = F.col("max_lat") - (F.col("__row") + 0.5) / F.col("height") * (F.col("max_lat") - F.col("min_lat"))
    share = (y(F.col("max_lat")) - y(lat)) / (y(F.col("max_lat")) - y(F.col("min_lat")))
    source = F.greatest(F.lit(0), F.least(F.floor(share * F.col("height")), F.col("height") - 1)).cast("int")
    wanted = _each_row(turned, F.col("height")).select(F.col("raster").alias("__r"), "__row", source.alias("__source"))
    rows = cells.join(wanted, (F.col("raster") == F.col("__r")) & (F.col("row") == F.col("__source"))).select("raster", F.col("__row").alias("row"), "values")
    kept = cells.join(turned.select("raster"), "raster", "left_anti").select("raster", "row", "values")
    return rasters.withColumn("crs", F.lit(4326)), kept.unionByName(rows)


def cell_centres(rasters: DataFrame) -> DataFrame:
    """One row (id, raster, row, col, lon, lat) for each cell of each raster."""
    at = _each_row(rasters, F.col("height")).withColumn("__col", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    lon, lat = to_degrees(F.col("__col") + 0.5, F.col("__row") + 0.5)
    return at.select(F.struct("raster", F.col("__row").alias("row"), F.col("__col").alias("col")).alias("id"), "raster", F.col("__row").alias("row"), F.col("__col").alias("col"), lon.alias("lon"), lat.alias("lat"))


def aligned(geoid: DataFrame, geoid_cells: DataFrame, rasters: DataFrame) -> DataFrame:
    """The geoid's height, bilinear, in each cell (raster, row, col, z) of each raster; cells beside the geoid are left out."""
    at = cell_centres(rasters)
    sampled = S.bilinear(at, geoid, geoid_cells)
    best = sampled.groupBy("id").agg(F.min_by("z", F.struct("e_area", "e_raster")).alias("z"))
    return best.select("id.raster", "id.row", "id.col", "z")


def resized(rasters: DataFrame, cells: DataFrame, share: Column) -> tuple[DataFrame, DataFrame]:
    """Rasters and rows at a share of their size, at least LEAST_SIDE pixels a side, by the nearest cell."""
    side = lambda c: F.greatest(F.lit(LEAST_SIDE), F.floor(F.col(c) * share)).cast("int")
    meta = rasters.withColumns({"__w": side("width"), "__h": side("height")})
    source = F.floor((F.col("__row") + 0.5) * F.col("height") / F.col("__h")).cast("int")
    wanted = _each_row(meta, F.col("__h")).select(F.col("raster").alias("__r"), "__row", source.alias("__source"), "__w", F.col("width").alias("__width"))
    rows = cells.join(wanted, (F.col("raster") == F.col("__r")) & (F.col("row") == F.col("__source")))
    picked = F.transform(F.sequence(F.lit(0), F.col("__w") - 1), lambda c: F.get("values", F.floor((c + 0.5) * F.col("__width") / F.col("__w")).cast("int")))
    return meta.withColumns({"width": F.col("__w"), "height": F.col("__h")}).select(*rasters.columns), rows.select("raster", F.col("__row").alias("row"), picked.alias("values"))


def pixel_metres() -> Column:
    """A raster's smaller pixel side in metres, by the radius at its middle latitude on both axes."""
    radius = G.prime_vertical_radius((F.col("min_lat") + F.col("max_lat")) / 2.0) * G.DEGREE
    return F.least((F.col("max_lon") - F.col("min_lon")) * radius / F.col("width"), (F.col("max_lat") - F.col("min_lat")) * radius / F.col("height"))


def resize_plan(spark: SparkSession, rasters: DataFrame, max_depth: int, intensity: float = 4.0) -> DataFrame:
    """raster, depth and the share of its size to use there, of each raster on its own: 1 where the raster is coarser than
    the depth asks for."""
    depths = T.thresholds(spark, intensity).where(F.col("depth") <= max_depth).select("depth", "pixel")
    pixels = rasters.select("raster", pixel_metres().alias("native"))
    each = pixels.crossJoin(F.broadcast(depths))  # 29 depths at most
    return each.select("raster", "depth", F.when(F.col("pixel") <= F.col("native"), 1.0).otherwise(F.col("native") / F.col("pixel")).alias("share"))


def at_depth(plan: DataFrame, rasters: DataFrame, cells: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """The rasters and rows that a depth reads: those that the plan resizes at their smaller size, the others as they are."""
    own = plan.where(F.col("depth") == depth).select(F.col("raster").alias("__p"), F.col("share").alias("__share"))
    meta = rasters.join(own, F.col("raster") == F.col("__p"), "left").withColumn("__share", F.coalesce("__share", F.lit(1.0)))
    small, small_rows = resized(meta.where("__share < 1"), cells, F.col("__share"))
    whole = meta.where("__share >= 1").select(*rasters.columns)
    return whole.unionByName(small.select(*rasters.columns)), cells.join(whole.select("raster"), "raster", "left_semi").select("raster", "row", "values").unionByName(small_rows)


def standardised(rasters: DataFrame, cells: DataFrame, geoid: tuple[DataFrame, DataFrame] | None = None, no_data: float = S.NO_DATA) -> tuple[DataFrame, DataFrame]:
    """Rasters in degrees, heights over the geoid added if one is given; cells without data have no_data."""
    if "crs" in rasters.columns:
        rasters, cells = reprojected(rasters, cells)
    if "no_data" in rasters.columns:
        none = rasters.select(F.col("raster").alias("__r"), F.col("no_data").alias("__none"))
        clean = lambda z: F.when(z.isNull() | F.isnan(z) | (z <= no_data) | F.coalesce(z == F.col("__none"), F.lit(False)), no_data).otherwise(z)
        cells = cells.join(none, F.col("raster") == F.col("__r")).select("raster", "row", F.transform("values", clean).alias("values"))
        rasters = rasters.withColumn("no_data", F.lit(no_data))
    if geoid is None:
        return rasters, cells
    flat = cells.select("raster", "row", F.posexplode("values").alias("col", "z"))
    return rasters, S.rows_of(S.with_geoid(flat, aligned(*geoid, rasters), no_data))


# Tiles sampled block by block


def sampled_tiles(tiles: DataFrame, rasters: DataFrame, cells: DataFrame, samples: int = 256, halo: int = 0, no_data: float = S.NO_DATA) -> DataFrame:
    """Heights (l, x, y, elev) of tiles (l, x, y): samples x samples pixel centres and halo more around them, rows from the south,
    as ``sampling.bilinear`` and ``sampling.by_priority`` give them. Beyond the date line the globe goes on; beyond a pole the last row does.

    Blocks go to the tiles that they touch, and each tile is sampled by itself from its own: what is exchanged is the
    rasters' blocks, not a row for each sample. Rasters should be about as fine as the tiles (``at_depth``), so that few blocks touch a tile.
    """
    levels = [r[0] for r in tiles.select("l").distinct().limit(T.MAX_DEPTH + 1).collect()]
    return sampled(tiles, placed_blocks(rasters, cells, levels, samples, halo), samples, halo, no_data)


def placed_blocks(rasters: DataFrame, cells: DataFrame, levels: list[int], samples: int = 256, halo: int = 0) -> DataFrame:
    """The blocks of rasters with the tiles (l, x, y) of these depths that touch them or come near by the halo."""
    size = S.BLOCK
    crs = F.col("crs") if "crs" in rasters.columns else F.lit(4326)
    none = F.col("no_data") if "no_data" in rasters.columns else F.lit(None).cast("double")
    meta = rasters.select(F.col("raster").alias("__m"), "width", "height", *EXTENT, S.pixel_area().alias("area"), F.coalesce(crs, F.lit(4326)).alias("crs"), none.alias("no_data"))
    b = S.blocks(cells, size).join(meta, F.col("raster") == F.col("__m")).drop("__m")
    part = lambda k, n, step: F.least(F.lit(1.0), (F.col(k) + step) * float(size) / F.col(n))
    (x0, x1), (y0, y1) = ((part(k, n, 0), part(k, n, 1)) for k, n in (("bx", "width"), ("by", "height")))
    y = lambda lat: G.mercator(F.lit(0.0), lat)[1]
    west, east = (F.col("min_lon") + s * (F.col("max_lon") - F.col("min_lon")) for s in (x0, x1))
    flat = lambda s: F.col("max_lat") - s * (F.col("max_lat") - F.col("min_lat"))
    bent = lambda s: G.from_mercator(F.lit(0.0), y(F.col("max_lat")) - s * (y(F.col("max_lat")) - y(F.col("min_lat"))))[1]
    lat = lambda s: F.when(F.col("crs") == 3857, bent(s)).otherwise(flat(s))
    placed = b.withColumns({"__w": west, "__e": east, "__n": lat(y0), "__s": lat(y1)})
    each = placed.withColumn("l", F.explode(F.array(*map(F.lit, levels)))) if levels else placed.withColumn("l", F.lit(0)).limit(0)
    d, margin = F.col("l"), T.angle(F.col("l")) / float(samples) * (halo + 1)
    last = F.pow(F.lit(2), d + 1).cast("int") - 1
    across = F.sequence(T.tile_x(F.col("__w") - margin, d), T.tile_x(F.col("__e") + margin, d))
    around = F.concat(across, F.when(F.col("__e") + margin >= 180.0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")), F.when(F.col("__w") - margin <= -180.0, F.array(last)).otherwise(F.array().cast("array<int>")))
    each = each.withColumn("x", F.explode(F.array_distinct(around))).withColumn("y", F.explode(F.sequence(T.tile_y(F.col("__s") - margin, d), T.tile_y(F.col("__n") + margin, d))))
    number = next(f.dataType for f in rasters.schema if f.name == "raster").typeName() in ("integer", "long", "short", "byte")
    rank = F.lpad(F.col("raster").cast("string"), 20, "0") if number else F.col("raster").cast("string")  # in the order of rasters
    return each.select("l", "x", "y", "area", rank.alias("raster"), "by", "bx", "width", "height", *EXTENT, "crs", "no_data", F.flatten("data").alias("data"), F.size(F.get("data", F.lit(0))).alias("wide"))


def sampled(tiles: DataFrame, blocks: DataFrame, samples: int = 256, halo: int = 0, no_data: float = S.NO_DATA) -> DataFrame:
    """Heights of tiles from the blocks placed at them."""
    size = S.BLOCK

    def sample(wanted: pa.Table, found: pa.Table) -> pa.Table:
        if not len(wanted):
            return wanted.select(["l", "x", "y"]).append_column("elev", pa.array([], pa.list_(pa.float32())))
        l, tx, ty = (wanted.column(c)[0].as_py() for c in ("l", "x", "y"))
        angle, n = 180.0 / 2**l, samples + 2 * halo
        at = (np.arange(-halo, samples + halo) + 0.5) * (angle / samples)
        lon = (angle * tx - 180.0 + at + 180.0) % 360.0 - 180.0 if halo else angle * tx - 180.0 + at
        half = angle / samples / 2
        lats = np.clip(angle * ty - 90.0 + at, -90.0 + half, 90.0 - half) if halo else angle * ty - 90.0 + at
        z, known = np.zeros((n, n), np.float32), np.zeros((n, n), bool)
        about = found.drop(["data"]).to_pylist()
        for k in sorted(range(len(about)), key=lambda i: (about[i]["area"], about[i]["raster"])):
            r = about[k]
            data = found.column("data")[k].values.to_numpy(zero_copy_only=False).astype(float).reshape(-1, r["wide"])
            inside = lambda v, low, high: (v >= low) & (v <= high)
            fx = (lon - r["min_lon"]) / (r["max_lon"] - r["min_lon"]) * r["width"]
            if r["crs"] == 3857:
                m = lambda v: np.arcsinh(np.tan(np.radians(v)))
                fy = (1.0 - (m(lats) - m(r["min_lat"])) / (m(r["max_lat"]) - m(r["min_lat"]))) * r["height"]
            else:
                fy = (1.0 - (lats - r["min_lat"]) / (r["max_lat"] - r["min_lat"])) * r["height"]
            cx, cy = np.clip(np.floor(fx), 0, r["width"] - 1).astype(int), np.clip(np.floor(fy), 0, r["height"] - 1).astype(int)
            i = np.flatnonzero(inside(lon, r["min_lon"], r["max_lon"]) & (cx // size == r["bx"]))
            j = np.flatnonzero(inside(lats, r["min_lat"], r["max_lat"]) & (cy // size == r["by"]))
            if not len(i) or not len(j):
                continue
            near = lambda c, step, end, block: np.minimum(c + step, end - 1) - block * size
            rows_, cols = [near(cy[j], s, r["height"], r["by"]) for s in (0, 1)], [near(cx[i], s, r["width"], r["bx"]) for s in (0, 1)]
            a, b_, c, e = (data[np.ix_(p, q)] for p in rows_ for q in cols)
            dx, dy = (fx[i] - np.floor(fx[i]))[None, :], (fy[j] - np.floor(fy[j]))[:, None]
            hole = lambda v: np.isnan(v) | (v <= no_data) | (v == r["no_data"] if r["no_data"] is not None else False)  # noqa: E731, B023
            mixed = (a * (1 - dx) + b_ * dx) * (1 - dy) + (c * (1 - dx) + e * dx) * dy
            got = np.where(hole(a), no_data, np.where(hole(b_) | hole(c) | hole(e), a, mixed))
            here = np.ix_(j, i)
            z[here] = np.where(known[here], z[here], got)
            known[here] = True
        flat_z = pa.ListArray.from_arrays(pa.array([0, n * n], pa.int32()), pa.array(z.ravel()))
        return pa.table([pa.array([l], pa.int32()), pa.array([tx], pa.int32()), pa.array([ty], pa.int32()), flat_z], ["l", "x", "y", "elev"])

    keys = ["l", "x", "y"]
    whole = tiles.select(*(F.col(k).cast("int").alias(k) for k in keys)).distinct()
    return whole.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(sample, "l int, x int, y int, elev array<float>")


# A tile's own raster: samples x samples heights, row 0 in the south, as one array of floats


def tile_arrays(samples: DataFrame) -> DataFrame:
    """Samples (l, x, y, i, j, z) as one row (l, x, y, elev) a tile, rows from the south."""
    ordered = F.array_sort(F.collect_list(F.struct("j", "i", "z")))  # a tile's samples
    return samples.groupBy("l", "x", "y").agg(F.transform(ordered, lambda s: s["z"].cast("float")).alias("elev"))


def pixel_of(lon: Column, lat: Column, samples: int = 256) -> tuple[Column, Column]:
    """Column and row of a position in the raster of the tile of columns l, x, y; -1 beyond it, and the last one on its far ends."""
    box, step = T.extent(F.col("l"), F.col("x"), F.col("y")), T.angle(F.col("l")) / float(samples)
    at = lambda v, low, high: F.when((v < low) | (v > high), -1).otherwise(F.least(F.floor((v - low) / step), F.lit(samples - 1))).cast("int")
    return at(lon, box["min_lon"], box["max_lon"]), at(lat, box["min_lat"], box["max_lat"])


def pixel_degrees(col: Column, row: Column, samples: int = 256) -> tuple[Column, Column]:
    """The south-western corner of a pixel of that raster."""
    box, step = T.extent(F.col("l"), F.col("x"), F.col("y")), T.angle(F.col("l")) / float(samples)
    return box["min_lon"] + col * step, box["min_lat"] + row * step


def tile_height(lon: Column, lat: Column, samples: int = 256) -> Column:
    """Height at a position in the raster (column elev) of its tile, between four pixels, in single precision; the last
    pixels but one are the farthest first ones."""
    box, step = T.extent(F.col("l"), F.col("x"), F.col("y")), T.angle(F.col("l")) / float(samples)
    fx, fy = (lon - box["min_lon"]) / step, (lat - box["min_lat"]) / step
    first = lambda v: F.greatest(F.lit(0), F.least(F.floor(v), F.lit(samples - 2))).cast("int")
    i, j = first(fx), first(fy)
    dx, dy = (fx - i).cast("float"), (fy - j).cast("float")
    at = lambda a, b: F.get("elev", (j + b) * samples + i + a)
    one = F.lit(1.0).cast("float")
    low, high = at(0, 0) * (one - dx) + at(1, 0) * dx, at(0, 1) * (one - dx) + at(1, 1) * dx
    return low * (one - dy) + high * dy


def raster_triangle(samples: int = 256) -> Column:
    """The columns and rows of a triangle's corners (x0, y0 .. y2) in its tile's raster."""
    corners = (pixel_of(F.col(f"x{k}_"), F.col(f"y{k}_"), samples) for k in range(3))
    return F.array(*(F.struct(c.alias("col"), r.alias("row")) for c, r in corners))


def resampled(vertices: DataFrame, arrays: DataFrame, depth: int, samples: int = 256) -> DataFrame:
    """Vertices (id, lon, lat, z) with the height of the tile at depth that holds each; z stays where there is no such tile."""
    d = F.lit(depth)
    at = vertices.withColumns({"l": d, "x": T.tile_x(F.col("lon"), d), "y": T.tile_y(F.col("lat"), d)})
    both = at.join(arrays, ["l", "x", "y"], "left")
    return both.withColumn("z", F.coalesce(tile_height(F.col("lon"), F.col("lat"), samples).cast("double"), F.col("z"))).select(*vertices.columns)
