"""Queries of raster sampling and preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geodesy as G
from ..operators import rasters as Q
from ..operators import sampling as S
from ..sources import adapters as A

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rasters' rows straight from the vectors, one row each."""
    rows = S.numbered(A.table(spark, sf_dir, "embeddings"), "label", "vec_id", "row")
    return rows.select(F.col("label").alias("raster"), "row", F.transform("embedding", lambda e: e.cast("double") * 1000.0).alias("values"))


_HIT = """hit AS (SELECT p.id, p.lon, p.lat, r.raster, r.width, r.height, (r.max_lon - r.min_lon) / r.width * ((r.max_lat - r.min_lat) / r.height) AS area,
  (p.lon - r.min_lon) / (r.max_lon - r.min_lon) * r.width AS fx, (1.0::DOUBLE - (p.lat - r.min_lat) / (r.max_lat - r.min_lat)) * r.height AS fy
  FROM pts p JOIN ras r ON p.lon BETWEEN r.min_lon AND r.max_lon AND p.lat BETWEEN r.min_lat AND r.max_lat)"""  # fmt: skip
_AT = "greatest(0, least(floor({v})::INT + {k}, {n} - 1))"
_NEAREST = f"""{A.oracle('pts', 'cells', 'ras')}, {_HIT}, sampled AS (SELECT hit.id, hit.raster, area, c.z FROM hit JOIN cells c ON c.raster = hit.raster AND c.row = {_AT.format(v='fy', k=0, n='height')} AND c.col = {_AT.format(v='fx', k=0, n='width')})"""
_C = " ".join(f"JOIN cells c{i}{j} ON c{i}{j}.raster = hit.raster AND c{i}{j}.row = {_AT.format(v='fy', k=i, n='height')} AND c{i}{j}.col = {_AT.format(v='fx', k=j, n='width')}" for i in (0, 1) for j in (0, 1))
_BILINEAR = """sampled AS (SELECT hit.id, hit.raster, area, (c00.z * (1.0::DOUBLE - dx) + c01.z * dx) * (1.0::DOUBLE - dy) + (c10.z * (1.0::DOUBLE - dx) + c11.z * dx) * dy AS z FROM (SELECT *, fx - floor(fx) AS dx, fy - floor(fy) AS dy FROM hit) hit """ + _C + ")"
_BEST = "best AS (SELECT id, first(z ORDER BY area, raster) AS z FROM sampled GROUP BY id)"


@query(f"{_NEAREST}, {_BEST} SELECT pts.id, round(coalesce(z, 0.0::DOUBLE), 6) AS z FROM pts LEFT JOIN best USING (id)")
def priority_sample_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point's nearest cell in the finest raster that holds it."""
    p = A.points(spark, sf_dir)
    return S.by_priority(p, S.nearest(p, A.rasters(spark, sf_dir), _rows(spark, sf_dir))).select("id", F.round("z", 6).alias("z"))


@query(f"{A.oracle('pts', 'cells', 'ras')}, {_HIT}, {_BILINEAR}, {_BEST} SELECT pts.id, round(coalesce(z, 0.0::DOUBLE), 6) AS z FROM pts LEFT JOIN best USING (id)")
def priority_sample_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point's value between four cells of the finest raster that holds it."""
    p = A.points(spark, sf_dir)
    return S.by_priority(p, S.bilinear(p, A.rasters(spark, sf_dir), _rows(spark, sf_dir))).select("id", F.round("z", 6).alias("z"))


@query(f"{_NEAREST}, best AS (SELECT id, max(z) AS z FROM sampled GROUP BY id) SELECT pts.id, round(greatest(coalesce(z, 0.0::DOUBLE), 0.0::DOUBLE), 6) AS z FROM pts LEFT JOIN best USING (id)")
def higher_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point's highest nearest cell, at least 0."""
    p = A.points(spark, sf_dir)
    return S.highest(p, S.nearest(p, A.rasters(spark, sf_dir), _rows(spark, sf_dir))).select("id", F.round("z", 6).alias("z"))


@query(f"{A.oracle('ras')} SELECT min(min_lon) AS min_lon, min(min_lat) AS min_lat, max(max_lon) AS max_lon, max(max_lat) AS max_lat, count(*) AS n FROM ras")
def raster_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extent of all rasters."""
    return A.rasters(spark, sf_dir).agg(F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"), F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"), F.count("*").alias("n"))


@query(f"""{A.oracle('ras')} SELECT raster, round((max_lon - min_lon) * 0.017453292519943296::DOUBLE * 6378137.0::DOUBLE / sqrt(1.0::DOUBLE - 0.00669437999014::DOUBLE * pow(sin((min_lat + max_lat) / 2.0::DOUBLE * 0.017453292519943296::DOUBLE), 2)) / width, 6) AS px_x,
  round((max_lat - min_lat) * 0.017453292519943296::DOUBLE * 6378137.0::DOUBLE / sqrt(1.0::DOUBLE - 0.00669437999014::DOUBLE * pow(sin((min_lat + max_lat) / 2.0::DOUBLE * 0.017453292519943296::DOUBLE), 2)) / height, 6) AS px_y FROM ras""")  # fmt: skip
def pixel_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each raster's pixel size in metres, by the radius at its middle latitude on both axes."""
    radius = G.prime_vertical_radius((F.col("min_lat") + F.col("max_lat")) / 2.0)
    return A.rasters(spark, sf_dir).select("raster", F.round((F.col("max_lon") - F.col("min_lon")) * G.DEGREE * radius / F.col("width"), 6).alias("px_x"), F.round((F.col("max_lat") - F.col("min_lat")) * G.DEGREE * radius / F.col("height"), 6).alias("px_y"))


@query(f"{A.oracle('cells')} SELECT raster, row // 4 AS row, (col // 4)::INT AS col, z FROM cells WHERE row % 4 = 2 AND col % 4 = 2")
def downscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rasters at a quarter of their resolution."""
    return S.downscaled(A.raster_cells(spark, sf_dir), 4)


@query(f"""{A.oracle('ext')}, w AS (SELECT id, (1 + id * 7 % 12000)::INT AS width, (1 + id * 11 % 9000)::INT AS height FROM ext)
  SELECT id, i::INT AS i, j::INT AS j, greatest(i * 4096 - 40, 0)::INT AS x0, least((i + 1) * 4096 + 40, width)::INT AS x1, greatest(j * 4096 - 40, 0)::INT AS y0, least((j + 1) * 4096 + 40, height)::INT AS y1
  FROM w, unnest(range(0, ceil(width / 4096.0::DOUBLE)::BIGINT)) AS a(i), unnest(range(0, ceil(height / 4096.0::DOUBLE)::BIGINT)) AS b(j)""")  # fmt: skip
def split_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that rasters of many sizes are split into."""
    sizes = A.extents(spark, sf_dir).select("id", (1 + F.col("id") * 7 % 12000).cast("int").alias("width"), (1 + F.col("id") * 11 % 9000).cast("int").alias("height"))
    return S.windows(sizes).drop("width", "height")


@query(f"{A.oracle('cells')} SELECT a.raster, a.row, a.col::INT AS col, round(CASE WHEN a.z <= -200.0::DOUBLE THEN -200.0::DOUBLE ELSE a.z + coalesce(g.z, 0.0::DOUBLE) END, 6) AS z FROM cells a LEFT JOIN cells g ON g.raster = a.raster + 1 AND g.row = a.row AND g.col = a.col")
def geoid_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights of all cells over the geoid that the next raster stands for; -200 m and less is no data."""
    cells = A.raster_cells(spark, sf_dir)
    return S.with_geoid(cells, cells.withColumn("raster", F.col("raster") - 1), -200.0).withColumn("z", F.round("z", 6))


@query(f"""{A.oracle('cells', 'ras')}, pts AS (SELECT (x * 65536 + j * 256 + i) AS id, x, -180.0::DOUBLE + x * 180.0::DOUBLE + (i + 0.5::DOUBLE) * (180.0::DOUBLE / 256.0::DOUBLE) AS lon, -90.0::DOUBLE + (j + 0.5::DOUBLE) * (180.0::DOUBLE / 256.0::DOUBLE) AS lat FROM range(0, 2) AS a(x), range(0, 256) AS b(i), range(0, 256) AS c(j)), {_HIT}, {_BILINEAR}, {_BEST}
  SELECT 0 AS l, x::INT AS x, 0 AS y, count(*) AS n, count_if(coalesce(z, 0.0::DOUBLE) <> 0) AS hit, round(min(coalesce(z, 0.0::DOUBLE)), 3) AS low, round(max(coalesce(z, 0.0::DOUBLE)), 3) AS high, round(avg(coalesce(z, 0.0::DOUBLE)), 3) AS mean FROM pts LEFT JOIN best USING (id) GROUP BY x""")  # fmt: skip
def tile_raster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heights of the two tiles at depth 0, sampled 256 x 256 times each."""
    roots = spark.range(2).select(F.lit(0).alias("l"), F.col("id").cast("int").alias("x"), F.lit(0).alias("y"))
    z = F.col("z").cast("double")
    rows = Q.sampled_tiles(roots, A.rasters(spark, sf_dir), _rows(spark, sf_dir)).select("l", "x", "y", F.explode("elev").alias("z"))
    stats = rows.groupBy("l", "x", "y")
    return stats.agg(F.count("*").alias("n"), F.count_if(z != 0).alias("hit"), F.round(F.min(z), 3).alias("low"), F.round(F.max(z), 3).alias("high"), F.round(F.avg(z), 3).alias("mean"))


_CROP = (-100.0, -31.0, -40.5, 22.0)


@query(f"""{A.oracle('cells', 'ras')}, p AS (SELECT *, (max_lon - min_lon) / width AS px, (max_lat - min_lat) / height AS py FROM ras WHERE min_lon <= -40.5 AND max_lon >= -100 AND min_lat <= 22 AND max_lat >= -31),
  c AS (SELECT *, greatest(0, least(floor((-100.0::DOUBLE - min_lon) / px)::INT, width)) AS x0, greatest(0, least(ceil((-40.5::DOUBLE - min_lon) / px)::INT, width)) AS x1, greatest(0, least(floor((max_lat - 22.0::DOUBLE) / py)::INT, height)) AS y0, greatest(0, least(ceil((max_lat + 31.0::DOUBLE) / py)::INT, height)) AS y1 FROM p)
  SELECT raster, (row - y0)::INT AS row, count(*) AS n, round(sum(z), 3) AS total, round(min(min_lon + x0 * px), 6) AS west FROM cells JOIN c USING (raster) WHERE row >= y0 AND row < y1 AND col >= x0 AND col < x1 GROUP BY raster, row - y0""")  # fmt: skip
def cropped_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row sums of all rasters cut to a window, and their new western ends."""
    meta, rows = Q.cropped(A.rasters(spark, sf_dir), _rows(spark, sf_dir), _CROP)
    sums = rows.select("raster", "row", F.size("values").cast("long").alias("n"), F.round(F.aggregate("values", F.lit(0.0), lambda a, b: a + b), 3).alias("total"))
    return sums.join(meta.select("raster", F.round("min_lon", 6).alias("west")), "raster")


def _merc(lat: str) -> str:
    return f"(ln(tan(0.7853981633974483::DOUBLE + {lat} * 0.008726646259971648::DOUBLE)) * 6378137.0::DOUBLE)"


@query(f"""{A.oracle('cells', 'ras')}, w AS (SELECT *, max_lat - (o + 0.5::DOUBLE) / height * (max_lat - min_lat) AS lat FROM ras, unnest(range(0, height)) AS t(o)),
  s AS (SELECT raster, o, greatest(0, least(floor(({_merc('max_lat')} - {_merc('lat')}) / ({_merc('max_lat')} - {_merc('min_lat')}) * height)::INT, height - 1)) AS src FROM w)
  SELECT raster, o::INT AS row, round(sum(z), 3) AS total FROM s JOIN cells USING (raster) WHERE cells.row = CASE WHEN raster % 2 = 0 THEN src ELSE o END GROUP BY raster, o""")  # fmt: skip
def reprojected_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row sums of rasters of which every second one stands for Mercator rows, evenly spaced in latitude."""
    meta = A.rasters(spark, sf_dir).withColumn("crs", F.when(F.col("raster") % 2 == 0, 3857).otherwise(4326))
    _, rows = Q.reprojected(meta, _rows(spark, sf_dir))
    return rows.select("raster", "row", F.round(F.aggregate("values", F.lit(0.0), lambda a, b: a + b), 3).alias("total"))


@query(f"""{A.oracle('cells', 'ras')}, m AS (SELECT *, greatest(24, floor(width * 0.4::DOUBLE))::INT AS w, greatest(24, floor(height * 0.4::DOUBLE))::INT AS h FROM ras),
  g AS (SELECT raster, w, h, r::INT AS row, c::INT AS col, floor((r + 0.5::DOUBLE) * height / h)::INT AS sr, floor((c + 0.5::DOUBLE) * width / w)::INT AS sc FROM m, unnest(range(0, h)) AS a(r), unnest(range(0, w)) AS b(c))
  SELECT g.raster, g.row, count(*) AS n, round(sum(z), 3) AS total FROM g JOIN cells k ON k.raster = g.raster AND k.row = sr AND k.col = sc GROUP BY g.raster, g.row""")  # fmt: skip
def resized_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row sums of rasters at two fifths of their size."""
    _, rows = Q.resized(A.rasters(spark, sf_dir), _rows(spark, sf_dir), F.lit(0.4))
    return rows.select("raster", "row", F.size("values").cast("long").alias("n"), F.round(F.aggregate("values", F.lit(0.0), lambda a, b: a + b), 3).alias("total"))


@query(f"""{A.oracle('ras')}, d AS (SELECT depth, 180.0::DOUBLE / pow(2, depth) * 0.017453292519943296::DOUBLE * 6378137.0::DOUBLE / 256 AS pixel FROM range(0, 8) AS t(depth)),
  n AS (SELECT raster, least((max_lon - min_lon) / width, (max_lat - min_lat) / height) * 0.017453292519943296::DOUBLE * 6378137.0::DOUBLE / sqrt(1.0::DOUBLE - 0.00669437999014::DOUBLE * pow(sin((min_lat + max_lat) / 2.0::DOUBLE * 0.017453292519943296::DOUBLE), 2)) AS native FROM ras)
  SELECT raster, depth::INT AS depth, round(CASE WHEN pixel <= native THEN 1.0::DOUBLE ELSE native / pixel END, 9) AS share FROM n, d""")  # fmt: skip
def resize_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each raster's size that each depth reads."""
    return Q.resize_plan(spark, A.rasters(spark, sf_dir), 7).withColumn("share", F.round("share", 9))


@query(f"""{A.oracle('cells', 'ras')}, pts AS (SELECT raster * 1000000 + r * 1000 + c AS id, raster AS own, -180.0::DOUBLE + raster * 30.0::DOUBLE + (c + 0.5::DOUBLE) * 60.0::DOUBLE / width AS lon, 60.0::DOUBLE - (r + 0.5::DOUBLE) * 120.0::DOUBLE / height AS lat, r, c FROM ras, unnest(range(0, height)) AS a(r), unnest(range(0, 64)) AS b(c) WHERE raster = 3), {_HIT.replace('JOIN ras r ON', 'JOIN ras r ON r.raster IN (2, 4) AND')}, {_BILINEAR}, {_BEST},
  g AS (SELECT k.raster, k.row, k.col, k.z + coalesce(best.z, 0.0::DOUBLE) AS z FROM cells k JOIN pts ON k.raster = own AND k.row = r AND k.col = c LEFT JOIN best USING (id))
  SELECT raster, row, round(sum(z), 3) AS total FROM g GROUP BY raster, row""")  # fmt: skip
def geoid_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row sums of raster 3 over a geoid that stands on the grids of its neighbours."""
    meta, rows = A.rasters(spark, sf_dir), _rows(spark, sf_dir)
    geoid = meta.where("raster IN (2, 4)"), rows.where("raster IN (2, 4)")
    _, out = Q.standardised(meta.where("raster = 3"), rows.where("raster = 3"), geoid)
    return out.select("raster", "row", F.round(F.aggregate("values", F.lit(0.0), lambda a, b: a + b), 3).alias("total"))


_NODATA = """sampled AS (SELECT hit.id, hit.raster, area, CASE WHEN c00.z <= -200 OR c00.z = 0.125::DOUBLE THEN -200.0::DOUBLE WHEN least(c01.z, c10.z, c11.z) <= -200 THEN c00.z ELSE (c00.z * (1.0::DOUBLE - dx) + c01.z * dx) * (1.0::DOUBLE - dy) + (c10.z * (1.0::DOUBLE - dx) + c11.z * dx) * dy END AS z FROM (SELECT *, fx - floor(fx) AS dx, fy - floor(fy) AS dy FROM hit) hit """ + _C + ")"


@query(f"{A.oracle('pts', 'cells', 'ras')}, {_HIT}, {_NODATA}, {_BEST} SELECT pts.id, round(z, 6) AS z, best.id IS NOT NULL AS hit FROM pts LEFT JOIN best USING (id)")
def samples_beside_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point's sample and whether a raster holds it, where -200 m and less is no data."""
    p = A.points(spark, sf_dir)
    meta = A.rasters(spark, sf_dir).withColumn("no_data", F.lit(0.125))
    got = S.with_hits(p, S.bilinear(p, meta, _rows(spark, sf_dir), -200.0))
    return got.select("id", F.round("z", 6).alias("z"), "hit")


@query("""WITH t AS (SELECT event_id AS id, (event_id * 7919 % 16)::INT AS x, (event_id * 104729 % 8)::INT AS y, (event_id * 31 % 300) / 10.0::DOUBLE - 3.0::DOUBLE AS a, (event_id * 17 % 260) / 10.0::DOUBLE - 1.0::DOUBLE AS b FROM events),
  p AS (SELECT *, x * 22.5::DOUBLE - 180 + a AS lon, y * 22.5::DOUBLE - 90 + b AS lat, x * 22.5::DOUBLE - 180 AS w, y * 22.5::DOUBLE - 90 AS s FROM t)
  SELECT id, CASE WHEN lon < w OR lon > w + 22.5 THEN -1 ELSE least(floor((lon - w) / (22.5::DOUBLE / 256)), 255) END::INT AS col, CASE WHEN lat < s OR lat > s + 22.5 THEN -1 ELSE least(floor((lat - s) / (22.5::DOUBLE / 256)), 255) END::INT AS row FROM p""")
def tile_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pixels of positions in and beside tiles at depth 3."""
    i = F.col("event_id")
    t = A.table(spark, sf_dir, "events").select(i.alias("id"), F.lit(3).alias("l"), (i * 7919 % 16).cast("int").alias("x"), (i * 104729 % 8).cast("int").alias("y"), ((i * 31 % 300) / 10.0 - 3.0).alias("a"), ((i * 17 % 260) / 10.0 - 1.0).alias("b"))
    lon, lat = F.col("x") * 22.5 - 180 + F.col("a"), F.col("y") * 22.5 - 90 + F.col("b")
    col, row = Q.pixel_of(lon, lat)
    return t.select("id", col.alias("col"), row.alias("row"))
