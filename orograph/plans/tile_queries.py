"""Queries of tile algebra, ranges and spatial joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tiles as T
from ..operators import ranges as R
from ..operators import spatial
from ..sources import adapters as A

QUERIES, ORACLE = {}, {}
DEGREE, RADIUS = "0.017453292519943296::DOUBLE", "6378137.0::DOUBLE"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _x(lon: str, d: int) -> str:
    return f"greatest(0, least(floor(({lon} + 180.0::DOUBLE) / (360.0::DOUBLE / {1 << (d + 1)}))::BIGINT, {(1 << (d + 1)) - 1}))::INT"


def _y(lat: str, d: int) -> str:
    return f"greatest(0, least(floor(({lat} + 90.0::DOUBLE) / (180.0::DOUBLE / {1 << d}))::BIGINT, {(1 << d) - 1}))::INT"


def _range(d: int) -> str:
    a = f"(180.0::DOUBLE / {1 << d})"
    side = lambda v, low: f"floor(({v} + {low}::DOUBLE) / {a} + 0.5::DOUBLE)::INT"
    return f"least({_x('min_lon', d)}, {side('min_lon', '180.0')}) AS min_x, greatest({_x('max_lon', d)}, {side('max_lon', '180.0')}) AS max_x, least({_y('min_lat', d)}, {side('min_lat', '90.0')}) AS min_y, greatest({_y('max_lat', d)}, {side('max_lat', '90.0')}) AS max_y"


@query(f"""{A.oracle('pts')} SELECT 4 AS l, {_x('lon', 4)} AS x, {_y('lat', 4)} AS y, count(*) AS n, min(h) AS min_h, max(h) AS max_h, round(sum(h), 4) AS sum_h,
  11.25::DOUBLE * {_x('lon', 4)} - 180.0::DOUBLE AS min_lon, 11.25::DOUBLE * {_y('lat', 4)} - 90.0::DOUBLE AS min_lat FROM pts GROUP BY 2, 3""")  # fmt: skip
def tile_point_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and heights of the points of each tile at depth 4, with the tile's lower corner."""
    d = F.lit(4)
    p = A.points(spark, sf_dir).groupBy(d.alias("l"), T.tile_x(F.col("lon"), d).alias("x"), T.tile_y(F.col("lat"), d).alias("y"))
    stats = p.agg(F.count("*").alias("n"), F.min("h").alias("min_h"), F.max("h").alias("max_h"), F.round(F.sum("h"), 4).alias("sum_h"))
    box = T.extent(F.col("l"), F.col("x"), F.col("y"))
    return stats.withColumns({k: box[k] for k in ("min_lon", "min_lat")})


@query(f"""{A.oracle('ext')}, r AS (SELECT {_range(6)} FROM ext), e AS (SELECT greatest(min_x - 1, 0) AS min_x, max_x + 1 AS max_x, greatest(min_y - 1, 0) AS min_y, max_y + 1 AS max_y FROM r)
  SELECT DISTINCT 6 AS depth, x::INT AS x, y::INT AS y FROM e, unnest(range(min_x, max_x + 1)) AS a(x), unnest(range(min_y, max_y + 1)) AS b(y) WHERE x < 128 AND y < 64""")  # fmt: skip
def tile_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct tiles at depth 6 that cover all extents with a margin of one tile."""
    return R.union(R.expanded(R.of_extents(A.extents(spark, sf_dir), F.lit(6))).select("depth", *R.BOUNDS))


@query(f"""{A.oracle('ext')}, s AS (SELECT d::INT AS d, 180.0::DOUBLE / pow(2.0::DOUBLE, d) * {DEGREE} * {RADIUS} AS size FROM range(0, 29) AS t(d))
  SELECT pixel, least(coalesce(min(d) + 1, 28), 28)::INT AS depth, any_value(n) AS n FROM (SELECT pixel, count(*) AS n FROM ext GROUP BY pixel) LEFT JOIN s ON size <= pixel * 256.0::DOUBLE GROUP BY pixel""")  # fmt: skip
def max_depth_by_pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deepest level that each pixel size supports."""
    return A.extents(spark, sf_dir).groupBy("pixel").agg(F.count("*").alias("n")).select("pixel", T.depth_of_pixel(F.col("pixel")).alias("depth"), "n")


@query(f"""WITH s AS (SELECT d::INT AS depth, 180.0::DOUBLE / pow(2.0::DOUBLE, d) * {DEGREE} * {RADIUS} AS size FROM range(0, 29) AS t(d))
  SELECT depth, round(size, 6) AS tile_size, round(size / 2.5::DOUBLE * CASE WHEN depth < 11 THEN 0.2::DOUBLE ELSE 1.0::DOUBLE END, 6) AS max_side,
   round(size * 0.1::DOUBLE / 4.0::DOUBLE * CASE WHEN depth <= 10 THEN 1.0 WHEN depth <= 14 THEN 1.25 WHEN depth = 15 THEN 1.125 WHEN depth <= 17 THEN 1.0 ELSE 0.75 END::DOUBLE, 6) AS min_side,
   round(size * CASE WHEN depth < 5 THEN 0.01 WHEN depth <= 8 THEN 0.015 WHEN depth = 9 THEN 0.02 WHEN depth = 10 THEN 0.03 WHEN depth = 11 THEN 0.04 WHEN depth = 12 THEN 0.05 WHEN depth <= 15 THEN 0.06 WHEN depth = 16 THEN 0.065 ELSE 0.07 END::DOUBLE / 4.0::DOUBLE, 6) AS max_diff,
   round(size / 256.0::DOUBLE, 6) AS pixel FROM s""")  # fmt: skip
def depth_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refinement thresholds of every depth."""
    t = T.thresholds(spark)
    return t.select("depth", *(F.round(c, 6).alias(c) for c in t.columns[1:]))


@query(f"""{A.oracle('ext')}, r AS (SELECT id, {_range(9)} FROM ext), c AS (SELECT *, ceil((max_x - min_x + 1) / 16.0::DOUBLE)::INT AS nx, ceil((max_y - min_y + 1) / 16.0::DOUBLE)::INT AS ny FROM r)
  SELECT id, 9 AS depth, (min_x + trunc(i * ((max_x - min_x + 1) / nx::DOUBLE)))::INT AS min_x, (min_x + trunc((i + 1) * ((max_x - min_x + 1) / nx::DOUBLE)) - 1)::INT AS max_x,
   (min_y + trunc(j * ((max_y - min_y + 1) / ny::DOUBLE)))::INT AS min_y, (min_y + trunc((j + 1) * ((max_y - min_y + 1) / ny::DOUBLE)) - 1)::INT AS max_y
  FROM c, unnest(range(0, nx)) AS a(i), unnest(range(0, ny)) AS b(j)""")  # fmt: skip
def mosaic_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of 16 x 16 tiles at most that each extent's range at depth 9 is worked in."""
    return R.blocks(R.of_extents(A.extents(spark, sf_dir), F.lit(9)).select("id", "depth", *R.BOUNDS))


_CORNERS = "(({b}.min_x BETWEEN {a}.min_x AND {a}.max_x AND {b}.min_y BETWEEN {a}.min_y AND {a}.max_y)::INT + ({b}.max_x BETWEEN {a}.min_x AND {a}.max_x AND {b}.min_y BETWEEN {a}.min_y AND {a}.max_y)::INT + ({b}.min_x BETWEEN {a}.min_x AND {a}.max_x AND {b}.max_y BETWEEN {a}.min_y AND {a}.max_y)::INT + ({b}.max_x BETWEEN {a}.min_x AND {a}.max_x AND {b}.max_y BETWEEN {a}.min_y AND {a}.max_y)::INT)"


@query(f"""{A.oracle('ext')}, r AS (SELECT id, {_range(5)} FROM ext), p AS (SELECT a.id, {_CORNERS.format(a='a', b='b')} AS ab, {_CORNERS.format(a='b', b='a')} AS ba,
   (a.max_x < b.min_x OR b.max_x < a.min_x OR a.max_y < b.min_y OR b.max_y < a.min_y) AS apart, (a.max_x + 1 = b.min_x OR b.max_x + 1 = a.min_x) AS tx, (a.max_y + 1 = b.min_y OR b.max_y + 1 = a.min_y) AS ty,
   (a.min_x = b.min_x AND a.max_x = b.max_x) AS sx, (a.min_y = b.min_y AND a.max_y = b.max_y) AS sy FROM r a JOIN r b ON b.id = a.id + 1),
  k AS (SELECT CASE WHEN ab = 4 THEN 'A_CONTAINS_B' WHEN ba = 4 THEN 'B_CONTAINS_A' WHEN ab = 2 AND ba = 0 THEN 'A_CONTAINS_2_B_0' WHEN ab = 2 AND ba = 1 THEN 'A_CONTAINS_2_B_1' WHEN ab = 2 AND ba = 2 THEN 'PARTIAL_OVERLAP'
   WHEN ab = 1 AND ba = 1 THEN 'A_CONTAINS_1_B_1' WHEN ba = 2 AND ab = 0 THEN 'B_CONTAINS_2_A_0' WHEN ba = 2 AND ab = 1 THEN 'B_CONTAINS_2_A_1' WHEN apart AND tx AND sy THEN 'HORIZONTAL_FULL_TOUCHING' WHEN apart AND NOT tx AND ty AND sx THEN 'VERTICAL_FULL_TOUCHING'
   WHEN apart THEN 'NO_INTERSECTION' ELSE 'UNKNOWN' END AS relation, id FROM p) SELECT relation, count(*) AS n, sum(id)::BIGINT AS ids FROM k GROUP BY relation""")  # fmt: skip
def range_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each extent's range lies to the next one's, counted by relation."""
    r = R.of_extents(A.extents(spark, sf_dir), F.lit(5)).select("id", "depth", *R.BOUNDS)
    pairs = r.alias("a").join(r.alias("b"), F.col("b.id") == F.col("a.id") + 1)
    return pairs.select(R.relation("a", "b").alias("relation"), F.col("a.id").alias("id")).groupBy("relation").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(f"""{A.oracle('ext')}, r AS ({' UNION ALL '.join(f'SELECT {d} AS depth, {_range(d)} FROM ext' for d in (3, 5, 7))}) SELECT depth, min(min_x) AS min_x, max(max_x) AS max_x, min(min_y) AS min_y, max(max_y) AS max_y FROM r GROUP BY depth""")
def range_hull_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hulls of all ranges at three depths, through a layer descriptor and back."""
    e = A.extents(spark, sf_dir)
    r = R.of_extents(e.withColumn("__d", F.explode(F.array(F.lit(3), F.lit(5), F.lit(7)))), F.col("__d"))
    return R.from_layer_json(R.layer_json(R.hull(r)))


@query(f"""{A.oracle('pts')}, t AS (SELECT DISTINCT {_x('lon', 3)} AS x, {_y('lat', 3)} AS y FROM pts) SELECT 4 AS l, x * 2 + i::INT AS x, y * 2 + j::INT AS y FROM t, unnest(range(0, 2)) AS a(i), unnest(range(0, 2)) AS b(j)""")
def tile_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The children of all tiles with points."""
    t = A.points(spark, sf_dir).select(T.tile_x(F.col("lon"), F.lit(3)).alias("x"), T.tile_y(F.col("lat"), F.lit(3)).alias("y")).distinct()
    return t.select(F.explode(T.children(F.col("x"), F.col("y"))).alias("c")).select(F.lit(4).alias("l"), "c.x", "c.y")


@query(f"""{A.oracle('pts')}, t AS (SELECT DISTINCT {_x('lon', 5)} AS x, {_y('lat', 5)} AS y FROM pts), n AS (SELECT x + i::INT AS x, y + j::INT AS y FROM t, unnest(range(-1, 2)) AS a(i), unnest(range(-1, 2)) AS b(j) WHERE i <> 0 OR j <> 0)
  SELECT x, y, count(*) AS n FROM n WHERE x BETWEEN 0 AND 63 AND y BETWEEN 0 AND 31 GROUP BY x, y""")  # fmt: skip
def tile_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tiles with points lie around each valid tile."""
    t = A.points(spark, sf_dir).select(T.tile_x(F.col("lon"), F.lit(5)).alias("x"), T.tile_y(F.col("lat"), F.lit(5)).alias("y")).distinct()
    n = t.select(F.explode(T.neighbours(F.col("x"), F.col("y"))).alias("c")).select("c.x", "c.y")
    return n.where(T.is_valid(F.lit(5), F.col("x"), F.col("y"))).groupBy("x", "y").agg(F.count("*").alias("n"))


@query(f"""{A.oracle('ext')}, t AS (SELECT DISTINCT id % 2 AS half, x::INT AS x, y::INT AS y FROM (SELECT id, {_range(7)} FROM ext), unnest(range(min_x, max_x + 1)) AS a(x), unnest(range(min_y, max_y + 1)) AS b(y) WHERE x < 256 AND y < 128)
  SELECT 7 AS depth, x, y FROM t WHERE half = 0 EXCEPT SELECT 7, x, y FROM t WHERE half = 1""")  # fmt: skip
def tile_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of the extents of even id that no extent of odd id covers."""
    r = R.of_extents(A.extents(spark, sf_dir), F.lit(7)).select("id", "depth", *R.BOUNDS)
    return R.minus(r.where("id % 2 = 0").drop("id"), r.where("id % 2 = 1").drop("id"))


@query(f"""{A.oracle('ext', 'ras')} SELECT r.raster, count(*) AS n, sum(e.id)::BIGINT AS ids FROM ext e JOIN ras r ON e.min_lon <= r.max_lon AND r.min_lon <= e.max_lon AND e.min_lat <= r.max_lat AND r.min_lat <= e.max_lat GROUP BY r.raster""")
def extent_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extents that meet each raster."""
    pairs = spatial.extents_meet(A.extents(spark, sf_dir), A.rasters(spark, sf_dir))
    return pairs.groupBy(F.col("b_raster").alias("raster")).agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(f"""{A.oracle('pts', 'ext')} SELECT p.id, count(*) AS n, min(e.id) AS first, max(e.id) AS last FROM pts p JOIN ext e ON p.lon BETWEEN e.min_lon AND e.max_lon AND p.lat BETWEEN e.min_lat AND e.max_lat GROUP BY p.id""")
def point_extent_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extents that hold each point."""
    pairs = spatial.points_in_extents(A.points(spark, sf_dir), A.extents(spark, sf_dir))
    return pairs.groupBy("id").agg(F.count("*").alias("n"), F.min("e_id").alias("first"), F.max("e_id").alias("last"))
