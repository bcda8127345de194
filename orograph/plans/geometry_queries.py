"""Queries of plane geometry, cutting and small helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geodesy as G
from ..functions import plane2d as L
from ..functions import tiles as T
from ..operators import cutting as C
from ..operators import mesh as M
from ..sources import adapters as A
from .tile_queries import _x, _y

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_OFF = "((x1 - x0) * (5.05::DOUBLE - y0) - (y1 - y0) * (-20.05::DOUBLE - x0)) / nullif(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)), 0)"


@query(f"{A.oracle('tri')} SELECT CASE WHEN {_OFF} IS NULL OR abs({_OFF}) <= 1e-8::DOUBLE THEN 0 WHEN {_OFF} > 0 THEN 1 ELSE 2 END AS side, count(*) AS n, sum(id)::BIGINT AS ids FROM tri GROUP BY 1")
def line_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On which side of each triangle's first edge a point lies."""
    side = L.side_of_line((F.col("x0"), F.col("y0")), (F.col("x1"), F.col("y1")), (F.lit(-20.05), F.lit(5.05)))
    return A.triangles(spark, sf_dir).groupBy(side.alias("side")).agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


def _turn(p: str, q: str, r: str) -> str:
    return f"sign(({q}x - {p}x) * ({r}y - {p}y) - ({q}y - {p}y) * ({r}x - {p}x))"


@query(f"""{A.oracle('ext')}, s AS (SELECT id, min_lon AS ax, min_lat AS ay, max_lon AS bx, max_lat AS "by", -180.0::DOUBLE AS cx, -80.03::DOUBLE AS cy, 180.0::DOUBLE AS dx, 70.07::DOUBLE AS dy FROM ext)
  SELECT id FROM s WHERE {_turn('a', 'b', 'c')} * {_turn('a', 'b', 'd')} < 0 AND {_turn('c', 'd', 'a')} * {_turn('c', 'd', 'b')} < 0""".replace("by -", '"by" -').replace("(by", '("by"'))
def segment_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extents whose diagonal a long segment crosses."""
    e = A.extents(spark, sf_dir)
    return e.where(L.segments_cross((F.col("min_lon"), F.col("min_lat")), (F.col("max_lon"), F.col("max_lat")), (F.lit(-180.0), F.lit(-80.03)), (F.lit(180.0), F.lit(70.07)))).select("id")


_V = "(6378137.0::DOUBLE / sqrt(1.0::DOUBLE - 0.00669437999014::DOUBLE * pow(sin({l} * 0.017453292519943296::DOUBLE), 2)))"


@query(f"{A.oracle('ext')} SELECT id, round(({_V.format(l='min_lat')} + {_V.format(l='max_lat')}) / 2.0::DOUBLE * ((max_lat - min_lat) * 0.017453292519943296::DOUBLE), 4) AS north, round({_V.format(l='min_lat')} * cos(min_lat * 0.017453292519943296::DOUBLE) * ((max_lon - min_lon) * 0.017453292519943296::DOUBLE), 4) AS east FROM ext")
def arc_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each extent's sides in metres."""
    c = F.col
    return A.extents(spark, sf_dir).select("id", F.round(G.latitude_distance(c("min_lat"), c("max_lat")), 4).alias("north"), F.round(G.longitude_distance(c("min_lat"), c("min_lon"), c("max_lon")), 4).alias("east"))


@query(f"{A.oracle('pts')} SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM pts WHERE abs(lat) < 85")
def mercator_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point to Web Mercator and back."""
    x, y = G.mercator(F.col("lon"), F.col("lat"))
    p = A.points(spark, sf_dir).where(F.abs("lat") < 85).select("id", x.alias("mx"), y.alias("my"))
    lon, lat = G.from_mercator(F.col("mx"), F.col("my"))
    return p.select("id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query(f"{A.oracle('leg')} SELECT value, CASE WHEN b > 127 THEN r + g * 256 + b * 65536 + b::BIGINT * 16777216 - 4294967296 ELSE r + g * 256 + b * 65536 + b::BIGINT * 16777216 END::INT AS packed, r, g, b FROM leg")
def colour_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legend colours as one integer, and back."""
    p = A.legend(spark, sf_dir).select("value", L.packed_colour(F.col("r"), F.col("g"), F.col("b"), F.col("b")).alias("packed"))
    r, g, b, _ = L.unpacked_colour(F.col("packed"))
    return p.select("value", "packed", r.alias("r"), g.alias("g"), b.alias("b"))


@query(f"{A.oracle('pts')} SELECT id, '6/' || {_x('lon', 6)} || '/' || {_y('lat', 6)} || '.terrain' AS path FROM pts")
def tile_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of each point's tile."""
    d = F.lit(6)
    return A.points(spark, sf_dir).select("id", L.tile_path(d, T.tile_x(F.col("lon"), d), T.tile_y(F.col("lat"), d)).alias("path"))


_S = [f"sqrt((x{i} - x{j}) * (x{i} - x{j}) + (y{i} - y{j}) * (y{i} - y{j}))" for i, j in ((0, 1), (1, 2), (2, 0))]


@query(f"""{A.oracle('tri')}, s AS (SELECT *, abs((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)) / 2.0::DOUBLE AS area FROM tri),
  c AS (SELECT area, x0, x1, CASE WHEN x1 <= 5.25::DOUBLE THEN 0.0::DOUBLE WHEN x0 >= 5.25::DOUBLE THEN area ELSE area * pow((x1 - 5.25::DOUBLE) / (x1 - x0), 2) END AS high FROM s)
  SELECT round(sum(area - high), 4) AS low, round(sum(high), 4) AS high FROM c""")  # fmt: skip
def cut_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of all triangles on either side of a meridian that cuts some of them."""
    parts = C.cut_by_plane(A.triangles(spark, sf_dir), "x", 5.25)
    area = F.abs((F.col("x1") - F.col("x0")) * (F.col("y2") - F.col("y0")) - (F.col("x2") - F.col("x0")) * (F.col("y1") - F.col("y0"))) / 2.0
    side = lambda k: F.round(F.sum(F.when(F.col("class") == k, area).otherwise(0.0)), 4)
    return parts.agg(side(1).alias("low"), side(2).alias("high"))


@query("SELECT a AS v0, a + 1 AS v1, a + 41 AS v2 FROM (SELECT j * 40 + i AS a FROM range(0, 39) AS x(i), range(0, 29) AS y(j)) UNION ALL SELECT a, a + 41, a + 40 FROM (SELECT j * 40 + i AS a FROM range(0, 39) AS x(i), range(0, 29) AS y(j))")
def net_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faces of a net of 40 x 30 vertices."""
    return C.regular_net(spark, 40, 30).drop("face")
