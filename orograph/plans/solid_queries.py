"""Queries of solids: polygons with holes, blocks, pipes, decimation, skirts, isosurfaces, by what they must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors3d as V
from ..operators import cutting as C
from ..operators import mesh as M
from ..operators import model as O
from ..operators import solids as S
from ..sources import adapters as A

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _ring(w: Column, s: Column, e: Column, n: Column) -> Column:
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(point(w, s), point(e, s), point(e, n), point(w, n))


def _framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fourth extent as a polygon with a hole of a quarter of its sides, from 0 to its pixel size."""
    w, s, e, n = (F.col(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat"))
    dx, dy = (e - w) / 4.0, (n - s) / 4.0
    rings = F.array(_ring(w, s, e, n), _ring(w + dx, s + dy, w + dx * 2, s + dy * 2))
    return A.extents(spark, sf_dir).where("id % 4 = 0").select("id", rings.alias("rings"), F.lit(0.0).alias("bottom"), F.col("pixel").alias("top"))


def _volume(points: str = "points", faces: str = "faces") -> Column:
    """Volume within a closed mesh of outward faces."""
    at = lambda f, k: tuple(F.get(F.get(F.col(points), F.get(f, F.lit(k))), F.lit(c)) for c in range(3))

    def one(f: Column) -> Column:
        (ax, ay, az), (bx, by, bz), (cx, cy, cz) = (at(f, k) for k in range(3))
        return (ax * (by * cz - bz * cy) + ay * (bz * cx - bx * cz) + az * (bx * cy - by * cx)) / 6.0

    return F.aggregate(F.transform(F.col(faces), one), F.lit(0.0), lambda a, b: a + b)


_EXT4 = f"{A.oracle('ext')}, f AS (SELECT id, (max_lon - min_lon) * (max_lat - min_lat) * 15 / 16 AS area, 2 * (max_lon - min_lon + max_lat - min_lat) AS around, pixel FROM ext WHERE id % 4 = 0)"


@query(f"{_EXT4} SELECT id, round(area, 6) AS area, 8 AS triangles FROM f")
def tessellated_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area and triangles of polygons with a hole, cut into triangles."""
    flat = S.tessellate(_framed(spark, sf_dir)).withColumn("points", F.transform("points", lambda p: F.concat(p, F.array(F.lit(0.0)))))
    return flat.select("id", F.round(S.mesh_area(), 6).alias("area"), F.size("faces").alias("triangles"))


@query(f"{_EXT4} SELECT id, round(area * pixel, 6) AS volume, round(2 * area + around * 1.25::DOUBLE * pixel, 6) AS surface FROM f")
def extruded_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume and surface of blocks over those polygons."""
    return S.extrude(_framed(spark, sf_dir)).select("id", F.round(_volume(), 6).alias("volume"), F.round(S.mesh_area(), 6).alias("surface"))


@query("SELECT p_partkey AS id, (CASE WHEN p_size * 0.02::DOUBLE <= 0.4::DOUBLE THEN 4 WHEN p_size * 0.02::DOUBLE <= 0.8::DOUBLE THEN 6 ELSE 8 END * 2 * 2)::INT AS faces FROM part")
def pipe_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces of pipes of two pieces by their radius; a point that repeats makes no piece."""
    k = F.col("p_partkey").cast("double")
    point = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), F.lit(z).alias("z"))
    line = F.array(point(k, k, 0.0), point(k + 5, k, 0.0), point(k + 5.001, k, 0.0), point(k + 9, k + 4, 1.0))
    p = A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), line.alias("line"), (F.col("p_size") * 0.02).alias("radius"))
    return S.pipes(p).select("id", F.size("faces").alias("faces"))


@query("SELECT n_nationkey::BIGINT AS id, 36.0::DOUBLE AS area, true AS fewer FROM nation")
def decimated_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level net for each nation, thinned: its area stays, its faces become fewer."""
    points = [[float(i), float(j), 0.0] for j in range(7) for i in range(7)]
    faces = [f for j in range(6) for i in range(6) for a in [j * 7 + i] for f in ([a, a + 1, a + 8], [a, a + 8, a + 7])]
    net = A.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.lit(points).cast("array<array<double>>").alias("points"), F.lit(faces).cast("array<array<int>>").alias("faces"))
    return S.decimate(net, 3.0).select("id", F.round(S.mesh_area(), 6).alias("area"), (F.size("faces") < len(faces)).alias("fewer"))


@query(f"""{A.oracle('tri')}, e AS (SELECT id, x0, y0, z0, x1, y1, z1 FROM tri) SELECT id, count(*) * 2 AS triangles, round(sum(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) * 10), 4) AS area FROM e GROUP BY id""")
def skirt_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of the upright strips, 10 deep, below triangles' first edges."""
    e = A.triangles(spark, sf_dir).select(F.col("id").alias("edge"), *(F.col(f"{c}{k}").alias(f"{n}{c}") for k, n in enumerate("ab") for c in "xyz"))
    n = M.plane()[:3]
    area = F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]) / 2.0
    return C.skirt(e, 10.0).groupBy(F.col("edge").alias("id")).agg(F.count("*").alias("triangles"), F.round(F.sum(area), 4).alias("area"))


@query(f"""{A.oracle('tri')}, a AS (SELECT x0, x1, abs((x1 - x0) * (y2 - y0)) / 2.0::DOUBLE AS area FROM tri), p(c, lo, hi) AS (VALUES (0, -1e9::DOUBLE, -60.0::DOUBLE), (1, -60.0::DOUBLE, 60.0::DOUBLE), (2, 60.0::DOUBLE, 1e9::DOUBLE)),
  k AS (SELECT c, area * (pow(greatest(0, least(1, (x1 - lo) / (x1 - x0))), 2) - pow(greatest(0, least(1, (x1 - hi) / (x1 - x0))), 2)) AS part FROM a, p) SELECT c::INT AS cell, round(sum(part), 3) AS area FROM k GROUP BY c""")  # fmt: skip
def slab_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of all triangles in three slabs between meridians."""
    parts = C.cut_by_grid(A.triangles(spark, sf_dir), "x", [-60.0, 60.0])
    area = F.abs((F.col("x1") - F.col("x0")) * (F.col("y2") - F.col("y0")) - (F.col("x2") - F.col("x0")) * (F.col("y1") - F.col("y0"))) / 2.0
    return parts.groupBy("cell").agg(F.round(F.sum(area), 3).alias("area"))


@query(f"{A.oracle('face')}, v AS (SELECT DISTINCT unnest([v0, v1, v2]) AS v FROM face) SELECT count(*) AS vertices, (count(*) - 1)::BIGINT AS last, (SELECT count(*) FROM face) AS faces, true AS kept FROM v")
def compacted_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners numbered without gaps; equal corners stay equal."""
    faces = A.faces(spark, sf_dir).withColumn("face", F.monotonically_increasing_id())
    index, out = O.compacted(faces)
    back = out.select("v0").distinct().count() == faces.select("v0").distinct().count()
    return index.agg(F.count("*").alias("vertices"), F.max("index").alias("last")).crossJoin(out.agg(F.count("*").alias("faces"))).withColumn("kept", F.lit(back))


@query("""SELECT p_partkey AS id, (CASE WHEN p_size % 5 = 0 THEN 2 ELSE 3 END)::INT AS points FROM part""")
def simplified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without points next to the one before."""
    step = (F.col("p_size") % 5) * 0.02
    point = lambda x: F.struct(x.alias("x"), F.lit(1.0).alias("y"))
    line = F.array(point(F.lit(0.0)), point(step), point(step + 1.0), point(step + 1.005))
    return A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.size(O.simplified(line)).alias("points"))


@query("""SELECT c_custkey AS id, round(h, 6) + 0 AS h, c_custkey % 3 = 1 AS solid, 'XY' AS plane FROM (SELECT *, 1.0::DOUBLE AS h FROM customer)""")
def ring_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normal of a level ring for each customer, whether it has heights, and the plane it is projected to."""
    k = F.col("c_custkey").cast("double")
    z = F.when(F.col("c_custkey") % 3 == 1, 2.5).otherwise(0.0)
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    ring = F.array(point(k, k), point(k + 3, k), point(k + 3, k + 1), point(k + 1, k + 1), point(k + 1, k + 4), point(k, k + 4))
    n = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), V.polygon_normal(ring).alias("n"), V.is_solid_ring(ring).alias("solid"))
    return n.select("id", (F.round("n.z", 6) + 0.0).alias("h"), "solid", V.best_plane((F.col("n.x"), F.col("n.y"), F.col("n.z"))).alias("plane"))
