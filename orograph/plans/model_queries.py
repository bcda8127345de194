"""Queries of face topology, features, voxels and display helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import mesh as M
from ..operators import model as L
from ..sources import adapters as A

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_EDGES = "e AS (SELECT face, 0 AS k, v0 AS a, v1 AS b FROM face UNION ALL SELECT face, 1, v1, v2 FROM face UNION ALL SELECT face, 2, v2, v0 FROM face), r AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY face, k) AS n FROM e), t AS (SELECT x.face, x.k, x.a, x.b, y.face AS twin_face, y.k AS twin_k FROM r x LEFT JOIN r y ON x.a = y.b AND x.b = y.a AND x.n = y.n)"


def _both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces, every second one turned round so that edges meet."""
    f = A.faces(spark, sf_dir)
    odd = F.col("face") % 2 == 1
    return f.select("face", F.when(odd, F.col("v1")).otherwise(F.col("v0")).alias("v0"), F.when(odd, F.col("v0")).otherwise(F.col("v1")).alias("v1"), "v2")


_TURNED = "face AS (SELECT face, CASE WHEN face % 2 = 1 THEN v1 ELSE v0 END AS v0, CASE WHEN face % 2 = 1 THEN v0 ELSE v1 END AS v1, v2 FROM raw)"


def _turned() -> str:
    return f"WITH RECURSIVE raw AS ({A.SQL['face']}), {_TURNED}"


@query(f"{_turned()}, {_EDGES} SELECT * FROM t")
def twin_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every directed edge with its twin."""
    return M.twins(_both_ways(spark, sf_dir))


@query(f"{_turned()}, {_EDGES} SELECT face, k, a, b FROM t WHERE twin_face IS NULL")
def border_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges without a twin."""
    return M.border(_both_ways(spark, sf_dir))


@query(f"""{A.oracle('tri')}, v AS ({' UNION ALL '.join(f'SELECT floor(x{k} / 0.5::DOUBLE + 0.5::DOUBLE)::BIGINT AS x, floor(y{k} / 0.5::DOUBLE + 0.5::DOUBLE)::BIGINT AS y FROM tri' for k in range(3))}) SELECT x, y, count(*) AS corners FROM v GROUP BY x, y""")
def weld_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corner positions welded on a grid of half a degree."""
    return M.welded(A.triangles(spark, sf_dir), 0.5)


@query(f"""{A.oracle('tri')}, v AS ({' UNION ALL '.join(f'SELECT x{k} AS x, y{k} AS y, z{k} AS z FROM tri' for k in range(3))}), c AS (SELECT floor(x / 10.0::DOUBLE + 0.000001::DOUBLE)::BIGINT AS ix, floor(y / 10.0::DOUBLE + 0.000001::DOUBLE)::BIGINT AS iy, floor(z / 10.0::DOUBLE + 0.000001::DOUBLE)::BIGINT AS iz, x, y, z FROM v)
  SELECT ix, iy, iz, round(avg(x) * count(*), 6) AS x, round(avg(y) * count(*), 6) AS y, round(avg(z) * count(*), 6) AS z, count(*) AS n FROM c GROUP BY ix, iy, iz HAVING count(*) >= 2""")  # fmt: skip
def cluster_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean corner of each 3-D cell of 10 units with two corners or more."""
    c = M.clusters(A.triangles(spark, sf_dir), 10.0)
    return c.select("ix", "iy", "iz", *(F.round(F.col(k) * F.col("n"), 6).alias(k) for k in "xyz"), "n")  # means times numbers: exact sums, whatever their order


_S = [f"sqrt((x{i} - x{j}) * (x{i} - x{j}) + (y{i} - y{j}) * (y{i} - y{j}))" for i, j in ((0, 1), (1, 2), (2, 0))]


@query(f"""{A.oracle('tri')}, t AS (SELECT id, x0, y0, CASE WHEN id % 5 = 0 THEN x0 ELSE x1 END AS x1, CASE WHEN id % 5 = 0 THEN y0 ELSE y1 END AS y1, x2, y2 FROM tri), s AS (SELECT id, {_S[0]} AS a, {_S[1]} AS b, {_S[2]} AS c FROM t)
  SELECT id FROM s WHERE least(a, b, c) < 1e-5::DOUBLE OR sqrt(greatest(0.0::DOUBLE, (a + b + c) / 2 * ((a + b + c) / 2 - a) * ((a + b + c) / 2 - b) * ((a + b + c) / 2 - c))) < 1e-5::DOUBLE""")  # fmt: skip
def degenerate_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles with a side or an area of nothing, where every fifth has two equal corners."""
    same = F.col("id") % 5 == 0
    t = A.triangles(spark, sf_dir).withColumns({"x1": F.when(same, F.col("x0")).otherwise(F.col("x1")), "y1": F.when(same, F.col("y0")).otherwise(F.col("y1"))})
    return t.where(M.degenerate()).select("id")


@query("""WITH RECURSIVE e AS (SELECT o_orderkey AS a, o_orderkey // 7 * 7 + o_orderkey % 3 AS b FROM orders UNION SELECT o_orderkey // 7 * 7 + o_orderkey % 3, o_orderkey // 7 * 7 + o_orderkey % 5 FROM orders),
  w AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a, a AS b FROM w UNION SELECT r.a, w.b FROM r JOIN w ON r.b = w.a) SELECT o_orderkey AS face, min(b) AS root FROM orders JOIN r ON o_orderkey = a GROUP BY o_orderkey""")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each face, by the least corner that it is connected with."""
    o = F.col("o_orderkey")
    base = F.expr("o_orderkey div 7") * 7
    return M.face_components(A.table(spark, sf_dir, "orders").select(o.alias("face"), o.alias("v0"), (base + o % 3).alias("v1"), (base + o % 5).alias("v2")))


@query(f"""{A.oracle('pts')}, c AS (SELECT id, floor((lon + 180.0::DOUBLE) / 22.5::DOUBLE)::BIGINT AS ix, floor((lat + 90.0::DOUBLE) / 11.25::DOUBLE)::BIGINT AS iy, least(15, floor(h / 32.0::DOUBLE)::BIGINT) AS iz FROM pts)
  SELECT id, {' + '.join(f'((i{c} >> {k} & 1) << {3 * k + j})' for k in range(4) for j, c in enumerate('xyz'))} AS path FROM c""")  # fmt: skip
def morton_octree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The octree path of every point at depth 4."""
    p = A.points(spark, sf_dir)
    ix, iy, iz = F.floor((F.col("lon") + 180.0) / 22.5), F.floor((F.col("lat") + 90.0) / 11.25), F.least(F.lit(15), F.floor(F.col("h") / 32.0))
    return p.select("id", M.morton(ix, iy, iz, 4).alias("path"))


@query(f"{A.oracle('tri')} SELECT CASE WHEN (z0 + z1 + z2) / 3.0::DOUBLE > 25.0::DOUBLE THEN 2 ELSE 1 END AS class, count(*) AS n, sum(id)::BIGINT AS ids FROM tri GROUP BY 1")
def plane_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles on either side of a horizontal plane."""
    return A.triangles(spark, sf_dir).groupBy(M.plane_class("z", 25.0).alias("class")).agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(f"""{A.oracle('pts', 'leg')}, k AS (SELECT id, h, (SELECT max(value) FROM leg WHERE value <= h) AS lo, (SELECT min(value) FROM leg WHERE value >= h) AS hi FROM pts), m AS (SELECT id, h, coalesce(lo, hi) AS lo, coalesce(hi, lo) AS hi FROM k),
  t AS (SELECT m.*, CASE WHEN hi = lo THEN 0.0::DOUBLE ELSE (h - lo) / (hi - lo) END AS t FROM m)
  SELECT id, round(a.r * (1.0::DOUBLE - t) + b.r * t, 6) AS r, round(a.g * (1.0::DOUBLE - t) + b.g * t, 6) AS g, round(a.b * (1.0::DOUBLE - t) + b.b * t, 6) AS b FROM t JOIN leg a ON a.value = lo JOIN leg b ON b.value = hi""")  # fmt: skip
def legend_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point's colour by height."""
    return L.legend_colour(A.points(spark, sf_dir), A.legend(spark, sf_dir), "h").select("id", *(F.round(c, 6).alias(c) for c in "rgb"))


@query(f"{A.oracle('feat')} SELECT id, name, segment, nation, coalesce(height, 3.0::DOUBLE) AS height FROM feat WHERE segment = 'BUILDING' OR nation = 'FRANCE'")
def attribute_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of a segment or a nation, with their heights as numbers."""
    f = A.features(spark, sf_dir).where(L.any_attribute([("segment", "BUILDING"), ("nation", "FRANCE")]))
    return f.withColumn("height", L.number_attribute("height", 3.0))


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extents as rings, with heights."""
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(at("min_lon", "min_lat"), at("max_lon", "min_lat"), at("max_lon", "max_lat"), at("min_lon", "max_lat"))
    return A.extents(spark, sf_dir).select("id", ring.alias("ring"), F.lit(2.0).alias("bottom"), F.col("pixel").alias("top"))


_RING = "p AS (SELECT id, 0 AS k, min_lon AS ax, min_lat AS ay, max_lon AS bx, min_lat AS \"by\", pixel FROM ext UNION ALL SELECT id, 1, max_lon, min_lat, max_lon, max_lat, pixel FROM ext UNION ALL SELECT id, 2, max_lon, max_lat, min_lon, max_lat, pixel FROM ext UNION ALL SELECT id, 3, min_lon, max_lat, min_lon, min_lat, pixel FROM ext)"


@query(f"{A.oracle('ext')}, {_RING} SELECT id, k, ax, ay, bx, \"by\", least(2.0::DOUBLE, pixel) AS low, greatest(2.0::DOUBLE, pixel) AS high FROM p")
def extrude_walls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The walls of every extent's block."""
    return L.walls(_boxes(spark, sf_dir))


@query(f"{A.oracle('ext')} SELECT id, round((max_lon - min_lon) * (max_lat - min_lat), 6) AS area, (-100.013::DOUBLE > min_lon AND -100.013::DOUBLE < max_lon AND 10.017::DOUBLE > min_lat AND 10.017::DOUBLE < max_lat) AS holds FROM ext")
def ring_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of each extent's ring and whether it holds one point."""
    b = _boxes(spark, sf_dir)
    return b.select("id", F.round(L.ring_area(F.col("ring")), 6).alias("area"), L.in_ring(F.col("ring"), F.lit(-100.013), F.lit(10.017)).alias("holds"))


@query(f"{A.oracle('vox')} SELECT ix, iy, iz, max(alpha) AS alpha, arg_min(seq, seq) AS seq FROM (SELECT *, max(alpha) OVER (PARTITION BY ix, iy, iz) AS m FROM vox) WHERE alpha = m GROUP BY ix, iy, iz")
def voxel_max_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each voxel's largest alpha and the first part that set it."""
    return L.densest(A.voxels(spark, sf_dir))


@query(f"""{A.oracle('vox')}, m AS (SELECT ix, iy, iz, max(alpha) AS alpha FROM vox GROUP BY ix, iy, iz), c AS (SELECT (ix - i)::INT AS ix, (iy - j)::INT AS iy, (iz - k)::INT AS iz, 1 << (i + 2 * j + 4 * k)::INT AS bit FROM m, range(0, 2) AS a(i), range(0, 2) AS b(j), range(0, 2) AS c(k) WHERE alpha > 120)
  SELECT ix, iy, iz, sum(bit)::INT AS cube FROM c GROUP BY ix, iy, iz HAVING sum(bit) < 255""")  # fmt: skip
def marching_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cubes that the surface of alpha 120 passes, with their cases."""
    return L.cube_cases(L.densest(A.voxels(spark, sf_dir)), 120.0)


@query(f"""{A.oracle('pts')}, c AS (SELECT floor((lon + 100.0::DOUBLE) / 7.0::DOUBLE)::INT AS i, floor((lat + 40.0::DOUBLE) / 9.0::DOUBLE)::INT AS j, h FROM pts), g AS (SELECT CASE WHEN i BETWEEN 0 AND 19 AND j BETWEEN 0 AND 9 THEN i END AS i, CASE WHEN i BETWEEN 0 AND 19 AND j BETWEEN 0 AND 9 THEN j END AS j, h FROM c)
  SELECT i, j, count(*) AS n, max(h) AS high FROM g GROUP BY i, j""")  # fmt: skip
def point_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by cell of a grid, those outside together."""
    i, j = L.cell_of(F.col("lon"), F.col("lat"), (-100.0, -40.0), (7.0, 9.0), (20, 10))
    return A.points(spark, sf_dir).groupBy(i.alias("i"), j.alias("j")).agg(F.count("*").alias("n"), F.max("h").alias("high"))


@query("SELECT o_orderkey AS id, CASE WHEN b >= 1073741824 THEN (b // 1073741824)::VARCHAR || 'GB' WHEN b >= 1048576 THEN (b // 1048576)::VARCHAR || 'MB' WHEN b >= 1024 THEN (b // 1024)::VARCHAR || 'KB' ELSE b::VARCHAR || 'bytes' END AS size, floor(o_totalprice / 7.0::DOUBLE * 1e8::DOUBLE) / 1e8::DOUBLE AS cut FROM (SELECT *, o_orderkey * o_orderkey * 37 AS b FROM orders)")
def display_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte counts as people read them, and prices cut at eight decimals."""
    b = F.col("o_orderkey") * F.col("o_orderkey") * 37
    return A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), N.byte_size(b).alias("size"), N.cut(F.col("o_totalprice") / 7.0).alias("cut"))
