"""Queries of what is left of scenes, orders, tile rasters and codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions import geodesy as G
from ..operators import mesh as M
from ..operators import ranges as R
from ..operators import rasters as Q
from ..operators import scenes as N
from ..operators import surfaces as S
from ..sources import adapters as A

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query(f"{A.oracle('pts', 'ras')} SELECT raster, count_if(lon BETWEEN min_lon AND max_lon) AS by_lon, count_if(lat BETWEEN min_lat AND max_lat) AS by_lat FROM pts, ras GROUP BY raster")
def axis_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many points lie in each raster's longitudes, and in its latitudes."""
    p, r = A.points(spark, sf_dir), A.rasters(spark, sf_dir)
    both = p.crossJoin(F.broadcast(r.select("raster", *Q.EXTENT)))  # ten rasters
    return both.groupBy("raster").agg(F.count_if(F.col("lon").between(F.col("min_lon"), F.col("max_lon"))).alias("by_lon"), F.count_if(F.col("lat").between(F.col("min_lat"), F.col("max_lat"))).alias("by_lat"))


@query(f"{A.oracle('pts')} SELECT id, true AS near, h AS beyond FROM pts")
def tile_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point in a raster of its tile whose heights rise evenly, and one depth below, where there is none."""
    p = A.points(spark, sf_dir).withColumn("z", F.col("h"))
    slope = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda k: (k % 16 + F.floor(k / 16) * 2).cast("float"))
    tiles = R.tiles(spark.createDataFrame([(2, 0, 7, 0, 3)], "depth int, min_x int, max_x int, min_y int, max_y int"))
    arrays = tiles.select(F.col("depth").alias("l"), "x", "y").withColumn("elev", slope)
    got = Q.resampled(p, arrays, 2, 16)
    step = 45.0 / 16
    fx, fy = (F.pmod(F.col("lon") + 180.0, F.lit(45.0)) / step, F.pmod(F.col("lat") + 90.0, F.lit(45.0)) / step)
    near = F.abs(got["z"] - (fx + fy * 2)) < 1e-3
    below = Q.resampled(p, arrays, 3, 16).select(F.col("id").alias("__id"), F.col("z").alias("beyond"))
    top = F.col("lat") >= 90.0
    return got.select("id", (near | top).alias("near")).join(below, F.col("id") == F.col("__id")).select("id", "near", "beyond")


_V = "v AS (SELECT p_partkey % 7 AS node, p_partkey AS vertex, p_size::DOUBLE AS x, p_partkey % 11::DOUBLE AS y, p_retailprice AS z FROM part)"


def _vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return A.table(spark, sf_dir, "part").select((k % 7).alias("node"), k.alias("vertex"), F.col("p_size").cast("double").alias("x"), (k % 11).cast("double").alias("y"), F.col("p_retailprice").alias("z"), F.lit(0.0).alias("nx"), F.lit(3.0).alias("ny"), F.lit(4.0).alias("nz"))


def _nodes(spark: SparkSession) -> DataFrame:
    """Seven nodes below each other, each of which shifts by its number along x and doubles heights."""
    rows = [(k, k - 1 if k else None, [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 2.0, 0.0, float(k), 0.0, 0.0, 1.0]) for k in range(7)]
    return spark.createDataFrame(rows, "node long, parent long, matrix array<double>")


@query(f"WITH {_V} SELECT vertex, x + node * (node + 1) / 2 AS x, round(z * pow(2, node + 1), 4) AS z, round(3.0::DOUBLE / sqrt(9 + pow(4 * pow(2, node + 1), 2)), 6) AS ny FROM v")
def baked_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as vertices of nested nodes, in the scene's coordinates."""
    out = N.baked(_vertices(spark, sf_dir), N.world_matrices(_nodes(spark)))
    return out.select("vertex", "x", F.round("z", 4).alias("z"), F.round("ny", 6).alias("ny"))


@query(f"WITH {_V}, m AS (SELECT node, max(vertex) + 1 AS n FROM v GROUP BY node), o AS (SELECT node, sum(n) OVER (ORDER BY node) - n AS o FROM m) SELECT 0::BIGINT AS node, (vertex + o)::BIGINT AS vertex, x FROM v JOIN o USING (node)")
def merged_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vertices of all nodes as one primitive's, numbered on from node to node."""
    v = _vertices(spark, sf_dir)
    faces = v.select("node", F.col("vertex").alias("face"), *(F.col("vertex").alias(f"v{k}") for k in range(3)))
    return N.merged(v, faces, N.world_matrices(_nodes(spark)))[0].select("node", "vertex", "x")


@query("SELECT n_nationkey AS id, round(1 - n_regionkey / 4.0::DOUBLE, 6) AS v, true AS same FROM nation")
def flipped_colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texture coordinates from the other side, and colours that only the region tells."""
    n = A.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), "n_regionkey", (F.col("n_regionkey") / 4.0).alias("v"))
    c = N.coloured(N.flipped(n), "n_regionkey", 5)
    own = N.coloured(A.table(spark, sf_dir, "region"), "r_regionkey", 5).select("r_regionkey", *(F.col(x).alias(f"{x}2") for x in "rgb"))
    both = c.join(own, F.col("n_regionkey") == F.col("r_regionkey"))
    return both.select("id", F.round("v", 6).alias("v"), ((F.col("r") == F.col("r2")) & (F.col("g") == F.col("g2")) & (F.col("b") == F.col("b2"))).alias("same"))


_NORMAL = "(y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS nx, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS ny, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS nz"


@query(f"""{A.oracle('tri')}, n AS (SELECT id, {_NORMAL} FROM tri), s AS (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) AS s FROM n), m AS (SELECT sum(nx / s) AS x, sum(ny / s) AS y, sum(nz / s) AS z FROM s),
  u AS (SELECT x / sqrt(x * x + y * y + z * z) AS x, y / sqrt(x * x + y * y + z * z) AS y, z / sqrt(x * x + y * y + z * z) AS z FROM m) SELECT round(sum(abs(nx * u.x + ny * u.y + nz * u.z) / 2), 3) AS area FROM s, u""")  # fmt: skip
def projected_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of all triangles seen along their mean normal."""
    p = N.projected(A.triangles(spark, sf_dir))
    area = F.abs((F.col("u1") - F.col("u0")) * (F.col("w2") - F.col("w0")) - (F.col("u2") - F.col("u0")) * (F.col("w1") - F.col("w0"))) / 2.0
    return p.agg(F.round(F.sum(area), 3).alias("area"))


def _net(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """A level net of 9 x 9 vertices, one of them raised; faces in two classes."""
    from ..operators.cutting import regular_net

    faces = regular_net(spark, 9, 9).withColumn("class", (F.col("face") % 2).cast("int"))
    i, j = F.col("id") % 9, F.floor(F.col("id") / 9)
    at = spark.range(81).select(F.col("id").alias("vertex"), i.cast("double").alias("x"), j.cast("double").alias("y"), F.when(F.col("id") == 40, 1.0).otherwise(0.0).alias("z"), F.lit(0.0).alias("nx"), F.lit(0.0).alias("ny"), F.lit(1.0).alias("nz"))
    return at, faces


@query("SELECT 2 * 3 * 64 AS triangles, round(64 * (1 + 1 + sqrt(2.0::DOUBLE)) * 2, 4) AS area")
def class_skirts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upright strips, 2 deep, below one class of a level net's faces, each of which has three border edges, and their area."""
    at, faces = _net(spark)
    strips = N.skirt_by_class(faces, at.withColumn("z", F.lit(0.0)), 0, 2.0)
    n = M.plane()[:3]
    area = F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]) / 2.0
    return strips.agg(F.count("*").cast("int").alias("triangles"), F.round(F.sum(area), 4).alias("area"))


@query("SELECT id AS vertex, round(CASE WHEN id = 40 THEN 1.1::DOUBLE WHEN id IN (30, 31, 39, 41, 49, 50) THEN -0.1::DOUBLE ELSE 0 END, 6) + 0 AS z FROM range(0, 81) AS t(id)")
def deformed_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A net's one hill and the vertices around it, made steeper."""
    at, faces = _net(spark)
    return N.deformed(at, faces, 0.1).select("vertex", (F.round("z", 6) + 0.0).alias("z"))


@query("SELECT 0 AS class, 'XPOS_ZNEG' AS direction, 64::BIGINT AS faces UNION ALL SELECT 1, 'XPOS_ZNEG', 64")
def direction_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level net's faces by class and camera: all slanting cameras see them alike, so the first is taken."""
    at, faces = _net(spark)
    out = faces
    for k in range(3):
        out = out.join(at.select(F.col("vertex").alias(f"v{k}"), F.col("x").alias(f"x{k}"), F.col("y").alias(f"y{k}"), F.lit(0.0).alias(f"z{k}")), f"v{k}")
    return N.by_direction(out)


@query(f"{A.oracle('tri')}, e AS (SELECT id, round((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0) + (z1 - z0) * (z1 - z0), 6) AS length2 FROM tri) SELECT length2, count(*) AS n FROM e GROUP BY length2 ORDER BY length2 LIMIT 20")
def shortest_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 least squared lengths of triangles' first edges."""
    e = A.triangles(spark, sf_dir).select(F.col("id").alias("edge"), *(F.col(f"{c}{k}").alias(f"{n}{c}") for k, n in enumerate("ab") for c in "xyz"))
    ranked = S.by_length(e).select(F.round(S.edge_measures()["length2"], 6).alias("length2"))
    return ranked.groupBy("length2").agg(F.count("*").alias("n")).orderBy("length2").limit(20)


@query("SELECT count(*) AS rows, count(*) AS places, least(256, count(*)) AS slots, 100::BIGINT AS numbers FROM events")
def shuffled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows dealt to places of a repeated pattern: no two at one place; and 100 different numbers by seed."""
    p = A.table(spark, sf_dir, "events").select(S.pattern_place(F.col("event_id"), 256, 3).alias("p"))
    numbers = S.unique_numbers(spark, 100, 1000, 7).select("number").distinct().count()
    return p.agg(F.count("*").alias("rows"), F.count_distinct("p").alias("places"), F.count_distinct("p.slot").alias("slots")).withColumn("numbers", F.lit(numbers).cast("long"))


@query(f"{A.oracle('face')}, m AS (SELECT max(face) + 1 AS f, max(greatest(v0, v1, v2)) + 1 AS v FROM face) SELECT count(*) * 2 AS faces, max(face) + max(f) AS last_face, max(greatest(v0, v1, v2)) + max(v) AS last_vertex FROM face, m")
def joined_meshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mesh and itself as one, with ids that go on."""
    f = A.faces(spark, sf_dir)
    return S.joined([f, f]).agg(F.count("*").alias("faces"), F.max("face").alias("last_face"), F.max(F.greatest("v0", "v1", "v2")).alias("last_vertex"))


@query(f"{A.oracle('vox')} SELECT min(ix) AS min_x, max(ix) AS max_x, min(iz) AS min_z, max(iz) AS max_z, count(*) AS n, 4 AS depth FROM vox")
def cell_hull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hull of the cells that voxels are in, and the greatest depth of some ranges."""
    v = A.voxels(spark, sf_dir).agg(F.min("ix").alias("min_x"), F.max("ix").alias("max_x"), F.min("iz").alias("min_z"), F.max("iz").alias("max_z"), F.count("*").alias("n"))
    deepest = R.deepest(spark.createDataFrame([(1,), (4,), (2,)], "depth int"))
    return v.crossJoin(deepest)  # one row each


@query(f"""SELECT n_name AS kind, CASE n_name WHEN 'RoofSurface' THEN 'ROOF' ELSE 'WALL' END AS class, 0.5::DOUBLE AS r FROM nation UNION ALL
  SELECT k, c, r FROM (VALUES {', '.join(f"('{k}', '{v}', {C.COLOURS[v][0]}::DOUBLE)" for k, v in C.CITY_CLASSES.items())}) AS t(k, c, r)""")  # fmt: skip
def city_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and the red of their colours for kinds of city objects, and for names that are none."""
    kinds = spark.createDataFrame([(k,) for k in C.CITY_CLASSES], "kind string").union(A.table(spark, sf_dir, "nation").select("n_name"))
    return kinds.select("kind", C.city_class(F.col("kind")).alias("class")).withColumn("r", F.get(C.class_colour(F.col("class")), F.lit(0)))


@query(f"{A.oracle('leg')} SELECT round(avg(r), 6) AS r, round(avg(g), 6) AS g, round(avg(b), 6) AS b FROM leg")
def mean_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of all colours."""
    return A.legend(spark, sf_dir).agg(*(F.round(F.avg(c), 6).alias(c) for c in "rgb"))


@query(f"{A.oracle('tri')}, e AS (SELECT id, x0, y0, x1, y1 FROM tri WHERE id % 3 = 0) SELECT a.id AS edge, count(*) AS twins FROM e a JOIN e b ON abs(a.x0 - b.x0) < 0.05 AND abs(a.y0 - b.y0) < 0.05 AND abs(a.x1 - b.x1) < 0.05 AND abs(a.y1 - b.y1) < 0.05 GROUP BY a.id")
def near_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many reversed first edges of triangles run against each of them, within a twentieth of a degree."""
    t = A.triangles(spark, sf_dir).where("id % 3 = 0")
    there = t.select(F.col("id").alias("edge"), F.col("x0").alias("ax"), F.col("y0").alias("ay"), F.col("x1").alias("bx"), F.col("y1").alias("by"))
    back = t.select((-F.col("id") - 1).alias("edge"), F.col("x1").alias("ax"), F.col("y1").alias("ay"), F.col("x0").alias("bx"), F.col("y0").alias("by"))
    return S.possible_twins(there.union(back), 0.05).where("edge >= 0").groupBy("edge").agg(F.count("*").alias("twins"))


@query(f"{A.oracle('pts')} SELECT count(*) AS points, true AS upward FROM pts")
def up_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the third axis of each point's local frame is the ellipsoid's normal."""
    p = A.points(spark, sf_dir).withColumn("m", G.enu_frame(F.col("lon"), F.col("lat"), F.col("h")))
    n = G.surface_normal(F.col("lon"), F.col("lat"))
    same = F.lit(True)
    for k in range(3):
        same = same & (F.abs(F.get("m", F.lit(8 + k)) - n[k]) < 1e-12)
    return p.agg(F.count("*").alias("points"), F.every(same).alias("upward"))




@query(f"{A.oracle('face')}, e AS (SELECT face, unnest([v0, v1, v2]) AS a, unnest([v1, v2, v0]) AS b, unnest([v2, v0, v1]) AS c, unnest([0, 1, 2]) AS k FROM (SELECT min(face) AS face, v0, v1, v2 FROM face GROUP BY v0, v1, v2)) SELECT a, count(*) AS n, sum(c)::BIGINT AS across, sum(k)::BIGINT AS places FROM e GROUP BY a")
def edge_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from each corner, with the corners across from them."""
    g = M.loops(A.faces(spark, sf_dir).groupBy("v0", "v1", "v2").agg(F.min("face").alias("face")))
    return g.groupBy("a").agg(F.count("*").alias("n"), F.sum("across").alias("across"), F.sum("k").alias("places"))


@query("WITH f AS (SELECT face, unnest([a, b, c]) AS p, unnest([b, c, a]) AS q FROM (SELECT i AS face, a, b, c FROM (SELECT 2 * (j * 39 + i) AS i, j * 40 + i AS a, j * 40 + i + 1 AS b, j * 40 + i + 41 AS c FROM range(0, 39) AS x(i), range(0, 29) AS y(j) UNION ALL SELECT 2 * (j * 39 + i) + 1, j * 40 + i, j * 40 + i + 41, j * 40 + i + 40 FROM range(0, 39) AS x(i), range(0, 29) AS y(j)) AS t(i, a, b, c))) SELECT g.face, count(DISTINCT h.face) AS others FROM f g JOIN f h ON g.p = h.q AND g.q = h.p GROUP BY g.face")
def face_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many faces each face of a net shares an edge with."""
    from ..operators.cutting import regular_net

    return M.adjacent_faces(regular_net(spark, 40, 30)).groupBy("face").agg(F.count("*").alias("others"))


@query(f"{A.oracle('ext')} SELECT id, (id % 7)::BIGINT AS points, true AS inside FROM ext WHERE id % 7 > 0")
def scattered_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points by seed in L-shaped rings over extents: as many as asked for, all inside."""
    from ..operators import model as O

    w, s, e, n = (F.col(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat"))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    cx, cy = (w + e) / 2.0, (s + n) / 2.0
    ring = F.array(point(w, s), point(e, s), point(e, cy), point(cx, cy), point(cx, n), point(w, n))
    f = A.extents(spark, sf_dir).select("id", ring.alias("ring"), cx.alias("cx"), cy.alias("cy"))
    p = O.scattered(f, (F.col("id") % 7).cast("int"), 11, 48, ("cx", "cy"))
    return p.groupBy("id").agg(F.count("*").alias("points"), F.every((F.col("x") <= F.col("cx")) | (F.col("y") <= F.col("cy"))).alias("inside"))
