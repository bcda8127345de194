"""Queries of borders, states, welding, scenes and their meshes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import tiles as T
from ..functions import vectors3d as V
from ..operators import mesh as M
from ..operators import scenes as N
from ..operators import surfaces as S
from ..sources import adapters as A
from .shape_queries import _BOX, _boxes

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_GRID = "SELECT 4 AS l, (event_id % 32)::INT AS x, (event_id // 32 % 16)::INT AS y, event_id AS vid, (event_id % 32) * 11.25::DOUBLE - 180 + 11.25::DOUBLE * (event_id * 7 % 5) / 4 AS lon, (event_id // 32 % 16) * 11.25::DOUBLE - 90 + 11.25::DOUBLE * (event_id * 11 % 9) / 8 AS lat, value AS h FROM events"


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of events on a lattice within tiles of depth 4, the tiles' sides included."""
    i = F.col("event_id")
    x, y = i % 32, F.expr("event_id div 32") % 16
    lon, lat = x * 11.25 - 180 + F.lit(11.25) * (i * 7 % 5) / 4, y * 11.25 - 90 + F.lit(11.25) * (i * 11 % 9) / 8
    return A.table(spark, sf_dir, "events").select(F.lit(4).alias("l"), x.cast("int").alias("x"), y.cast("int").alias("y"), i.alias("vid"), lon.alias("lon"), lat.alias("lat"), F.col("value").alias("h"))


_SIDES = "b AS (SELECT *, x * 11.25::DOUBLE - 180 AS w, y * 11.25::DOUBLE - 90 AS s FROM g), e AS (SELECT l, x, y, vid, 0 AS side, -lat AS along FROM b WHERE abs(lon - w) < 1e-13 UNION ALL SELECT l, x, y, vid, 1, -lat FROM b WHERE abs(lon - w - 11.25) < 1e-13 UNION ALL SELECT l, x, y, vid, 2, lon FROM b WHERE abs(lat - s - 11.25) < 1e-13 UNION ALL SELECT l, x, y, vid, 3, lon FROM b WHERE abs(lat - s) < 1e-13)"


@query(f"WITH g AS ({_GRID}), {_SIDES} SELECT x, y, vid, side::INT AS side, (row_number() OVER (PARTITION BY l, x, y, side ORDER BY along, vid) - 1)::INT AS rank FROM e")
def border_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice points on their tiles' sides, ranked along each."""
    return S.border_vertices(_grid(spark, sf_dir)).select("x", "y", "vid", "side", F.col("rank").cast("int").alias("rank"))


@query(f"""WITH g AS ({_GRID}), {_SIDES}, k AS (SELECT *, row_number() OVER (PARTITION BY l, x, y, side ORDER BY along, vid) AS r FROM e), a AS (SELECT * FROM k WHERE side = 1), c AS (SELECT l, x - 1 AS x, y, r, along FROM k WHERE side = 0)
  SELECT coalesce(a.x, c.x)::INT AS x, coalesce(a.y, c.y)::INT AS y, count(*) AS pairs, count(a.r) AS own, count(c.r) AS next, round(max(abs(a.along - c.along)), 6) + 0 AS apart FROM a FULL JOIN c USING (l, x, y, r) GROUP BY coalesce(a.x, c.x), coalesce(a.y, c.y)""".replace("coalesce(a.x, c.x)", "x").replace("coalesce(a.y, c.y)", "y"))
def border_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the points on tiles' eastern sides pair with those on the next ones' western sides."""
    z = S.zipped_borders(_grid(spark, sf_dir))
    return z.groupBy("x", "y").agg(F.count("*").alias("pairs"), F.count("lat").alias("own"), F.count("lat2").alias("next"), (F.round(F.max("apart"), 6) + 0.0).alias("apart"))


@query(f"WITH g AS ({_GRID}) SELECT round(lon, 6) AS lon, round(lat, 6) AS lat, round(avg(h), 6) AS h, count(*) AS tiles FROM g GROUP BY lon, lat")
def stitched_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice points of all tiles as one mesh's vertices."""
    g = _grid(spark, sf_dir)
    t = g.select("l", "x", "y", F.col("vid").alias("tid"), *(F.col("vid").alias(f"v{k}") for k in range(3))).limit(0)
    return S.stitched(g, t)[0].select(*(F.round(c, 6).alias(c) for c in ("lon", "lat", "h")), "tiles")


@query(f"""WITH g AS ({_GRID}), n AS (SELECT *, lon + 5e-9::DOUBLE * (vid % 3 - 1) AS lon1, x * 11.25::DOUBLE - 180 AS w FROM g)
  SELECT vid, abs(lon1 - w) < 1e-8 OR abs(lon1 - w - 11.25) < 1e-8 AS snapped, CASE WHEN abs(lon1 - w) < 1e-8 THEN w WHEN abs(lon1 - w - 11.25) < 1e-8 THEN w + 11.25 ELSE round(lon1, 7) END AS lon FROM n""")  # fmt: skip
def clamped_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points next to their tiles' sides, brought onto them."""
    g = _grid(spark, sf_dir).withColumn("lon", F.col("lon") + 5e-9 * (F.col("vid") % 3 - 1)).withColumn("was", F.col("lon"))
    box = T.extent(F.col("l"), F.col("x"), F.col("y"))
    c = S.clamped(g)
    on = (F.col("lon") == box["min_lon"]) | (F.col("lon") == box["max_lon"])
    return c.select("vid", on.alias("snapped"), F.when(on, F.col("lon")).otherwise(F.round("lon", 7)).alias("lon"))


def _tile(axis: str, at: str) -> str:
    return f"greatest(0, least(floor(({at} + {180 if axis == 'x' else 90}) / 11.25::DOUBLE), {31 if axis == 'x' else 15}))"


@query(f"""{A.oracle('tri')}, o AS (SELECT *, {_tile('x', '(x0 + x1 + x2) / 3.0::DOUBLE')} AS tx, {_tile('y', '(y0 + y1 + y2) / 3.0::DOUBLE')} AS ty FROM tri), b AS (SELECT *, tx * 11.25::DOUBLE - 180 AS w, ty * 11.25::DOUBLE - 90 AS s FROM o)
  SELECT tx::INT AS x, ty::INT AS y, count(*) AS n, count_if(abs(x0 - w) < 1e-13 AND abs(x2 - w) < 1e-13) AS on_left, count_if(abs(y0 - s) < 1e-13 AND abs(y1 - s) < 1e-13) AS on_down FROM b GROUP BY tx, ty""")  # fmt: skip
def owned_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles by owner tile at depth 4, and how many have a side on the tile's western or southern one."""
    t = S.separated(A.triangles(spark, sf_dir), 4)
    side = lambda k, name: F.count_if(F.col(f"class{k}") == S.CLASSES[name])
    return t.groupBy("x", "y").agg(F.count("*").alias("n"), side(2, "LEFT").alias("on_left"), side(0, "DOWN").alias("on_down"))


@query("""WITH o AS (SELECT l_orderkey % 64 AS l, l_partkey % 50 AS x, sum(l_quantity) AS h FROM lineitem GROUP BY ALL), n AS (SELECT s_suppkey % 64 AS l, s_nationkey AS x, sum(s_acctbal) AS h FROM supplier GROUP BY ALL)
  SELECT l, x::BIGINT AS x, round(h, 4) AS h FROM n UNION ALL SELECT l, x, round(h, 4) FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l = o.l AND n.x = o.x)""")
def replaced_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state of tiles with those that came again in place of the old ones."""
    old = A.table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 64).alias("l"), (F.col("l_partkey") % 50).alias("x")).agg(F.round(F.sum("l_quantity"), 4).alias("h"))
    new = A.table(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 64).alias("l"), F.col("s_nationkey").cast("long").alias("x")).agg(F.round(F.sum("s_acctbal"), 4).alias("h"))
    return S.upserted(old, new, ["l", "x"])


@query("""WITH s AS (SELECT s_nationkey::BIGINT AS k, max(s_acctbal) AS h FROM supplier WHERE s_suppkey % 3 = 0 GROUP BY 1), w AS (SELECT DISTINCT n_nationkey::BIGINT AS k FROM nation)
  SELECT k, CASE WHEN s.k IS NULL THEN -1.0::DOUBLE ELSE h END AS h, s.k IS NOT NULL AS loaded FROM w LEFT JOIN s USING (k)""".replace("s.k IS", "h IS"))
def loaded_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with their state, or the initial one."""
    state = A.table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").groupBy(F.col("s_nationkey").cast("long").alias("k")).agg(F.max("s_acctbal").alias("h"))
    wanted = A.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    return S.loaded_or(wanted, state, {"h": F.lit(-1.0)}, ["k"])


_EDGES = "e AS (SELECT face, v0 AS a, v1 AS b FROM face UNION ALL SELECT face, v1, v2 FROM face UNION ALL SELECT face, v2, v0 FROM face), u AS (SELECT least(a, b) AS lo, greatest(a, b) AS hi, count(*) AS n, count_if(a < b) AS up FROM e GROUP BY 1, 2)"


@query(f"""{A.oracle('face')}, {_EDGES} SELECT (SELECT count(*) FROM face) AS faces, (SELECT count_if(v0 = v1 OR v1 = v2 OR v2 = v0) FROM face) AS repeated, (SELECT count_if(n > 1) FROM (SELECT count(*) AS n FROM face GROUP BY list_sort([v0, v1, v2]))) AS again, count_if(n > 2) AS crowded, count_if(n = 2 AND up <> 1) AS turned, count_if(n = 1) AS border FROM u""")
def mesh_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mesh of line items has that a mesh should not."""
    return S.integrity(A.faces(spark, sf_dir))


@query(f"{A.oracle('face')}, c AS (SELECT face % 10 AS part, face, v FROM (SELECT face, unnest([v0, v1, v2]) AS v FROM face)) SELECT part, count(DISTINCT face) AS faces, count(DISTINCT v) AS vertices FROM c GROUP BY part")
def mesh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces and corners of ten parts of a mesh."""
    return S.counts(A.faces(spark, sf_dir).withColumn("part", F.col("face") % 10), ["part"])


@query(f"{A.oracle('face')} SELECT v AS vertex, count(*) AS faces, sum(k)::BIGINT AS places FROM (SELECT unnest([v0, v1, v2]) AS v, unnest([0, 1, 2]) AS k FROM face) GROUP BY v")
def faces_of_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corners with the number of their faces."""
    return S.vertex_faces(A.faces(spark, sf_dir)).groupBy("vertex").agg(F.count("*").alias("faces"), F.sum("k").alias("places"))


@query(f"""{A.oracle('tri')}, n AS (SELECT (y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS nx, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS ny, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS nz FROM tri),
  u AS (SELECT sum(nx / s) AS x, sum(ny / s) AS y, sum(nz / s) AS z FROM (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) AS s FROM n)) SELECT round(x / sqrt(x * x + y * y + z * z), 6) + 0 AS x, round(y / sqrt(x * x + y * y + z * z), 6) + 0 AS y, round(z / sqrt(x * x + y * y + z * z), 6) + 0 AS z FROM u""")  # fmt: skip
def mean_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean direction of all faces."""
    return S.mean_normal(A.triangles(spark, sf_dir)).select(*((F.round(c, 6) + 0.0).alias(c) for c in "xyz"))


@query(f"{A.oracle('tri')}, b AS (SELECT id AS number, 3 AS size, {_BOX} FROM tri) SELECT sum(size)::BIGINT AS size, {', '.join(f'{m}({m}_{a}) AS {m}_{a}' for m in ('min', 'max') for a in 'xyz')}, max(number) AS number FROM b")
def combined_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header of all triangles' boxes."""
    return S.combined_headers(_boxes(spark, sf_dir).select(F.col("id").alias("number"), F.lit(3).alias("size"), *B.SIDES))


@query("SELECT count_if(event_type = 'signup') AS info, count_if(event_type = 'click') AS warn, count_if(event_type = 'error') AS error, count_if(event_type = 'view') AS fatal FROM events")
def report_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by severity."""
    level = F.when(F.col("event_type") == "signup", "info").when(F.col("event_type") == "click", "WARN").when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "Fatal")
    return S.report_counts(A.table(spark, sf_dir, "events").select(level.alias("level")))


@query(f"{A.oracle('pts', 'ras')} SELECT p.id, min(r.raster) AS extent FROM pts p LEFT JOIN ras r ON p.lon BETWEEN r.min_lon AND r.max_lon AND p.lat BETWEEN r.min_lat AND r.max_lat GROUP BY p.id")
def first_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first raster that holds each point."""
    r = A.rasters(spark, sf_dir).withColumnRenamed("raster", "id")
    return S.first_extent(A.points(spark, sf_dir), r).select("id", "extent")


@query(f"""{A.oracle('tri')}, e AS (SELECT id, (x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0) AS f, (z1 - z0) * (z1 - z0) AS h, (x0 + x1) / 2.0::DOUBLE AS m, (z1 - z0) AS dz, x0 + 0.25::DOUBLE * (x1 - x0) AS q FROM tri)
  SELECT id, round(f, 6) AS flat2, round(f + h, 4) AS length2, round(m, 6) + 0 AS mid_x, round(dz / sqrt(f + h), 5) + 0 AS dir_z, round(q, 6) + 0 AS quarter FROM e""")  # fmt: skip
def edge_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of each triangle's first edge, and the point at a quarter of it."""
    e = A.triangles(spark, sf_dir).select("id", *(F.col(f"{c}{k}").alias(f"{n}{c}") for k, n in enumerate("ab") for c in "xyz"))
    m = S.edge_measures()
    r = lambda c, p: F.round(c, p) + 0.0
    return e.select("id", r(m["flat2"], 6).alias("flat2"), r(m["length2"], 4).alias("length2"), r(m["mid_x"], 6).alias("mid_x"), r(m["dir_z"], 5).alias("dir_z"), r(S.point_on_edge(F.lit(0.25))["x"], 6).alias("quarter"))


_NEAR = "SELECT vec_id AS vertex, floor(embedding[1]::DOUBLE * 20) / 20 + 0.001::DOUBLE * (vec_id % 3) AS x, floor(embedding[2]::DOUBLE * 20) / 20 AS y, floor(embedding[3]::DOUBLE * 20) / 20 AS z FROM embeddings"


@query(f"""WITH RECURSIVE p AS MATERIALIZED ({_NEAR}), l AS MATERIALIZED (SELECT a.vertex AS a, b.vertex AS b FROM p a JOIN p b ON abs(a.x - b.x) <= 0.0015 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= 0.0015::DOUBLE * 0.0015::DOUBLE),
  r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b) SELECT a AS vertex, min(b) AS root FROM r GROUP BY a""")  # fmt: skip
def welded_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as points, those within 1.5 mm of each other as one."""
    e = lambda k: F.floor(F.get("embedding", F.lit(k)).cast("double") * 20) / 20
    p = A.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("vertex"), (e(0) + 0.001 * (F.col("vec_id") % 3)).alias("x"), e(1).alias("y"), e(2).alias("z"))
    return S.weld(p, 0.0015)


@query(f"{A.oracle('face')} SELECT face, face * 3 + 2 AS vertex, v2 AS was FROM face")
def unwelded_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every face's third corner under a number of its own."""
    own, _ = S.unwelded(A.faces(spark, sf_dir))
    return own.where("vertex % 3 = 2").select(F.expr("vertex div 3").alias("face"), "vertex", "was")


_NODES = "n AS (SELECT s_suppkey AS node, s_suppkey // 3 AS parent, s_nationkey::DOUBLE AS dx, s_suppkey % 7 AS dy FROM supplier)"


@query(f"""WITH RECURSIVE {_NODES}, t AS (SELECT node, node AS root, 0 AS depth, dx AS x, dy::DOUBLE AS y FROM n WHERE parent NOT IN (SELECT node FROM n) UNION ALL SELECT n.node, t.root, t.depth + 1, t.x + n.dx, t.y + n.dy FROM n JOIN t ON n.parent = t.node AND n.node <> t.node)
  SELECT node, root, depth::INT AS depth, round(x, 6) + 0 AS x, round(y, 6) + 0 AS y FROM t""")  # fmt: skip
def world_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a tree of nodes that each shift what is below: where each comes to stand."""
    s = A.table(spark, sf_dir, "supplier")
    one = [F.lit(1.0 if k % 5 == 0 else 0.0) for k in range(12)]
    nodes = s.select(F.col("s_suppkey").alias("node"), F.expr("s_suppkey div 3").alias("parent"), F.array(*one, F.col("s_nationkey").cast("double"), (F.col("s_suppkey") % 7).cast("double"), F.lit(0.0), F.lit(1.0)).alias("matrix"))
    w = N.world_matrices(nodes)
    x, y, _ = V.applied(F.col("matrix"), (F.lit(0.0), F.lit(0.0), F.lit(0.0)))
    return w.select("node", "root", "depth", (F.round(x, 6) + 0.0).alias("x"), (F.round(y, 6) + 0.0).alias("y"))


@query("SELECT l_orderkey AS node, (count(*) // 3)::BIGINT AS faces FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 3")
def index_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces of index lists, three by three."""
    p = A.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("node")).agg(F.sort_array(F.collect_list(F.col("l_linenumber").cast("int"))).alias("indices"))
    return N.triangulated(p).groupBy("node").agg(F.count("*").alias("faces"))


@query(f"{A.oracle('tri')}, b AS (SELECT id, {_BOX} FROM tri) SELECT id, count(*) AS boxes, round(sum((max_x - min_x) * (max_y - min_y) * (max_z - min_z)), 7) + 0 AS volume FROM b GROUP BY id")
def box_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume within the twelve faces of each triangle's box."""
    t = N.boxes_as_triangles(_boxes(spark, sf_dir).select("id", *B.SIDES))
    v = N.signed_volume(t)
    return v.join(t.groupBy("id").agg((F.count("*") / 12).cast("long").alias("boxes")), "id").select("id", "boxes", (F.round("volume", 7) + 0.0).alias("volume"))


_OCT = "p AS (SELECT p_partkey AS id, (p_partkey * 37 % 1000) / 1000.0::DOUBLE AS x, (p_size * 19 % 50) / 50.0::DOUBLE AS y, (p_partkey % 13) / 13.0::DOUBLE AS z FROM part)"


@query(f"""WITH {_OCT}, c AS (SELECT id, d, floor(x * pow(2, d))::INT AS cx, floor(y * pow(2, d))::INT AS cy, floor(z * pow(2, d))::INT AS cz FROM p, range(0, 6) AS t(d)), n AS (SELECT d, cx, cy, cz, count(*) AS n FROM c GROUP BY ALL),
  f AS (SELECT id, d, cx, cy, cz FROM c JOIN n USING (d, cx, cy, cz) WHERE n <= 20 OR d = 5), m AS (SELECT id, min(d) AS d FROM f GROUP BY id) SELECT id, d::INT AS leaf_depth, cx AS ix, cy AS iy, cz AS iz FROM m JOIN f USING (id, d)""")  # fmt: skip
def octree_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as points in an octree of at most 20 a leaf."""
    k = F.col("p_partkey")
    p = A.table(spark, sf_dir, "part").select(k.alias("id"), ((k * 37 % 1000) / 1000.0).alias("x"), ((F.col("p_size") * 19 % 50) / 50.0).alias("y"), ((k % 13) / 13.0).alias("z"))
    return N.octree_leaves(p, (0.0, 0.0, 0.0), 1.0, 20, 5).select("id", "leaf_depth", "ix", "iy", "iz")


@query(f"""{A.oracle('tri')}, c AS ({' UNION ALL '.join(f'SELECT id, x{k} AS x, y{k} AS y, z{k} AS z FROM tri' for k in range(3))}), g AS (SELECT floor(x / 30.0::DOUBLE + 0.000001::DOUBLE) AS ix, floor(y / 30.0::DOUBLE + 0.000001::DOUBLE) AS iy, floor(z / 30.0::DOUBLE + 0.000001::DOUBLE) AS iz, count(*) AS n FROM c GROUP BY 1, 2, 3) SELECT count_if(n >= 2) AS clusters, sum(n)::BIGINT AS corners FROM g""")
def cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of 30 that corners of a remeshed surface fall in."""
    t = A.triangles(spark, sf_dir)
    corners = t.count() * 3
    vertices, _ = N.remeshed(t.withColumn("id", F.monotonically_increasing_id()), 30.0)
    index = lambda c: F.floor(F.col(c) / 30.0 + 1e-6)
    return vertices.select(index("x").alias("i")).agg(F.count("*").alias("clusters")).withColumn("corners", F.lit(corners).cast("long"))


@query(f"""{A.oracle('tri')}, a AS (SELECT *, abs((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0)) / 2.0::DOUBLE AS area FROM tri) SELECT round(sum(area), 3) AS area FROM a""")
def grid_cut_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of all parts after cutting by a grid of 2 x 2 x 1 cells: nothing is lost."""
    parts = N.cut_by_boxes(A.triangles(spark, sf_dir), (-180.0, -90.0, -1e9), 180.0, (2, 1, 1))
    area = F.abs((F.col("x1") - F.col("x0")) * (F.col("y2") - F.col("y0")) - (F.col("x2") - F.col("x0")) * (F.col("y1") - F.col("y0"))) / 2.0
    return parts.agg(F.round(F.sum(area), 3).alias("area"))


@query(f"{A.oracle('face')}, c AS (SELECT *, face % 4 AS class FROM face) SELECT class::INT AS class, count(*) AS n FROM (SELECT class FROM c WHERE class IN (0, 2) UNION ALL SELECT 9 FROM c WHERE class = 2) GROUP BY class")
def class_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces of two classes, one of them again under another."""
    f = A.faces(spark, sf_dir).withColumn("class", (F.col("face") % 4).cast("int"))
    return N.copied(N.of_classes(f, [0, 2]), 2, 9).groupBy("class").agg(F.count("*").alias("n"))
