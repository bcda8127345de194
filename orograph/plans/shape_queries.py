"""Queries of vectors, boxes, octree coordinates, tile schemes, codes and text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import codes as C
from ..functions import geodesy as G
from ..functions import numbers as N
from ..functions import plane2d as L
from ..functions import tiles as T
from ..functions import vectors3d as V
from ..operators import mesh as M
from ..operators import ranges as R
from ..sources import adapters as A

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_D = "0.017453292519943296::DOUBLE"


def _rounded(places: int, **columns: Column) -> list[Column]:
    return [(F.round(c, places) + 0.0).alias(k) for k, c in columns.items()]


@query(f"""{A.oracle('pts')}, v AS (SELECT id, cos(lat * {_D}) * cos(lon * {_D}) AS x, cos(lat * {_D}) * sin(lon * {_D}) AS y, sin(lat * {_D}) AS z FROM pts WHERE abs(lat) < 89.9 AND lon > -180)
  SELECT id, round(x, 6) + 0 AS x, round(y, 6) + 0 AS y, round(z, 6) + 0 AS z, round(degrees(atan2(y, x)), 6) + 0 AS lon, round(degrees(atan2(z, sqrt(x * x + y * y))), 6) + 0 AS lat FROM v""")  # fmt: skip
def sphere_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directions of points on the sphere, and back."""
    p = A.points(spark, sf_dir).where((F.abs("lat") < 89.9) & (F.col("lon") > -180))
    v = p.select("id", *(c.alias(a) for a, c in zip("xyz", V.to_sphere(F.col("lon"), F.col("lat")))))
    lon, lat = V.from_sphere((F.col("x"), F.col("y"), F.col("z")))
    return v.select("id", *_rounded(6, x=F.col("x"), y=F.col("y"), z=F.col("z"), lon=lon, lat=lat))


_SIDES = "sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1)) AS a, sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)) AS b, sqrt((x2 - x0) * (x2 - x0) + (y2 - y0) * (y2 - y0)) AS c"


@query(f"""{A.oracle('tri')}, s AS (SELECT *, {_SIDES} FROM tri), h AS (SELECT *, (a + b + c) / 2.0::DOUBLE AS s FROM s)
  SELECT id, round(acos(((x0 - x1) * (x2 - x1) + (y0 - y1) * (y2 - y1)) / (a * b)), 5) AS corner, round(((x1 - x0) * (y2 - y1) - (y1 - y0) * (x2 - x1)) / (a * b), 5) AS turn,
   round(greatest(a, b, c) / (2.0::DOUBLE * sqrt(s * (s - a) * (s - b) * (s - c)) / greatest(a, b, c)), 4) AS aspect FROM h""")  # fmt: skip
def triangle_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each triangle's corner at its second vertex, the turn there, and its longest side over the height on it."""
    p = [(F.col(f"x{k}"), F.col(f"y{k}")) for k in range(3)]
    t = A.triangles(spark, sf_dir)
    return t.select("id", *_rounded(5, corner=V.corner_angle(*p), turn=V.cross2(*p)), *_rounded(4, aspect=V.aspect_ratio(M.side(0, 1), M.side(1, 2), M.side(2, 0))))


_N = "(y1 - y0) * (z2 - z0) - (z1 - z0) * (y2 - y0) AS nx, (z1 - z0) * (x2 - x0) - (x1 - x0) * (z2 - z0) AS ny, (x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0) AS nz"


@query(f"""{A.oracle('tri')}, n AS (SELECT *, {_N} FROM tri), f AS (SELECT *, abs(nx::FLOAT) AS ax, abs(ny::FLOAT) AS ay, abs(nz::FLOAT) AS az, sqrt(nx * nx + ny * ny + nz * nz) AS size FROM n)
  SELECT id, CASE WHEN ax >= ay AND ax >= az THEN CASE WHEN nx >= 0 THEN 'YZ' ELSE 'YZNEG' END WHEN ay >= ax AND ay >= az THEN CASE WHEN ny >= 0 THEN 'XZ' ELSE 'XZNEG' END ELSE CASE WHEN nz >= 0 THEN 'XY' ELSE 'XYNEG' END END AS plane,
   nz / size > 0.9::DOUBLE AS ceiling, round(-(nx * (x0 + 0.05::DOUBLE) + ny * (y0 + 0.02::DOUBLE) + -(nx * x0 + ny * y0 + nz * z0)) / nz, 3) + 0 AS height FROM f""")  # fmt: skip
def face_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plane that each face is projected to, whether it is nearly level, and its height beside its first corner."""
    plane = M.plane()
    n = plane[:3]
    height = V.plane_height(plane, F.col("x0") + 0.05, F.col("y0") + 0.02)
    return A.triangles(spark, sf_dir).select("id", V.best_plane(n).alias("plane"), V.is_ceiling(G.unit(n)).alias("ceiling"), *_rounded(3, height=height))


_VIEWS = ", ".join(f"({k}, '{name}', {x / (x * x + y * y + z * z) ** 0.5!r}::DOUBLE, {y / (x * x + y * y + z * z) ** 0.5!r}::DOUBLE, {z / (x * x + y * y + z * z) ** 0.5!r}::DOUBLE)" for k, (name, (x, y, z)) in enumerate((n, d) for n, d in V.DIRECTIONS.items() if "_" in n))


@query(f"""{A.oracle('tri')}, n AS MATERIALIZED (SELECT id, row_number() OVER () AS r, {_N} FROM tri WHERE id % 7 = 0), d(k, name, dx, dy, dz) AS (VALUES {_VIEWS}),
  r AS (SELECT n.id, name, row_number() OVER (PARTITION BY n.r ORDER BY round(-(nx * dx + ny * dy + nz * dz) / sqrt(nx * nx + ny * ny + nz * nz), 9) DESC, k) AS p FROM n, d)
  SELECT name AS direction, count(*) AS n, sum(id)::BIGINT AS ids FROM r WHERE p = 1 GROUP BY name""")  # fmt: skip
def view_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the faces whose id is divisible by 7 each slanting camera looks at most straight."""
    n = G.unit(M.plane()[:3])
    t = A.triangles(spark, sf_dir).where("id % 7 = 0").select("id", V.oblique_direction(n).alias("direction"))
    return t.groupBy("direction").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


_BOX = ", ".join(f"{f}({a}0, {a}1, {a}2) AS {m}_{a}" for m, f in (("min", "least"), ("max", "greatest")) for a in "xyz")


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [(F.least if m == "min" else F.greatest)(*(F.col(f"{a}{k}") for k in range(3))).alias(f"{m}_{a}") for m in ("min", "max") for a in "xyz"]
    return A.triangles(spark, sf_dir).select("*", *sides)


@query(f"""{A.oracle('tri')}, b AS (SELECT *, {_BOX} FROM tri)
  SELECT id, round((min_x + max_x) / 2.0::DOUBLE, 6) AS cx, round((max_x - min_x) * (max_y - min_y) * (max_z - min_z), 8) AS volume, round(sqrt(pow(max_x - min_x, 2) + pow(max_y - min_y, 2) + pow(max_z - min_z, 2)), 6) AS diagonal,
   round(sqrt(pow(max_x - min_x, 2) + pow(max_y - min_y, 2)), 6) AS flat, round(min_x + greatest(max_x - min_x, max_y - min_y, max_z - min_z), 6) AS cube_x, round(2.0::DOUBLE * (max_x - min_x + max_y - min_y), 6) AS perimeter, round((max_x - min_x) * (max_y - min_y), 6) AS area,
   min_x < max_x AND min_y < max_y AND min_z < max_z AS sound, min_x - 1.0::DOUBLE <= x1 + 0.5::DOUBLE AND max_x + 1.0::DOUBLE >= x1 + 0.5::DOUBLE AND min_y - 1.0::DOUBLE <= y1 AND max_y + 1.0::DOUBLE >= y1 AS holds FROM b""")  # fmt: skip
def box_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of each triangle's box."""
    b = B.box()
    flat = {s: c for s, c in b.items() if s[-1] != "z"}
    measures = {"cx": B.centre(b)["x"], "diagonal": B.diagonal(b), "flat": B.flat_diagonal(b), "cube_x": B.cube(b)["max_x"], "perimeter": B.rectangle_perimeter(flat), "area": B.rectangle_area(flat)}
    return _boxes(spark, sf_dir).select("id", *_rounded(6, **measures), *_rounded(8, volume=B.volume(b)), B.is_sound(b).alias("sound"), B.holds(B.grown(flat, 1.0), (F.col("x1") + 0.5, F.col("y1"))).alias("holds"))


@query(f"""{A.oracle('ext')}, p AS (SELECT a.id, greatest(a.min_lon, b.min_lon) AS w, greatest(a.min_lat, b.min_lat) AS s, least(a.max_lon, b.max_lon) AS e, least(a.max_lat, b.max_lat) AS n FROM ext a JOIN ext b ON b.id = a.id + 97)
  SELECT id, round(w, 6) + 0 AS w, round(s, 6) + 0 AS s, round(e, 6) + 0 AS e, round(n, 6) + 0 AS n FROM p WHERE w < e AND s < n""")  # fmt: skip
def shared_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What extents whose ids are 97 apart share."""
    e = A.extents(spark, sf_dir)
    as_box = lambda k: {f"{m}_{a}": F.col(f"{k}.{m}_{g}") for m in ("min", "max") for a, g in (("x", "lon"), ("y", "lat"))}
    both = e.alias("a").join(e.alias("b"), F.col("b.id") == F.col("a.id") + 97)
    got = both.select("a.id", B.shared(as_box("a"), as_box("b")).alias("s")).where("s IS NOT NULL")
    return got.select("id", *_rounded(6, w=F.col("s.min_x"), s=F.col("s.min_y"), e=F.col("s.max_x"), n=F.col("s.max_y")))


@query(f"""{A.oracle('tri')}, b AS (SELECT *, {_BOX} FROM tri WHERE id % 5 = 0), n AS (SELECT *, {_N} FROM b)
  SELECT id, true AS own, (SELECT min(v) <= 0 AND max(v) >= 0 FROM (SELECT nx * (px - x0) + ny * (py - y0) + nz * (pz - z0 - 2.73::DOUBLE) AS v FROM (VALUES (min_x), (max_x)) AS a(px), (VALUES (min_y), (max_y)) AS c(py), (VALUES (min_z), (max_z)) AS d(pz))) AS lifted FROM n""")  # fmt: skip
def box_meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fifth triangle's box: it meets its own triangle; does it meet that one's plane lifted by 2.73 metres?"""
    b, (a, bb, c, d) = B.box(), M.plane()
    corners = [M.corner(k) for k in range(3)]
    rows = _boxes(spark, sf_dir).where("id % 5 = 0")
    return rows.select("id", B.meets_triangle(b, corners).alias("own"), B.meets_plane(b, (a, bb, c, d - c * 2.73)).alias("lifted"))


@query(f"""{A.oracle('vox')} SELECT seq, (ix // 2 * 100 + iy // 2 * 10 + iz // 2)::INT AS parent, ix + 8 * iy + 64 * iz::BIGINT AS number, (CASE WHEN ix % 2 = 1 THEN CASE WHEN iy % 2 = 1 THEN 2 ELSE 1 END ELSE CASE WHEN iy % 2 = 1 THEN 3 ELSE 0 END END + 4 * (iz % 2))::INT AS child,
  (ix // 4 * 100 + iy // 4 * 10 + iz // 4)::INT AS top, (ix - 1)::INT AS left_x, (iz + 1)::INT AS top_z, round(alpha / 255.0::DOUBLE, 6) AS share FROM vox""")  # fmt: skip
def octree_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each voxel as an octree coordinate of depth 3: parent, numbers, the path's second step and neighbours."""
    c = (F.lit(3), F.col("ix"), F.col("iy"), F.col("iz"))
    _, px, py, pz = B.octree_parent(c)
    path, beside = B.octree_path(c), B.octree_neighbours(c)
    top = F.get(path, F.lit(1))
    return A.voxels(spark, sf_dir).select("seq", (px * 100 + py * 10 + pz).cast("int").alias("parent"), B.octree_number(c).alias("number"), B.octree_child(c).alias("child"), (top["x"] * 100 + top["y"] * 10 + top["z"]).cast("int").alias("top"), F.get(beside, F.lit(0))["x"].cast("int").alias("left_x"), F.get(beside, F.lit(4))["z"].cast("int").alias("top_z"), *_rounded(6, share=B.alpha_share(F.col("alpha"))))


@query("SELECT level::INT AS level, CASE WHEN level = 0 THEN 0 ELSE (1 << level) END::INT AS error, CASE level WHEN 0 THEN 0 WHEN 1 THEN 8 WHEN 2 THEN 50 ELSE (level - 1) * 60 END::INT AS block_error, round(CASE WHEN level < 6 THEN pow(0.5::DOUBLE, level) ELSE 0.01625::DOUBLE * pow(0.5::DOUBLE, level - 6) END, 12) AS texture_scale FROM range(24) AS t(level)")
def detail_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of levels of detail."""
    return C.levels_of_detail(spark).withColumn("texture_scale", F.round("texture_scale", 12))


_FORMAT_ROWS = ", ".join(f"({k}, '{n}', '{n.lower()}', '{e}', '{o}')" for k, (n, e, o) in enumerate(C.FORMATS))


@query(f"""WITH f(k, name, lower_name, e, o) AS (VALUES {_FORMAT_ROWS}), asked AS (SELECT DISTINCT lower(p_type) AS t FROM part UNION SELECT e FROM f UNION SELECT o FROM f UNION SELECT lower_name FROM f),
  m AS (SELECT t, name, row_number() OVER (PARTITION BY t ORDER BY k) AS r FROM asked JOIN f ON t IN (lower_name, e, o))
  SELECT t AS extension, CASE t WHEN 'instance' THEN 'I3DM' WHEN 'batch' THEN 'B3DM' WHEN 'pointcloud' THEN 'PNTS' ELSE name END AS format FROM asked LEFT JOIN m USING (t) WHERE r IS NULL OR r = 1""")  # fmt: skip
def formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The formats that names and extensions, and the types of parts, stand for."""
    own = spark.createDataFrame([(t,) for n, e, o in C.FORMATS for t in (n.lower(), e, o)], "extension string")
    asked = own.union(A.table(spark, sf_dir, "part").select(F.lower("p_type"))).distinct()
    return asked.select("extension", C.format_of(F.upper("extension")).alias("format"))


@query(f"SELECT p_partkey AS id, coalesce(list_extract({C.PROFILES!r}, p_size % 7 + 1), 'UNKNOWN') AS profile, coalesce(list_extract({C.TEXTURES!r}, p_size % 25 + 1), 'UNKNOWN') AS texture FROM part")
def code_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles and texture kinds by code, codes beyond the tables too."""
    return A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), C.profile_of(F.col("p_size") % 7).alias("profile"), C.texture_of(F.col("p_size") % 25).alias("texture"))


def _mod_sql(shift: str) -> str:
    v = f"((d * {shift}::FLOAT)::FLOAT * 255.0::FLOAT)::FLOAT"
    return f"(({v}::DOUBLE - 256.0::DOUBLE * floor(({v} / 256.0::FLOAT)::FLOAT::DOUBLE))::FLOAT / 255.0::FLOAT)::FLOAT"


@query(f"""WITH s AS (SELECT event_id AS id, (value / 500.0::DOUBLE)::FLOAT AS d FROM events), m AS (SELECT id, {', '.join(f'{_mod_sql(s)} AS r{k}' for k, s in enumerate(('16777216.0', '65536.0', '256.0', '1.0')))} FROM s)
  SELECT id, trunc((r3 - (r2 * 0.00390625::FLOAT)::FLOAT)::FLOAT * 255.0::FLOAT)::INT AS c0, trunc((r2 - (r1 * 0.00390625::FLOAT)::FLOAT)::FLOAT * 255.0::FLOAT)::INT AS c1 FROM m""")  # fmt: skip
def packed_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two coarse channels of values packed as depths."""
    e = A.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), C.packed_depth(F.col("value") / 500.0).alias("c"))
    return e.select("id", F.get("c", F.lit(0)).alias("c0"), F.get("c", F.lit(1)).alias("c1"))


@query("""WITH s AS (SELECT event_id AS id, (value * 100000.0::DOUBLE)::BIGINT AS ms, event_type || '.' || event_id || CASE WHEN event_id % 3 = 0 THEN '.tar' ELSE '' END AS file FROM events)
  SELECT id, concat_ws(' ', CASE WHEN ms >= 3600000 THEN (ms // 3600000) || 'h' END, CASE WHEN ms >= 60000 THEN (ms // 60000 % 60) || 'm' END, CASE WHEN ms >= 1000 THEN (ms // 1000 % 60) || 's' END, (ms % 1000) || 'ms') AS took,
   split_part(file, '.', -1) AS extension, left(file, length(file) - 1 - length(split_part(file, '.', -1))) AS stem, regexp_full_match(split_part(file, '.', -1), '[0-9]+') AS number, length(file) + (4 - length(file) % 4) % 4 AS padded FROM s""")  # fmt: skip
def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in words, file names in parts, texts padded to four bytes."""
    tar = F.when(F.col("event_id") % 3 == 0, ".tar").otherwise("")
    s = A.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.round(F.col("value") * 100000.0).cast("long").alias("ms"), F.concat("event_type", F.lit("."), F.col("event_id").cast("string"), tar).alias("file"))
    return s.select("id", C.milliseconds(F.col("ms")).alias("took"), C.extension(F.col("file")).alias("extension"), C.without_extension(F.col("file")).alias("stem"), C.is_int(C.extension(F.col("file"))).alias("number"), F.length(C.padded_bytes(F.col("file"))).cast("long").alias("padded"))


@query(f"""{A.oracle('pts')}, a AS (SELECT *, 180.0::DOUBLE / 32 AS a FROM pts)
  SELECT id, floor((lon + 180) / a)::INT AS x, floor((lat + 90) / a)::INT AS y, floor((90 - lat) / a)::INT AS top_y, least(floor((lon + 180) / 360 * 16), 15)::INT AS sx, least(floor((1.0::DOUBLE - (lat + 90) / 180) * 16), 15)::INT AS sy,
   round(90 - a * (floor((90 - lat) / a)::INT + 1), 6) + 0 AS top_south, round(22.5::DOUBLE * least(floor((lon + 180) / 360 * 16), 15) - 180, 6) + 0 AS square_west, round(degrees(atan(sinh(pi() * (1.0::DOUBLE - 2.0::DOUBLE * (id % 32) / 32)))), 6) + 0 AS mercator_north FROM a""")  # fmt: skip
def tile_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each point's tile in the other schemes, and sides of those tiles."""
    d, s = F.lit(5), F.lit(4)
    p = A.points(spark, sf_dir)
    (x, y), (_, top_y), (sx, sy) = T.plain_tile(F.col("lon"), F.col("lat"), d), T.plain_tile(F.col("lon"), F.col("lat"), d, True), T.square_tile(F.col("lon"), F.col("lat"), s)
    sides = {"top_south": T.extent_from_top(d, x, top_y)["min_lat"], "square_west": T.square_extent(s, sx, sy)["min_lon"], "mercator_north": T.mercator_extent(d, x, F.col("id") % 32)["max_lat"]}
    return p.select("id", x.alias("x"), y.alias("y"), top_y.alias("top_y"), sx.alias("sx"), sy.alias("sy"), *_rounded(6, **sides))


_RANGES = "SELECT o_orderkey AS id, 6 AS depth, (o_orderkey % 100)::INT AS min_x, (o_orderkey % 100 + o_custkey % 9)::INT AS max_x, (o_orderkey % 50)::INT AS min_y, (o_orderkey % 50 + o_custkey % 7)::INT AS max_y FROM orders"


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    i = lambda e: e.cast("int")
    return A.table(spark, sf_dir, "orders").select(o.alias("id"), F.lit(6).alias("depth"), i(o % 100).alias("min_x"), i(o % 100 + c % 9).alias("max_x"), i(o % 50).alias("min_y"), i(o % 50 + c % 7).alias("max_y"))


@query(f"""WITH r AS ({_RANGES}), m AS (SELECT id, depth, greatest(0, min_x - 3) AS min_x, max_x - 3 AS max_x, greatest(0, min_y + 2) AS min_y, max_y + 2 AS max_y FROM r),
  p AS (SELECT *, 0 AS part, min_x AS a, least(max_x, 49) AS b FROM m UNION ALL SELECT *, 1, greatest(min_x, 50), max_x FROM m)
  SELECT id, depth, a AS min_x, b AS max_x, min_y, max_y, part, depth = 6 AND 50 BETWEEN a AND b AND 20 BETWEEN min_y AND max_y AS holds FROM p WHERE a <= b""")  # fmt: skip
def range_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges moved by (-3, 2), cut before column 50, and whether they hold a tile."""
    cut = R.split_at(R.moved(_ranges(spark, sf_dir), -3, 2), "x", 50)
    return cut.withColumn("holds", R.holds(F.lit(6), F.lit(50), F.lit(20)))


@query(f"""{A.oracle('pts')}, r AS (SELECT id, lat, h, 6378137.0::DOUBLE / sqrt(1.0::DOUBLE - 0.00669437999014::DOUBLE * sin(lat * {_D}) * sin(lat * {_D})) AS v FROM pts WHERE abs(lat) < 89)
  SELECT id, round(degrees(h / v), 9) AS north, round(degrees(h / (v * cos(lat * {_D}))), 9) AS east FROM r""")  # fmt: skip
def arc_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees that a point's height would go north and east."""
    p = A.points(spark, sf_dir).where(F.abs("lat") < 89)
    return p.select("id", *_rounded(9, north=G.latitude_angle(F.col("lat"), F.col("h")), east=G.longitude_angle(F.col("lat"), F.col("h"))))


def _right_of(a: int, b: int) -> str:
    off = f"((x{b} - x{a}) * (py - y{a}) - (y{b} - y{a}) * (px - x{a})) / sqrt(pow(x{b} - x{a}, 2) + pow(y{b} - y{a}, 2))"
    return f"({off} < -1e-8::DOUBLE)"


@query(f"{A.oracle('tri')}, p AS (SELECT *, x0 + 0.2::DOUBLE AS px, y0 + 0.15::DOUBLE AS py FROM tri) SELECT id FROM p WHERE NOT {_right_of(0, 1)} AND NOT {_right_of(1, 2)} AND NOT {_right_of(2, 0)}")
def points_in_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles that hold a point beside their first corner."""
    p = [(F.col(f"x{k}"), F.col(f"y{k}")) for k in range(3)]
    return A.triangles(spark, sf_dir).where(L.in_triangle(*p, (F.col("x0") + 0.2, F.col("y0") + 0.15))).select("id")


@query(f"""{A.oracle('tri')}, b AS (SELECT *, {_BOX} FROM tri), s AS (SELECT *, greatest(max_x - min_x, max_y - min_y, max_z - min_z) AS scale FROM b), q AS (SELECT id, scale, {', '.join(f'trunc(((({a}1::FLOAT - min_{a}::FLOAT)::FLOAT / scale::FLOAT)::FLOAT * 65535.0::FLOAT)::FLOAT)::INT AS {a}' for a in 'xyz')} FROM s)
  SELECT id, round(scale, 6) AS scale, {', '.join(f'CASE WHEN {a} > 32767 THEN {a} - 65536 ELSE {a} END AS {a}' for a in 'xyz')} FROM q""")  # fmt: skip
def quantised_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each triangle's second corner in 16-bit numbers of its own box."""
    points = F.array(*(F.struct(*(F.col(f"{a}{k}").alias(a) for a in "xyz")) for k in range(3)))
    t = A.triangles(spark, sf_dir).withColumn("q", B.quantisation(points))
    return t.select("id", *_rounded(6, scale=F.col("q.scale")), *(B.quantised(F.col(f"{a}1"), F.col(f"q.{a}"), F.col("q.scale")).alias(a) for a in "xyz"))


@query("""SELECT p_partkey AS id, least(16384, greatest(32, pow(2, ceil(log2(p_partkey)))))::INT AS up, least(16384, greatest(32, pow(2, floor(log2(p_partkey)))))::INT AS down,
  round(CASE WHEN u < 0 THEN u + ceil(-u) WHEN u > 1 THEN u - ceil(u - 1) ELSE u END, 6) + 0 AS u, round(greatest(0.1::DOUBLE, least(0.9::DOUBLE, u)), 6) + 0 AS clamped, trunc(p_retailprice * 0.5::DOUBLE / 2.25::DOUBLE)::INT AS points
  FROM (SELECT *, (p_size - 25) / 7.0::DOUBLE AS u FROM part)""")
def texture_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes as powers of two, coordinates within a texture, points in an area."""
    u = (F.col("p_size") - 25) / 7.0
    key = F.col("p_partkey")
    return A.table(spark, sf_dir, "part").select(key.alias("id"), C.texture_size(key, "up").alias("up"), C.texture_size(key, "down").alias("down"), *_rounded(6, u=C.positive_coordinate(u), clamped=C.clamped_coordinate(u, 0.1)), C.point_count(F.col("p_retailprice"), 0.5, 1.5).alias("points"))


_R2 = f"6378137.0::DOUBLE / sqrt(1.0::DOUBLE - 0.00669437999014::DOUBLE * sin(lat * {_D}) * sin(lat * {_D}))"


@query(f"""{A.oracle('pts')}, v AS (SELECT id, lon * {_D} AS l, lat * {_D} AS b, h, {_R2} AS v FROM pts WHERE id % 4 = 0)
  SELECT id, round((v + h) * cos(b) * cos(l) + 10 * -sin(l) + 20 * -sin(b) * cos(l) + 30 * cos(b) * cos(l), 3) + 0 AS x, round((v + h) * cos(b) * sin(l) + 10 * cos(l) + 20 * -sin(b) * sin(l) + 30 * cos(b) * sin(l), 3) + 0 AS y,
   round((v * (1.0::DOUBLE - 0.00669437999014::DOUBLE) + h) * sin(b) + 20 * cos(b) + 30 * sin(b), 3) + 0 AS z, true AS same FROM v""")  # fmt: skip
def local_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point 10 m east, 20 m north and 30 m above each fourth point, by its frame; turning y to z and back changes nothing."""
    ten = tuple(F.lit(v) for v in (10.0, 20.0, 30.0))
    frame = G.enu_frame(F.col("lon"), F.col("lat"), F.col("h"))
    p = A.points(spark, sf_dir).where("id % 4 = 0").withColumn("m", frame)
    x, y, z = V.applied(F.col("m"), ten)
    return p.select("id", *_rounded(3, x=x, y=y, z=z), V.is_identity(V.multiplied(V.up_axis(1), V.up_axis(-1))).alias("same"))


@query(f"{A.oracle('vox')} SELECT seq, round(ix * 2.5::DOUBLE + 10, 6) AS px, round(iz * 0.5::DOUBLE - 3, 6) + 0 AS pz, round(10 + (ix + 1) * 2.5::DOUBLE, 6) AS max_x FROM vox")
def voxel_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of voxels and the boxes of their cells."""
    low, step = {"x": 10.0, "y": 0.0, "z": -3.0}, {"x": 2.5, "y": 1.0, "z": 0.5}
    i = (F.col("ix"), F.col("iy"), F.col("iz"))
    px, _, pz = B.voxel_position(low, step, *i)
    return A.voxels(spark, sf_dir).select("seq", *_rounded(6, px=px, pz=pz, max_x=B.cell_box(i, low, 2.5)["max_x"]))


@query(f"""{A.oracle('leg')} SELECT id, s IS NULL OR s <> s OR abs(s) < 1e-9 AS invalid, abs(s - 1) < 0.5::DOUBLE AS alike, floor(value * 1e8::DOUBLE) / 1e8::DOUBLE AS cut FROM (SELECT value, value::BIGINT AS id, CASE WHEN value::BIGINT % 60 = 0 THEN 0.0::DOUBLE ELSE value / 100.0::DOUBLE END AS s FROM leg)""")
def number_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors without a direction, values alike, values cut at eight decimals."""
    s = F.when(F.col("value").cast("long") % 60 == 0, 0.0).otherwise(F.col("value") / 100.0)
    return A.legend(spark, sf_dir).select(F.col("value").cast("long").alias("id"), V.is_invalid((s, s, s)).alias("invalid"), V.alike((s,), (F.lit(1.0),), 0.5).alias("alike"), N.cut(F.col("value")).alias("cut"))
