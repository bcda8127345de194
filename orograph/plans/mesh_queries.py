"""Queries of geodesy, tile codecs and meshes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geodesy as G
from ..functions import numbers as N
from ..functions import tiles as T
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


_D, _E2, _R = "0.017453292519943296::DOUBLE", "0.00669437999014::DOUBLE", "6378137.0::DOUBLE"


def _v(lat: str) -> str:
    return f"({_R} / sqrt(1.0::DOUBLE - {_E2} * sin({lat} * {_D}) * sin({lat} * {_D})))"


def _ecef(lon: str, lat: str, h: str) -> tuple[str, str, str]:
    ring = f"(({_v(lat)} + {h}) * cos({lat} * {_D}))"
    return f"({ring} * cos({lon} * {_D}))", f"({ring} * sin({lon} * {_D}))", f"(({_v(lat)} * (1.0::DOUBLE - {_E2}) + {h}) * sin({lat} * {_D}))"


def _rounded(columns: dict, places: int = 6) -> list:
    return [F.round(c, places).alias(k) for k, c in columns.items()]


_X, _Y, _Z = _ecef("lon", "lat", "h")


@query(f"""{A.oracle('pts')}, e AS (SELECT {_x('lon', 3)} AS x, {_y('lat', 3)} AS y, {_X} AS ex, {_Y} AS ey, {_Z} AS ez FROM pts)
  SELECT x, y, {', '.join(f'round({f}(e{c}), 3) AS {f}_{c}' for c in 'xyz' for f in ('min', 'max'))} FROM e GROUP BY x, y""")  # fmt: skip
def ecef_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earth-centred bounding box of each tile's points at depth 3."""
    p = A.points(spark, sf_dir)
    at = dict(zip(("ex", "ey", "ez"), G.ecef(F.col("lon"), F.col("lat"), F.col("h"))))
    rows = p.select(T.tile_x(F.col("lon"), F.lit(3)).alias("x"), T.tile_y(F.col("lat"), F.lit(3)).alias("y"), *(c.alias(k) for k, c in at.items()))
    return rows.groupBy("x", "y").agg(*(F.round(f(f"e{c}"), 3).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))))


@query(f"{A.oracle('pts')} SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat, round(h, 3) AS h FROM pts WHERE abs(lat) < 89.9")
def ecef_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point to earth-centred coordinates and back."""
    p = A.points(spark, sf_dir).where(F.abs("lat") < 89.9)
    lon, lat, h = G.geodetic(*(F.col(c) for c in ("ex", "ey", "ez")))
    e = G.ecef(F.col("lon"), F.col("lat"), F.col("h"))
    turned = p.select("id", *(c.alias(k) for k, c in zip(("ex", "ey", "ez"), e)))
    lon = F.when(F.round(lon, 6) == 180.0, -180.0).otherwise(F.round(lon, 6))
    return turned.select("id", lon.alias("lon"), F.round(lat, 6).alias("lat"), F.round(h, 3).alias("h"))


@query(f"""{A.oracle('pts')}, e AS (SELECT {_x('lon', 3)} AS x, {_y('lat', 3)} AS y, {_X} AS ex, {_Y} AS ey, {_Z} AS ez, h FROM pts),
  b AS (SELECT x, y, (min(ex) + max(ex)) / 2.0::DOUBLE AS cx, (min(ey) + max(ey)) / 2.0::DOUBLE AS cy, (min(ez) + max(ez)) / 2.0::DOUBLE AS cz, sqrt(pow(max(ex) - min(ex), 2) + pow(max(ey) - min(ey), 2) + pow(max(ez) - min(ez), 2)) / 2.0::DOUBLE AS r,
   22.5::DOUBLE * x - 180.0::DOUBLE + 11.25::DOUBLE AS lon, 22.5::DOUBLE * y - 90.0::DOUBLE + 11.25::DOUBLE AS lat FROM e GROUP BY x, y)
  SELECT x, y, round(cx, 3) AS cx, round(cy, 3) AS cy, round(cz, 3) AS cz, round(r, 3) AS radius, round(cx + cos(lat * {_D}) * cos(lon * {_D}) * r, 3) AS hx, round(cy + cos(lat * {_D}) * sin(lon * {_D}) * r, 3) AS hy, round(cz + sin(lat * {_D}) * r, 3) AS hz FROM b""")  # fmt: skip
def bounding_sphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounding sphere of each tile's points and the point above it by which the horizon hides it."""
    e = G.ecef(F.col("lon"), F.col("lat"), F.col("h"))
    rows = A.points(spark, sf_dir).select(T.tile_x(F.col("lon"), F.lit(3)).alias("x"), T.tile_y(F.col("lat"), F.lit(3)).alias("y"), *(c.alias(k) for k, c in zip(("ex", "ey", "ez"), e)))
    box = rows.groupBy("x", "y").agg(*(((F.min(c) + F.max(c)) / 2.0).alias(f"c{c[1]}") for c in ("ex", "ey", "ez")), (F.sqrt(sum((F.max(c) - F.min(c)) * (F.max(c) - F.min(c)) for c in ("ex", "ey", "ez"))) / 2.0).alias("r"))
    side = T.extent(F.lit(3), F.col("x"), F.col("y"))
    up = G.surface_normal((side["min_lon"] + side["max_lon"]) / 2.0, (side["min_lat"] + side["max_lat"]) / 2.0)
    out = {c: F.col(c) for c in ("cx", "cy", "cz")} | {"radius": F.col("r")} | {f"h{c}": F.col(f"c{c}") + u * F.col("r") for c, u in zip("xyz", up)}
    return box.select("x", "y", *_rounded(out, 3))


_OCT = """o AS (SELECT id, nx / (abs(nx) + abs(ny) + abs(nz)) AS u, ny / (abs(nx) + abs(ny) + abs(nz)) AS v, nz FROM n),
  f AS (SELECT id, CASE WHEN nz <= 0 THEN (1.0::DOUBLE - abs(v)) * CASE WHEN u >= 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ELSE u END AS u, CASE WHEN nz <= 0 THEN (1.0::DOUBLE - abs(u)) * CASE WHEN v >= 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ELSE v END AS v FROM o)
  SELECT id, floor((greatest(-1.0::DOUBLE, least(1.0::DOUBLE, u)) * 0.5::DOUBLE + 0.5::DOUBLE) * 255.0::DOUBLE + 0.5::DOUBLE)::INT AS a, floor((greatest(-1.0::DOUBLE, least(1.0::DOUBLE, v)) * 0.5::DOUBLE + 0.5::DOUBLE) * 255.0::DOUBLE + 0.5::DOUBLE)::INT AS b FROM f"""


@query(f"{A.oracle('pts')}, n AS (SELECT id, (id % 21 - 10) / 10.0::DOUBLE AS nx, (id // 21 % 21 - 10) / 10.0::DOUBLE AS ny, (id // 441 % 21 - 10) / 10.0::DOUBLE + 0.05::DOUBLE AS nz FROM pts), {_OCT}")
def oct_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directions on a grid in two bytes each."""
    i = F.col("id")
    n = A.points(spark, sf_dir).select("id", ((i % 21 - 10) / 10.0).alias("nx"), ((F.expr("id div 21") % 21 - 10) / 10.0).alias("ny"), ((F.expr("id div 441") % 21 - 10) / 10.0 + 0.05).alias("nz"))
    a, b = M.oct_bytes(F.col("nx"), F.col("ny"), F.col("nz"))
    return n.select("id", a.alias("a"), b.alias("b"))


_Q = f"""{A.oracle('pts')}, t AS (SELECT {_x('lon', 2)} * 4 + {_y('lat', 2)} AS tile, id, h FROM pts), s AS (SELECT *, min(h) OVER (PARTITION BY tile) AS low, max(h) OVER (PARTITION BY tile) AS high FROM t),
  q AS (SELECT tile, id, CASE WHEN high <= low THEN 0 ELSE trunc((h - low) / (high - low) * 32767.0::DOUBLE)::INT END AS q FROM s)"""  # fmt: skip


def _quantized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.points(spark, sf_dir).select((T.tile_x(F.col("lon"), F.lit(2)) * 4 + T.tile_y(F.col("lat"), F.lit(2))).alias("tile"), "id", "h")
    span = rows.groupBy("tile").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    return rows.join(F.broadcast(span), "tile").select("tile", "id", M.quantized(F.col("h"), F.col("low"), F.col("high")).alias("q"))  # one row for each of 32 tiles


@query(f"{_Q} SELECT * FROM q")
def quantize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point's height in 15 bits between its tile's lowest and highest."""
    return _quantized(spark, sf_dir)


@query(f"{_Q}, d AS (SELECT tile, id, ((q - lag(q, 1, 0) OVER (PARTITION BY tile ORDER BY id) + 32768) & 65535) - 32768 AS d FROM q) SELECT tile, id, (CASE WHEN d >= 0 THEN 2 * d ELSE -2 * d - 1 END)::INT AS code FROM d")
def zigzag_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zig-zag codes of quantised heights along each tile."""
    return M.delta_codes(_quantized(spark, sf_dir), "tile", "id", "q").select("tile", "id", "code")


@query(f"{_Q} SELECT tile, id, q::BIGINT AS q FROM q")
def delta_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantised heights from their codes."""
    from pyspark.sql import Window

    codes = M.delta_codes(_quantized(spark, sf_dir), "tile", "id", "q")
    along = Window.partitionBy("tile").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return codes.select("tile", "id", N.wrap16(F.sum(N.unzigzag(F.col("code"))).over(along)).alias("q"))


_FIRST = "f AS (SELECT id % 97 AS g, id, id * 31 % 53 AS v FROM pts), u AS (SELECT g, v, dense_rank() OVER (PARTITION BY g ORDER BY min(id)) - 1 AS i FROM f GROUP BY g, v), w AS (SELECT f.g, f.id, u.i FROM f JOIN u USING (g, v))"


@query(f"{A.oracle('pts')}, {_FIRST} SELECT g, id, (coalesce(max(i) OVER (PARTITION BY g ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, 0) - i)::INT AS code FROM w")
def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-water codes of indices numbered by first use."""
    from pyspark.sql import Window

    f = A.points(spark, sf_dir).select((F.col("id") % 97).alias("g"), "id", (F.col("id") * 31 % 53).alias("v"))
    u = f.groupBy("g", "v").agg(F.min("id").alias("first")).withColumn("i", F.row_number().over(Window.partitionBy("g").orderBy("first")) - 1)
    return M.high_water_codes(f.join(u, ["g", "v"]), "g", "id", "i").select("g", "id", "code")


_S = [f"sqrt((x{i} - x{j}) * (x{i} - x{j}) + (y{i} - y{j}) * (y{i} - y{j}))" for i, j in ((0, 1), (1, 2), (2, 0))]


@query(f"""{A.oracle('tri')}, s AS (SELECT *, {_S[0]} AS a, {_S[1]} AS b, {_S[2]} AS c FROM tri)
  SELECT id, round(sqrt(greatest(0.0::DOUBLE, (a + b + c) / 2 * ((a + b + c) / 2 - a) * ((a + b + c) / 2 - b) * ((a + b + c) / 2 - c))), 6) AS area, CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS longest,
   round((x0 + x1 + x2) / 3.0::DOUBLE, 6) AS bx, round((y0 + y1 + y2) / 3.0::DOUBLE, 6) AS "by", round((x1 - x0) * (y2 - y0) - (y1 - y0) * (x2 - x0), 6) AS c FROM s""")  # fmt: skip
def triangle_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area, longest side, barycentre and the third coefficient of the plane of each triangle."""
    bx, by, _ = M.barycentre()
    return A.triangles(spark, sf_dir).select("id", F.round(M.area(M.side(0, 1), M.side(1, 2), M.side(2, 0)), 6).alias("area"), M.longest_side().alias("longest"), F.round(bx, 6).alias("bx"), F.round(by, 6).alias("by"), F.round(M.plane()[2], 6).alias("c"))


_LOW = ", ".join(f"least({c}0, {c}1, {c}2) AS lo{c}, greatest({c}0, {c}1, {c}2) AS hi{c}" for c in "xyz")


@query(f"""{A.oracle('tri')}, s AS (SELECT id, {_LOW} FROM tri), m AS (SELECT *, greatest(hix - lox, hiy - loy) * {_D} * {_R} AS metres, sqrt((hix - lox) * (hix - lox) + (hiy - loy) * (hiy - loy)) * {_D} * {_R} AS diagonal, 180.0::DOUBLE / 128.0::DOUBLE * {_D} * {_R} AS size FROM s),
  v AS (SELECT CASE WHEN metres < size * 0.1::DOUBLE / 4.0::DOUBLE THEN 'keep' WHEN metres > size / 2.5::DOUBLE * 0.2::DOUBLE THEN 'split'
   WHEN NOT (lox >= -170.0 AND loy >= -60.0 AND hix <= 170.0 AND hiy <= 60.0) THEN CASE WHEN hiz > size * 0.015::DOUBLE / 4.0::DOUBLE * (0.8::DOUBLE * (diagonal / size) + 0.2::DOUBLE) THEN 'split' ELSE 'keep' END ELSE 'test' END AS verdict, id FROM m)
  SELECT verdict, count(*) AS n, sum(id)::BIGINT AS ids FROM v GROUP BY verdict""")  # fmt: skip
def refine_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What size and place settle about refining each triangle at depth 7."""
    size = 180.0 / 128 * G.DEGREE * G.EQUATORIAL_RADIUS
    verdict = M.refine_by_size(7, {"tile_size": size, "max_side": size / 2.5 * 0.2, "min_side": size * 0.1 / 4.0, "max_diff": size * 0.015 / 4.0}, (-170.0, -60.0, 170.0, 60.0))
    return A.triangles(spark, sf_dir).groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(f"""{A.oracle('tri')}, b AS (SELECT (x0 + x1 + x2) / 3.0::DOUBLE AS lon, (y0 + y1 + y2) / 3.0::DOUBLE AS lat FROM tri), t AS (SELECT lon, lat, {_x('lon', 5)} AS tx, {_y('lat', 5)} AS ty FROM b)
  SELECT tx, ty, (lon >= 5.625::DOUBLE * tx - 180.0::DOUBLE + 2.8125::DOUBLE)::INT + 2 * (lat >= 5.625::DOUBLE * ty - 90.0::DOUBLE + 2.8125::DOUBLE)::INT AS child, count(*) AS n FROM t GROUP BY 1, 2, 3""")  # fmt: skip
def owner_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles by owning tile at depth 5 and child of it."""
    own = A.triangles(spark, sf_dir).withColumns(M.owner(5))
    return own.groupBy("tx", "ty", M.child_of_tile().alias("child")).agg(F.count("*").alias("n"))


_E = [_ecef(f"x{k}", f"y{k}", f"z{k}") for k in range(3)]
_EC = "e AS (SELECT *, " + ", ".join(f"{_E[k][i]} AS e{k}{'xyz'[i]}" for k in range(3) for i in range(3)) + " FROM tri)"
_N = "n AS (SELECT *, (e1y - e0y) * (e2z - e0z) - (e1z - e0z) * (e2y - e0y) AS a, (e1z - e0z) * (e2x - e0x) - (e1x - e0x) * (e2z - e0z) AS b, (e1x - e0x) * (e2y - e0y) - (e1y - e0y) * (e2x - e0x) AS c FROM e), u AS (SELECT *, a / nullif(sqrt(a * a + b * b + c * c), 0) AS nx, b / nullif(sqrt(a * a + b * b + c * c), 0) AS ny, c / nullif(sqrt(a * a + b * b + c * c), 0) AS nz FROM n)"


@query(f"{A.oracle('tri')}, {_EC}, {_N} SELECT id, round(nx, 6) AS nx, round(ny, 6) AS ny, round(nz, 6) AS nz FROM u")
def face_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit normal of each triangle, earth-centred."""
    return A.triangles(spark, sf_dir).select("id", *_rounded(dict(zip(("nx", "ny", "nz"), M.normal()))))


@query(f"""{A.oracle('tri')}, {_EC}, {_N}, v AS ({' UNION ALL '.join(f'SELECT x{k} AS x, y{k} AS y, nx, ny, nz FROM u' for k in range(3))}), s AS (SELECT x, y, sum(nx) AS nx, sum(ny) AS ny, sum(nz) AS nz FROM v GROUP BY x, y)
  SELECT x, y, round(nx / sqrt(nx * nx + ny * ny + nz * nz), 5) AS n0, round(ny / sqrt(nx * nx + ny * ny + nz * nz), 5) AS n1, round(nz / sqrt(nx * nx + ny * ny + nz * nz), 5) AS n2 FROM s""")  # fmt: skip
def vertex_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit normal of each corner position."""
    n = M.vertex_normals(A.triangles(spark, sf_dir))
    return n.select("x", "y", *(F.round(f"n{i}", 5).alias(f"n{i}") for i in range(3)))
