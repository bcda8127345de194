"""Queries of the tile pyramid: adaptive meshes and their encoded form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pyramid as P
from ..sources import adapters as A
from .raster_queries import _rows
from .tile_queries import _range

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _meshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pyramid(A.rasters(spark, sf_dir), _rows(spark, sf_dir), 2)


@query()
def mesh_pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and height range of each tile's mesh, depths 0 to 2."""
    return _meshes(spark, sf_dir).select("l", "x", "y", "vertices", "triangles", F.array_min("h").alias("low"), F.array_max("h").alias("high"))


@query()
def quantized_mesh_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tile's encoded bytes, by length and checksum."""
    return P.blobs(_meshes(spark, sf_dir)).select("l", "x", "y", F.octet_length("blob").alias("bytes"), F.crc32("blob").alias("crc"))


_COVER = f"r AS ({' UNION ALL '.join(f'SELECT {d} AS l, {_range(d)} FROM ras' for d in range(3))}), t AS (SELECT DISTINCT l::INT AS l, x::INT AS x, y::INT AS y FROM r, unnest(range(min_x, max_x + 1)) AS a(x), unnest(range(min_y, max_y + 1)) AS b(y) WHERE x < (2 << l) AND y < (1 << l))"


@query(f"{A.oracle('ras')}, {_COVER} SELECT l, x, y, true AS same, true AS near FROM t")
def mesh_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether tiles come back from their bytes as they were, heights within half a step."""
    was = _meshes(spark, sf_dir)
    now = P.decoded(P.blobs(was)).select("l", "x", "y", F.col("u").alias("u2"), F.col("v").alias("v2"), F.col("h").alias("h2"), F.col("indices").alias("i2"))
    step = (F.array_max("h") - F.array_min("h")) / 32767.0
    near = F.forall(F.zip_with("h", "h2", lambda a, b: F.abs(a - b)), lambda d: d <= step + 1e-3)
    both = was.join(now, ["l", "x", "y"])
    return both.select("l", "x", "y", ((F.col("u") == F.col("u2")) & (F.col("v") == F.col("v2")) & (F.col("indices") == F.col("i2"))).alias("same"), near.alias("near"))


@query("SELECT l::INT AS l, 2 * n * n + 2 * n * (n - 1) AS pairs, 0 AS cracked FROM (SELECT l, (1 << l) AS n FROM range(0, 3) AS t(l)) WHERE l < 1")
def border_cracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Common borders of tiles at depth 0 that differ: the two tiles meet on both sides of the globe."""
    return P.cracks(P.levels(A.rasters(spark, sf_dir), _rows(spark, sf_dir), [0])).where("l < 1")


@query("SELECT 2::INT AS l, true AS closed, true AS shared")
def border_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether no border at depth 2 cracks, and whether there are borders."""
    c = P.cracks(P.levels(A.rasters(spark, sf_dir), _rows(spark, sf_dir), [2]))
    return c.select("l", (F.col("cracked") == 0).alias("closed"), (F.col("pairs") > 20).alias("shared"))


@query("SELECT 1::INT AS l, true AS sound, true AS within")
def mesh_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all tiles at depth 1 cover their square exactly, with every triangle the same way round, and all heights lie
    between the rasters' ends and 0."""
    m = P.levels(A.rasters(spark, sf_dir), _rows(spark, sf_dir), [1])
    at = lambda t, k, c: F.get(c, F.get(t, F.lit(k))).cast("double")
    tri = F.transform(F.sequence(F.lit(0), F.col("triangles") - 1), lambda k: F.slice("indices", k * 3 + 1, F.lit(3)))
    twice = F.transform(tri, lambda t: (at(t, 1, "u") - at(t, 0, "u")) * (at(t, 2, "v") - at(t, 0, "v")) - (at(t, 2, "u") - at(t, 0, "u")) * (at(t, 1, "v") - at(t, 0, "v")))
    low, high = A.raster_cells(spark, sf_dir).agg(F.least(F.min("z"), F.lit(0.0)), F.greatest(F.max("z"), F.lit(0.0))).first()
    whole = F.abs(F.aggregate(twice, F.lit(0.0), lambda a, b: a + b) - 2.0 * 32767 * 32767) < 1
    each = m.select("l", (whole & (F.array_min(twice) > 0)).alias("sound"), ((F.array_min("h") >= low - 1e-3) & (F.array_max("h") <= high + 1e-3)).alias("within"))
    return each.groupBy("l").agg(F.every("sound").alias("sound"), F.every("within").alias("within"))


@query("SELECT 1::INT AS l, true AS same")
def normals_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether tiles at depth 1 keep their meshes with normals beside them."""
    m = P.levels(A.rasters(spark, sf_dir), _rows(spark, sf_dir), [1])
    b = P.blobs(m, normals=True).withColumnRenamed("blob", "with_normals").join(P.blobs(m), ["l", "x", "y"]).join(m.select("l", "x", "y", "vertices"), ["l", "x", "y"])
    more = F.octet_length("with_normals") - F.octet_length("blob") == 5 + 2 * F.col("vertices")
    return b.groupBy("l").agg(F.every(more).alias("same"))
