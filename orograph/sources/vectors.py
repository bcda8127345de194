"""Vector features and tile trees through Spark's own readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINT = "array<double>"
_RINGS = f"array<array<{_POINT}>>"


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """id, kind, part, rings and properties of every polygon and line of GeoJSON feature collections.

    Multi-geometries become their parts; a line is one ring; other kinds are left out.
    """
    schema = "features array<struct<id:string,geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>"
    each = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f")).select("f.id", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("c"), F.col("f.properties").alias("properties"))
    of = lambda s: F.from_json("c", s)
    parts = (
        F.when(F.col("kind") == "Polygon", F.array(of(_RINGS)))
        .when(F.col("kind") == "MultiPolygon", of(f"array<{_RINGS}>"))
        .when(F.col("kind") == "LineString", F.array(F.array(of(f"array<{_POINT}>"))))
        .when(F.col("kind") == "MultiLineString", F.transform(of(_RINGS), lambda line: F.array(line)))
    )
    rows = each.select("id", "kind", "properties", F.posexplode(parts).alias("part", "rings"))
    point = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"), F.coalesce(F.get(p, F.lit(2)), F.lit(0.0)).alias("z"))
    return rows.select("id", F.regexp_replace("kind", "^Multi", "").alias("kind"), "part", F.transform("rings", lambda r: F.transform(r, point)).alias("rings"), "properties")


def placements(spark: SparkSession, path: str) -> DataFrame:
    """Position, orientation, scale and reference of the model placements of KML files."""
    p = spark.read.format("xml").option("rowTag", "Placemark").option("inferSchema", False).schema("name string, Model struct<altitudeMode:string,Location:struct<longitude:double,latitude:double,altitude:double>,Orientation:struct<heading:double,tilt:double,roll:double>,Scale:struct<x:double,y:double,z:double>,Link:struct<href:string>>").load(path)
    m = "Model"
    zero = lambda c, d=0.0: F.coalesce(F.col(f"{m}.{c}"), F.lit(d))
    return p.where(F.col(m).isNotNull()).select("name", F.col(f"{m}.altitudeMode").alias("altitude_mode"), F.col(f"{m}.Location.longitude").alias("lon"), F.col(f"{m}.Location.latitude").alias("lat"), zero("Location.altitude").alias("altitude"), zero("Orientation.heading").alias("heading"), zero("Orientation.tilt").alias("tilt"), zero("Orientation.roll").alias("roll"), zero("Scale.x", 1.0).alias("scale_x"), zero("Scale.y", 1.0).alias("scale_y"), zero("Scale.z", 1.0).alias("scale_z"), F.col(f"{m}.Link.href").alias("href"))


def tile_tree(spark: SparkSession, folder: str) -> DataFrame:
    """depth, x, y and bytes of the tiles of a {depth}/{x}/{y}.terrain tree."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.terrain").load(folder)
    at = lambda k: F.regexp_extract("path", r"/(\d+)/(\d+)/(\d+)\.terrain$", k).cast("int")
    return files.where(F.col("path").rlike(r"/\d+/\d+/\d+\.terrain$")).select(at(1).alias("depth"), at(2).alias("x"), at(3).alias("y"), F.col("content").alias("blob"))


def tile_tree_or_none(spark: SparkSession, folder: str) -> DataFrame | None:
    """The tiles of a tree, or None if there is no such folder yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tile_tree(spark, folder) if files.exists(path) else None


def tree_ranges(tiles: DataFrame) -> DataFrame:
    """Available ranges of a tile tree: the hull of each depth."""
    return tiles.groupBy("depth").agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y"))


def write_tree(tiles: DataFrame, folder: str) -> int:
    """Writes tiles (l, x, y, blob) as {l}/{x}/{y}.terrain through Arrow's file systems; how many were written.

    A tile is written under a passing name and moved, so a repeated task leaves whole files only.
    """
    import uuid

    from pyarrow.fs import FileSystem

    def run(batches):
        import pyarrow as pa

        files, base = FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        n = 0
        for b in batches:
            for l, x, y, blob in zip(*(b.column(c).to_pylist() for c in ("l", "x", "y", "blob"))):  # noqa: E741
                files.create_dir(f"{base}/{l}/{x}", recursive=True)
                passing = f"{base}/{l}/{x}/.{y}-{uuid.uuid4().hex}"
                with files.open_output_stream(passing, compression=None) as out:
                    out.write(blob)
                files.move(passing, f"{base}/{l}/{x}/{y}.terrain")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return tiles.select("l", "x", "y", "blob").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def missing(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Tiles (depth, x, y) that a tree does not hold yet: what a resumed run has to make."""
    return wanted.join(done.select("depth", "x", "y"), ["depth", "x", "y"], "left_anti")


def delete_tiles(tiles: DataFrame, folder: str) -> int:
    """Deletes the files of tiles (depth, x, y) from a tree; how many there were."""
    from pyarrow.fs import FileSystem, FileType

    def run(batches):
        import pyarrow as pa

        files, base = FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        n = 0
        for b in batches:
            for depth, x, y in zip(*(b.column(c).to_pylist() for c in ("depth", "x", "y"))):
                path = f"{base}/{depth}/{x}/{y}.terrain"
                if files.get_file_info(path).type == FileType.File:
                    files.delete_file(path)
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return tiles.select("depth", "x", "y").distinct().mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
