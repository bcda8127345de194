"""Point-cloud block files: a head of scale and offset, then points in fixed rows, big-endian; and sets of scenes in groups."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format: its version, and a row's fields.
VERSION = 1106
ROW = np.dtype([("x", ">f4"), ("y", ">f4"), ("z", ">f4"), ("r", "u1"), ("g", "u1"), ("b", "u1"), ("pad", "u1"), ("intensity", ">u2"), ("class", ">i2")])
HEAD = struct.Struct(">hh6d")
_COLUMNS = ["x", "y", "z", "r", "g", "b", "intensity", "class"]
_DDL = "file string, x double, y double, z double, r int, g int, b int, intensity int, class int"


def encoded(points: dict[str, np.ndarray], scale: tuple[float, float, float], offset: tuple[float, float, float]) -> bytes:
    """A block file of points (arrays x, y, z, r, g, b, intensity, class); a position that is no number is an error."""
    rows = np.zeros(len(points["x"]), ROW)
    for k, c in enumerate("xyz"):
        rows[c] = (np.asarray(points[c], float) - offset[k]) / scale[k]
    if not all(np.isfinite(rows[c]).all() for c in "xyz"):
        raise ValueError("a position is no number")
    for c in _COLUMNS[3:]:
        rows[c] = points[c]
    return HEAD.pack(VERSION, ROW.itemsize, *scale, *offset) + rows.tobytes()


def decoded(raw: bytes) -> dict[str, np.ndarray]:
    """The points of a block file."""
    version, size, *numbers = HEAD.unpack_from(raw)
    if version != VERSION or size != ROW.itemsize:
        raise ValueError("not a point block of this version")
    rows = np.frombuffer(raw, ROW, offset=HEAD.size)
    out = {c: rows[c].astype(float) * numbers[k] + numbers[3 + k] for k, c in enumerate("xyz")}
    return out | {c: rows[c].astype(np.int32) for c in _COLUMNS[3:]}


def read(spark: SparkSession, folder: str, pattern: str = "*.block") -> DataFrame:
    """The points of all block files below a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = decoded(content)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(p["x"])), *(pa.array(p[c]) for c in _COLUMNS)], ["file", *_COLUMNS])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")
    return files.mapInArrow(run, _DDL)


def write(points: DataFrame, folder: str, cell: float, per_file: int = 1 << 20) -> int:
    """Writes points as block files, a file for each cell of the plane and each per_file of its points, in the cell's own scale;
    how many files. Points of a full cell are dealt by a hash, so none is gathered whole."""
    import uuid

    from pyarrow.fs import FileSystem

    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    rows = points.select(*_COLUMNS).withColumns({"__i": at("x"), "__j": at("y")})
    sizes = rows.groupBy("__i", "__j").agg(F.ceil(F.count("*") / per_file).alias("__n"))
    dealt = rows.join(sizes, ["__i", "__j"]).withColumn("__part", F.pmod(F.xxhash64("x", "y", "z", "intensity"), F.col("__n")))

    def one(key: tuple, t: pa.Table) -> pa.Table:
        i, j, part = (k.as_py() for k in key)
        files, base = FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        files.create_dir(base, recursive=True)
        p = {c: t.column(c).to_numpy(zero_copy_only=False) for c in _COLUMNS}
        low, span = float(p["z"].min()), max(float(np.ptp(p["z"])), 1e-9)
        passing = f"{base}/.{uuid.uuid4().hex}"
        with files.open_output_stream(passing, compression=None) as out:
            out.write(encoded(p, (cell, cell, span), (i * cell, j * cell, low)))
        files.move(passing, f"{base}/{i}_{j}_{part}.block")
        return pa.table({"n": pa.array([1], pa.int64())})

    return dealt.groupBy("__i", "__j", "__part").applyInArrow(one, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_sets(scenes: DataFrame, folder: str, group: int = 10_000) -> None:
    """Scenes (id and any columns) as Parquet in folders of about so many, by a hash of the id."""
    n = max(1, -(-scenes.count() // group))
    scenes.withColumn("set", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).write.partitionBy("set").mode("overwrite").parquet(folder)


def read_sets(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("set")
