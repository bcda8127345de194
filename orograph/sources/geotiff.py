"""GeoTIFF elevation rasters as a Spark data source, in numpy: TIFF and BigTIFF, strips or tiles, plain, LZW or deflate,
predictors 1 to 3; of several bands the first.

``spark.dataSource.register(GeoTiffSource)`` and ``spark.read.format("geotiff").load(folder)`` give one row for each
raster row: raster, row (0 is the north), values. Files are found by Spark's own listing and each is one
partition; ``metadata`` gives extents and sizes. Coordinates are degrees; EPSG:3857 is turned into them, other
systems are refused.
"""

from __future__ import annotations

import math
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the TIFF format: bytes of each field type, and numpy kinds by sample format and bits.
_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 13: 4, 16: 8, 18: 8}
_CODES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 18: "Q"}
_KINDS = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}
_MERCATOR = 20037508.342789244


@dataclass
class Raster:
    width: int
    height: int
    min_lon: float
    min_lat: float
    max_lon: float
    max_lat: float
    no_data: float | None
    crs: int


def _fields(raw: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    version = struct.unpack(order + "H", raw[2:4])[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    (at,) = struct.unpack_from(order + "Q", raw, 8) if big else struct.unpack_from(order + "I", raw, 4)
    (n,) = struct.unpack_from(order + ("Q" if big else "H"), raw, at)
    first, step, head, room = (at + 8, 20, "HHQ", 8) if big else (at + 2, 12, "HHI", 4)
    out = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + head, raw, first + step * k)
        if kind not in _CODES:
            continue
        place = first + step * k + step - room
        if _BYTES[kind] * count > room:
            (place,) = struct.unpack_from(order + ("Q" if big else "I"), raw, place)
        out[tag] = (raw[place : place + count].rstrip(b"\0"),) if kind == 2 else struct.unpack_from(f"{order}{count}{_CODES[kind]}", raw, place)
    return order, out


def _degrees(x: float, y: float) -> tuple[float, float]:
    return x / _MERCATOR * 180.0, math.degrees(math.atan(math.sinh(y / _MERCATOR * math.pi)))


def describe(raw: bytes) -> Raster:
    _, f = _fields(raw)
    width, height = f[256][0], f[257][0]
    keys = f.get(34735, ())
    ids = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    crs = ids.get(3072, ids.get(2048, 4326))
    if crs not in (4326, 3857):
        raise ValueError(f"EPSG:{crs} is not supported; EPSG:4326 and EPSG:3857 are")
    scale, tie = f[33550], f[33922]
    west, north = tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1]
    if ids.get(1025) == 2:  # the tie point is the middle of a pixel
        west, north = west - scale[0] / 2, north + scale[1] / 2
    low, high = (west, north - height * scale[1]), (west + width * scale[0], north)
    if crs == 3857:
        low, high = _degrees(*low), _degrees(*high)
    none = float(f[42113][0].split()[0]) if 42113 in f and f[42113][0].strip() else None
    return Raster(width, height, *low, *high, none, crs)


def _plain(data: bytes, method: int) -> bytes:
    if method == 1:
        return data
    if method in (8, 32946):
        return zlib.decompress(data)
    if method == 5:
        return _unpacked(data)
    raise ValueError(f"TIFF compression {method} is not supported")


def _unpacked(data: bytes) -> bytes:
    """LZW as TIFF has it: codes from the highest bit on, one bit longer a code early."""
    clear, end = 256, 257
    start = [bytes([k]) for k in range(256)] + [b"", b""]
    table, out, last = list(start), [], b""
    held = bits = 0
    width = 9
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == end:
            break
        if code == clear:
            table, last, width = list(start), b"", 9
            continue
        if code > len(table) or code == len(table) and not last:
            raise ValueError("damaged LZW data")
        now = table[code] if code < len(table) else last + last[:1]
        out.append(now)
        if last:
            table.append(last + now[:1])
        last = now
        width = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


def _block(data: bytes, rows: int, columns: int, kind: str, order: str, predictor: int, bands: int = 1) -> np.ndarray:
    """The first band of a block."""
    size, wide = np.dtype(kind).itemsize, columns * bands
    if predictor == 3:  # bytes of equal weight stand together, as differences along the row
        flat = np.frombuffer(data, np.uint8)[: rows * wide * size].reshape(rows, wide * size // bands, bands)
        flat = np.cumsum(flat, axis=1, dtype=np.uint8).reshape(rows, wide * size)
        got = np.ascontiguousarray(flat.reshape(rows, size, wide).transpose(0, 2, 1)).reshape(rows, wide * size).view(">" + kind)
        return got[:, ::bands]
    got = np.frombuffer(data, order + kind)[: rows * wide].reshape(rows, columns, bands)[:, :, 0]
    return np.cumsum(got, axis=1, dtype=got.dtype.newbyteorder("=")) if predictor == 2 else got


def rows(raw: bytes) -> Iterator[np.ndarray]:
    """The raster's rows from the north, as doubles; a strip or a row of tiles is held at a time."""
    order, f = _fields(raw)
    width, height = f[256][0], f[257][0]
    kind = _KINDS[f.get(339, (1,))[0], f[258][0]]
    method, predictor = f.get(259, (1,))[0], f.get(317, (1,))[0]
    bands = f.get(277, (1,))[0] if f.get(284, (1,))[0] == 1 else 1  # in one plane the bands of a pixel stand together
    tiled = 322 in f
    across, down = (f[322][0], f[323][0]) if tiled else (width, min(height, f.get(278, (height,))[0]))
    offsets, counts = (f[324], f[325]) if tiled else (f[273], f[279])
    per_row = -(-width // across)
    for band, top in enumerate(range(0, height, down)):
        held = min(down, height - top)
        parts = []
        for k in range(band * per_row, (band + 1) * per_row):
            data = _plain(raw[offsets[k] : offsets[k] + counts[k]], method)
            parts.append(_block(data, down if tiled else held, across, kind, order, predictor, bands))
        whole = np.concatenate(parts, axis=1)[:held, :width].astype(np.float64)
        yield from whole


def encoded(values: np.ndarray, min_lon: float, max_lat: float, px: float, py: float, no_data: float | None = None, crs: int = 4326) -> bytes:
    """A GeoTIFF of 32-bit floats in deflated strips."""
    h, w = values.shape
    per = max(1, (1 << 18) // max(1, w * 4))
    strips = [zlib.compress(values[i : i + per].astype("<f4").tobytes()) for i in range(0, h, per)]
    # Fixed values of the format: field numbers, and keys for the model (2: geographic, 1: projected), pixels as areas and the system.
    keys = [1, 1, 0, 3, 1024, 0, 1, 2 if crs == 4326 else 1, 1025, 0, 1, 1, 2048 if crs == 4326 else 3072, 0, 1, crs]
    offsets = np.concatenate([[8], 8 + np.cumsum([len(s) for s in strips])]).tolist()
    fields = {256: ("I", [w]), 257: ("I", [h]), 258: ("H", [32]), 259: ("H", [8]), 262: ("H", [1]), 273: ("I", offsets[:-1]), 277: ("H", [1]), 278: ("I", [per]), 279: ("I", [len(s) for s in strips]), 339: ("H", [3]), 33550: ("d", [px, py, 0.0]), 33922: ("d", [0.0, 0.0, 0.0, min_lon, max_lat, 0.0]), 34735: ("H", keys)}
    if no_data is not None:
        fields[42113] = ("s", f"{no_data:g}\0".encode())
    at, extra, entries = offsets[-1] + 2 + 12 * len(fields) + 4, b"", b""
    for tag, (code, v) in sorted(fields.items()):
        raw = v if code == "s" else struct.pack(f"<{len(v)}{code}", *v)
        place = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", at + len(extra))
        extra += raw if len(raw) > 4 else b""
        entries += struct.pack("<HHI", tag, {"H": 3, "I": 4, "d": 12, "s": 2}[code], len(v)) + place
    return b"II" + struct.pack("<HI", 42, offsets[-1]) + b"".join(strips) + struct.pack("<H", len(fields)) + entries + b"\0" * 4 + extra


def write(rasters: DataFrame, cells: DataFrame, folder: str, overwrite: bool = False) -> int:
    """Writes each raster as {raster}.tif; a file that is there and not empty stays, unless overwrite. How many were written.

    A raster is gathered where it is written: one that is split into windows first stays small there. Errors are raised.
    """
    import uuid

    import pandas as pd
    from pyarrow.fs import FileSystem, FileType

    none = F.col("no_data") if "no_data" in rasters.columns else F.lit(None).cast("double")
    crs = F.col("crs") if "crs" in rasters.columns else F.lit(4326)
    meta = rasters.select("raster", "width", "height", "min_lon", "max_lat", "max_lon", "min_lat", none.alias("no_data"), crs.alias("crs"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        files, base = FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        path = f"{base}/{r['raster']}.tif"
        there = files.get_file_info(path)
        if there.type == FileType.File and there.size and not overwrite:
            return pd.DataFrame({"n": [0]})
        values = np.full((int(r["height"]), int(r["width"])), np.nan)
        for k, v in zip(pdf["row"], pdf["values"]):
            values[int(k), : len(v)] = v
        x0, x1, y0, y1 = r["min_lon"], r["max_lon"], r["min_lat"], r["max_lat"]
        if r["crs"] == 3857:
            x0, x1 = (x / 180.0 * _MERCATOR for x in (x0, x1))
            y0, y1 = (math.asinh(math.tan(math.radians(y))) / math.pi * _MERCATOR for y in (y0, y1))
        files.create_dir(path.rpartition("/")[0], recursive=True)
        passing = f"{path}.{uuid.uuid4().hex}"
        with files.open_output_stream(passing, compression=None) as out:
            out.write(encoded(values, x0, y1, (x1 - x0) / r["width"], (y1 - y0) / r["height"], None if pd.isna(r["no_data"]) else float(r["no_data"]), int(r["crs"])))
        files.move(passing, path)
        return pd.DataFrame({"n": [1]})

    return cells.select("raster", "row", "values").join(meta, "raster").groupBy("raster").applyInPandas(one, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def listed(spark: SparkSession, folder: str, suffix: str = "*.tif", recursive: bool = True) -> DataFrame:
    """path, name, folder and length of the files of a folder, without their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", suffix).load(folder)
    parts = F.split("path", "/")
    return files.select("path", F.element_at(parts, -1).alias("name"), F.element_at(parts, -2).alias("folder"), "length")


def read(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(metadata, rows) of all .tif files below a folder, or of one file, of any store that Spark reads.

    Files come through Spark's binary source, so a file is read where it is worked on. A raster is named by its path below the
    folder, so files of one name in two folders are two rasters. A folder without such a file is an error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.tif").load(folder).select("path", "content")
    if files.select("path").isEmpty():
        raise ValueError(f"no .tif file in {folder}")
    top = folder.rstrip("/").split("://")[-1].removeprefix("file:").lstrip("/")

    def name(path: str) -> str:
        below = path.partition(f"/{top}/")[2]
        return (below or os.path.basename(path)).removesuffix(".tif")

    def about(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(name(p), describe(c)) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist([{"raster": n, **r.__dict__} for n, r in got], pa.schema([("raster", pa.string()), ("width", pa.int32()), ("height", pa.int32()), *((c, pa.float64()) for c in ("min_lon", "min_lat", "max_lon", "max_lat", "no_data")), ("crs", pa.int32())]))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for k, values in enumerate(rows(c)):
                    yield pa.RecordBatch.from_arrays([pa.array([name(p)]), pa.array([k], pa.int32()), pa.array([values], pa.list_(pa.float64()))], ["raster", "row", "values"])

    meta = files.mapInArrow(about, "raster string, width int, height int, min_lon double, min_lat double, max_lon double, max_lat double, no_data double, crs int")
    return meta, files.mapInArrow(cells, "raster string, row int, values array<double>")


@dataclass
class _File(InputPartition):
    path: str
    name: str


class GeoTiffSource(DataSource):
    """The rows of the .tif files of a local or mounted folder: spark.read.format('geotiff')."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return "raster string, row int, values array<double>"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])


class _Reader(DataSourceReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        found = [self.folder] if self.folder.endswith(".tif") else sorted(os.path.join(d, f) for d, _, names in os.walk(self.folder) for f in names if f.endswith(".tif"))
        if not found:
            raise ValueError(f"no .tif file in {self.folder}")
        return [_File(f, (os.path.relpath(f, self.folder) if f != self.folder else os.path.basename(f)).removesuffix(".tif")) for f in found]

    def read(self, partition: _File) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            raw = f.read()
        for k, values in enumerate(rows(raw)):
            yield partition.name, k, values.tolist()
