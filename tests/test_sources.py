"""Sources, sinks and streams on files that the tests write."""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orograph.operators import pyramid as P
from orograph.operators import ranges as R
from orograph.sources import geotiff, vectors
from orograph.streaming import tiles as S


def tiff(z: np.ndarray, order: str = "<", deflate: bool = False, predictor: int = 1, tile: int = 0, crs: int = 4326, scale=(0.5, 0.5), tie=(10.0, 50.0)) -> bytes:
    """A GeoTIFF of one band, written by hand."""
    h, w = z.shape
    kind = order + z.dtype.str[1:]
    blocks = []
    if tile:
        padded = np.pad(z, ((0, -h % tile), (0, -w % tile)))
        blocks = [padded[i : i + tile, j : j + tile] for i in range(0, padded.shape[0], tile) for j in range(0, padded.shape[1], tile)]
    else:
        blocks = [z[i : i + 5] for i in range(0, h, 5)]

    def pack(b: np.ndarray) -> bytes:
        if predictor == 2:
            b = np.diff(b, axis=1, prepend=np.zeros((len(b), 1), b.dtype)).astype(b.dtype)
        raw = b.astype(kind).tobytes()
        if predictor == 3:
            size = b.dtype.itemsize
            planes = np.frombuffer(b.astype(">" + b.dtype.str[1:]).tobytes(), np.uint8).reshape(len(b), b.shape[1], size).transpose(0, 2, 1).reshape(len(b), -1)
            raw = np.diff(planes, axis=1, prepend=np.zeros((len(b), 1), np.uint8)).astype(np.uint8).tobytes()
        return zlib.compress(raw) if deflate else raw

    data = [pack(b) for b in blocks]
    keys = (1, 1, 0, 1, 3072 if crs != 4326 else 2048, 0, 1, crs)
    sizes = {256: ("I", [w]), 257: ("I", [h]), 258: ("H", [z.dtype.itemsize * 8]), 259: ("H", [8 if deflate else 1]), 277: ("H", [1]), 317: ("H", [predictor]), 339: ("H", [{"f": 3, "i": 2, "u": 1}[z.dtype.kind]]), 33550: ("d", [*scale, 0.0]), 33922: ("d", [0.0, 0.0, 0.0, *tie, 0.0]), 34735: ("H", list(keys))}
    place, offsets = 8, []
    for d in data:
        offsets.append(place)
        place += len(d)
    names = (322, 323, 324, 325) if tile else (278, None, 273, 279)
    sizes |= {names[2]: ("I", offsets), names[3]: ("I", [len(d) for d in data]), names[0]: ("I", [tile or 5])} | ({323: ("I", [tile])} if tile else {})
    none = b"-9999\0"
    entries, extra, at = [], b"", place + 2 + 12 * (len(sizes) + 1) + 4
    codes = {"H": 3, "I": 4, "d": 12}
    for tag, (c, v) in sorted({**sizes, 42113: ("s", none)}.items()):
        raw = v if c == "s" else struct.pack(f"{order}{len(v)}{c}", *v)
        value = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(order + "I", at + len(extra))
        extra += raw if len(raw) > 4 else b""
        entries.append(struct.pack(order + "HHI", tag, 2 if c == "s" else codes[c], len(v)) + value)
    return (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, place) + b"".join(data) + struct.pack(order + "H", len(entries)) + b"".join(entries) + b"\0" * 4 + extra


@pytest.mark.parametrize("kind, options", [("f4", {}), ("f4", {"order": ">"}), ("i2", {"deflate": True, "predictor": 2}), ("f4", {"deflate": True, "predictor": 3}), ("f8", {"tile": 16}), ("f4", {"tile": 16, "deflate": True, "predictor": 3, "order": ">"})])
def test_rasters_of_many_layouts(kind, options):
    z = (np.arange(23 * 37).reshape(23, 37) * 3 - 500).astype(kind)
    raw = tiff(z, **options)
    assert (np.array(list(geotiff.rows(raw))) == z).all()
    r = geotiff.describe(raw)
    assert (r.width, r.height, r.min_lon, r.max_lat, r.max_lon, r.min_lat, r.no_data) == (37, 23, 10.0, 50.0, 28.5, 38.5, -9999.0)


def test_other_coordinates():
    z = np.zeros((4, 4), "f4")
    r = geotiff.describe(tiff(z, crs=3857, scale=(1000.0, 1000.0), tie=(0.0, 4000.0)))
    assert abs(r.max_lon - 4000 / 20037508.342789244 * 180) < 1e-12 and abs(r.min_lat) < 1e-12
    with pytest.raises(ValueError, match="EPSG:5186"):
        geotiff.describe(tiff(z, crs=5186))


def test_folders_of_rasters(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"r{k}.tif").write_bytes(tiff(np.full((6, 4), k + 1.5, "f4")))
    (tmp_path / "note.txt").write_text("x")
    meta, rows = geotiff.read(spark, str(tmp_path))
    assert sorted(r["raster"] for r in meta.collect()) == ["r0", "r1"]
    assert {(r["raster"], r["values"][0]) for r in rows.collect()} == {("r0", 1.5), ("r1", 2.5)} and rows.count() == 12
    spark.dataSource.register(geotiff.GeoTiffSource)
    assert spark.read.format("geotiff").load(str(tmp_path)).count() == 12


def test_geojson_parts(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    kinds = [("Polygon", [ring]), ("MultiPolygon", [[ring], [ring, ring]]), ("LineString", ring), ("Point", [0, 0])]
    (tmp_path / "f.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"id": str(i), "geometry": {"type": k, "coordinates": c}, "properties": {"h": 3}} for i, (k, c) in enumerate(kinds)]}))
    got = vectors.geojson(spark, str(tmp_path / "f.json")).collect()
    assert sorted((r["id"], r["kind"], r["part"], len(r["rings"])) for r in got) == [("0", "Polygon", 0, 1), ("1", "Polygon", 0, 1), ("1", "Polygon", 1, 2), ("2", "LineString", 0, 1)]
    assert got[0]["properties"]["h"] == "3"


def test_placements(spark, tmp_path):
    (tmp_path / "p.kml").write_text("<kml><Document><Placemark><name>a</name><Model><altitudeMode>absolute</altitudeMode><Location><longitude>1.5</longitude><latitude>2</latitude></Location><Link><href>m.glb</href></Link></Model></Placemark></Document></kml>")
    r = vectors.placements(spark, str(tmp_path / "p.kml")).first()
    assert (r["name"], r["lon"], r["lat"], r["altitude"], r["scale_x"], r["href"]) == ("a", 1.5, 2.0, 0.0, 1.0, "m.glb")


def test_tile_tree_and_resuming(spark, tmp_path):
    tiles = spark.createDataFrame([(1, 0, 0, bytearray(b"a")), (1, 1, 0, bytearray(b"bb")), (2, 3, 1, bytearray(b"c"))], "l int, x int, y int, blob binary")
    assert vectors.write_tree(tiles, str(tmp_path)) == 3
    tree = vectors.tile_tree(spark, str(tmp_path))
    assert {(r["depth"], r["x"], r["y"], bytes(r["blob"])) for r in tree.collect()} == {(1, 0, 0, b"a"), (1, 1, 0, b"bb"), (2, 3, 1, b"c")}
    assert sorted(map(tuple, vectors.tree_ranges(tree).collect())) == [(1, 0, 1, 0, 0), (2, 3, 3, 1, 1)]
    wanted = R.union(spark.createDataFrame([(1, 0, 2, 0, 0)], "depth int, min_x int, max_x int, min_y int, max_y int"))
    assert [tuple(r) for r in vectors.missing(wanted, tree).collect()] == [(1, 2, 0)]


def test_meshes_of_a_folder_of_rasters(spark, tmp_path):
    z = 500 * np.sin(np.arange(64) / 6)[:, None] * np.cos(np.arange(64) / 5)[None, :]
    (tmp_path / "dem.tif").write_bytes(tiff(z.astype("f4"), scale=(0.5, 0.5), tie=(100.0, 45.0)))
    meta, rows = geotiff.read(spark, str(tmp_path))
    tiles = P.pyramid(meta, rows, 3).cache()
    assert tiles.groupBy("l").count().count() == 4
    assert vectors.write_tree(P.blobs(tiles), str(tmp_path / "out")) == tiles.count()


def test_streamed_tiles(spark, tmp_path):
    spark.createDataFrame([("2024-01-01 00:00:00", 10.0, 10.0, 1.0), ("2024-01-01 01:00:00", 10.0, 10.0, 3.0), ("2024-01-05 00:00:00", 11.0, 11.0, 0.0)], "ts string, lon double, lat double, h double").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, lon double, lat double, h double").parquet(str(tmp_path / "in"))
    q = S.tile_statistics(stream, 4).writeStream.format("memory").queryName("tiles").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("tiles").where("n = 2 AND max_h = 3").count() == 1
