"""Vector sources, raster layouts and the raster writer, on files that the tests write by hand."""

from __future__ import annotations

import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from orograph.operators import rasters as Q
from orograph.operators import sampling as S
from orograph.sources import features as V
from orograph.sources import geotiff

OUTER = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]  # clockwise
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]


def lzw(data: bytes) -> bytes:
    """An encoder by the book: the longest known string, one bit longer a code early."""
    table = {bytes([k]): k for k in range(256)}
    width, bits, out, now = 9, "", [], b""
    bits += format(256, "09b")
    for byte in data:
        new = now + bytes([byte])
        if new in table:
            now = new
            continue
        bits += format(table[now], f"0{width}b")
        table[new] = len(table) + 2
        if len(table) + 2 >= (1 << width) - 0 and width < 12:
            width += 1
        if len(table) + 2 >= 4094:
            bits += format(256, f"0{width}b")
            table, width = {bytes([k]): k for k in range(256)}, 9
        now = bytes([byte])
    if now:
        bits += format(table[now], f"0{width}b")
        if len(table) + 3 >= (1 << width) and width < 12:
            width += 1
    bits += format(257, f"0{width}b")
    bits += "0" * (-len(bits) % 8)
    out = int(bits, 2).to_bytes(len(bits) // 8, "big")
    return out


def tiff(blocks: list[bytes], w: int, h: int, per: int, method: int = 1, big: bool = False, bands: int = 1, point: bool = False) -> bytes:
    size, code = (8, "Q") if big else (4, "I")
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0) if big else struct.pack("<2sHI", b"II", 42, 0)
    offsets = (len(head) + np.concatenate([[0], np.cumsum([len(b) for b in blocks])[:-1]])).tolist()
    keys = [1, 1, 0, 2, 1025, 0, 1, 2 if point else 1, 2048, 0, 1, 4326]
    fields = {256: ("I", [w]), 257: ("I", [h]), 258: ("H", [32] * bands), 259: ("H", [method]), 273: (code, offsets), 277: ("H", [bands]), 278: ("I", [per]), 279: (code, [len(b) for b in blocks]), 339: ("H", [3] * bands), 33550: ("d", [1.0, 1.0, 0.0]), 33922: ("d", [0.0, 0.0, 0.0, 10.0, 50.0, 0.0]), 34735: ("H", keys)}
    at = len(head) + sum(map(len, blocks))
    extra_at = at + (8 if big else 2) + (20 if big else 12) * len(fields) + size
    entries, extra = b"", b""
    for tag, (c, v) in sorted(fields.items()):
        raw = struct.pack(f"<{len(v)}{c}", *v)
        place = raw.ljust(size, b"\0") if len(raw) <= size else struct.pack(f"<{code}", extra_at + len(extra))
        extra += raw if len(raw) > size else b""
        entries += struct.pack("<HHQ" if big else "<HHI", tag, {"H": 3, "I": 4, "d": 12, "Q": 16}[c], len(v)) + place
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHI", b"II", 42, at)
    return head + b"".join(blocks) + struct.pack("<Q" if big else "<H", len(fields)) + entries + b"\0" * size + extra


@pytest.mark.parametrize("size", [(7, 5), (40, 130)])
def test_lzw_and_big_rasters(size):
    rng = np.random.default_rng(1)
    z = rng.integers(0, 9, size).astype("<f4")
    strips = [z[i : i + 3].tobytes() for i in range(0, size[0], 3)]
    for raw in (tiff(list(map(lzw, strips)), size[1], size[0], 3, 5), tiff(strips, size[1], size[0], 3, big=True)):
        assert (np.array(list(geotiff.rows(raw))) == z).all()


def test_first_band_and_pixel_points():
    z = np.arange(12, dtype="<f4").reshape(3, 4)
    two = np.stack([z, z + 100], axis=2)
    raw = tiff([two.tobytes()], 4, 3, 3, bands=2, point=True)
    assert (np.array(list(geotiff.rows(raw))) == z).all()
    r = geotiff.describe(raw)
    assert (r.min_lon, r.max_lat, r.max_lon, r.min_lat) == (9.5, 50.5, 13.5, 47.5)


def test_rasters_written_and_read(spark, tmp_path):
    meta = spark.createDataFrame([("a/x", 3, 2, 10.0, 40.0, 13.0, 42.0, -7.0, 4326), ("b/x", 2, 2, 0.0, 10.0, 10.0, 20.0, None, 3857)], "raster string, width int, height int, min_lon double, min_lat double, max_lon double, max_lat double, no_data double, crs int")
    rows = spark.createDataFrame([("a/x", 0, [1.0, 2.0, -7.0]), ("a/x", 1, [4.0, 5.0, 6.0]), ("b/x", 0, [1.5, 2.5]), ("b/x", 1, [3.5, 4.5])], "raster string, row int, values array<double>")
    assert geotiff.write(meta, rows, str(tmp_path)) == 2 and geotiff.write(meta, rows, str(tmp_path)) == 0 and geotiff.write(meta, rows, str(tmp_path), True) == 2
    m, r = geotiff.read(spark, str(tmp_path))
    got = {x["raster"]: x for x in m.collect()}
    assert set(got) == {"a/x", "b/x"} and got["a/x"]["no_data"] == -7.0 and got["b/x"]["crs"] == 3857 and abs(got["b/x"]["max_lat"] - 20) < 1e-9 and abs(got["a/x"]["max_lon"] - 13) < 1e-12
    assert sorted(map(tuple, r.collect())) == sorted(map(tuple, rows.collect()))
    assert sorted(x["folder"] for x in geotiff.listed(spark, str(tmp_path)).collect()) == ["a", "b"]
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no .tif file"):
        geotiff.read(spark, str(tmp_path / "none"))


def test_mercator_rows_and_holes_are_sampled_right(spark):
    """A raster of its own latitudes: every sample is its position's latitude, whatever the rows' spacing."""
    h, top = 200, 60.0
    y = lambda lat: np.arcsinh(np.tan(np.radians(lat)))
    edges = np.linspace(y(top), 0, h + 1)
    lats = np.degrees(np.arctan(np.sinh((edges[1:] + edges[:-1]) / 2)))
    meta = spark.createDataFrame([("m", 3, h, 0.0, 0.0, 30.0, top, 99.0, 3857)], "raster string, width int, height int, min_lon double, min_lat double, max_lon double, max_lat double, no_data double, crs int")
    rows = spark.createDataFrame([("m", k, [float(v), float("nan"), 99.0]) for k, v in enumerate(lats)], "raster string, row int, values array<double>")
    points = spark.createDataFrame([(k, 5.0, float(v)) for k, v in enumerate(np.linspace(1, 59, 30))] + [(100, 15.0, 30.0), (101, 25.0, 30.0)], "id long, lon double, lat double")
    got = {r["id"]: (r["lat"], r["z"]) for r in S.nearest(points, meta, rows).collect()}
    assert all(abs(lat - z) < 0.3 for i, (lat, z) in got.items() if i < 100) and got[100][1] == got[101][1] == S.NO_DATA
    flat, turned = Q.reprojected(meta, rows)
    again = {r["id"]: (r["lat"], r["z"]) for r in S.nearest(points.where("id < 100"), flat, turned).collect()}
    assert all(abs(lat - z) < 0.5 for lat, z in again.values())


def shp(records: list[bytes]) -> bytes:
    body = b"".join(struct.pack(">2i", k + 1, len(r) // 2) + r for k, r in enumerate(records))
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i8d", 1000, 5, *([0.0] * 8)) + body


def dbf(rows: list[tuple[str, str]], charset: str) -> bytes:
    fields = b"".join(name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for name, w in (("name", 20), ("h", 8)))
    body = b"".join(b" " + a.encode(charset).ljust(20) + b.encode().ljust(8) for a, b in rows)
    return struct.pack("<B3BIHH20x", 3, 24, 1, 1, len(rows), 32 + len(fields) + 1, 29) + fields + b"\r" + body


def polygon(rings: list[list[tuple[float, float]]]) -> bytes:
    points = [p for r in rings for p in r]
    starts = np.cumsum([0, *(len(r) for r in rings[:-1])]).tolist()
    return struct.pack("<i4d2i", 5, 0, 0, 4, 4, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + struct.pack(f"<{2 * len(points)}d", *(c for p in points for c in p))


@pytest.mark.parametrize("charset, name", [("utf-8", "산 é"), ("cp949", "한라산")])
def test_shapefiles(spark, tmp_path, charset, name):
    second = [(x + 10, y) for x, y in OUTER]
    point = struct.pack("<i3d", 11, 7.0, 8.0, 9.0) + struct.pack("<d", 0.0)
    (tmp_path / "f.shp").write_bytes(shp([polygon([OUTER, HOLE, second]), struct.pack("<i", 0), point]))
    (tmp_path / "f.dbf").write_bytes(dbf([(name, "12"), ("none", ""), ("peak", "3")], charset))
    if charset == "utf-8":
        (tmp_path / "f.cpg").write_text("UTF-8")
    got = sorted(V.shapefile(spark, str(tmp_path)).collect(), key=lambda r: (r["id"], r["part"]))
    assert [(r["id"], r["kind"], r["part"], len(r["rings"])) for r in got] == [("0", "Polygon", 0, 2), ("0", "Polygon", 1, 1), ("2", "Point", 0, 1)]
    assert got[0]["properties"] == {"name": name, "h": "12"} and tuple(got[2]["rings"][0][0]) == (7.0, 8.0, 9.0)


def test_shapefiles_in_other_systems(spark, tmp_path):
    (tmp_path / "f.shp").write_bytes(shp([struct.pack("<i2d", 1, 20037508.342789244, 0.0)]))
    (tmp_path / "f.dbf").write_bytes(dbf([("a", "1")], "ascii"))
    (tmp_path / "f.prj").write_text('PROJCS["WGS_1984_Web_Mercator_Auxiliary_Sphere"]')
    p = V.shapefile(spark, str(tmp_path)).first()["rings"][0][0]
    assert abs(p["x"] - 180) < 1e-9 and abs(p["y"]) < 1e-9
    (tmp_path / "f.prj").write_text('PROJCS["Korea_2000"]')
    with pytest.raises(Exception, match="not supported"):
        V.shapefile(spark, str(tmp_path)).collect()


def test_geopackages(spark, tmp_path):
    path = tmp_path / "g.gpkg"
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INT, z INT, m INT)")
    wkb = lambda rings: struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<2d", *p) for p in r) for r in rings)
    multi = struct.pack("<BII", 1, 6, 2) + wkb([OUTER, HOLE]) + wkb([OUTER])
    tall = struct.pack("<BI3d", 1, 1001, 1.0, 2.0, 3.0)
    for name, blobs in (("houses", [struct.pack("<2sBBi4d", b"GP", 0, 0b11, 4326, 0, 4, 0, 4) + multi, None]), ("trees", [struct.pack("<2sBBi", b"GP", 0, 1, 4326) + tall])):
        con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', 4326, 0, 0)", (name,))
        con.execute(f"CREATE TABLE {name} (fid INTEGER PRIMARY KEY, geom BLOB, heading REAL, SCALE REAL)")
        con.executemany(f"INSERT INTO {name} (geom, heading, SCALE) VALUES (?, 90.5, NULL)", [(b,) for b in blobs])
    con.commit()
    con.close()
    got = V.geopackage(spark, str(tmp_path))
    rows = sorted(got.collect(), key=lambda r: (r["id"], r["part"]))
    assert [(r["id"], r["kind"], r["part"], len(r["rings"])) for r in rows] == [("houses.1", "Polygon", 0, 2), ("houses.1", "Polygon", 1, 1), ("trees.1", "Point", 0, 1)]
    assert rows[0]["properties"]["__table"] == "houses" and rows[0]["properties"]["SCALE"] == "null"
    p = V.placements(got).first()
    assert (p["lon"], p["lat"], p["altitude"], p["heading"], p["scale"]) == (1.0, 2.0, 3.0, 90.5, 1.0)


def test_city_and_indoor_models(spark, tmp_path):
    square = "0 0 1 4 0 1 4 4 1 0 0 1"
    (tmp_path / "c.gml").write_text(f'<CityModel xmlns="c" xmlns:gml="g" xmlns:bldg="b" xmlns:gen="n"><cityObjectMember><bldg:Building gml:id="b1"><bldg:measuredHeight>9.5</bldg:measuredHeight><gen:stringAttribute name="use"><gen:value>shop</gen:value></gen:stringAttribute><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>{square}</gml:posList></gml:LinearRing></gml:exterior><gml:interior><gml:LinearRing><gml:pos>1 1 1</gml:pos><gml:pos>2 1 1</gml:pos><gml:pos>2 2 1</gml:pos></gml:LinearRing></gml:interior></gml:Polygon><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>{square}</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></bldg:Building></cityObjectMember></CityModel>')
    rows = sorted(V.citygml(spark, str(tmp_path)).collect(), key=lambda r: r["part"])
    assert [(r["id"], r["part"], len(r["rings"]), len(r["rings"][0])) for r in rows] == [("b1", 0, 2, 4), ("b1", 1, 1, 4)]
    assert rows[0]["properties"] == {"class": "Building", "measuredHeight": "9.5", "use": "shop"}
    inside = tmp_path / "indoor"
    inside.mkdir()
    (inside / "i.gml").write_text(f'<IndoorFeatures xmlns="i" xmlns:gml="g"><cellSpaceMember><CellSpace gml:id="r1"><gml:Solid><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>{square}</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></gml:Solid></CellSpace></cellSpaceMember></IndoorFeatures>')
    assert [(r["id"], r["kind"]) for r in V.indoorgml(spark, str(inside)).collect()] == [("r1", "Polygon")]


def test_point_clouds(spark, tmp_path):
    from orograph.sources import clouds

    rng = np.random.default_rng(3)
    rows = [(float(x), float(y), float(z), int(r), int(g), int(b), int(i), int(c)) for x, y, z, r, g, b, i, c in zip(*rng.uniform(-50, 50, (3, 500)), *rng.integers(0, 256, (3, 500)), rng.integers(0, 65536, 500), rng.integers(-5, 5, 500))]
    points = spark.createDataFrame(rows, "x double, y double, z double, r int, g int, b int, intensity int, class int")
    assert clouds.write(points, str(tmp_path / "c"), 30.0, per_file=20) > 16
    got = sorted(tuple(r)[1:] for r in clouds.read(spark, str(tmp_path / "c")).collect())
    assert np.allclose(np.array(got)[:, :3], np.array(sorted(rows))[:, :3], atol=1e-4)
    assert sorted(g[3:] for g in got) == sorted(r[3:] for r in rows)
    with pytest.raises(ValueError, match="no number"):
        clouds.encoded({"x": [float("nan")], "y": [0.0], "z": [0.0], "r": [0], "g": [0], "b": [0], "intensity": [0], "class": [0]}, (1, 1, 1), (0, 0, 0))
    clouds.write_sets(points.withColumn("id", F.monotonically_increasing_id()), str(tmp_path / "s"), 100)
    assert clouds.read_sets(spark, str(tmp_path / "s")).count() == 500 and len(list((tmp_path / "s").glob("set=*"))) == 5
