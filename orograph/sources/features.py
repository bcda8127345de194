"""Vector features of shapefiles, GeoPackages, CityGML and IndoorGML, and model placements of their points.

Files come through Spark's binary source, so any store that Spark reads will do, and a file is read where it is worked on. Every
reader gives the rows of ``vectors.geojson``: id, kind (Point, LineString, Polygon), part, rings of (x, y, z), properties.
"""

from __future__ import annotations

import codecs
import re
import sqlite3
import struct
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Point = tuple[float, float, float]
Rings = list[list[Point]]
Feature = tuple[str, str, int, Rings, dict[str, str]]
_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())])
_SCHEMA = pa.schema([("file", pa.string()), ("id", pa.string()), ("kind", pa.string()), ("part", pa.int32()), ("rings", pa.list_(pa.list_(_POINT))), ("properties", pa.map_(pa.string(), pa.string()))])
_DDL = "file string, id string, kind string, part int, rings array<array<struct<x:double,y:double,z:double>>>, properties map<string,string>"


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")
    if files.select("path").isEmpty():
        raise ValueError(f"no {pattern} in {path}")
    return files


def _mapped(files: DataFrame, each: Callable[[bytes], Iterator[Feature]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held: list[dict] = []
                for i, kind, part, rings, properties in each(content):
                    points = [[{"x": x, "y": y, "z": z} for x, y, z in ring] for ring in rings]
                    held.append({"file": path, "id": i, "kind": kind, "part": part, "rings": points, "properties": list(properties.items())})
                    if len(held) >= 1000:
                        yield pa.RecordBatch.from_pylist(held, _SCHEMA)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, _SCHEMA)

    return files.mapInArrow(run, _DDL)


# Shapefiles


def _clockwise(ring: list[Point]) -> bool:
    return sum((b[0] - a[0]) * (b[1] + a[1]) for a, b in zip(ring, ring[1:] + ring[:1])) > 0


def _shapes(raw: bytes) -> Iterator[Feature]:
    """Records of a .shp file; a polygon's holes follow their outer ring. The id is the record's number from 0."""
    # Fixed values of the format: shape types by their last digit, of which those from 11 on have heights.
    at, number = 100, 0
    while at + 12 <= len(raw):
        (words,) = struct.unpack_from(">i", raw, at + 4)
        at += 8
        (kind,) = struct.unpack_from("<i", raw, at)
        body, sort, tall = at + 4, kind % 10, 10 < kind < 20
        at += words * 2
        i, number = str(number), number + 1
        if sort == 1:
            x, y = struct.unpack_from("<2d", raw, body)
            z = struct.unpack_from("<d", raw, body + 16)[0] if tall else 0.0
            yield i, "Point", 0, [[(x, y, z)]], {}
        elif sort == 8:
            (n,) = struct.unpack_from("<i", raw, body + 32)
            heights = struct.unpack_from(f"<{n}d", raw, body + 36 + 16 * n + 16) if tall else (0.0,) * n
            for k in range(n):
                x, y = struct.unpack_from("<2d", raw, body + 36 + 16 * k)
                yield i, "Point", k, [[(x, y, heights[k])]], {}
        elif sort in (3, 5):
            parts, n = struct.unpack_from("<2i", raw, body + 32)
            starts = [*struct.unpack_from(f"<{parts}i", raw, body + 40), n]
            place = body + 40 + 4 * parts
            flat = struct.unpack_from(f"<{2 * n}d", raw, place)
            heights = struct.unpack_from(f"<{n}d", raw, place + 16 * n + 16) if tall else (0.0,) * n
            rings = [[(flat[2 * k], flat[2 * k + 1], heights[k]) for k in range(a, b)] for a, b in zip(starts, starts[1:])]
            if sort == 3:
                for k, line in enumerate(rings):
                    yield i, "LineString", k, [line], {}
                continue
            groups: list[Rings] = []
            for ring in rings:
                if _clockwise(ring) or not groups:
                    groups.append([ring])
                else:
                    groups[-1].append(ring)
            for k, group in enumerate(groups):
                yield i, "Polygon", k, group, {}


def _text(raw: bytes, charset: str | None) -> str:
    """By the charset if it fits, else as UTF-8, Korean or Latin: the first that can be read."""
    for name in (charset, "utf-8", "cp949", "latin-1"):
        try:
            if name:
                return raw.decode(name)
        except (UnicodeDecodeError, LookupError):
            pass
    return raw.decode("latin-1")


def _table(raw: bytes, charset: str | None) -> Iterator[tuple[int, dict[str, str]]]:
    """Rows of a .dbf file as text; deleted ones keep their number."""
    n, head, size = struct.unpack_from("<IHH", raw, 4)
    fields, at, place = [], 32, 1
    while at < head - 1 and raw[at] != 0x0D:
        fields.append((_text(raw[at : at + 11].split(b"\0")[0], charset), place, raw[at + 16]))
        place += raw[at + 16]
        at += 32
    for k in range(n):
        row = raw[head + k * size : head + (k + 1) * size]
        if row[:1] != b"*":
            yield k, {name: _text(row[a : a + w], charset).strip() for name, a, w in fields}


def _known_system(wkt: str) -> int:
    """4326 or 3857 of a .prj text; others are an error."""
    if not wkt.strip() or wkt.lstrip().startswith("GEOGCS") or wkt.lstrip().startswith("GEOGCRS"):
        return 4326
    if re.search(r"3857|Pseudo-?_?Mercator|Auxiliary_Sphere", wkt):
        return 3857
    raise ValueError(f"coordinate system {wkt[:60]} is not supported; EPSG:4326 and EPSG:3857 are")


def shapefile(spark: SparkSession, path: str) -> DataFrame:
    """Features of .shp files with the attributes of the .dbf files beside them, in degrees. The charset is that of a .cpg file,
    else found out; the system that of a .prj file, else degrees."""
    stem = F.regexp_replace("path", r"\.[^.]*$", "")
    shapes = _mapped(_files(spark, path, "*.shp"), _shapes).withColumn("file", F.regexp_replace("file", r"\.[^.]*$", ""))
    small = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    notes = small.option("pathGlobFilter", "*.{cpg,prj}").load(path).select(stem.alias("file"), F.lower(F.regexp_extract("path", r"([^.]*)$", 1)).alias("sort"), F.col("content").cast("string").alias("text"))
    about = notes.groupBy("file").agg(F.max(F.when(F.col("sort") == "cpg", F.trim("text"))).alias("charset"), F.max(F.when(F.col("sort") == "prj", F.col("text"))).alias("wkt"))
    tables = small.option("pathGlobFilter", "*.dbf").load(path).select(stem.alias("file"), "content").join(about, "file", "left")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                charset = r["charset"] or None
                try:
                    charset = codecs.lookup(charset).name if charset else None
                except LookupError:
                    charset = f"cp{charset}" if charset.isdigit() else None
                found = [{"file": r["file"], "id": str(k), "properties": list(p.items())} for k, p in _table(r["content"], charset)]
                yield pa.RecordBatch.from_pylist(found, pa.schema([("file", pa.string()), ("id", pa.string()), ("properties", pa.map_(pa.string(), pa.string()))]))

    attributes = tables.select("file", "content", "charset").mapInArrow(rows, "file string, id string, properties map<string,string>")
    system = F.udf(lambda wkt: _known_system(wkt or ""), "int")  # once a file
    joined = shapes.drop("properties").join(attributes, ["file", "id"], "left").join(about.select("file", system("wkt").alias("crs")), "file", "left")
    return _in_degrees(joined, F.coalesce("crs", F.lit(4326))).select("file", "id", "kind", "part", "rings", F.coalesce("properties", F.create_map().cast("map<string,string>")).alias("properties"))


def _in_degrees(features: DataFrame, crs: Column) -> DataFrame:
    from ..functions import geodesy as G

    def turned(p: Column) -> Column:
        lon, lat = G.from_mercator(p["x"], p["y"])
        return F.struct(lon.alias("x"), lat.alias("y"), p["z"].alias("z"))

    return features.withColumn("rings", F.when(crs == 3857, F.transform("rings", lambda r: F.transform(r, turned))).otherwise(F.col("rings")))


# GeoPackages


def _wkb(raw: bytes, at: int = 0) -> tuple[list[tuple[str, Rings]], int]:
    """(kind, rings) of each part of a well-known binary geometry, and where it ends; collections give all their parts."""
    order = "<" if raw[at] == 1 else ">"
    (kind,) = struct.unpack_from(order + "I", raw, at + 1)
    tall = bool(kind & 0x80000000) or kind // 1000 in (1, 3)
    wide = 2 + tall + (bool(kind & 0x40000000) or kind // 1000 in (2, 3))
    kind = (kind & 0xFFFF) % 1000
    at += 5

    def points(n: int) -> list[Point]:
        nonlocal at
        v = struct.unpack_from(f"{order}{n * wide}d", raw, at)
        at += 8 * n * wide
        return [(v[k], v[k + 1], v[k + 2] if tall else 0.0) for k in range(0, n * wide, wide)]

    def count() -> int:
        nonlocal at
        (n,) = struct.unpack_from(order + "I", raw, at)
        at += 4
        return n

    if kind == 1:
        return [("Point", [points(1)])], at
    if kind == 2:
        return [("LineString", [points(count())])], at
    if kind == 3:
        return [("Polygon", [points(count()) for _ in range(count())])], at
    out: list[tuple[str, Rings]] = []
    if 4 <= kind <= 7:
        for _ in range(count()):
            parts, at = _wkb(raw, at)
            out += parts
        return out, at
    raise ValueError(f"geometry type {kind} is not supported")


def _package(raw: bytes) -> Iterator[Feature]:
    con = sqlite3.connect(":memory:")
    con.deserialize(raw)
    quote = lambda name: '"' + name.replace('"', '""') + '"'
    for table, geometry, system in con.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns ORDER BY table_name").fetchall():
        if system not in (4326, 3857, 0, -1):
            raise ValueError(f"EPSG:{system} is not supported; EPSG:4326 and EPSG:3857 are")
        rows = con.execute(f"SELECT rowid, * FROM {quote(table)}")
        names = [d[0] for d in rows.description][1:]
        for row in rows:
            values = dict(zip(names, row[1:]))
            blob = values.pop(geometry)
            if blob is None or blob[:2] != b"GP":
                continue
            envelope = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]  # fixed values of the format: bytes of the envelope by its sort
            properties = {k: "null" if v is None else str(v) for k, v in values.items()} | {"__table": table, "__crs": str(system)}
            for part, (kind, rings) in enumerate(_wkb(blob, 8 + envelope)[0]):
                yield f"{table}.{row[0]}", kind, part, rings, properties
    con.close()


def geopackage(spark: SparkSession, path: str) -> DataFrame:
    """Features of every feature table of .gpkg files, in degrees; property __table names the table."""
    rows = _mapped(_files(spark, path, "*.gpkg"), _package)
    turned = _in_degrees(rows, F.col("properties")["__crs"].cast("int"))
    return turned.withColumn("properties", F.map_filter("properties", lambda k, v: k != "__crs"))


# City and indoor models


def _name(element: ET.Element) -> str:
    return element.tag.rpartition("}")[2]


def _positions(ring: ET.Element) -> list[Point]:
    """The points of a ring: one list of numbers, or one element a point."""
    text = " ".join(e.text or "" for e in ring.iter() if _name(e) in ("posList", "pos"))
    if not text.strip():
        text = " ".join((e.text or "").replace(",", " ") for e in ring.iter() if _name(e) == "coordinates")
    v = [float(x) for x in text.split()]
    return [(v[k], v[k + 1], v[k + 2]) for k in range(0, len(v) - 2, 3)]


def _members(raw: bytes, member: set[str]) -> Iterator[Feature]:
    """A feature for each polygon of each member's object: its id, class and plain attributes go along."""
    root = ET.fromstring(raw)
    for holder in root.iter():
        if _name(holder) not in member:
            continue
        for thing in holder if _name(holder).endswith("ember") else [holder]:
            i = next((v for k, v in thing.attrib.items() if k.rpartition("}")[2] == "id"), "")
            properties = {"class": _name(thing)}
            for e in thing.iter():
                if _name(e).endswith("Attribute") and "name" in e.attrib:
                    properties[e.attrib["name"]] = next((c.text or "" for c in e if _name(c) == "value"), "")
                elif _name(e) in ("measuredHeight", "function", "usage", "yearOfConstruction", "name", "description") and (e.text or "").strip():
                    properties.setdefault(_name(e), e.text.strip())
            part = 0
            for e in thing.iter():
                if _name(e) != "Polygon":
                    continue
                outer = [_positions(r) for r in e if _name(r) == "exterior"]
                holes = [_positions(r) for r in e if _name(r) == "interior"]
                if outer and len(outer[0]) >= 3:
                    yield i, "Polygon", part, [outer[0], *holes], properties
                    part += 1


def citygml(spark: SparkSession, path: str) -> DataFrame:
    """The surfaces of all city objects, as polygons with heights; coordinates as the file has them."""
    return _mapped(_files(spark, path, "*.{gml,xml}"), lambda raw: _members(raw, {"cityObjectMember"}))


def indoorgml(spark: SparkSession, path: str) -> DataFrame:
    """The surfaces of all cells of indoor models."""
    return _mapped(_files(spark, path, "*.{gml,xml}"), lambda raw: _members(raw, {"CellSpace", "GeneralSpace", "TransitionSpace", "ConnectionSpace", "AnchorSpace"}))


# Placements


def placements(features: DataFrame, heading: str = "heading", scale: str = "scale", altitude: str = "altitude", default_scale: float = 1.0) -> DataFrame:
    """Model placements (id, lon, lat, altitude, heading, scale, properties) of point features; attributes are found under
    their name or its capitals, and a point's own height counts where there is no altitude."""
    p = F.get(F.get("rings", F.lit(0)), F.lit(0))
    value = lambda name: F.expr(f"try_cast(coalesce(properties['{name.lower()}'], properties['{name.upper()}']) AS DOUBLE)")
    rows = features.where("kind = 'Point'")
    return rows.select("id", "part", p["x"].alias("lon"), p["y"].alias("lat"), F.coalesce(value(altitude), p["z"]).alias("altitude"), F.coalesce(value(heading), F.lit(0.0)).alias("heading"), F.coalesce(value(scale), F.lit(default_scale)).alias("scale"), "properties")
