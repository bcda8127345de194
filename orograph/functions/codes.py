"""Fixed tables and codes: levels of detail, formats, profiles, packed numbers, text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Formats by name, with their extension and a second one. The first that matches counts.
FORMATS = [
    ("KML", "kml", "kml"), ("GLTF", "gltf", "glb"), ("GLB", "glb", "gltf"), ("COLLADA", "dae", "dae"), ("MAX_3DS", "3ds", "3ds"),
    ("MAX_ASE", "ase", "ase"), ("FBX", "fbx", "fbx"), ("OBJ", "obj", "obj"), ("T3MF", "3mf", "3mf"), ("PLY", "ply", "ply"),
    ("X3D", "x3d", "x3d"), ("STL", "stl", "stl"), ("IFC", "ifc", "ifc"), ("CITYGML", "gml", "xml"), ("INDOORGML", "gml", "xml"),
    ("MODO", "lxo", "lxo"), ("LWO", "lwo", "lwo"), ("LWS", "lws", "lws"), ("DirectX", "x", "x"), ("SHP", "shp", "shp"),
    ("GEOJSON", "geojson", "json"), ("GEO_PACKAGE", "gpkg", "gpkg"), ("LAS", "las", "laz"), ("LAZ", "laz", "las"),
    ("B3DM", "b3dm", "gltf"), ("I3DM", "i3dm", "gltf"), ("PNTS", "pnts", "gltf"), ("TILESET", "tileset", "json"),
    ("INSTANCE", "instance", "gltf"), ("BATCH", "batch", "gltf"), ("POINTCLOUD", "pointcloud", "gltf"), ("FOREST", "forest", "forest"),
    ("PHOTOGRAMMETRY", "photogrammetry", "pg"), ("TEMP", "tmp", "temp"),
]
# Formats that stand for another one when named by their own extension.
ALIASES = {"instance": "I3DM", "batch": "B3DM", "pointcloud": "PNTS"}
# Profiles of pipes and kinds of textures by code.
PROFILES = ["UNKNOWN", "CIRCULAR", "RECTANGULAR", "OVAL", "IRREGULAR"]
TEXTURES = "NONE DIFFUSE SPECULAR AMBIENT EMISSIVE HEIGHT NORMALS SHININESS OPACITY DISPLACEMENT LIGHTMAP REFLECTION BASE_COLOR NORMAL_CAMERA EMISSION_COLOR METALNESS DIFFUSE_ROUGHNESS AMBIENT_OCCLUSION UNKNOWN".split()
# Geometric errors of blocks of the first levels of detail.
_BLOCK_ERRORS = [0, 8, 50]


def format_of(extension: Column) -> Column:
    """The format that a name or extension stands for, in any case; null if there is none."""
    e, out = F.lower(extension), F
    for own, stands_for in ALIASES.items():
        out = out.when(e == own, stands_for)
    for name, own, other in FORMATS:
        out = out.when(e.isin(name.lower(), own, other), name)
    return out.otherwise(F.lit(None))


def _by_code(code: Column, names: list[str], default: str) -> Column:
    return F.coalesce(F.try_element_at(F.array(*map(F.lit, names)), F.when(code >= 0, code + 1)), F.lit(default))


def profile_of(code: Column) -> Column:
    return _by_code(code, PROFILES, "UNKNOWN")


def texture_of(code: Column) -> Column:
    return _by_code(code, TEXTURES, "UNKNOWN")


def same_profile(a: str, b: str) -> Column:
    """Have two pipes (columns {a}_type, {a}_diameter, {a}_width, {a}_height) the same profile? The sizes count for circles
    and rectangles only."""
    col = lambda c: F.col(f"{a}_{c}") == F.col(f"{b}_{c}")
    sizes = F.when(F.col(f"{a}_type") == "CIRCULAR", col("diameter")).when(F.col(f"{a}_type") == "RECTANGULAR", col("width") & col("height")).otherwise(True)
    return col("type") & sizes


def buildable(link: tuple[Column, Column, Column], edge: tuple[Column, Column, Column]) -> Column:
    """Does the line between two elbows run the way of their edge?"""
    return link[0] * edge[0] + link[1] * edge[1] + link[2] * edge[2] >= 0


def levels_of_detail(spark: SparkSession, levels: int = 24) -> DataFrame:
    """level, geometric error (2^level, 0 at first), error of blocks and share of a texture's size."""
    n = F.col("level")
    blocks = F.coalesce(F.try_element_at(F.array(*map(F.lit, _BLOCK_ERRORS)), n + 1), (n - 1) * 60).cast("int")
    scale = F.when(n < 6, F.pow(F.lit(0.5), n)).otherwise(0.01625 * F.pow(F.lit(0.5), n - 6))
    return spark.range(levels).select(F.col("id").cast("int").alias("level")).withColumns({"error": F.when(n == 0, 0).otherwise(F.pow(F.lit(2), n)).cast("int"), "block_error": blocks, "texture_scale": scale})


def float_mod(a: Column, b: Column) -> Column:
    """a modulo b with the sign of b, in single precision."""
    a, b = a.cast("float"), b.cast("float")
    return (a - b * F.floor((a / b).cast("float")).cast("double")).cast("float")


def packed_depth(depth: Column) -> Column:
    """A depth from 0 to 1 as four bytes, the finest first: what 8-bit channels keep of it."""
    f = lambda v: F.lit(v).cast("float")
    part = [float_mod((depth.cast("float") * f(s) * f(255.0)).cast("float"), f(256.0)) / f(255.0) for s in (16777216.0, 65536.0, 256.0, 1.0)]
    part = [p.cast("float") for p in part]
    rest = [part[0], *((part[k] - (part[k - 1] * f(0.00390625)).cast("float")).cast("float") for k in (1, 2, 3))]
    return F.array(*((r * f(255.0)).cast("float").cast("int") for r in reversed(rest)))


def unpacked_depth(channels: Column) -> Column:
    """The depth that four channels from 0 to 1 stand for, the coarsest first."""
    return sum((F.get(channels, F.lit(k)) / 256.0**k for k in range(1, 4)), F.get(channels, F.lit(0)))


def milliseconds(c: Column) -> Column:
    """A time as hours, minutes, seconds and milliseconds; leading parts that are zero are left out."""
    h, m, s, ms = F.floor(c / 3_600_000), F.floor(c / 60_000) % 60, F.floor(c / 1000) % 60, c % 1000
    part = lambda v, name, there: F.when(there, F.concat(v.cast("long").cast("string"), F.lit(name)))
    return F.concat_ws(" ", part(h, "h", c >= 3_600_000), part(m, "m", c >= 60_000), part(s, "s", c >= 1000), part(ms, "ms", F.lit(True)))


def is_int(text: Column) -> Column:
    """Is a text a whole number of 32 bits?"""
    return text.rlike(r"^[+-]?\d{1,18}$") & F.coalesce(text.try_cast("long").between(-(1 << 31), (1 << 31) - 1), F.lit(False))


def extension(path: Column) -> Column:
    """What follows the last dot of a path's last part, or nothing."""
    return F.regexp_extract(path, r"\.([^./\\]*)$", 1)


def without_extension(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./\\]*$", "")


def padded_bytes(text: Column, to: int = 4) -> Column:
    """Text filled with blanks to a multiple of to bytes in UTF-8."""
    return F.concat(text, F.repeat(F.lit(" "), F.pmod(-F.octet_length(text), F.lit(to))))


def first_difference(a: Column, b: Column) -> Column:
    """The first folder in which path a differs from path b, null if there is none."""
    pairs = F.arrays_zip(F.split(F.regexp_replace(a, r"\\", "/"), "/").alias("a"), F.split(F.regexp_replace(b, r"\\", "/"), "/").alias("b"))
    return F.get(F.filter(pairs, lambda p: p["a"].isNotNull() & (p["b"].isNull() | (p["a"] != p["b"]))), F.lit(0))["a"]


def texture_size(n: Column, way: str = "nearest") -> Column:
    """The power of two above, below or nearest to n, at least 32 and at most 16384."""
    log = F.log2(n.cast("double"))
    power = {"up": F.ceil(log), "down": F.floor(log), "nearest": F.round(log)}[way]
    return F.least(F.lit(16384), F.greatest(F.lit(32), F.pow(F.lit(2.0), power).cast("int")))


def positive_coordinate(u: Column) -> Column:
    """A repeating texture coordinate within 0 and 1; whole numbers above 0 are 1."""
    return F.when(u < 0, u + F.ceil(-u)).when(u > 1, u - F.ceil(u - 1)).otherwise(u)


def clamped_coordinate(u: Column, margin: float) -> Column:
    return F.greatest(F.lit(margin), F.least(F.lit(1.0 - margin), u))


def point_count(area: Column, share: float, diameter: float) -> Column:
    """How many points of a diameter fill a share of an area."""
    return (area * share / (diameter * diameter)).cast("int")


# Classes of surfaces by kind of city object, and their colours.
COLOURS = {
    "WALL": (0.5, 0.5, 0.5, 1.0), "ROOF": (1.0, 0.0, 0.0, 1.0), "DOOR": (0.0, 0.0, 1.0, 1.0), "WINDOW": (0.0, 1.0, 1.0, 0.5), "CEILING": (0.6, 0.6, 0.6, 1.0),
    "FLOOR": (0.2, 0.2, 0.2, 1.0), "STAIRS": (0.4, 0.4, 0.4, 1.0), "GROUND": (0.0, 1.0, 0.0, 1.0), "WATER": (0.0, 0.0, 1.0, 0.5), "FURNITURE": (1.0, 0.05, 0.05, 1.0),
    "INSTALLATION": (1.0, 0.5, 0.25, 1.0), "INFRASTRUCTURE": (1.0, 0.25, 0.0, 1.0), "UNKNOWN": (0.5, 0.5, 0.5, 1.0),
}
CITY_CLASSES = {
    "CeilingSurface": "CEILING", "InteriorWallSurface": "WALL", "FloorSurface": "FLOOR", "GroundSurface": "FLOOR", "RoofSurface": "ROOF", "WallSurface": "WALL",
    "ClosureSurface": "WINDOW", "DoorSurface": "DOOR", "WindowSurface": "WINDOW", "WaterSurface": "WATER", "WaterGroundSurface": "GROUND", "ReliefFeature": "GROUND",
    "Building": "WALL", "BuildingFurniture": "FURNITURE", "BuildingInstallation": "INSTALLATION", "BuildingPart": "WALL", "BuildingRoom": "WALL",
    "CityFurniture": "FURNITURE", "Bridge": "INFRASTRUCTURE", "BridgeFurniture": "FURNITURE", "BridgeInstallation": "INSTALLATION", "Tunnel": "INFRASTRUCTURE",
    "TunnelFurniture": "FURNITURE", "TunnelInstallation": "INSTALLATION", "WaterBody": "WATER", "Railway": "WALL", "GenericOccupiedSpace": "FURNITURE",
    "SolitaryVegetationObject": "GROUND", "Road": "FLOOR", "PlantCover": "INSTALLATION",
}


def city_class(kind: Column) -> Column:
    """The class of a city object's or surface's kind; others are walls."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(v) for pair in CITY_CLASSES.items() for v in pair)), kind), F.lit("WALL"))


def class_colour(name: Column) -> Column:
    """The colour (r, g, b, a) of a class."""
    return F.element_at(F.create_map(*(c for k, v in COLOURS.items() for c in (F.lit(k), F.array(*map(F.lit, v))))), name)
