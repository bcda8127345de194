"""Tile ranges as rows (depth, min_x, max_x, min_y, max_y), inclusive, and the sets of tiles they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tiles as T
from ..functions.numbers import to_int

BOUNDS = ["min_x", "max_x", "min_y", "max_y"]


def of_extents(df: DataFrame, depth: Column) -> DataFrame:
    """df with its extents' tile ranges at a depth."""
    d = df.withColumn("depth", depth)
    return d.withColumns(T.range_of(F.col("depth"), F.col("min_lon"), F.col("min_lat"), F.col("max_lon"), F.col("max_lat")))


def expanded(df: DataFrame, n: int = 1) -> DataFrame:
    """n more tiles on each side; the lower sides stop at 0, the upper ones don't stop."""
    return df.withColumns({"min_x": F.greatest(F.col("min_x") - n, F.lit(0)), "min_y": F.greatest(F.col("min_y") - n, F.lit(0)), "max_x": F.col("max_x") + n, "max_y": F.col("max_y") + n})


def moved(df: DataFrame, by_x: int, by_y: int) -> DataFrame:
    """Ranges moved by so many tiles; the lower sides stop at 0."""
    to = lambda c, n: F.greatest(F.lit(0), F.col(c) + n) if c[:3] == "min" else F.col(c) + n
    return df.withColumns({c: to(c, by_x if c[-1] == "x" else by_y) for c in BOUNDS})


def split_at(df: DataFrame, axis: str, at: int) -> DataFrame:
    """Ranges cut before the tile at of an axis: one or two parts of each, column part 0 below and 1 from there on."""
    low, high = F.col(f"min_{axis}"), F.col(f"max_{axis}")
    parts = F.array(F.struct(F.lit(0).alias("part"), low.alias("a"), F.least(high, F.lit(at - 1)).alias("b")), F.struct(F.lit(1).alias("part"), F.greatest(low, F.lit(at)).alias("a"), high.alias("b")))
    cut = df.withColumn("__p", F.explode(F.filter(parts, lambda p: p["a"] <= p["b"])))
    return cut.withColumns({f"min_{axis}": F.col("__p.a"), f"max_{axis}": F.col("__p.b"), "part": F.col("__p.part")}).drop("__p")


def holds(depth: Column, x: Column, y: Column) -> Column:
    """Is a tile in the range of columns depth, min_x .. max_y?"""
    return (F.col("depth") == depth) & x.between(F.col("min_x"), F.col("max_x")) & y.between(F.col("min_y"), F.col("max_y"))


def deepest(df: DataFrame) -> DataFrame:
    """The greatest depth of ranges or tiles, -1 if there are none."""
    return df.agg(F.coalesce(F.max("depth"), F.lit(-1)).alias("depth"))


def tiles(df: DataFrame) -> DataFrame:
    """One row (depth, x, y) for each valid tile of each range; the range's other columns go along."""
    keep = [c for c in df.columns if c not in BOUNDS]
    rows = df.where("min_x <= max_x AND min_y <= max_y").select(*keep, "min_x", "max_x", F.explode(F.sequence("min_y", "max_y")).alias("y"))
    rows = rows.select(*keep, F.explode(F.sequence("min_x", "max_x")).alias("x"), "y")
    return rows.where(T.is_valid(F.col("depth"), F.col("x"), F.col("y")))


def union(df: DataFrame) -> DataFrame:
    """The distinct tiles of all ranges: overlapping and touching ranges name each tile once."""
    return tiles(df).select("depth", "x", "y").distinct()


def minus(big: DataFrame, small: DataFrame) -> DataFrame:
    """The distinct tiles of big's ranges that are in none of small's."""
    return union(big).join(union(small), ["depth", "x", "y"], "left_anti")


def hull(df: DataFrame) -> DataFrame:
    """For each depth the least range that holds all its ranges."""
    return df.groupBy("depth").agg(F.min("min_x").alias("min_x"), F.max("max_x").alias("max_x"), F.min("min_y").alias("min_y"), F.max("max_y").alias("max_y"))


def blocks(df: DataFrame, columns: int = 16, rows: int = 16) -> DataFrame:
    """Each range in near-equal blocks of columns x rows tiles at most."""
    wide, high = F.col("max_x") - F.col("min_x") + 1, F.col("max_y") - F.col("min_y") + 1
    nx, ny = F.ceil(wide / columns).cast("int"), F.ceil(high / rows).cast("int")
    keep = [c for c in df.columns if c not in BOUNDS]
    cut = df.withColumns({"__wide": wide / nx, "__high": high / ny, "__i": F.explode(F.sequence(F.lit(0), nx - 1))}).withColumn("__j", F.explode(F.sequence(F.lit(0), F.ceil((F.col("max_y") - F.col("min_y") + 1) / rows).cast("int") - 1)))
    at = lambda low, k, size: (F.col(low) + to_int(k * F.col(size))).cast("int")
    return cut.select(*keep, at("min_x", F.col("__i"), "__wide").alias("min_x"), (at("min_x", F.col("__i") + 1, "__wide") - 1).alias("max_x"), at("min_y", F.col("__j"), "__high").alias("min_y"), (at("min_y", F.col("__j") + 1, "__high") - 1).alias("max_y"))


def _corners(a: str, b: str) -> Column:
    """How many of range b's corners lie in range a."""
    inside = lambda x, y: (F.col(f"{b}.{x}").between(F.col(f"{a}.min_x"), F.col(f"{a}.max_x")) & F.col(f"{b}.{y}").between(F.col(f"{a}.min_y"), F.col(f"{a}.max_y"))).cast("int")
    return inside("min_x", "min_y") + inside("max_x", "min_y") + inside("min_x", "max_y") + inside("max_x", "max_y")


def relation(a: str, b: str) -> Column:
    """How two aliased ranges lie to each other: one of twelve names."""
    ab, ba = _corners(a, b), _corners(b, a)
    col = lambda s, c: F.col(f"{s}.{c}")
    touch = lambda axis: (col(a, f"max_{axis}") + 1 == col(b, f"min_{axis}")) | (col(b, f"max_{axis}") + 1 == col(a, f"min_{axis}"))
    same = lambda axis: (col(a, f"min_{axis}") == col(b, f"min_{axis}")) & (col(a, f"max_{axis}") == col(b, f"max_{axis}"))
    apart = (col(a, "max_x") < col(b, "min_x")) | (col(b, "max_x") < col(a, "min_x")) | (col(a, "max_y") < col(b, "min_y")) | (col(b, "max_y") < col(a, "min_y"))
    out = F.when(col(a, "depth") != col(b, "depth"), "NO_INTERSECTION").when(ab == 4, "A_CONTAINS_B").when(ba == 4, "B_CONTAINS_A")
    # The names of partial relations by the numbers of corners inside each other.
    for n, m, name in ((2, 0, "A_CONTAINS_2_B_0"), (2, 1, "A_CONTAINS_2_B_1"), (2, 2, "PARTIAL_OVERLAP"), (1, 1, "A_CONTAINS_1_B_1"), (0, 2, "B_CONTAINS_2_A_0"), (1, 2, "B_CONTAINS_2_A_1")):
        out = out.when((ab == n) & (ba == m), name)
    out = out.when(apart & touch("x") & same("y"), "HORIZONTAL_FULL_TOUCHING").when(apart & ~touch("x") & touch("y") & same("x"), "VERTICAL_FULL_TOUCHING")
    return out.when(apart, "NO_INTERSECTION").otherwise("UNKNOWN")


def layer_json(ranges: DataFrame, name: str = "terrain", normals: bool = False, extensions: list[str] = ()) -> DataFrame:
    """One row with the layer descriptor of all ranges: its available tiles by depth, and the extensions that tiles have."""
    extensions = ["octvertexnormals"] if normals and not extensions else list(extensions)
    each = F.struct(F.col("min_x").alias("startX"), F.col("max_x").alias("endX"), F.col("min_y").alias("startY"), F.col("max_y").alias("endY"))
    by_depth = ranges.groupBy("depth").agg(F.array_sort(F.collect_set(each)).alias("available"))
    filled = F.sequence(F.lit(0), F.max("depth"))
    found = F.map_from_entries(F.collect_list(F.struct("depth", "available")))
    rows = by_depth.agg(F.transform(filled, lambda d: F.coalesce(F.try_element_at(found, d), F.array().cast("array<struct<startX:int,endX:int,startY:int,endY:int>>"))).alias("available"))
    # Fixed values of the descriptor.
    head = {"tilejson": "2.1.0", "name": name, "description": "", "version": "1.1.0", "format": "quantized-mesh-1.0", "attribution": "", "template": "terrain", "legend": "", "scheme": "tms", "projection": "EPSG:4326"}
    parts = [*(F.lit(v).alias(k) for k, v in head.items()), F.array(F.lit("{z}/{x}/{y}.terrain?v={version}")).alias("tiles"), F.array(*map(F.lit, (-180.0, -90.0, 180.0, 90.0))).alias("bounds")]
    if extensions:
        parts.append(F.array(*map(F.lit, extensions)).alias("extensions"))
    return rows.select(F.to_json(F.struct(*parts, "available")).alias("json"))


def from_layer_json(df: DataFrame) -> DataFrame:
    """The ranges that a descriptor (column json) names."""
    schema = "available array<array<struct<startX:int,endX:int,startY:int,endY:int>>>"
    rows = df.select(F.from_json("json", schema)["available"].alias("a")).select(F.posexplode("a").alias("depth", "r")).select("depth", F.explode("r").alias("r"))
    return rows.select("depth", F.col("r.startX").alias("min_x"), F.col("r.endX").alias("max_x"), F.col("r.startY").alias("min_y"), F.col("r.endY").alias("max_y"))
