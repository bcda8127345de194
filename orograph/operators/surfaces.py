"""Borders, stitching, states and bookkeeping of meshes as tables.

Vertices are rows (l, x, y, vid, lon, lat, h), triangles rows (l, x, y, tid, v0, v1, v2) with vertex ids of their tile; edges are
derived. A model without pointers needs no re-linking: what shares an exact position is one vertex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tiles as T
from . import mesh as M

TILE = ["l", "x", "y"]
# An edge's class by its place in a tile.
CLASSES = {"UNKNOWN": -1, "LEFT": 0, "RIGHT": 1, "UP": 2, "DOWN": 3, "INTERIOR": 4}
ACTIVE, DELETED = 0, 1


def active(df: DataFrame) -> DataFrame:
    """Rows whose status does not say deleted."""
    return df.where(F.coalesce(F.col("status"), F.lit(ACTIVE)) != DELETED)


def edge_class(a: tuple[Column, Column], b: tuple[Column, Column], error: float = 1e-13) -> Column:
    """The class of an edge by its ends' lon, lat in the tile of columns l, x, y: both on one side, else interior."""
    box = T.extent(F.col("l"), F.col("x"), F.col("y"))
    on = lambda k, side: (F.abs(a[k] - box[side]) < error) & (F.abs(b[k] - box[side]) < error)
    sides = (("LEFT", 0, "min_lon"), ("RIGHT", 0, "max_lon"), ("UP", 1, "max_lat"), ("DOWN", 1, "min_lat"))
    out = F
    for name, k, side in sides:
        out = out.when(on(k, side), CLASSES[name])
    return out.otherwise(CLASSES["INTERIOR"])


def clamped(vertices: DataFrame, error: float = 1e-8) -> DataFrame:
    """Vertices with those next to a side of their tile exactly on it."""
    box = T.extent(F.col("l"), F.col("x"), F.col("y"))
    snap = lambda c, low, high: F.when(F.abs(c - box[low]) < error, box[low]).when(F.abs(c - box[high]) < error, box[high]).otherwise(c)
    return vertices.withColumns({"lon": snap(F.col("lon"), "min_lon", "max_lon"), "lat": snap(F.col("lat"), "min_lat", "max_lat")})


def border_vertices(vertices: DataFrame, error: float = 1e-13) -> DataFrame:
    """Vertices on their tile's sides with the side's class and their rank along it: west and east from the north, south
    and north from the west."""
    box = T.extent(F.col("l"), F.col("x"), F.col("y"))
    near = lambda c, side: F.abs(F.col(c) - box[side]) < error
    sides = [("LEFT", near("lon", "min_lon"), -F.col("lat")), ("RIGHT", near("lon", "max_lon"), -F.col("lat")), ("UP", near("lat", "max_lat"), F.col("lon")), ("DOWN", near("lat", "min_lat"), F.col("lon"))]
    each = F.filter(F.array(*(F.when(there, F.struct(F.lit(CLASSES[n]).alias("side"), along.alias("along"))) for n, there, along in sides)), lambda s: s.isNotNull())
    rows = vertices.withColumn("__s", F.explode(each)).withColumns({"side": F.col("__s.side"), "__along": F.col("__s.along")}).drop("__s")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*TILE, "side").orderBy("__along", "vid")) - 1).drop("__along")


def zipped_borders(vertices: DataFrame) -> DataFrame:
    """Each vertex on a tile's eastern side with the one of the same rank on the western side of the next tile, and how far
    they are apart: zero where borders don't crack. Sides of different length leave vertices without partner."""
    b = border_vertices(vertices)
    left = b.where(F.col("side") == CLASSES["RIGHT"]).select("l", "x", "y", "rank", "lat", "h")
    right = b.where(F.col("side") == CLASSES["LEFT"]).select("l", (F.col("x") - 1).alias("x"), "y", "rank", F.col("lat").alias("lat2"), F.col("h").alias("h2"))
    return left.join(right, [*TILE, "rank"], "full_outer").withColumns({"apart": F.abs(F.col("lat") - F.col("lat2")), "step": F.abs(F.col("h") - F.col("h2"))})


def stitched(vertices: DataFrame, triangles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All tiles' meshes as one: vertices (gid, lon, lat, h) by exact position, heights averaged where tiles differ, and
    triangles with those ids. An id is the position's hash and rank, so no task numbers all vertices."""
    at = F.xxhash64("lon", "lat")
    one = vertices.groupBy("lon", "lat").agg(F.avg("h").alias("h"), F.count("*").alias("tiles")).withColumn("gid", at)
    names = vertices.select(*TILE, "vid", at.alias("gid"))
    out = triangles
    for k in range(3):
        out = out.join(names.select(*TILE, F.col("vid").alias(f"v{k}"), F.col("gid").alias(f"g{k}")), [*TILE, f"v{k}"])
    return one.select("gid", "lon", "lat", "h", "tiles"), out.select(*TILE, "tid", *(F.col(f"g{k}").alias(f"v{k}") for k in range(3)))


def separated(triangles: DataFrame, depth: int) -> DataFrame:
    """Triangles (corner columns) with the tile that owns each, by barycentre, and the classes of their three sides there."""
    own = M.owner(depth)
    rows = triangles.withColumns({"l": own["l"], "x": own["tx"], "y": own["ty"]})
    at = [(F.col(f"x{k}"), F.col(f"y{k}")) for k in range(3)]
    return rows.withColumns({f"class{k}": edge_class(at[k], at[(k + 1) % 3]) for k in range(3)})


def possible_twins(edges: DataFrame, error: float) -> DataFrame:
    """Pairs of directed edges (edge, ax, ay, bx, by) that run against each other between points closer than error.

    Start points fall in cells of twice the error; an edge is sought in the cells around its end, so pairs across cells are found.
    """
    cell = lambda c: F.floor(c / (2 * error)).cast("long")
    left = edges.withColumns({"__i": cell(F.col("ax")), "__j": cell(F.col("ay"))})
    around = F.explode(F.array(*(F.struct((cell(F.col("bx")) + i).alias("i"), (cell(F.col("by")) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    right = edges.select(F.col("edge").alias("twin"), *(F.col(c).alias(f"{c}2") for c in ("ax", "ay", "bx", "by")), around.alias("__c"))
    near = lambda p, q: F.abs(F.col(p) - F.col(q)) < error
    pairs = left.join(right, (F.col("__i") == F.col("__c.i")) & (F.col("__j") == F.col("__c.j")))
    return pairs.where(near("ax", "bx2") & near("ay", "by2") & near("bx", "ax2") & near("by", "ay2") & (F.col("edge") != F.col("twin"))).select("edge", "twin")


def edge_measures() -> dict[str, Column]:
    """Of an edge (ax, ay, az, bx, by, bz): squared lengths in the plane and in space, its middle and its direction."""
    d = {c: F.col(f"b{c}") - F.col(f"a{c}") for c in "xyz"}
    flat = d["x"] * d["x"] + d["y"] * d["y"]
    whole = flat + d["z"] * d["z"]
    size = F.nullif(F.sqrt(whole), F.lit(0.0))
    return {"flat2": flat, "length2": whole, **{f"mid_{c}": (F.col(f"a{c}") + F.col(f"b{c}")) / 2.0 for c in "xyz"}, **{f"dir_{c}": d[c] / size for c in "xyz"}}


def point_on_edge(t: Column) -> dict[str, Column]:
    """The point at a share of the way along an edge."""
    return {c: F.col(f"a{c}") + t * (F.col(f"b{c}") - F.col(f"a{c}")) for c in "xyz"}


def joined(meshes: list[DataFrame]) -> DataFrame:
    """Meshes (face, v0, v1, v2) as one; ids of later ones go on after the earlier ones'."""
    out, offset = None, {"face": F.lit(0).cast("long"), "v": F.lit(0).cast("long")}
    faces = vertices = 0
    for m in meshes:
        rows = m.select((F.col("face") + offset["face"]).alias("face"), *((F.col(f"v{k}") + offset["v"]).alias(f"v{k}") for k in range(3)))
        out = rows if out is None else out.unionByName(rows)
        top = m.agg(F.max("face").alias("f"), F.max(F.greatest("v0", "v1", "v2")).alias("v")).first()
        faces, vertices = faces + (top["f"] if top["f"] is not None else -1) + 1, vertices + (top["v"] if top["v"] is not None else -1) + 1
        offset = {"face": F.lit(faces).cast("long"), "v": F.lit(vertices).cast("long")}
    return out


def upserted(old: DataFrame, new: DataFrame, key: list[str] = TILE) -> DataFrame:
    """A state with new rows in place of the old ones of their keys."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def loaded_or(wanted: DataFrame, state: DataFrame, initial: dict[str, Column], key: list[str] = TILE) -> DataFrame:
    """Wanted keys with their state, and with the initial one where there is none."""
    there = state.withColumn("__there", F.lit(True))
    rows = wanted.select(*key).distinct().join(there, key, "left")
    return rows.select(*key, *(F.when(F.col("__there"), F.col(c)).otherwise(initial.get(c, F.lit(None))).alias(c) for c in state.columns if c not in key), F.coalesce("__there", F.lit(False)).alias("loaded"))


def integrity(faces: DataFrame) -> DataFrame:
    """One row of what a mesh of faces (face, v0, v1, v2) should not have: repeated corners, faces that occur again, and edges
    that more than one other runs against or along; and how many border edges there are."""
    e = M.edges(faces).groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.count("*").alias("n"), F.sum((F.col("a") < F.col("b")).cast("int")).alias("up"))
    edges = e.agg(F.count_if(F.col("n") > 2).alias("crowded"), F.count_if((F.col("n") == 2) & (F.col("up") != 1)).alias("turned"), F.count_if(F.col("n") == 1).alias("border"))
    repeated = (F.col("v0") == F.col("v1")) | (F.col("v1") == F.col("v2")) | (F.col("v2") == F.col("v0"))
    same = faces.groupBy(F.array_sort(F.array("v0", "v1", "v2")).alias("c")).count().agg(F.count_if(F.col("count") > 1).alias("again"))
    return faces.agg(F.count("*").alias("faces"), F.count_if(repeated).alias("repeated")).crossJoin(same).crossJoin(edges)  # one row each


def counts(triangles: DataFrame, by: list[str]) -> DataFrame:
    """Triangles and distinct corners of each group."""
    v = triangles.select(*by, "face", F.explode(F.array("v0", "v1", "v2")).alias("v"))
    return v.groupBy(*by).agg(F.count_distinct("face").alias("faces"), F.count_distinct("v").alias("vertices"))


def vertex_faces(faces: DataFrame) -> DataFrame:
    """vertex, face, k: the faces around each corner, one row each."""
    return faces.select("face", F.posexplode(F.array("v0", "v1", "v2")).alias("k", "vertex")).select("vertex", "face", "k")


def mean_normal(triangles: DataFrame) -> DataFrame:
    """The unit mean of all triangles' unit normals (plane coordinates), one row; null if they cancel out."""
    from ..functions import geodesy as G

    n = G.unit(M.plane()[:3])
    total = triangles.select(*(c.alias(f"n{a}") for a, c in zip("xyz", n))).agg(*(F.sum(f"n{a}").alias(f"n{a}") for a in "xyz"))
    return total.select(*(c.alias(a) for a, c in zip("xyz", G.unit((F.col("nx"), F.col("ny"), F.col("nz"))))))


def combined_headers(headers: DataFrame) -> DataFrame:
    """One header of many (number, size, min_x .. max_z): sizes summed, boxes joined, the last number."""
    ends = [(F.min if s[:3] == "min" else F.max)(s).alias(s) for s in (f"{m}_{a}" for m in ("min", "max") for a in "xyz")]
    return headers.agg(F.sum("size").alias("size"), *ends, F.max("number").alias("number"))


def report_counts(messages: DataFrame) -> DataFrame:
    """How many messages (level, text) there are of each severity."""
    return messages.agg(*(F.count_if(F.upper("level") == n).alias(n.lower()) for n in ("INFO", "WARN", "ERROR", "FATAL")))


def first_extent(points: DataFrame, extents: DataFrame, key: str = "id") -> DataFrame:
    """Each point with the first of the extents (by id) that hold it, null if none does."""
    from .spatial import points_in_extents

    hit = points_in_extents(points, extents).groupBy(key).agg(F.min("e_id").alias("extent"))
    return points.join(hit, key, "left")


# Orders


def by_length(edges: DataFrame) -> DataFrame:
    """Edges with their rank by length, ties by number."""
    return edges.orderBy(edge_measures()["length2"], "edge")


def shuffled(df: DataFrame, seed: int, *key: str) -> DataFrame:
    """Rows in an order that the seed and their key tell, the same on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key)


def pattern_place(i: Column, slots: int = 1 << 19, seed: int = 0) -> Column:
    """The place of row i in the order that shuffles slots and repeats over blocks of them: all first slots come first."""
    slot, block = F.pmod(i, F.lit(slots)), F.floor(i / slots)
    # An odd multiplier and an offset permute the slots, which are a power of two.
    mixed = F.pmod(slot * (2 * (seed * 48_271 + 100_003) + 1) + seed * 7919 + 12_345, F.lit(slots))
    return F.struct(mixed.alias("slot"), block.alias("block"))


def unique_numbers(spark, n: int, below: int, seed: int) -> DataFrame:
    """n different numbers from 0 to below, by seed."""
    return spark.range(below).select(F.col("id").alias("number")).orderBy(F.xxhash64(F.lit(seed), "number")).limit(n)


# Welding by distance


def weld(vertices: DataFrame, error: float, alike: Column | None = None) -> DataFrame:
    """vertex, root of vertices (vertex, x, y, z, other columns): those within error of each other, directly or through
    others, have one root, the least vertex. alike may ask more of a pair: columns of the second are named with a 2.

    Equal positions are one vertex first; then cells of the error's size are joined with the 27 around them.
    """
    first = vertices.groupBy("x", "y", "z").agg(F.min("vertex").alias("rep")) if alike is None else vertices.withColumn("rep", F.col("vertex"))
    cell = lambda c: F.floor(F.col(c) / error).cast("long")
    here = first.withColumns({f"__{c}": cell(c) for c in "xyz"})
    steps = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
    around = F.explode(F.array(*(F.struct(*((cell(c) + s).alias(c) for c, s in zip("xyz", step))) for step in steps)))
    there = first.select(*(F.col(c).alias(f"{c}2") for c in first.columns), around.alias("__c"))
    near = sum(((F.col(c) - F.col(f"{c}2")) * (F.col(c) - F.col(f"{c}2")) for c in "xyz"), F.lit(0.0)) <= error * error
    pairs = here.join(there, (F.col("__x") == F.col("__c.x")) & (F.col("__y") == F.col("__c.y")) & (F.col("__z") == F.col("__c.z")))
    pairs = pairs.where(near & (F.col("rep") < F.col("rep2")) & (F.lit(True) if alike is None else alike))
    roots = M.components(pairs.select(F.col("rep").alias("a"), F.col("rep2").alias("b")))
    reps = first.join(roots.withColumnRenamed("a", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    return vertices.join(reps.select("x", "y", "z", "root"), ["x", "y", "z"]).select("vertex", "root") if alike is None else reps.select("vertex", "root")


def weldable(normal_error: float = 1e-4, uv_error: float = 1e-4, colour_error: int = 0) -> Column:
    """What weld may ask of a pair besides its places: normals, texture coordinates, colour bytes and batch (columns nx, ny, nz,
    u, v, r, g, b, a, batch)."""
    turn = sum((F.col(f"n{c}") * F.col(f"n{c}2") for c in "xyz"), F.lit(0.0))
    close = lambda c, e: F.abs(F.col(c) - F.col(f"{c}2")) <= e
    out = (F.lit(1.0) - turn <= normal_error) & close("u", uv_error) & close("v", uv_error) & (F.col("batch") == F.col("batch2"))
    for c in "rgba":
        out = out & close(c, colour_error)
    return out


def on_roots(faces: DataFrame, roots: DataFrame) -> DataFrame:
    """Faces whose corners are their roots; those that lose a corner go."""
    out = faces
    for k in range(3):
        out = out.join(roots.select(F.col("vertex").alias(f"v{k}"), F.col("root").alias(f"r{k}")), f"v{k}")
    return out.where("r0 <> r1 AND r1 <> r2 AND r2 <> r0").select("face", *(F.col(f"r{k}").alias(f"v{k}") for k in range(3)))


def unwelded(faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices (vertex, was) of their own for each corner, numbered by face and corner, and faces with these."""
    own = faces.select(F.posexplode(F.array("v0", "v1", "v2")).alias("k", "was"), "face").select((F.col("face") * 3 + F.col("k")).alias("vertex"), "was")
    return own, faces.select("face", *((F.col("face") * 3 + k).alias(f"v{k}") for k in range(3)))
