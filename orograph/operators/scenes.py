"""Scenes as tables: nodes with matrices, meshes below them, and what is done to all of their vertices and faces.

Nodes are rows (node, parent, matrix: 16 column-major doubles); vertices (node, vertex, x, y, z, nx, ny, nz); faces (node, face,
v0, v1, v2, class). The levels between a scene and its faces are columns, so what visits a hierarchy is one expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geodesy as G
from ..functions import vectors3d as V
from . import mesh as M
from .storage import checkpointed

# The twelve triangles of a box whose corners count x first, then y, then z.
BOX_FACES = [(0, 2, 3), (0, 3, 1), (4, 5, 7), (4, 7, 6), (0, 1, 5), (0, 5, 4), (2, 6, 7), (2, 7, 3), (0, 4, 6), (0, 6, 2), (1, 3, 7), (1, 7, 5)]


def world_matrices(nodes: DataFrame, rounds: int = 200) -> DataFrame:
    """node, root, depth and the product of all matrices from the root down, level by level. A node whose parent is missing
    is a root; a cycle is an error."""
    known = nodes.select(F.col("node").alias("__n"))
    root = nodes.join(known, F.col("parent") == F.col("__n"), "left").where("__n IS NULL")
    level = checkpointed(root.select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), "matrix"))
    out = level
    for _ in range(rounds):
        up = level.select(F.col("node").alias("parent"), "root", "depth", F.col("matrix").alias("__up"))
        level = checkpointed(nodes.join(up, "parent").select("node", "root", (F.col("depth") + 1).alias("depth"), V.multiplied(F.col("__up"), F.col("matrix")).alias("matrix")))
        if level.isEmpty():
            return out
        out = out.unionByName(level)
    raise RuntimeError("the nodes have a cycle, or go on for too many levels")


def modified(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """df after each step in turn: what a visitor does to vertices or faces is a function of their table."""
    for step in steps:
        df = df.transform(step)
    return df


def baked(vertices: DataFrame, world: DataFrame) -> DataFrame:
    """Vertices in the scene's coordinates; normals are turned and brought to length 1."""
    rows = vertices.join(world.select("node", F.col("matrix").alias("__m")), "node")
    at = V.applied(F.col("__m"), (F.col("x"), F.col("y"), F.col("z")))
    turned = G.unit(V.applied(F.col("__m"), (F.col("nx"), F.col("ny"), F.col("nz")), 0.0))
    return rows.withColumns({**{f"__{c}": v for c, v in zip("xyz", at)}, **{f"__n{c}": v for c, v in zip("xyz", turned)}}).select(*(F.col(f"__{c}").alias(c) if c in ("x", "y", "z", "nx", "ny", "nz") else F.col(c) for c in vertices.columns))


def triangulated(primitives: DataFrame) -> DataFrame:
    """Faces (node, face, v0, v1, v2) of index lists (node, indices), three by three; what is left of a list goes."""
    n = F.floor(F.size("indices") / 3).cast("int")
    each = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice("indices", k * 3 + 1, F.lit(3)))).otherwise(F.array().cast("array<array<int>>"))
    return primitives.select("node", F.posexplode(each).alias("face", "t")).select("node", "face", *(F.get("t", F.lit(k)).alias(f"v{k}") for k in range(3)))


def merged(vertices: DataFrame, faces: DataFrame, world: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and faces of all nodes as one primitive a root: ids go on from node to node, in the order of nodes."""
    before = lambda df, key, name: df.groupBy("node").agg((F.max(key) + 1).alias("__n")).join(world.select("node", "root"), "node").withColumn(name, F.sum("__n").over(Window.partitionBy("root").orderBy("node")) - F.col("__n")).select("node", "root", name)
    v0, f0 = before(vertices, "vertex", "__v"), before(faces, "face", "__f")
    out = vertices.join(v0, "node").withColumn("vertex", F.col("vertex") + F.col("__v")).withColumn("node", F.col("root")).select(*vertices.columns)
    all_faces = faces.join(v0, "node").join(f0.drop("root"), "node")
    moved = all_faces.withColumns({"face": F.col("face") + F.col("__f"), **{f"v{k}": F.col(f"v{k}") + F.col("__v") for k in range(3)}})
    return out, moved.withColumn("node", F.col("root")).select(*faces.columns)


def without_empty(nodes: DataFrame, faces: DataFrame, rounds: int = 200) -> DataFrame:
    """Nodes that have faces, or have one below them that does."""
    keep = checkpointed(faces.select("node").distinct())
    edge = keep
    for _ in range(rounds):
        up = nodes.join(edge, "node", "left_semi").where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
        edge = checkpointed(up.join(keep, "node", "left_anti"))
        if edge.isEmpty():
            return nodes.join(keep, "node", "left_semi")
        keep = checkpointed(keep.union(edge))
    raise RuntimeError("the nodes go on for too many levels")


def projected(triangles: DataFrame) -> DataFrame:
    """Triangles (x0 .. z2) in the plane across their mean normal: columns u0, w0 .. u2, w2. Faces that look straight up
    take the mean's place if there is no mean."""
    from .surfaces import mean_normal

    n = mean_normal(triangles).select(*(F.coalesce(c, F.lit(d)).alias(f"__{c}") for c, d in zip("xyz", (0.0, 0.0, 1.0))))
    frame = n.select(V.frame_along((F.col("__x"), F.col("__y"), F.col("__z"))).alias("__m"))
    rows = triangles.crossJoin(F.broadcast(frame))  # one row
    axis = lambda k: tuple(F.get("__m", F.lit(4 * k + i)) for i in range(3))
    return rows.withColumns({f"{name}{c}": G.dot(axis(k), M.corner(c)) for c in range(3) for k, name in enumerate("uw")}).drop("__m")


def flipped(df: DataFrame) -> DataFrame:
    """Texture coordinates with v counted from the other side."""
    return df.withColumn("v", F.lit(1.0) - F.col("v"))


def coloured(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """df with a colour (r, g, b) for each key, the same for equal keys on every run."""
    part = lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), key), F.lit(256)).cast("int")
    return df.withColumns({c: part(k) for k, c in enumerate("rgb")})


def of_classes(faces: DataFrame, classes: list[int], keep: bool = True) -> DataFrame:
    """Faces whose class is one of these, or, with keep false, the others."""
    inside = F.col("class").isin(classes)
    return faces.where(inside if keep else ~F.coalesce(inside, F.lit(False)))


def copied(faces: DataFrame, kind: int, as_kind: int) -> DataFrame:
    """Faces and a copy of those of one class under another, numbered after the last."""
    last = faces.agg(F.coalesce(F.max("face"), F.lit(-1)).alias("__last"))
    own = faces.where(F.col("class") == kind).crossJoin(F.broadcast(last))  # one row
    copy = own.withColumns({"face": F.col("face") + F.col("__last") + 1, "class": F.lit(as_kind)}).select(*faces.columns)
    return faces.unionByName(copy)


def cut_by_boxes(triangles: DataFrame, low: tuple[float, float, float], step: float, n: tuple[int, int, int]) -> DataFrame:
    """Triangles cut by the planes of a grid across all three axes; columns cx, cy and cz name the cell of each part."""
    from .cutting import cut_by_plane

    out = triangles
    for k, axis in enumerate("xyz"):
        for i in range(1, n[k]):
            out = cut_by_plane(out, axis, low[k] + i * step).drop("class")
    cell = lambda k, axis: F.greatest(F.lit(0), F.least(F.floor((sum((F.col(f"{axis}{c}") for c in (1, 2)), F.col(f"{axis}0")) / 3.0 - low[k]) / step), F.lit(n[k] - 1))).cast("int")
    return out.withColumns({f"c{axis}": cell(k, axis) for k, axis in enumerate("xyz")})


def by_direction(triangles: DataFrame) -> DataFrame:
    """How many faces of each class look towards each slanting camera."""
    look = V.oblique_direction(G.unit(M.plane()[:3]))
    return triangles.groupBy("class", look.alias("direction")).agg(F.count("*").alias("faces"))


def convexity(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """vertex and the mean height of its neighbours over the plane of its normal: negative where the surface bulges out."""
    pairs = M.edges(faces)
    near = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    own = vertices.select(F.col("vertex").alias("a"), *(F.col(c).alias(f"__{c}") for c in ("x", "y", "z", "nx", "ny", "nz")))
    other = vertices.select(F.col("vertex").alias("b"), "x", "y", "z")
    over = sum(((F.col(c) - F.col(f"__{c}")) * F.col(f"__n{c}") for c in "xyz"), F.lit(0.0))
    return near.join(own, "a").join(other, "b").groupBy(F.col("a").alias("vertex")).agg(F.avg(over).alias("over"))


def deformed(vertices: DataFrame, faces: DataFrame, by: float) -> DataFrame:
    """Vertices moved along their normals: out where the surface bulges, in where it is hollow, not at all where it is flat."""
    c = convexity(vertices, faces)
    rows = vertices.join(c, "vertex", "left")
    move = F.when(F.abs("over") < 1e-9, 0.0).otherwise(-F.signum("over") * by)
    return rows.withColumns({a: F.col(a) + F.coalesce(move, F.lit(0.0)) * F.col(f"n{a}") for a in "xyz"}).drop("over")


def octree_leaves(points: DataFrame, low: tuple[float, float, float], size: float, most: int = 50, depth: int = 10) -> DataFrame:
    """Points with the leaf (leaf_depth, ix, iy, iz) of an octree over a cube that splits cells of more than most points, to a depth.

    Points are counted by cell at the greatest depth; the counts of all depths above follow from those.
    """
    at = lambda c, k: F.greatest(F.lit(0), F.least(F.floor((F.col(c) - low[k]) / size * (1 << depth)), F.lit((1 << depth) - 1))).cast("int")
    rows = points.withColumns({f"__{c}": at(c, k) for k, c in enumerate("xyz")})
    cells = rows.groupBy("__x", "__y", "__z").agg(F.count("*").alias("n"))
    up = lambda c, d: F.shiftright(F.col(c), 0) if isinstance(d, int) else F.floor(F.col(c) / F.pow(F.lit(2), F.lit(depth) - d)).cast("int")
    each = cells.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    each = each.withColumns({f"c{c}": up(f"__{c}", F.col("d")) for c in "xyz"})
    counted = each.groupBy("d", "cx", "cy", "cz").agg(F.sum("n").alias("all"))
    fit = each.join(counted, ["d", "cx", "cy", "cz"]).where((F.col("all") <= most) | (F.col("d") == depth))
    leaf = fit.groupBy("__x", "__y", "__z").agg(F.min(F.struct("d", "cx", "cy", "cz")).alias("leaf"))
    out = rows.join(leaf, ["__x", "__y", "__z"])
    return out.select(*points.columns, F.col("leaf.d").alias("leaf_depth"), *(F.col(f"leaf.c{c}").alias(f"i{c}") for c in "xyz"))


def remeshed(triangles: DataFrame, cell: float, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Vertices (vertex, x, y, z), the means of the face corners in each cell, and the faces between different ones. Corners in
    cells of fewer than least stay themselves."""
    index = lambda c: F.floor(c / cell + 1e-6).cast("long")
    corners = triangles.select("id", F.posexplode(F.array(*(F.struct(*(F.col(f"{c}{k}").alias(c) for c in "xyz")) for k in range(3)))).alias("k", "p")).select("id", "k", "p.*")
    corners = corners.withColumns({f"i{c}": index(F.col(c)) for c in "xyz"})
    groups = corners.groupBy("ix", "iy", "iz").agg(F.count("*").alias("n"), *(F.avg(c).alias(f"m{c}") for c in "xyz"))
    placed = corners.join(groups, ["ix", "iy", "iz"])
    many = F.col("n") >= least
    key = F.when(many, F.xxhash64(F.lit(0), "ix", "iy", "iz")).otherwise(F.xxhash64(F.lit(1), "x", "y", "z"))
    placed = placed.select("id", "k", key.alias("vertex"), *(F.when(many, F.col(f"m{c}")).otherwise(F.col(c)).alias(c) for c in "xyz"))
    faces = placed.groupBy("id").pivot("k", [0, 1, 2]).agg(F.first("vertex")).select("id", *(F.col(str(k)).alias(f"v{k}") for k in range(3)))
    vertices = placed.groupBy("vertex").agg(*(F.first(c).alias(c) for c in "xyz"))
    return vertices, faces.where("v0 <> v1 AND v1 <> v2 AND v2 <> v0")


def box_mesh(spark: SparkSession) -> DataFrame:
    """The faces (face, v0, v1, v2) of a box whose corner i is at x = i & 1, y = i >> 1 & 1, z = i >> 2."""
    return spark.createDataFrame([(k, *f) for k, f in enumerate(BOX_FACES)], "face int, v0 int, v1 int, v2 int")


def boxes_as_triangles(boxes: DataFrame) -> DataFrame:
    """Boxes (id, min_x .. max_z) as twelve triangles (id, face, x0 .. z2) each, facing out."""
    corner = lambda i, k: {c: F.col(f"{'max' if i >> n & 1 else 'min'}_{c}").alias(f"{c}{k}") for n, c in enumerate("xyz")}
    each = F.array(*(F.struct(F.lit(f).alias("face"), *(col for k, i in enumerate(face) for col in corner(i, k).values())) for f, face in enumerate(BOX_FACES)))
    return boxes.select("id", F.explode(each).alias("t")).select("id", "t.*")


def signed_volume(triangles: DataFrame, by: str = "id") -> DataFrame:
    """Volume that a closed set of outward faces holds."""
    a, b, c = (M.corner(k) for k in range(3))
    return triangles.groupBy(by).agg(F.sum(G.dot(a, G.cross(b, c)) / 6.0).alias("volume"))


def skirt_by_class(faces: DataFrame, vertices: DataFrame, kind: int, depth: float) -> DataFrame:
    """Upright triangles below the border edges of one class' faces."""
    from .cutting import skirt

    rim = M.border(faces.where(F.col("class") == kind).select("face", "v0", "v1", "v2"))
    out = rim.withColumn("edge", F.col("face") * 3 + F.col("k"))
    for end in "ab":
        out = out.join(vertices.select(F.col("vertex").alias(end), *(F.col(c).alias(f"{end}{c}") for c in "xyz")), end)
    return skirt(out.select("edge", *(f"{e}{c}" for e in "ab" for c in "xyz")), depth)


def buffers(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """For each node its flat lists: positions and normals by vertex, indices by face. A node's mesh is what one row holds."""
    v = vertices.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("vertex", F.array("x", "y", "z").alias("p"), F.array("nx", "ny", "nz").alias("n")))).alias("v"))
    f = faces.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("face", F.array("v0", "v1", "v2").alias("i")))).alias("f"))
    flat = lambda c, name: F.flatten(F.transform(c, lambda r: r[name]))
    return v.join(f, "node").select("node", flat("v", "p").alias("positions"), flat("v", "n").alias("normals"), flat("f", "i").alias("indices"))
