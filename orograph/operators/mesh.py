"""Meshes as tables: triangles with corner columns, faces with corner ids, directed edges by explosion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geodesy as G
from ..functions import tiles as T
from ..functions.numbers import half_up, wrap16, zigzag
from .storage import checkpointed

CORNERS = (0, 1, 2)


def corner(k: int) -> G.Vector:
    return F.col(f"x{k}"), F.col(f"y{k}"), F.col(f"z{k}")


def plane() -> tuple[Column, Column, Column, Column]:
    """a, b, c, d of the plane through a triangle's corners: a x + b y + c z + d = 0."""
    n = G.cross(G.minus(corner(1), corner(0)), G.minus(corner(2), corner(0)))
    return (*n, -G.dot(n, corner(0)))


def barycentre() -> G.Vector:
    return tuple((F.col(f"{c}0") + F.col(f"{c}1") + F.col(f"{c}2")) / 3.0 for c in "xyz")


def side(i: int, j: int) -> Column:
    """Length of a triangle's side in the plane of degrees."""
    dx, dy = F.col(f"x{i}") - F.col(f"x{j}"), F.col(f"y{i}") - F.col(f"y{j}")
    return F.sqrt(dx * dx + dy * dy)


def area(a: Column, b: Column, c: Column) -> Column:
    """Heron's area of three sides."""
    s = (a + b + c) / 2.0
    return F.sqrt(F.greatest(F.lit(0.0), s * (s - a) * (s - b) * (s - c)))


def longest_side() -> Column:
    """Number of the longest side (0: corners 0-1, 1: 1-2, 2: 2-0), the first on a tie."""
    a, b, c = side(0, 1), side(1, 2), side(2, 0)
    return F.when((a >= b) & (a >= c), 0).when(b >= c, 1).otherwise(2)


def owner(depth: int) -> dict[str, Column]:
    """The tile of a triangle's barycentre."""
    x, y, _ = barycentre()
    return {"l": F.lit(depth), "tx": T.tile_x(x, F.lit(depth)), "ty": T.tile_y(y, F.lit(depth))}


def child_of_tile() -> Column:
    """Which of its tile's children (0 to 3, x + 2 y) a triangle's barycentre is in; the middle goes up."""
    box = T.extent(F.col("l"), F.col("tx"), F.col("ty"))
    x, y, _ = barycentre()
    high = lambda v, axis: (v >= (box[f"min_{axis}"] + box[f"max_{axis}"]) / 2.0).cast("int")
    return high(x, "lon") + 2 * high(y, "lat")


def refine_by_size(depth: int, thresholds: dict[str, float], data: tuple[float, float, float, float]) -> Column:
    """'split', 'keep' or 'test': what a triangle's size and place settle before its pixels are looked at."""
    low = [F.least(*(F.col(f"{c}{k}") for k in CORNERS)) for c in "xy"]
    high = [F.greatest(*(F.col(f"{c}{k}") for k in CORNERS)) for c in "xy"]
    metres = F.greatest(high[0] - low[0], high[1] - low[1]) * G.DEGREE * G.EQUATORIAL_RADIUS
    diagonal = F.sqrt((high[0] - low[0]) * (high[0] - low[0]) + (high[1] - low[1]) * (high[1] - low[1])) * G.DEGREE * G.EQUATORIAL_RADIUS
    allowed = thresholds["max_diff"] * (0.8 * (diagonal / thresholds["tile_size"]) + 0.2)
    inside = (low[0] >= data[0]) & (low[1] >= data[1]) & (high[0] <= data[2]) & (high[1] <= data[3])
    over = F.greatest(*(F.col(f"z{k}") for k in CORNERS)) > allowed
    return F.when(metres < thresholds["min_side"], "keep").when(metres > thresholds["max_side"], "split").when(~inside, F.when(over, "split").otherwise("keep")).otherwise("test")


def normal() -> G.Vector:
    """Unit normal of a triangle in earth-centred coordinates, null if it has no area."""
    at = [G.ecef(*corner(k)) for k in CORNERS]
    return G.unit(G.cross(G.minus(at[1], at[0]), G.minus(at[2], at[0])))


def vertex_normals(triangles: DataFrame) -> DataFrame:
    """x, y and unit normal of each corner position: the sum of its triangles' unit normals."""
    n = normal()
    rows = triangles.select(F.explode(F.array(*(F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in CORNERS))).alias("v"), *(c.alias(f"n{i}") for i, c in enumerate(n)))
    summed = rows.groupBy("v.x", "v.y").agg(*(F.sum(f"n{i}").alias(f"n{i}") for i in range(3)))
    u = G.unit((F.col("n0"), F.col("n1"), F.col("n2")))
    return summed.select("x", "y", *(c.alias(f"n{i}") for i, c in enumerate(u)))


def oct_bytes(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """A unit normal in two unsigned bytes: octahedron, unfolded, 255 steps a side."""
    total = F.abs(x) + F.abs(y) + F.abs(z)
    u, v = x / total, y / total
    sign = lambda c: F.when(c >= 0, 1.0).otherwise(-1.0)
    fold = z <= 0
    pu = F.when(fold, (1.0 - F.abs(v)) * sign(u)).otherwise(u)
    pv = F.when(fold, (1.0 - F.abs(u)) * sign(v)).otherwise(v)
    byte = lambda c: half_up((F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c)) * 0.5 + 0.5) * 255.0).cast("int")
    return byte(pu), byte(pv)


def quantized(v: Column, low: Column, high: Column) -> Column:
    """v in 0..32767 between low and high; 0 where both are the same."""
    return F.when(high <= low, 0).otherwise(((v - low) / F.nullif(high - low, F.lit(0.0)) * 32767.0).cast("int"))


def delta_codes(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """df with code: the zig-zag of the difference to the value before, from 0."""
    before = F.lag(value, 1, 0).over(Window.partitionBy(by).orderBy(order))
    return df.withColumn("code", zigzag(wrap16(F.col(value) - before)))


def high_water_codes(df: DataFrame, by: str, order: str, index: str) -> DataFrame:
    """df with code: the highest index so far plus one, minus the index. Indices are numbered by first use."""
    before = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("code", F.coalesce(F.max(index).over(before) + 1, F.lit(0)) - F.col(index))


# Faces with corner ids


def edges(faces: DataFrame) -> DataFrame:
    """The directed edges (face, k, a, b) of faces (face, v0, v1, v2)."""
    each = F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"v{k}").alias("a"), F.col(f"v{(k + 1) % 3}").alias("b")) for k in CORNERS))
    return faces.select("face", F.explode(each).alias("e")).select("face", "e.k", "e.a", "e.b")


def twins(faces: DataFrame) -> DataFrame:
    """Edges with their twin (face, k) that runs the other way: the n-th of one direction with the n-th of the other. An edge
    from a corner to itself is its own twin.

    One exchange brings both directions of an edge together; ranks and twins are found within it.
    """
    e = edges(faces).withColumns({"__lo": F.least("a", "b"), "__hi": F.greatest("a", "b"), "__way": (F.col("a") > F.col("b")).cast("int")})
    ranked = e.repartition("__lo", "__hi").withColumn("__n", F.row_number().over(Window.partitionBy("__lo", "__hi", "__way").orderBy("face", "k")))
    pair = Window.partitionBy("__lo", "__hi", "__n").orderBy("__way")
    own = F.col("a") == F.col("b")
    other = lambda c: F.when(own, F.col(c)).otherwise(F.coalesce(F.lead(c).over(pair), F.lag(c).over(pair)))
    return ranked.select("a", "b", "face", "k", other("face").alias("twin_face"), other("k").alias("twin_k"))


def loops(faces: DataFrame) -> DataFrame:
    """Edges (face, k, a, b) with the number of the next and of the one before in their face, and the corner across from them.

    Each face makes its own edges, so faces need no ids of their own: those that share one, or get one anew each time they
    are read, keep their corners.
    """
    corner = lambda k: F.col(f"v{k % 3}")
    each = F.array(*(F.struct(F.lit(k).alias("k"), corner(k).alias("a"), corner(k + 1).alias("b"), F.lit((k + 1) % 3).alias("next_k"), F.lit((k + 2) % 3).alias("prev_k"), corner(k + 2).alias("across")) for k in CORNERS))
    return faces.select("face", F.explode(each).alias("e")).select("face", "e.*")


def adjacent_faces(faces: DataFrame) -> DataFrame:
    """Pairs (face, other) of faces that share an edge, each way."""
    t = twins(faces).where("twin_face IS NOT NULL AND twin_face <> face")
    return t.select("face", F.col("twin_face").alias("other")).distinct()


def border(faces: DataFrame) -> DataFrame:
    """The edges without a twin."""
    return twins(faces).where("twin_face IS NULL").drop("twin_face", "twin_k")


def welded(triangles: DataFrame, cell: float) -> DataFrame:
    """x, y of the distinct corner positions on a grid of cell degrees and how many corners stand at each."""
    at = lambda c: half_up(c / cell).cast("long")
    rows = triangles.select(F.explode(F.array(*(F.struct(at(F.col(f"x{k}")).alias("x"), at(F.col(f"y{k}")).alias("y")) for k in CORNERS))).alias("v"))
    return rows.groupBy("v.x", "v.y").agg(F.count("*").alias("corners"))


def clusters(triangles: DataFrame, cell: float, least: int = 2) -> DataFrame:
    """Mean position of the face corners in each cell of a 3-D grid that has at least so many."""
    index = lambda c: F.floor(c / cell + 1e-6).cast("long")
    rows = triangles.select(F.explode(F.array(*(F.struct(*(F.col(f"{c}{k}").alias(c) for c in "xyz")) for k in CORNERS))).alias("v")).select("v.*")
    got = rows.groupBy(*(index(F.col(c)).alias(f"i{c}") for c in "xyz")).agg(*(F.avg(c).alias(c) for c in "xyz"), F.count("*").alias("n"))
    return got.where(F.col("n") >= least)


def degenerate() -> Column:
    """Has a triangle a side under 1e-5 or an area under 1e-5 (in degrees)?"""
    a, b, c = side(0, 1), side(1, 2), side(2, 0)
    return (F.least(a, b, c) < 1e-5) | (area(a, b, c) < 1e-5)


def plane_class(axis: str, at: float) -> Column:
    """2 if a triangle's barycentre is beyond a plane across an axis, else 1."""
    return F.when(barycentre()["xyz".index(axis)] > at, 2).otherwise(1)


def morton(ix: Column, iy: Column, iz: Column, depth: int) -> Column:
    """Octree path of a cell at a depth: its index bits interleaved, x lowest."""
    out = F.lit(0).cast("long")
    for k in range(depth):
        bit = lambda c, j: F.shiftleft(F.shiftright(c.cast("long"), k).bitwiseAND(F.lit(1)), 3 * k + j)  # noqa: E731, B023
        out = out.bitwiseOR(bit(ix, 0)).bitwiseOR(bit(iy, 1)).bitwiseOR(bit(iz, 2))
    return out


def components(links: DataFrame, rounds: int = 200) -> DataFrame:
    """a, root: the least id that each end of links (a, b) reaches.

    Ids take the least label around them and then their label's label, until none changes; every
    round is checkpointed, so lineage stays short and an executor's loss costs one round.
    """
    both = checkpointed(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = checkpointed(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("root")))
    for _ in range(rounds):
        around = both.join(label.select(F.col("a").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = label.join(around, "a").select("a", "root", F.least("root", "near").alias("now"))
        over = label.select(F.col("a").alias("now"), F.col("root").alias("over"))
        jump = checkpointed(step.join(over, "now").select("a", F.least("now", "over").alias("root"), (F.col("root") != F.least("now", "over")).alias("new")))
        label = jump.select("a", "root")
        if jump.where("new").isEmpty():
            return label
    raise RuntimeError("labels did not settle")


def face_components(faces: DataFrame, rounds: int = 200) -> DataFrame:
    """face, root: faces that share corners, directly or through others, have one root, the least corner id."""
    pairs = F.array(F.struct(F.col("v0").alias("a"), F.col("v1").alias("b")), F.struct(F.col("v1").alias("a"), F.col("v2").alias("b")))
    label = components(faces.select(F.explode(pairs).alias("e")).select("e.a", "e.b"), rounds)
    return faces.join(label.withColumnRenamed("a", "v0"), "v0").select("face", "root")
