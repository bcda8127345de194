"""Adaptive tile meshes: longest-edge bisection to a level-of-detail pyramid, one tile a group.

Tiles start as two right triangles on a dyadic grid, so a triangle's longest edge is its hypotenuse and its
midpoint is again a grid point. A sweep marks the edges of triangles that deviate from the surface; marks spread
to the longest edge of every triangle they touch until none is new, and all triangles with marked
longest edges are halved. That needs no neighbour pointers, and its result doesn't depend on order. A tile's
mesh conforms within itself. Tiles are meshed apart from samples that reach a pixel beyond them, so heights on common
borders are equal; ``closed`` then gives each tile the border vertices that its neighbours have, so nothing cracks.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tiles as T
from .storage import checkpointed

GRID = 256
SWEEPS = 15

Surface = Callable[[np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Limits:
    """What a level asks of its triangles besides the deviation allowed: sides in metres, uniform bisections at first,
    and the extent in which there is terrain, in degrees (west, south, east, north)."""

    level: int
    tile_size: float
    min_side: float
    max_side: float
    extent: tuple[float, float, float, float]

    @property
    def first(self) -> int:
        return 4 if self.level < 10 else 3


def _pixels(c: np.ndarray, n: int, grid: int) -> np.ndarray:
    return np.minimum(c * n // grid, n - 1).astype(np.int64)


def _deviating(tri: np.ndarray, z: np.ndarray, heights: np.ndarray, allowed: np.ndarray, cosine: np.ndarray, grid: int, narrow: int) -> np.ndarray:
    """Which triangles (heights at their corners z) are further from the raster of heights than allowed: in the pixel
    of the barycentre, or, if they are at least narrow pixels wide and high, in any pixel within."""
    n = len(heights)
    t = tri.astype(float)
    e, f = t[:, 1] - t[:, 0], t[:, 2] - t[:, 0]
    area = e[:, 0] * f[:, 1] - e[:, 1] * f[:, 0]
    dz1, dz2 = z[:, 1] - z[:, 0], z[:, 2] - z[:, 0]
    gx, gy = (dz1 * f[:, 1] - dz2 * e[:, 1]) / area, (dz2 * e[:, 0] - dz1 * f[:, 0]) / area

    def off(k: np.ndarray | int, col: np.ndarray, row: np.ndarray) -> np.ndarray:
        x, y = (col + 0.5) * grid / n - t[k, 0, 0], (row + 0.5) * grid / n - t[k, 0, 1]
        return np.abs(heights[row, col] - (z[k, 0] + gx[k] * x + gy[k] * y)) * cosine[k]

    every = np.arange(len(tri))
    middle = _pixels(tri.sum(axis=1) // 3, n, grid)
    out = off(every, middle[:, 0], middle[:, 1]) > allowed
    p = _pixels(tri, n, grid)
    low, high = p.min(axis=1), p.max(axis=1)
    for k in np.flatnonzero(~out & ((high - low + 1) >= narrow).all(axis=1)).tolist():
        col, row = np.meshgrid(np.arange(low[k, 0], high[k, 0] + 1), np.arange(low[k, 1], high[k, 1] + 1))
        (ax, ay), (bx, by), (cx, cy) = p[k].tolist()
        whole = (by - cy) * (ax - cx) + (cx - bx) * (ay - cy)
        if not whole:
            continue
        alpha = ((by - cy) * (col - cx) + (cx - bx) * (row - cy)) / whole
        beta = ((cy - ay) * (col - cx) + (ax - cx) * (row - cy)) / whole
        within = (alpha >= 0) & (beta >= 0) & (alpha + beta <= 1)
        within[[0, 0, -1, -1], [0, -1, 0, -1]] &= narrow < 2  # the box's corners
        out[k] = (off(k, col[within], row[within]) > allowed[k]).any()
    return out


def bisected(allowed: float, surface: Surface, sweeps: int = SWEEPS, grid: int = GRID, heights: np.ndarray | None = None, limits: Limits | None = None, tile: tuple[int, int] = (0, 0)) -> tuple[np.ndarray, np.ndarray]:
    """Vertices (col, row on a grid of grid steps) and triangles of one tile whose surface deviates by at most allowed.

    surface gives heights of columns and rows, heights those of pixel centres (else the surface's there). All pixels
    in a triangle are tested. With limits, what is allowed follows a triangle's size, and the level's sides, extent
    and first bisections hold. The mesh conforms: no vertex lies within another triangle's edge.
    """
    corners = np.array([[0, 0], [grid, 0], [grid, grid], [0, grid]])
    tri = np.array([[corners[1], corners[2], corners[0]], [corners[3], corners[0], corners[2]]])  # right angle first
    if heights is None:
        row, col = np.mgrid[:grid, :grid] + 0.5
        heights = surface(col.ravel(), row.ravel()).reshape(grid, grid)
    for _ in range(limits.first if limits else 0):
        tri = _halved(tri, np.ones(len(tri), bool))
    kept = np.zeros(0, np.int64)  # triangles that stay
    for _ in range(sweeps):
        names = _names(tri)
        new = ~np.isin(names, kept)
        split = np.zeros(len(tri), bool)
        split[new] = _must_split(tri[new], allowed, surface, grid, heights, limits, tile)
        if not split.any():
            break
        kept = np.concatenate([kept, names[new & ~split]])
        tri = _halved(tri, split)
    key, place = np.unique(tri.reshape(-1, 2), axis=0, return_inverse=True)
    return key, place.reshape(-1, 3)


def _must_split(tri: np.ndarray, allowed: float, surface: Surface, grid: int, heights: np.ndarray, limits: Limits | None, tile: tuple[int, int]) -> np.ndarray:
    z = surface(tri[:, :, 0].ravel(), tri[:, :, 1].ravel()).reshape(-1, 3)
    low, high = tri.min(axis=1), tri.max(axis=1)
    divisible = np.abs(tri[:, 1] - tri[:, 2]).max(axis=1) > 1
    if limits is None:
        return divisible & _deviating(tri, z, heights, np.full(len(tri), allowed), np.ones(len(tri)), grid, 1)
    bound = allowed * (0.8 * np.hypot(*(high - low).T) / grid + 0.2)
    side = (high - low).max(axis=1) / grid * limits.tile_size
    angle = 180.0 / 2**limits.level
    west, south = angle * tile[0] - 180, angle * tile[1] - 90
    lon, lat = west + tri[:, :, 0] * angle / grid, south + tri[:, :, 1] * angle / grid
    w, s, e, n = limits.extent
    there = (lon.min(1) < e) & (lon.max(1) > w) & (lat.min(1) < n) & (lat.max(1) > s)
    cosine = np.ones(len(tri))
    if limits.level > 10:
        at = _ecef(lon, lat, z)
        normal = np.cross(at[:, 1] - at[:, 0], at[:, 2] - at[:, 0])
        a, b = np.radians(west + angle / 2), np.radians(south + angle / 2)
        cosine = np.abs(normal @ np.array([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)])) / np.linalg.norm(normal, axis=1)
    large = side > limits.max_side
    split = large | ~there & (z > bound[:, None]).any(axis=1)
    ask = np.flatnonzero(~large & there & (side >= limits.min_side) & divisible)
    split[ask] = _deviating(tri[ask], z[ask], heights, bound[ask], cosine[ask], grid, 6)
    return split & (side >= limits.min_side) & divisible


def _code(p: np.ndarray) -> np.ndarray:
    return (p[..., 0].astype(np.int64) << 32) | p[..., 1].astype(np.int64)


def _names(tri: np.ndarray) -> np.ndarray:
    """A number for each triangle by its corners, whose coordinates are 1,023 at most."""
    out = np.zeros(len(tri), np.int64)
    for k in range(6):
        out = out << 10 | tri.reshape(-1, 6)[:, k]
    return out


def _halved(tri: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Triangles with the split ones halved, and whatever else keeps the mesh conforming. A midpoint is known by
    the sum of its edge's ends."""
    wanted = np.unique(_code(tri[split, 1] + tri[split, 2]))
    middle = _code(tri[:, 1] + tri[:, 2])
    legs = np.stack([_code(tri[:, 0] + tri[:, 1]), _code(tri[:, 0] + tri[:, 2])], axis=1)
    while True:
        more = np.isin(legs, wanted).any(axis=1) & ~np.isin(middle, wanted)
        if not more.any():
            break
        wanted = np.union1d(wanted, middle[more])
    while True:
        now = np.isin(_code(tri[:, 1] + tri[:, 2]), wanted)
        if not now.any():
            return tri
        a, b, c = tri[now, 0], tri[now, 1], tri[now, 2]
        m = (b + c) // 2
        tri = np.concatenate([tri[~now], np.stack([m, a, b], axis=1), np.stack([m, c, a], axis=1)])


_MESH = "l int, x int, y int, vertices int, triangles int, u array<int>, v array<int>, h array<double>, indices array<int>"


def _mesh_rows(found: list[tuple]) -> pa.RecordBatch:
    """A batch of meshes (l, x, y, u, v, h, indices)."""
    lists = [pa.array([np.asarray(f[k]) for f in found], pa.list_(t)) for k, t in ((3, pa.int32()), (4, pa.int32()), (5, pa.float64()), (6, pa.int32()))]
    keys = [pa.array([f[k] for f in found], pa.int32()) for k in range(3)]
    sizes = [pa.array([len(f[3]) for f in found], pa.int32()), pa.array([len(f[6]) // 3 for f in found], pa.int32())]
    return pa.RecordBatch.from_arrays([*keys, *sizes, *lists], ["l", "x", "y", "vertices", "triangles", "u", "v", "h", "indices"])


def _first_use(tri: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of vertices by first use, as the index code wants them, and triangles with these numbers."""
    _, first = np.unique(tri.ravel(), return_index=True)
    order = tri.ravel()[np.sort(first)]
    rank = np.empty(int(order.max()) + 1, np.int64)
    rank[order] = np.arange(len(order))
    return order, rank[tri]


def meshes(tiles: DataFrame, limits: dict[int, tuple[float, Limits | None]], grid: int = GRID, halo: int = 1) -> DataFrame:
    """One mesh (l, x, y, vertices, triangles, u, v, h, indices) for each tile (l, x, y, elev) of ``rasters.sampled_tiles``; no
    tile waits for another. limits: for each depth what a surface may deviate, and the depth's other limits."""

    def one(l: int, x: int, y: int, elev: np.ndarray) -> tuple:  # noqa: E741
        n = int(round(len(elev) ** 0.5))
        whole = elev.astype(float).reshape(n, n)
        inner = whole[halo : n - halo, halo : n - halo] if halo else whole
        m = len(inner)

        def surface(col: np.ndarray, row: np.ndarray) -> np.ndarray:
            # Samples are pixel centres.
            c, r = np.clip(col * m / grid - 0.5 + halo, 0, n - 1), np.clip(row * m / grid - 0.5 + halo, 0, n - 1)
            i, j = np.minimum(c.astype(int), n - 2), np.minimum(r.astype(int), n - 2)
            dx, dy = c - i, r - j
            return (whole[j, i] * (1 - dx) + whole[j, i + 1] * dx) * (1 - dy) + (whole[j + 1, i] * (1 - dx) + whole[j + 1, i + 1] * dx) * dy

        allowed, more = limits[l]
        at, tri = bisected(allowed, surface, grid=grid, heights=inner, limits=more, tile=(x, y))
        order, tri = _first_use(tri)
        at = at[order]
        h = surface(at[:, 0].astype(float), at[:, 1].astype(float))
        return l, x, y, at[:, 0] * 32767 // grid, at[:, 1] * 32767 // grid, h, tri.ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                key = (b.column(c)[k].as_py() for c in range(3))
                yield _mesh_rows([one(*key, b.column(3)[k].values.to_numpy(zero_copy_only=False))])

    return tiles.select("l", "x", "y", "elev").mapInArrow(run, _MESH)


_FULL = 32767
# A tile's sides in the order of the tile format, and the step to the neighbour beyond each.
_SIDES = {"west": (-1, 0), "south": (0, -1), "east": (1, 0), "north": (0, 1)}


def _on_side(side: str, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which vertices are on a side, and their places along it."""
    return {"west": (u == 0, v), "south": (v == 0, u), "east": (u == _FULL, v), "north": (v == _FULL, u)}[side]


def with_border(u: np.ndarray, v: np.ndarray, h: np.ndarray, tri: np.ndarray, side: str, places: np.ndarray, heights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A mesh with vertices at all these places of a side: triangles with an edge there become fans."""
    there, along = _on_side(side, u, v)
    have = dict(zip(along[there].tolist(), np.flatnonzero(there).tolist()))
    new = [(p, z) for p, z in zip(places.tolist(), heights.tolist()) if p not in have]
    if not new:
        return u, v, h, tri
    fixed = {"west": 0, "south": 0, "east": _FULL, "north": _FULL}[side]
    p, z = np.array([p for p, _ in new]), np.array([z for _, z in new])
    flat = np.full(len(new), fixed)
    have |= dict(zip(p.tolist(), range(len(u), len(u) + len(new))))
    upright = side in ("west", "east")
    u, v, h = np.concatenate([u, flat if upright else p]), np.concatenate([v, p if upright else flat]), np.concatenate([h, z])
    there, along = _on_side(side, u, v)
    ordered = np.array(sorted(have))
    on = there[tri]
    rim = on.sum(axis=1) >= 2
    out = []
    for t, o in zip(tri[rim].tolist(), on[rim].tolist()):
        k = next(k for k in range(3) if o[k] and o[(k + 1) % 3])
        a, b, c = t[k], t[(k + 1) % 3], t[(k + 2) % 3]
        low, high = sorted((int(along[a]), int(along[b])))
        between = ordered[(ordered > low) & (ordered < high)].tolist()
        line = [a, *(have[q] for q in (between if along[a] < along[b] else between[::-1])), b]
        out += [(p0, p1, c) for p0, p1 in zip(line, line[1:])]
    return u, v, h, np.concatenate([tri[~rim], np.array(out, np.int64).reshape(-1, 3)])


def closed(tiles: DataFrame) -> DataFrame:
    """Meshes with the border vertices of their neighbours of the same depth, around the date line too: both sides of a common
    border have the same vertices and heights. One exchange of border vertices; corners count for both their sides."""

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for t in b.to_pylist():
                u, v, h = np.array(t["u"]), np.array(t["v"]), np.array(t["h"])
                for side, (dx, dy) in _SIDES.items():
                    there, along = _on_side(side, u, v)
                    other = {"west": "east", "east": "west", "south": "north", "north": "south"}[side]
                    x, y = (t["x"] + dx) % 2 ** (t["l"] + 1), t["y"] + dy
                    if 0 <= y < 2 ** t["l"]:
                        rows.append((t["l"], x, y, other, along[there].tolist(), h[there].tolist()))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["l", "x", "y", "side", "places", "heights"])

    found = tiles.select("l", "x", "y", "u", "v", "h").mapInArrow(borders, "l int, x int, y int, side string, places array<int>, heights array<double>")
    around = found.groupBy("l", "x", "y").agg(F.collect_list(F.struct("side", "places", "heights")).alias("around"))  # four sides

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.to_pylist():
                u, v, h, tri = np.array(t["u"]), np.array(t["v"]), np.array(t["h"]), np.array(t["indices"]).reshape(-1, 3)
                for s in sorted(t["around"] or [], key=lambda s: s["side"]):
                    u, v, h, tri = with_border(u, v, h, tri, s["side"], np.array(s["places"], np.int64), np.array(s["heights"]))
                order, tri = _first_use(tri)
                yield _mesh_rows([(t["l"], t["x"], t["y"], u[order], v[order], h[order], tri.ravel())])

    return tiles.join(around, ["l", "x", "y"], "left").select("l", "x", "y", "u", "v", "h", "indices", "around").mapInArrow(join, _MESH)


def cracks(tiles: DataFrame) -> DataFrame:
    """l, pairs, cracked: neighbouring tiles of each depth whose common border differs in its vertices or heights."""
    on = lambda c, v: F.filter(F.arrays_zip("u", "v", "h"), lambda p: p[c] == v)
    line = lambda c, v, along: F.array_sort(F.transform(on(c, v), lambda p: F.struct(p[along].alias("at"), p["h"].alias("h"))))
    out = None
    for (c, far, along), step in ((("u", _FULL, "v"), (1, 0)), (("v", _FULL, "u"), (0, 1))):
        wide = F.pow(F.lit(2), F.col("l") + 1).cast("int")
        own = tiles.select("l", F.pmod(F.col("x") + step[0], wide).alias("x"), (F.col("y") + step[1]).alias("y"), line(c, far, along).alias("a"))
        other = tiles.select("l", "x", "y", line(c, 0, along).alias("b"))
        pairs = own.join(other, ["l", "x", "y"]).select("l", (F.col("a") != F.col("b")).alias("cracked"))
        out = pairs if out is None else out.union(pairs)
    return out.groupBy("l").agg(F.count("*").alias("pairs"), F.count_if("cracked").alias("cracked"))


# The tile format: little-endian, 88 bytes of header, then zig-zag deltas, high-water indices and border lists.


def _zigzag(v: np.ndarray) -> np.ndarray:
    d = np.diff(v, prepend=0).astype(np.int64)
    return ((d << 1) ^ (d >> 63)).astype("<u2")


def _unzigzag(code: np.ndarray) -> np.ndarray:
    c = code.astype(np.int64)
    return np.cumsum((c >> 1) ^ -(c & 1)) & 0xFFFF


def encode_tile(centre: tuple, low: float, high: float, sphere: tuple, occlusion: tuple, u: np.ndarray, v: np.ndarray, h: np.ndarray, indices: np.ndarray, normals: np.ndarray | None = None) -> bytes:
    """One tile's bytes; h in metres is quantised between low and high. normals: two bytes a vertex, an extension of the format."""
    q = np.zeros(len(h), np.int64) if high <= low else ((np.asarray(h) - low) * 32767 / (high - low)).astype(np.int64)
    u, v, indices = np.asarray(u, np.int64), np.asarray(v, np.int64), np.asarray(indices, np.int64)
    kind = "<u4" if len(u) > 65536 else "<u2"
    before = np.maximum.accumulate(np.concatenate([[-1], indices[:-1]])) + 1 if len(indices) else indices
    out = [struct.pack("<3d2f4d3d", *centre, low, high, *sphere, *occlusion), struct.pack("<i", len(u)), _zigzag(u).tobytes(), _zigzag(v).tobytes(), _zigzag(q).tobytes()]
    out += [struct.pack("<i", len(indices) // 3), (before - indices).astype(kind).tobytes()]
    for edge, along in ((u == 0, -v), (v == 0, u), (u == 32767, v), (v == 32767, -u)):  # west, south, east, north
        at = np.flatnonzero(edge)
        at = at[np.argsort(along[at], kind="stable")]
        out += [struct.pack("<i", len(at)), at.astype(kind).tobytes()]
    if normals is not None:  # fixed value of the format: extension 1 holds normals
        out += [struct.pack("<BI", 1, 2 * len(u)), np.asarray(normals, np.uint8).tobytes()]
    return b"".join(out)


def oct_normals(normals: np.ndarray) -> np.ndarray:
    """Unit normals (n, 3) as two bytes each: on an octahedron, its lower half folded out."""
    flat = normals[:, :2] / np.abs(normals).sum(axis=1, keepdims=True)
    sign = np.where(flat >= 0, 1.0, -1.0)
    flat = np.where(normals[:, 2:] <= 0, (1.0 - np.abs(flat[:, ::-1])) * sign, flat)
    return np.floor((np.clip(flat, -1, 1) * 0.5 + 0.5) * 255 + 0.5).astype(np.uint8)


def _vertex_normals(at: np.ndarray, tri: np.ndarray) -> np.ndarray:
    """Unit sums of the unit normals of the faces around each vertex; up where there is no face."""
    n = np.cross(at[tri[:, 1]] - at[tri[:, 0]], at[tri[:, 2]] - at[tri[:, 0]])
    n /= np.maximum(np.linalg.norm(n, axis=1, keepdims=True), 1e-300)
    total = np.zeros_like(at)
    for k in range(3):
        np.add.at(total, tri[:, k], n)
    size = np.linalg.norm(total, axis=1, keepdims=True)
    return np.where(size > 0, total / np.maximum(size, 1e-300), at / np.linalg.norm(at, axis=1, keepdims=True))


def decode_tile(raw: bytes) -> dict:
    """The parts of a tile's bytes."""
    head = struct.unpack_from("<3d2f4d3d", raw)
    at = 88

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(raw, kind, n, at)
        at += got.nbytes
        return got

    n = int(take("<i4", 1)[0])
    u, v, q = (_unzigzag(take("<u2", n)) for _ in range(3))
    kind = "<u4" if n > 65536 else "<u2"
    codes = take(kind, 3 * int(take("<i4", 1)[0])).astype(np.int64)
    indices, highest = np.empty(len(codes), np.int64), 0
    for k, c in enumerate(codes.tolist()):
        indices[k] = highest - c
        highest += c == 0
    edges = [take(kind, int(take("<i4", 1)[0])).astype(np.int64) for _ in range(4)]
    extensions = {}
    while at + 5 <= len(raw):
        name, size = struct.unpack_from("<BI", raw, at)
        extensions[name] = raw[at + 5 : at + 5 + size]
        at += 5 + size
    low, high = head[3], head[4]
    return {"centre": head[:3], "low": low, "high": high, "sphere": head[5:9], "occlusion": head[9:], "u": u, "v": v, "h": low + q * (high - low) / 32767, "indices": indices, "edges": edges, "normals": np.frombuffer(extensions[1], np.uint8).reshape(-1, 2) if 1 in extensions else None}


def _ecef(lon: np.ndarray, lat: np.ndarray, h: np.ndarray) -> np.ndarray:
    from ..functions.geodesy import ECCENTRICITY_SQUARED as e2
    from ..functions.geodesy import EQUATORIAL_RADIUS as a

    lon, lat = np.radians(lon), np.radians(lat)
    n = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    return np.stack([(n + h) * np.cos(lat) * np.cos(lon), (n + h) * np.cos(lat) * np.sin(lon), (n * (1 - e2) + h) * np.sin(lat)], axis=-1)


def blobs(tiles: DataFrame, normals: bool = False) -> DataFrame:
    """l, x, y and the bytes of each tile of meshes, with vertex normals if they are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for t in batch.to_pylist():
                side = 180.0 / 2 ** t["l"]
                west, south = side * t["x"] - 180, side * t["y"] - 90
                u, v, h = np.array(t["u"]), np.array(t["v"]), np.array(t["h"])
                low, high = float(h.min()), float(h.max())
                at = _ecef(west + u / 32767 * side, south + v / 32767 * side, h)
                box = (at.min(0) + at.max(0)) / 2
                radius = float(np.linalg.norm(at.max(0) - at.min(0)) / 2)
                mid = _ecef(np.array(west + side / 2), np.array(south + side / 2), np.array((low + high) / 2))
                lat, lon = np.radians(south + side / 2), np.radians(west + side / 2)
                up = np.array([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])
                codes = oct_normals(_vertex_normals(at, np.array(t["indices"]).reshape(-1, 3))) if normals else None
                raw.append(encode_tile(tuple(mid), low, high, (*box, radius), tuple(box + up * radius), u, v, h, np.array(t["indices"]), codes))
            yield pa.RecordBatch.from_arrays([batch.column("l"), batch.column("x"), batch.column("y"), pa.array(raw, pa.binary())], ["l", "x", "y", "blob"])

    return tiles.select("l", "x", "y", "u", "v", "h", "indices").mapInArrow(run, "l int, x int, y int, blob binary")


def decoded(tiles: DataFrame) -> DataFrame:
    """Meshes from tile bytes (l, x, y, blob)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [decode_tile(b) for b in batch.column("blob").to_pylist()]
            lists = [pa.array([g[k].tolist() for g in got], pa.list_(t)) for k, t in (("u", pa.int32()), ("v", pa.int32()), ("h", pa.float64()), ("indices", pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in "lxy"), *lists], ["l", "x", "y", "u", "v", "h", "indices"])

    return tiles.select("l", "x", "y", "blob").mapInArrow(run, "l int, x int, y int, u array<int>, v array<int>, h array<double>, indices array<int>")


def levels(rasters: DataFrame, cells: DataFrame, depths: list[int], tiles: DataFrame | None = None, intensity: float = 4.0, samples: int = 256) -> DataFrame:
    """Meshes of some depths, borders closed: of these tiles (l, x, y), or of all that the rasters touch. Depths that read the
    rasters as they are share their blocks; the others read them resized."""
    from . import ranges as R
    from . import rasters as Q

    spark = rasters.sparkSession
    table = {r["depth"]: r for r in T.thresholds(spark, intensity).where(F.col("depth").isin(depths)).collect()}  # 29 depths at most
    if tiles is None:
        boxes = rasters.select("min_lon", "min_lat", "max_lon", "max_lat", F.explode(F.array(*map(F.lit, depths))).alias("at"))
        tiles = R.union(R.of_extents(boxes, F.col("at")).select("depth", *R.BOUNDS)).select(F.col("depth").alias("l"), "x", "y")
    extent = tuple(rasters.agg(F.min("min_lon"), F.min("min_lat"), F.max("max_lon"), F.max("max_lat")).first())
    plan = Q.resize_plan(spark, rasters, max(depths), intensity)
    small = {r["depth"] for r in plan.where("share < 1").select("depth").distinct().collect()}
    plain = [d for d in depths if d not in small]
    found = Q.placed_blocks(rasters, cells, plain, samples, 1) if plain else None
    for d in depths:
        if d in small:
            one = Q.placed_blocks(*Q.at_depth(plan, rasters, cells, d), [d], samples, 1)
            found = one if found is None else found.unionByName(one)
    limits = {d: (r["max_diff"], Limits(d, r["tile_size"], r["min_side"], r["max_side"], extent)) for d, r in table.items()}
    return closed(checkpointed(meshes(Q.sampled(tiles, found, samples, 1), limits)))


def pyramid(rasters: DataFrame, cells: DataFrame, max_depth: int, intensity: float = 4.0, samples: int = 256, min_depth: int = 0) -> DataFrame:
    """Meshes of all tiles of depths min_depth to max_depth that the rasters touch."""
    return levels(rasters, cells, list(range(min_depth, max_depth + 1)), None, intensity, samples)


def max_depth_of(rasters: DataFrame) -> int:
    """The depth whose tiles are as fine as the finest raster."""
    from . import rasters as Q

    return rasters.select(T.depth_of_pixel(Q.pixel_metres()).alias("d")).agg(F.coalesce(F.max("d"), F.lit(0))).first()[0]
