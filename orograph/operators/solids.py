"""Solids of features: tessellated polygons with holes, extruded blocks, tubes, isosurfaces and decimated meshes.

Each function works on one feature in numpy and is mapped over rows; no feature waits for another, and one
feature's geometry is what a row holds. Polygons whose rings have as many points each are tessellated in step, with the same
points and faces; those with large, repeating or missing rings go one at a time.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import spread

Ring = list[tuple[float, float]]


def signed_area(ring: Ring) -> float:
    p = np.asarray(ring, float)
    return float((p[:, 0] * np.roll(p[:, 1], -1) - np.roll(p[:, 0], -1) * p[:, 1]).sum() / 2)


def clean_ring(ring: Ring, least: float = 1e-9) -> Ring:
    """A ring without its repeated last point, points that repeat and points in a straight line."""
    out: Ring = []
    for p in ring:
        if not out or abs(p[0] - out[-1][0]) > least or abs(p[1] - out[-1][1]) > least:
            out.append((p[0], p[1]))
    while len(out) > 1 and abs(out[0][0] - out[-1][0]) <= least and abs(out[0][1] - out[-1][1]) <= least:
        out.pop()
    k = 0
    while len(out) > 3 and k < len(out):
        a, b, c = out[k - 1], out[k], out[(k + 1) % len(out)]
        if abs((b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])) <= least:
            out.pop(k)
            k = max(0, k - 1)
        else:
            k += 1
    return out


def _blocks(a, b, c, d) -> bool:
    """Does wall c-d cross the open segment a-b, or end on it?"""
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0:
        return True
    on = lambda q: q not in (a, b) and abs(side(a, b, q)) < 1e-12 and (q[0] - a[0]) * (b[0] - q[0]) + (q[1] - a[1]) * (b[1] - q[1]) > 0
    return on(c) or on(d)


def without_holes(outer: Ring, holes: list[Ring]) -> Ring:
    """One ring that runs along the outer one and, over bridges, around each hole; the rightmost hole comes first.

    A bridge goes from a hole's rightmost point to the nearest point of the ring to the right that it sees.
    """
    ring = clean_ring(outer)
    if signed_area(ring) < 0:
        ring = ring[::-1]
    left = [h if signed_area(h) < 0 else h[::-1] for h in map(clean_ring, holes) if len(clean_ring(h)) > 2]
    for hole in sorted(left, key=lambda h: -max(p[0] for p in h)):
        k = max(range(len(hole)), key=lambda i: hole[i])
        p = hole[k]
        near = sorted((i for i in range(len(ring)) if ring[i][0] >= p[0]), key=lambda i: (ring[i][0] - p[0]) ** 2 + (ring[i][1] - p[1]) ** 2)
        walls = [(r[i], r[(i + 1) % len(r)]) for r in [ring, *left] for i in range(len(r))]
        at = next((i for i in near if not any(_blocks(p, ring[i], *w) for w in walls)), near[0])
        ring = ring[: at + 1] + hole[k:] + hole[: k + 1] + ring[at:]
    return ring


def tessellated(outer: Ring, holes: list[Ring] = ()) -> tuple[Ring, list[tuple[int, int, int]]]:
    """Points and counter-clockwise triangles of a polygon: ears are cut off, the shortest cut first."""
    ring = without_holes(outer, list(holes))
    at, out = list(range(len(ring))), []
    p = np.asarray(ring, float)

    def turn(a: int, b: int, c: int) -> float:
        return (p[b][0] - p[a][0]) * (p[c][1] - p[a][1]) - (p[b][1] - p[a][1]) * (p[c][0] - p[a][0])

    def is_ear(k: int) -> bool:
        a, b, c = at[k - 1], at[k], at[(k + 1) % len(at)]
        if turn(a, b, c) <= 0:
            return False
        rest = np.array([i for i in at if i not in (a, b, c) and tuple(p[i]) not in (tuple(p[a]), tuple(p[b]), tuple(p[c]))], int)
        if not len(rest):
            return True
        q = p[rest]
        side = lambda s, e: (p[e][0] - p[s][0]) * (q[:, 1] - p[s][1]) - (p[e][1] - p[s][1]) * (q[:, 0] - p[s][0])
        return not ((side(a, b) >= 0) & (side(b, c) >= 0) & (side(c, a) >= 0)).any()

    while len(at) > 3:
        ears = [k for k in range(len(at)) if is_ear(k)]
        if not ears:  # only degenerate corners are left
            flat = [k for k in range(len(at)) if abs(turn(at[k - 1], at[k], at[(k + 1) % len(at)])) < 1e-12]
            if not flat:
                break
            at.pop(flat[0])
            continue
        k = min(ears, key=lambda k: float(np.hypot(*(p[at[k - 1]] - p[at[(k + 1) % len(at)]]))))
        out.append((at[k - 1], at[k], at[(k + 1) % len(at)]))
        at.pop(k)
    if len(at) == 3 and turn(*at) > 0:
        out.append(tuple(at))
    return ring, out


def extruded(outer: Ring, holes: list[Ring], bottom: float, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Vertices and triangles of a block: roof, floor and the walls of all rings."""
    low, high = min(bottom, top), max(bottom, top)
    ring, tri = tessellated(outer, holes)
    n = len(ring)
    points = [(x, y, high) for x, y in ring] + [(x, y, low) for x, y in ring]
    faces = [(a, b, c) for a, b, c in tri] + [(n + a, n + c, n + b) for a, b, c in tri]
    rings = [(clean_ring(outer), 1.0), *((clean_ring(h), -1.0) for h in holes)]
    for r, way in rings:
        if signed_area(r) * way < 0:
            r = r[::-1]
        at = len(points)
        points += [(x, y, z) for x, y in r for z in (low, high)]
        for k in range(len(r)):
            a, b = at + 2 * k, at + 2 * ((k + 1) % len(r))
            faces += [(a, b, b + 1), (a, b + 1, a + 1)]
    return np.array(points, float), np.array(faces, int).reshape(-1, 3)


IN_STEP = 1 << 20
"""Numbers of one kind that polygons in step hold at once; a polygon whose bridges alone would take more goes by itself."""


def _areas(p: np.ndarray) -> np.ndarray:
    return (p[:, :, 0] * np.roll(p[:, :, 1], -1, 1) - np.roll(p[:, :, 0], -1, 1) * p[:, :, 1]).sum(1) / 2


def _turned(p: np.ndarray, way: float) -> np.ndarray:
    """Rings (n, points, 2) that don't run that way reversed."""
    return np.where((_areas(p) * way < 0)[:, None, None], p[:, ::-1], p)


def _sides(s: np.ndarray, e: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (e[..., 0] - s[..., 0]) * (q[..., 1] - s[..., 1]) - (e[..., 1] - s[..., 1]) * (q[..., 0] - s[..., 0])


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[..., 0] == b[..., 0]) & (a[..., 1] == b[..., 1])


def _bridged(ring: np.ndarray, holes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """without_holes for clean rings (n, points, 2) of n polygons, holes in order; and which of them have no way to the right."""
    ring, holes = _turned(ring, 1.0), [np.where((_areas(h) < 0)[:, None, None], h, h[:, ::-1]) for h in holes]
    rows, lost = np.arange(len(ring)), np.zeros(len(ring), bool)
    for hole in holes:
        m, n = ring.shape[1], hole.shape[1]
        most = hole[:, :, 0].max(1, keepdims=True)
        k = np.where(hole[:, :, 0] == most, hole[:, :, 1], -np.inf).argmax(1)
        p = hole[rows, k]
        a, b = p[:, None, None], ring[:, :, None]
        c, d = (np.concatenate([r if way == 0 else np.roll(r, -1, 1) for r in [ring, *holes]], 1)[:, None] for way in (0, 1))
        ac, ad = _sides(a, b, c), _sides(a, b, d)
        blocked = (ac * ad < 0) & (_sides(c, d, a) * _sides(c, d, b) < 0)
        for q, off in ((c, ac), (d, ad)):
            between = (q[..., 0] - a[..., 0]) * (b[..., 0] - q[..., 0]) + (q[..., 1] - a[..., 1]) * (b[..., 1] - q[..., 1]) > 0
            blocked |= ~_same(q, a) & ~_same(q, b) & (np.abs(off) < 1e-12) & between
        right = ring[:, :, 0] >= p[:, None, 0]
        far = np.where(right, (ring[:, :, 0] - p[:, None, 0]) ** 2 + (ring[:, :, 1] - p[:, None, 1]) ** 2, np.inf)
        seen = np.where(blocked.any(2), np.inf, far)
        at = np.where(np.isfinite(seen).any(1), seen.argmin(1), far.argmin(1))[:, None]
        lost |= ~right.any(1)
        i = np.arange(m + n + 2)[None]
        way_in, way_out = i <= at, i > at + n + 1
        of_ring = np.where(way_in, i, np.where(way_out, i - n - 2, 0))
        ring = np.where((way_in | way_out)[:, :, None], ring[rows[:, None], of_ring], hole[rows[:, None], (k[:, None] + i - at - 1) % n])
    return ring, lost


def _cut_ears(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triangles (n, points - 2, 3) of n rings (n, points, 2), cut as tessellated does, and which of them there are."""
    n, m = p.shape[:2]
    tri, there = np.zeros((n, max(0, m - 2), 3), int), np.zeros((n, max(0, m - 2)), bool)
    rows, at = np.arange(n), np.tile(np.arange(m), (n, 1))
    for step in range(m - 3):
        q = p[rows[:, None], at]
        a, c = np.roll(q, 1, 1), np.roll(q, -1, 1)
        turn = _sides(a, q, c)
        ear = turn > 0
        f, k = np.nonzero(ear)
        for lo in range(0, len(f), each := max(1, IN_STEP // q.shape[1])):
            ff, kk = f[lo : lo + each], k[lo : lo + each]
            x, y, z, rest = a[ff, kk][:, None], q[ff, kk][:, None], c[ff, kk][:, None], q[ff]
            within = (_sides(x, y, rest) >= 0) & (_sides(y, z, rest) >= 0) & (_sides(z, x, rest) >= 0)
            ear[ff, kk] = ~(within & ~_same(rest, x) & ~_same(rest, y) & ~_same(rest, z)).any(1)
        has, flat = ear.any(1), np.abs(turn) < 1e-12
        cut = np.where(has, np.where(ear, np.hypot(a[..., 0] - c[..., 0], a[..., 1] - c[..., 1]), np.inf).argmin(1), flat.argmax(1))
        own, size = np.arange(len(rows)), at.shape[1]
        tri[rows, step] = np.stack([at[own, cut - 1], at[own, cut], at[own, (cut + 1) % size]], 1)
        there[rows, step] = has
        left = np.arange(size)[None] != cut[:, None]
        go = has | flat.any(1)
        rows, at = rows[go], at[left].reshape(len(own), size - 1)[go]
    if m >= 3 and len(rows):
        tri[rows, m - 3] = at
        there[rows, m - 3] = _sides(*(p[rows, at[:, k]] for k in (0, 1, 2))) > 0
    return tri, there


def circle_steps(radius: float) -> int:
    """Sides of a round pipe's profile."""
    return 4 if radius <= 0.4 else 6 if radius <= 0.8 else 8


def tube(line: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Vertices and triangles of a pipe along a line: a profile at each point, across the mean direction there."""
    line = np.asarray(line, float)
    line = line[np.concatenate([[True], np.linalg.norm(np.diff(line, axis=0), axis=1) > 0.01])]
    if len(line) < 2:
        return np.zeros((0, 3)), np.zeros((0, 3), int)
    way = np.diff(line, axis=0)
    way /= np.linalg.norm(way, axis=1, keepdims=True)
    mean = np.concatenate([way[:1], way[:-1] + way[1:], way[-1:]])
    n = circle_steps(radius)
    angle = 2 * np.pi * np.arange(n) / n
    points = []
    side = None
    for p, d in zip(line, mean):
        d = d / max(np.linalg.norm(d), 1e-12)
        side = np.cross(d, [0.0, 0, 1]) if side is None else side - d * (side @ d)
        if np.linalg.norm(side) < 1e-6:
            side = np.cross(d, [1.0, 0, 0])
        side = side / np.linalg.norm(side)
        points += list(p + radius * (np.cos(angle)[:, None] * side + np.sin(angle)[:, None] * np.cross(d, side)))
    faces = [f for s in range(len(line) - 1) for k in range(n) for a, b in [(s * n + k, s * n + (k + 1) % n)] for f in ((a, a + n, b), (b, a + n, b + n))]
    return np.array(points), np.array(faces, int)


# A cube in six tetrahedra around its long diagonal; corners are numbered x + 2 y + 4 z.
_TETRAHEDRA = [(0, a, a | b, 7) for a in (1, 2, 4) for b in (1, 2, 4) if a != b]


def isosurface(values: np.ndarray, iso: float) -> np.ndarray:
    """Triangles (n, 3, 3) of the surface at iso in a 3-D grid, cut from tetrahedra: by rule, with no table of cases."""
    nx, ny, nz = values.shape
    i, j, k = (a.ravel() for a in np.meshgrid(np.arange(nx - 1), np.arange(ny - 1), np.arange(nz - 1), indexing="ij"))
    corner = np.array([[c & 1, c >> 1 & 1, c >> 2] for c in range(8)])
    at = np.stack([i, j, k], axis=1)[:, None, :] + corner[None]
    v = values[at[:, :, 0], at[:, :, 1], at[:, :, 2]]
    out = []
    for tet in _TETRAHEDRA:
        p, z = at[:, tet].astype(float), v[:, tet]
        above = z > iso
        for case in range(1, 15):
            inside = [c for c in range(4) if case >> c & 1]
            outside = [c for c in range(4) if c not in inside]
            rows = (above == np.array([bool(case >> c & 1) for c in range(4)])).all(1)
            if not rows.any():
                continue
            cut = lambda a, b: p[rows, a] + ((iso - z[rows, a]) / (z[rows, b] - z[rows, a]))[:, None] * (p[rows, b] - p[rows, a])  # noqa: E731, B023
            if len(inside) == 2:
                (a, b), (c, d) = inside, outside
                quad = [cut(a, c), cut(a, d), cut(b, d), cut(b, c)]
                found = [(quad[0], quad[1], quad[2]), (quad[0], quad[2], quad[3])]
            else:
                one, rest = (inside[0], outside) if len(inside) == 1 else (outside[0], inside)
                found = [tuple(cut(one, r) for r in rest)]
            up = p[rows][:, inside].mean(1) - p[rows][:, outside].mean(1)  # normals point away from what is above
            for t in found:
                t = np.stack(t, axis=1)
                turned = np.einsum("nc,nc->n", np.cross(t[:, 1] - t[:, 0], t[:, 2] - t[:, 0]), up) > 0
                t[turned] = t[turned][:, ::-1]
                out.append(t)
    return np.concatenate(out) if out else np.zeros((0, 3, 3))


def decimated(points: np.ndarray, faces: np.ndarray, longest: float, turn: float = 20.0) -> tuple[np.ndarray, np.ndarray]:
    """Edges shorter than longest collapse, shortest first, while no face turns by more than turn degrees.

    Vertices on the border stay. Ties go by vertex number, so the result is always the same.
    """
    points, faces = np.asarray(points, float), [tuple(map(int, f)) for f in faces]
    around: dict[int, set[int]] = {}
    for k, f in enumerate(faces):
        for v in f:
            around.setdefault(v, set()).add(k)
    count: dict[tuple[int, int], int] = {}
    for f in faces:
        for k in range(3):
            e = tuple(sorted((f[k], f[(k + 1) % 3])))
            count[e] = count.get(e, 0) + 1
    border = {v for e, n in count.items() if n == 1 for v in e}
    limit = np.cos(np.radians(turn))

    def normal(f: tuple[int, ...]) -> np.ndarray:
        n = np.cross(points[f[1]] - points[f[0]], points[f[2]] - points[f[0]])
        return n / max(np.linalg.norm(n), 1e-300)

    gone: set[int] = set()
    for a, b in sorted(count, key=lambda e: (float(np.linalg.norm(points[e[0]] - points[e[1]])), e)):
        if np.linalg.norm(points[a] - points[b]) >= longest:
            break
        for drop, keep in ((a, b), (b, a)):
            if drop in border or drop in gone or keep in gone:
                continue
            mine = around[drop]
            both = [k for k in mine if keep in faces[k]]
            near = lambda v: {x for k in around[v] for x in faces[k]} - {v}
            if len(both) != 2 or len(near(drop) & near(keep)) != 2:
                continue
            moved = {k: tuple(keep if v == drop else v for v in faces[k]) for k in mine if k not in both}
            if any(normal(f) @ normal(faces[k]) < limit for k, f in moved.items()):
                continue
            for k in both:
                for v in faces[k]:
                    around[v].discard(k)
            for k, f in moved.items():
                faces[k] = f
                around[keep].add(k)
            around[drop] = set()
            gone.add(drop)
            break
    live = sorted({k for ks in around.values() for k in ks})
    left = np.array([faces[k] for k in live], int).reshape(-1, 3)
    used = np.unique(left)
    rank = np.zeros(len(points), int)
    rank[used] = np.arange(len(used))
    return points[used], rank[left]


def glb(points: np.ndarray, faces: np.ndarray) -> bytes:
    """A binary glTF file of one mesh."""
    p, f = np.asarray(points, "<f4"), np.asarray(faces, "<u4").ravel()
    body = p.tobytes() + f.tobytes()
    low, high = (p.min(0).tolist(), p.max(0).tolist()) if len(p) else ([0.0] * 3, [0.0] * 3)
    # Fixed values of the format: component types 5126 (float) and 5125 (unsigned int), targets 34962 and 34963.
    head = {
        "asset": {"version": "2.0"}, "scene": 0, "scenes": [{"nodes": [0]}], "nodes": [{"mesh": 0}], "meshes": [{"primitives": [{"attributes": {"POSITION": 0}, "indices": 1}]}],
        "accessors": [{"bufferView": 0, "componentType": 5126, "count": len(p), "type": "VEC3", "min": low, "max": high}, {"bufferView": 1, "componentType": 5125, "count": len(f), "type": "SCALAR"}],
        "bufferViews": [{"buffer": 0, "byteOffset": 0, "byteLength": p.nbytes, "target": 34962}, {"buffer": 0, "byteOffset": p.nbytes, "byteLength": f.nbytes, "target": 34963}], "buffers": [{"byteLength": len(body)}],
    }
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 4)
    return struct.pack("<4sII", b"glTF", 2, 20 + len(text) + 8 + len(body)) + struct.pack("<I4s", len(text), b"JSON") + text + struct.pack("<I4s", len(body), b"BIN\0") + body


_MESH = "id long, points array<array<double>>, faces array<array<int>>"


def _meshes(rows: list[dict], each) -> pa.RecordBatch:
    got = [each(r) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array([r["id"] for r in rows], pa.int64()), pa.array([np.asarray(p).tolist() for p, _ in got], pa.list_(pa.list_(pa.float64()))), pa.array([np.asarray(f, int).tolist() for _, f in got], pa.list_(pa.list_(pa.int32())))], ["id", "points", "faces"])


def _mapped(df: DataFrame, each) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _meshes(b.to_pylist(), each)

    return df.mapInArrow(run, _MESH)


def _flat(ring: list[dict]) -> Ring:
    return [(p["x"], p["y"]) for p in ring]


def _lists(values: np.ndarray, there: np.ndarray | None, kind: pa.DataType) -> pa.Array:
    """Lists, a row each, of short lists: values (rows, lists, numbers) where there is true."""
    n, m, width = values.shape
    number = np.full(n, m) if there is None else there.sum(1)
    flat = (values if there is None else values[there]).reshape(-1, width)
    short = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * width, pa.int32()), pa.array(flat.ravel(), kind))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(number)]), pa.int32()), short)


def _clean_rings(batch: pa.RecordBatch) -> list[list[np.ndarray]] | None:
    """Each row's rings, cleaned; None if anything is null."""
    rings = batch.column("rings")
    inner = rings.flatten()
    corners = inner.flatten()
    x, y = (corners.flatten()[corners.type.get_field_index(c)] for c in "xy")
    if any(a.null_count for a in (*batch.columns, inner, corners, x, y)):
        return None
    p = np.stack([x.to_numpy(zero_copy_only=False).astype(float), y.to_numpy(zero_copy_only=False).astype(float)], 1)
    size = pc.list_value_length(inner).to_numpy(zero_copy_only=False)
    end = np.cumsum(size)
    begin, of = end - size, np.repeat(np.arange(len(size)), size)
    place = np.arange(len(p))
    after, before = np.where(place + 1 == end[of], begin[of], place + 1), np.where(place == begin[of], end[of] - 1, place - 1)
    least = 1e-9
    odd = ~(np.abs(p[after] - p) > least).any(1)
    u, v = p - p[before], p[after] - p
    odd |= (np.abs(u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]) <= least) & (size[of] > 3)
    odd_ring = np.zeros(len(size), bool)
    odd_ring[of[odd]] = True
    parts = [p[lo:hi] for lo, hi in zip(begin.tolist(), end.tolist())]
    for k in np.flatnonzero(odd_ring).tolist():
        parts[k] = np.array(clean_ring([tuple(q) for q in parts[k].tolist()]), float).reshape(-1, 2)
    number = np.concatenate([[0], np.cumsum(pc.list_value_length(rings).to_numpy(zero_copy_only=False))]).tolist()
    return [parts[lo:hi] for lo, hi in zip(number, number[1:])]


def _block(outer: np.ndarray, holes: list[np.ndarray], ring: np.ndarray, tri: np.ndarray, there: np.ndarray, bottom: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What extruded makes of n polygons in step: points, faces, and which of these there are."""
    low, high = np.minimum(bottom, top)[:, None], np.maximum(bottom, top)[:, None]
    raised = lambda p, z: np.concatenate([p, np.broadcast_to(z, p.shape[:2])[:, :, None]], 2)
    n, points, walls = ring.shape[1], [raised(ring, high), raised(ring, low)], []
    at = 2 * n
    for r, way in [(outer, 1.0), *((h, -1.0) for h in holes)]:
        r, size = _turned(r, way), r.shape[1]
        points.append(np.stack([raised(r, low), raised(r, high)], 2).reshape(len(r), 2 * size, 3))
        walls += [f for k in range(size) for a, b in [(at + 2 * k, at + 2 * ((k + 1) % size))] for f in ((a, b, b + 1), (a, b + 1, a + 1))]
        at += 2 * size
    walls = np.broadcast_to(np.array(walls), (len(ring), len(walls), 3))
    return np.concatenate(points, 1), np.concatenate([tri, n + tri[:, :, [0, 2, 1]], walls], 1), np.concatenate([there, there, np.ones(walls.shape[:2], bool)], 1)


def _polygons(df: DataFrame, upright: bool) -> DataFrame:
    """Meshes of polygons (id, rings), or, upright, of blocks (id, rings, bottom, top)."""

    def plain(r: dict) -> tuple:
        rings = [_flat(h) for h in r["rings"]]
        return extruded(rings[0], rings[1:], r["bottom"], r["top"]) if upright else tessellated(rings[0], rings[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rings = _clean_rings(b)
            groups: dict[tuple | None, list[int]] = {}
            for row, own in enumerate(rings or [[]] * len(b)):
                sizes = [len(r) for r in own]
                in_step = own and min(sizes) > 2 and sum(sizes) * (sum(sizes) + 2 * len(sizes)) <= IN_STEP
                order = tuple(sorted(range(1, len(own)), key=lambda k: -own[k][:, 0].max())) if in_step and len(own) > 2 else tuple(range(1, len(own)))
                groups.setdefault((*sizes, order) if in_step else None, []).append(row)
            alone = groups.pop(None, [])
            for key, rows in groups.items():
                total = sum(key[:-1])
                each = max(1, IN_STEP // (total * (total + 2 * len(key))))
                for lo in range(0, len(rows), each):
                    now = np.array(rows[lo : lo + each])
                    outer, *holes = (np.stack([rings[row][k] for row in now.tolist()]) for k in range(len(key) - 1))
                    ring, lost = _bridged(outer, [holes[k - 1] for k in key[-1]])
                    alone += now[lost].tolist()
                    tri, there = _cut_ears(ring)
                    points = ring
                    if upright:
                        points, tri, there = _block(outer, holes, ring, tri, there, *(b.column(c).to_numpy(zero_copy_only=False)[now].astype(float) for c in ("bottom", "top")))
                    points, tri, there = points[~lost], tri[~lost], there[~lost]
                    yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(now[~lost])).cast(pa.int64()), _lists(points, None, pa.float64()), _lists(tri, there, pa.int32())], ["id", "points", "faces"])
            if alone:
                yield _meshes(b.take(pa.array(alone)).to_pylist(), plain)

    return spread(df).mapInArrow(run, _MESH)


def tessellate(features: DataFrame) -> DataFrame:
    """Meshes (id, points, faces) of features (id, rings: outer, then holes)."""
    return _polygons(features.select("id", "rings"), False)


def extrude(features: DataFrame) -> DataFrame:
    """Meshes of features (id, rings, bottom, top) as blocks."""
    return _polygons(features.select("id", "rings", "bottom", "top"), True)


def pipes(features: DataFrame) -> DataFrame:
    """Meshes of pipes (id, line, radius)."""
    return _mapped(features.select("id", "line", "radius"), lambda r: tube([(p["x"], p["y"], p["z"]) for p in r["line"]], r["radius"]))


def decimate(meshes: DataFrame, longest: float, turn: float = 20.0) -> DataFrame:
    """Meshes with short edges collapsed."""
    return _mapped(meshes.select("id", "points", "faces"), lambda r: decimated(np.array(r["points"]), np.array(r["faces"]), longest, turn))


def as_glb(meshes: DataFrame) -> DataFrame:
    """id and binary glTF of meshes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([glb(np.array(r["points"]).reshape(-1, 3), np.array(r["faces"]).reshape(-1, 3)) for r in rows], pa.binary())], ["id", "glb"])

    return meshes.select("id", "points", "faces").mapInArrow(run, "id long, glb binary")


def mesh_area(points: str = "points", faces: str = "faces") -> Column:
    """Total area of a mesh's faces."""
    at = lambda f, k: F.get(F.col(points), F.get(f, F.lit(k)))
    d = lambda f, k, c: F.get(at(f, k), F.lit(c)) - F.get(at(f, 0), F.lit(c))

    def one(f):
        x = d(f, 1, 1) * d(f, 2, 2) - d(f, 1, 2) * d(f, 2, 1)
        y = d(f, 1, 2) * d(f, 2, 0) - d(f, 1, 0) * d(f, 2, 2)
        z = d(f, 1, 0) * d(f, 2, 1) - d(f, 1, 1) * d(f, 2, 0)
        return F.sqrt(x * x + y * y + z * z) / 2.0

    return F.aggregate(F.transform(F.col(faces), one), F.lit(0.0), lambda a, b: a + b)
