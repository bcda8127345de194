"""Solids by their areas, volumes and topology."""

from __future__ import annotations

import struct
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from orograph.operators import model as O
from orograph.operators import solids as S


def flat_area(ring, tri):
    p = np.array(ring)
    return sum(((p[b] - p[a])[0] * (p[c] - p[a])[1] - (p[b] - p[a])[1] * (p[c] - p[a])[0]) / 2 for a, b, c in tri)


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
HOLES = [[(2, 2), (4, 2), (4, 4), (2, 4)], [(6, 6), (6, 8), (8, 8), (8, 6)]]


@pytest.mark.parametrize("outer, holes, want", [(SQUARE, [], 100), (SQUARE[::-1], [], 100), (SQUARE, HOLES[:1], 96), (SQUARE, HOLES, 92), ([(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)], [], 10), ([(0, 0), (1, 0), (2, 0), (2, 2), (0, 2)], [], 4)])
def test_tessellated_area(outer, holes, want):
    assert abs(flat_area(*S.tessellated(outer, holes)) - want) < 1e-9


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.5, 5.0), min_size=3, max_size=24))
def test_star_shaped_rings(radii):
    ring = [(r * np.cos(a), r * np.sin(a)) for r, a in zip(radii, np.arange(len(radii)) * 2 * np.pi / len(radii))]
    assert abs(flat_area(*S.tessellated(ring)) - abs(S.signed_area(ring))) < 1e-6


def volume(points, faces):
    return sum(np.dot(points[a], np.cross(points[b], points[c])) / 6 for a, b, c in faces)


def test_blocks_and_tubes():
    assert abs(volume(*S.extruded(SQUARE, HOLES, 5.0, 2.0)) - 92 * 3) < 1e-6
    points, faces = S.tube([(0, 0, 0), (0, 0, 0.001), (0, 0, 5), (5, 0, 5)], 0.5)
    assert len(points) == 3 * 6 and len(faces) == 2 * 2 * 6


def test_isosurface_is_closed_and_round():
    g = np.linspace(-1, 1, 25)
    x, y, z = np.meshgrid(g, g, g, indexing="ij")
    tri = S.isosurface(0.7 - np.sqrt(x * x + y * y + z * z), 0.0)
    key, at = np.unique(np.round(tri.reshape(-1, 3), 6), axis=0, return_inverse=True)
    edges = Counter(tuple(sorted(e)) for f in at.reshape(-1, 3).tolist() for e in ((f[0], f[1]), (f[1], f[2]), (f[2], f[0])) if e[0] != e[1])
    assert set(edges.values()) <= {2, 4} or all(n % 2 == 0 for n in edges.values())
    assert abs(volume(tri.reshape(-1, 3) / 12, np.arange(len(tri) * 3).reshape(-1, 3)) - 4 / 3 * np.pi * 0.7**3) < 0.03


def test_flat_nets_decimate_to_little():
    n = 12
    points = np.array([(i, j, 0.0) for j in range(n) for i in range(n)], float)
    faces = np.array([f for j in range(n - 1) for i in range(n - 1) for a in [j * n + i] for f in ((a, a + 1, a + n + 1), (a, a + n + 1, a + n))])
    p, f = S.decimated(points, faces, 50.0)
    assert len(f) < len(faces) / 2 and abs(abs(flat_area(p[:, :2].tolist(), f.tolist())) - (n - 1) ** 2) < 1e-9


def test_meshes_of_rows(spark):
    ring = lambda r: [{"x": float(x), "y": float(y)} for x, y in r]
    df = spark.createDataFrame([(1, [ring(SQUARE), ring(HOLES[0])], 0.0, 3.0)], "id long, rings array<array<struct<x:double,y:double>>>, bottom double, top double")
    meshes = S.extrude(df)
    assert abs(meshes.select(S.mesh_area().alias("a")).first()[0] - (2 * 96 + 3 * (40 + 8))) < 1e-9
    raw = bytes(S.as_glb(meshes).first()["glb"])
    assert raw[:4] == b"glTF" and struct.unpack("<I", raw[8:12])[0] == len(raw)
    assert S.tessellate(df).count() == S.decimate(meshes, 0.1).count() == 1


def ring_rows(spark):
    point = lambda r: [{"x": float(x), "y": float(y)} for x, y in r]
    rings = [SQUARE, [(0, 0), (9, 0), (9, 1), (1, 1), (1, 9), (0, 9)], [(0, 0), (10, 0), (10, 10)], [(1, 1), (1, 1), (1, 1)], None]
    return spark.createDataFrame([(k, r and point(r), n, k * 10) for k, r in enumerate(rings) for n in [[7, 40, 3, 2, 5][k]]] + [(9, point(SQUARE), 0, 1), (10, point(SQUARE), None, 1)], "id long, ring array<struct<x:double,y:double>>, n int, other long")


def test_points_found_in_a_row_are_those_of_all_candidates(spark, monkeypatch):
    rows = lambda: sorted(map(tuple, O.scattered(ring_rows(spark), F.col("n"), 5, 6, ("other",)).collect()))
    found = rows()
    monkeypatch.setattr(O, "MOST_IN_A_ROW", 0)
    assert found == rows() and {r[0] for r in found} == {0, 1, 2} and sum(r[0] == 0 for r in found) == 7 and all(r[4] == r[0] * 10 for r in found)


def test_tries_cost_nothing_once_all_points_are_inside(spark):
    """every candidate became a row that was tested, 48 for each point wanted."""

    def generated(plan):
        own = plan.metrics().apply("numOutputRows").value() if plan.nodeName().startswith("Generate") else 0
        return own + sum(generated(plan.children().apply(k)) for k in range(plan.children().size()))

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = O.scattered(ring_rows(spark).where("id = 1"), F.col("n"), 5, 48)
        assert len(got.collect()) == 40 and generated(got._jdf.queryExecution().executedPlan()) == 40
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_polygons_in_step_are_those_made_one_at_a_time(spark):
    """each polygon went through plain Python by itself; in step, points and faces must not differ."""
    rng = np.random.default_rng(3)

    def star(n, cx, cy, most):
        angle = np.sort(rng.uniform(0, 2 * np.pi, n))
        size = rng.uniform(0.3, 1.0, n) * most
        return [(float(x), float(y)) for x, y in zip(cx + size * np.cos(angle), cy + size * np.sin(angle))]

    shapes = [[SQUARE], [SQUARE, *HOLES], [SQUARE[::-1], HOLES[1][::-1], HOLES[0]], [[(0, 0), (5, 0), (5, 0), (10, 0), (10, 10), (0, 10)], HOLES[0]], [SQUARE, [(1, 1), (1, 1), (2, 2)]]]
    shapes += [[SQUARE[:-1], star(4, 3, 3, 2), star(4, 7, 7, 2)][: 1 + k % 3] for k in range(60)] + [[star(7, 0, 0, 9)] for _ in range(40)]
    shapes = [[[(float(x), float(y)) for x, y in r] for r in s] for s in shapes]
    rows = [(k, [[{"x": x, "y": y} for x, y in r] for r in s], 3.0 + k, k * 0.5) for k, s in enumerate(shapes)]
    df = spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>, bottom double, top double")
    flat = {r["id"]: (r["points"], r["faces"]) for r in S.tessellate(df).collect()}
    blocks = {r["id"]: (r["points"], r["faces"]) for r in S.extrude(df).collect()}
    assert len(flat) == len(blocks) == len(shapes)
    for k, (outer, *holes) in enumerate(shapes):
        ring, tri = S.tessellated(outer, holes)
        assert flat[k] == ([list(p) for p in ring], [list(map(int, t)) for t in tri])
        points, faces = S.extruded(outer, holes, 3.0 + k, k * 0.5)
        assert blocks[k] == (points.tolist(), faces.tolist())


@pytest.mark.parametrize("make", [S.tessellate, S.extrude])
def test_many_polygons_take_seconds(spark, make):
    """20,000 polygons in one file took minutes, some milliseconds each in one task."""
    import time

    k = F.col("id") % 50
    ring = lambda lo, hi: F.array(*(F.struct((k + x).alias("x"), F.lit(y).alias("y")) for x, y in ((lo, lo), (hi, lo), (hi, hi), (lo, hi))))
    df = spark.range(20_000).coalesce(1).select("id", F.array(ring(0.0, 4.0), ring(1.0, 2.0)).alias("rings"), F.lit(0.0).alias("bottom"), F.lit(1.0).alias("top"))
    started = time.monotonic()
    assert make(df).agg(F.sum(F.size("faces"))).first()[0] == 20_000 * (8 if make is S.tessellate else 32)
    assert time.monotonic() - started < 30
