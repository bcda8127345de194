"""Scenes, welding and codes on small hand-made tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orograph.functions import boxes as B
from orograph.functions import codes as C
from orograph.functions import vectors3d as V
from orograph.operators import mesh as M
from orograph.operators import scenes as N
from orograph.operators import surfaces as S


def test_nodes_without_faces_go(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 3), (5, None)], "node long, parent long")
    faces = spark.createDataFrame([(4, 0)], "node long, face long")
    assert sorted(r["node"] for r in N.without_empty(nodes, faces).collect()) == [1, 3, 4]


def test_a_cycle_of_nodes_is_left_out_or_an_error(spark):
    m = [1.0 if k % 5 == 0 else 0.0 for k in range(16)]
    nodes = spark.createDataFrame([(1, 2, m), (2, 1, m), (3, None, m)], "node long, parent long, matrix array<double>")
    assert [r["node"] for r in N.world_matrices(nodes).collect()] == [3]


def test_weld_across_cells_and_attributes(spark):
    rows = [(1, 0.0999, 0.0, 0.0), (2, 0.1001, 0.0, 0.0), (3, 0.1001, 0.0, 0.0), (4, 5.0, 0.0, 0.0), (5, 0.15, 0.0, 0.0)]
    v = spark.createDataFrame(rows, "vertex long, x double, y double, z double")
    assert {r["vertex"]: r["root"] for r in S.weld(v, 0.01).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    more = v.withColumns({"nx": F.lit(0.0), "ny": F.lit(0.0), "nz": F.lit(1.0), "u": F.when(F.col("vertex") == 3, 0.5).otherwise(0.0), "v": F.lit(0.0), "r": F.lit(1), "g": F.lit(1), "b": F.lit(1), "a": F.lit(1), "batch": F.lit(0)})
    assert {r["vertex"]: r["root"] for r in S.weld(more, 0.01, S.weldable()).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    faces = spark.createDataFrame([(0, 1, 4, 5), (1, 1, 2, 4)], "face long, v0 long, v1 long, v2 long")
    assert [tuple(r) for r in S.on_roots(faces, S.weld(v, 0.01)).collect()] == [(0, 1, 4, 5)]


def test_crowded_turned_and_repeated_faces_are_counted(spark):
    faces = spark.createDataFrame([(0, 1, 2, 3), (1, 1, 2, 4), (2, 2, 1, 5), (3, 6, 6, 7), (4, 8, 9, 10), (5, 9, 10, 8)], "face long, v0 long, v1 long, v2 long")
    r = S.integrity(faces).first().asDict()
    assert r["faces"] == 6 and r["repeated"] == 1 and r["again"] == 1 and r["crowded"] == 1 and r["turned"] == 3


def test_twins_of_many_faces_on_an_edge(spark):
    faces = spark.createDataFrame([(0, 1, 2, 3), (1, 2, 1, 4), (2, 2, 1, 5), (3, 1, 2, 6), (4, 1, 2, 7)], "face long, v0 long, v1 long, v2 long")
    got = {(r["face"], r["k"]): (r["twin_face"], r["twin_k"]) for r in M.twins(faces).where("k = 0").collect()}
    assert got == {(0, 0): (1, 0), (1, 0): (0, 0), (2, 0): (3, 0), (3, 0): (2, 0), (4, 0): (None, None)}


def test_states_and_buffers(spark):
    v = spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0), (1, 1, 1.0, 0.0, 0.0)], "node long, vertex long, x double, y double, z double")
    v = v.withColumns({c: F.lit(1.0) for c in ("nx", "ny", "nz")})
    f = spark.createDataFrame([(1, 0, 0, 1, 0)], "node long, face long, v0 long, v1 long, v2 long")
    r = N.buffers(v, f).first()
    assert r["positions"] == [0.0, 0.0, 0.0, 1.0, 0.0, 0.0] and r["indices"] == [0, 1, 0]
    assert S.active(v.withColumn("status", F.when(F.col("vertex") == 0, 1))).count() == 1


def test_boxes_and_pipes(spark):
    row = spark.range(1)
    box = {f"{m}_{a}": F.lit(v) for m, v in (("min", 0.0), ("max", 2.0)) for a in "xyz"}
    tri = lambda *p: [tuple(F.lit(float(c)) for c in q) for q in p]
    near, far, through = tri((3, 3, 0), (3, 0, 3), (4, 4, 4)), tri((2.9, 2.9, 0), (2.9, 0, 2.9), (0, 2.9, 2.9)), tri((-5, 1, 1), (5, 1, 1), (0, 9, 1))
    got = row.select(*(B.meets_triangle(box, t).alias(n) for n, t in (("near", near), ("far", far), ("through", through)))).first()
    assert not got["near"] and got["far"] and got["through"]
    assert row.select(C.buildable(tuple(F.lit(x) for x in (1.0, 0.0, 0.0)), tuple(F.lit(x) for x in (-1.0, 0.0, 0.0))).alias("b")).first()["b"] is False
    pipes = spark.createDataFrame([("CIRCULAR", 1.0, 5.0, 5.0, "CIRCULAR", 1.0, 6.0, 6.0), ("RECTANGULAR", 1.0, 5.0, 5.0, "RECTANGULAR", 2.0, 5.0, 6.0), ("OVAL", 1.0, 5.0, 5.0, "OVAL", 2.0, 1.0, 6.0)], "a_type string, a_diameter double, a_width double, a_height double, b_type string, b_diameter double, b_width double, b_height double")
    assert [r[0] for r in pipes.select(C.same_profile("a", "b")).collect()] == [True, False, True]


@pytest.mark.parametrize("a, b, want", [("/data/x/y", "/data/z/y", "x"), ("C:\\d\\e", "C:\\d", "e"), ("/a", "/a", None)])
def test_first_folder_that_differs(spark, a, b, want):
    assert spark.range(1).select(C.first_difference(F.lit(a), F.lit(b)).alias("d")).first()["d"] == want


def test_frames_are_right_handed(spark):
    for d in ((0.0, 0.0, 1.0), (0.6, 0.0, 0.8), (0.0, -1.0, 0.0)):
        m = spark.range(1).select(V.frame_along(tuple(map(F.lit, d))).alias("m")).first()["m"]
        x, y, z = m[:3], m[4:7], m[8:11]
        cross = [x[1] * y[2] - x[2] * y[1], x[2] * y[0] - x[0] * y[2], x[0] * y[1] - x[1] * y[0]]
        assert max(abs(a - b) for a, b in zip(cross, z)) < 1e-12 and tuple(z) == d


def test_loops_keep_the_corners_of_faces_that_share_an_id(spark):
    """edges were joined to faces by id again, so equal ids, and ids numbered anew by each reading, mixed corners."""
    faces = spark.createDataFrame([(5, 1, 2, 3), (5, 4, 5, 6)], "face long, v0 long, v1 long, v2 long")
    got = sorted((r["a"], r["b"], r["k"], r["next_k"], r["prev_k"], r["across"]) for r in M.loops(faces).collect())
    assert got == [(1, 2, 0, 1, 2, 3), (2, 3, 1, 2, 0, 1), (3, 1, 2, 0, 1, 2), (4, 5, 0, 1, 2, 6), (5, 6, 1, 2, 0, 4), (6, 4, 2, 0, 1, 5)]
