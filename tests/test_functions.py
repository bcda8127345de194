"""Number, codec and mesh functions at their edges."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orograph.functions import geodesy as G
from orograph.functions import numbers as N
from orograph.functions import tiles as T
from orograph.operators import mesh as M
from orograph.operators import pyramid as P
from orograph.operators import ranges as R


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_integers_truncate_and_saturate(spark):
    v = [1.7, -1.7, float("nan"), 1e12, -1e12]
    assert one(spark, *(N.to_int(F.lit(x)) for x in v)) == (1, -1, 0, 2147483647, -2147483648)
    assert one(spark, *(N.half_up(F.lit(x)) for x in (-1.5, 2.5))) == (-1, 3)
    assert one(spark, *(N.wrap16(F.lit(x)) for x in (40000, -40000, 5))) == (-25536, 25536, 5)


def test_zigzag_round_trip(spark):
    v = [0, -1, 1, 32767, -32768]
    assert one(spark, *(N.unzigzag(N.zigzag(F.lit(x))) for x in v)) == tuple(v)


# Known encodings of unit normals.
@pytest.mark.parametrize("normal, want", [((0.0, 0.0, -1.0), (255, 255)), ((0.0, 0.0, 1.0), (128, 128))])
def test_octahedral_bytes(spark, normal, want):
    assert one(spark, *M.oct_bytes(*map(F.lit, normal))) == want


def test_tiles_at_the_edges_of_the_globe(spark):
    d = F.lit(3)
    assert one(spark, T.tile_x(F.lit(180.0), d), T.tile_y(F.lit(90.0), d), T.tile_x(F.lit(-180.0), d), T.tile_y(F.lit(-90.0), d)) == (15, 7, 0, 0)
    assert one(spark, T.angle(F.lit(29)), T.angle(F.lit(0))) == (-1.0, 180.0)


def test_geodesy_round_trip(spark):
    rows = spark.createDataFrame([(12.5, 47.25, 812.0), (-179.0, -89.0, -30.0), (0.0, 0.0, 0.0)], "lon double, lat double, h double")
    x, y, z = G.ecef(F.col("lon"), F.col("lat"), F.col("h"))
    back = rows.select("*", x.alias("x"), y.alias("y"), z.alias("z")).select("lon", "lat", "h", *G.geodetic(F.col("x"), F.col("y"), F.col("z")))
    for r in back.collect():
        assert np.allclose(r[:2], r[3:5], atol=1e-9) and abs(r[2] - r[5]) < 1e-5


def test_touching_ranges_name_each_tile_once(spark):
    r = spark.createDataFrame([(4, 0, 3, 0, 1), (4, 3, 5, 1, 2), (4, 30, 40, 14, 20)], "depth int, min_x int, max_x int, min_y int, max_y int")
    want = {(x, y) for x in range(4) for y in range(2)} | {(x, y) for x in range(3, 6) for y in (1, 2)} | {(x, y) for x in (30, 31) for y in (14, 15)}
    assert sorted((t["x"], t["y"]) for t in R.union(r).collect()) == sorted(want)


def test_bisected_mesh_conforms():
    at, tri = P.bisected(2.0, lambda c, r: 100 * np.sin(c / 40) * np.cos(r / 30))
    edges = Counter(frozenset((t[i], t[(i + 1) % 3])) for t in tri.tolist() for i in range(3))
    points = {tuple(p) for p in at.tolist()}
    for edge, n in edges.items():
        a, b = (at[i] for i in edge)
        outer = any(a[k] == b[k] and a[k] in (0, P.GRID) for k in (0, 1))
        assert n == (1 if outer else 2)
        assert ((a + b) % 2).any() or tuple(((a + b) // 2).tolist()) not in points
    area = sum(abs((at[b][0] - at[a][0]) * (at[c][1] - at[a][1]) - (at[c][0] - at[a][0]) * (at[b][1] - at[a][1])) / 2 for a, b, c in tri.tolist())
    assert area == P.GRID**2


def test_a_peak_of_one_sample_splits_its_triangle():
    z = np.zeros((256, 256))
    z[101, 83] = 50.0
    surface = lambda c, r: z[np.minimum(r.astype(int), 255), np.minimum(c.astype(int), 255)]
    limits = P.Limits(2, 256.0, 6.4, 20.48, (-180.0, -90.0, 180.0, 90.0))
    flat = P.bisected(10.0, lambda c, r: c * 0.0, limits=limits)[1]
    assert len(flat) == 512 and len(P.bisected(10.0, surface, heights=z, limits=limits)[1]) > 512
    assert len(P.bisected(10.0, surface, heights=z)[1]) > 2


def test_tile_bytes_round_trip():
    u, v, h = np.array([0, 32767, 0, 32767]), np.array([0, 0, 32767, 32767]), np.array([5.0, 10.0, 7.5, 5.0])
    raw = P.encode_tile((1.0, 2.0, 3.0), 5.0, 10.0, (0, 0, 0, 1), (0, 0, 1), u, v, h, np.array([0, 1, 2, 2, 1, 3]))
    got = P.decode_tile(raw)
    assert got["u"].tolist() == u.tolist() and got["v"].tolist() == v.tolist() and got["indices"].tolist() == [0, 1, 2, 2, 1, 3]
    assert np.allclose(got["h"], h, atol=1e-3) and [e.tolist() for e in got["edges"]] == [[2, 0], [0, 1], [1, 3], [3, 2]]
