"""Whole runs on small rasters: all tiles, what is missing, what new rasters touch; options; borders and tolerances of meshes."""

from __future__ import annotations

import json

import numpy as np
import pytest

from orograph import run
from orograph.operators import pyramid as P
from orograph.options import Options, parsed
from orograph.sources import geotiff, vectors


def write(folder, name, z, west, north, px):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.tif").write_bytes(geotiff.encoded(z.astype("f4"), west, north, px, px, -9999.0))


@pytest.fixture(scope="module")
def dem(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dem")
    j, i = np.mgrid[:60, :80]
    write(folder, "a", 2000 * np.sin(i / 5) * np.cos(j / 7) + 300 * (i % 3), 100.0, 45.0, 0.5)
    return folder


def test_options(tmp_path):
    o = parsed(["-i", "a", "-o", "b", "-min", "5", "-max", "3", "-is", "99", "-it", "cubic", "-pt", "Higher", "--calculateNormals"])
    assert (o.min_depth, o.max_depth, o.intensity, o.interpolation, o.priority, o.calculate_normals, o.nodata) == (0, 3, 16.0, "bilinear", "higher", True, -9999.0)
    assert parsed(["-i", "a", "-o", "b", "-min", "2"]).min_depth == 0 and parsed(["-i", "a", "-o", "b", "-max", "40"]).max_depth == 22
    for wrong in (["-o", "b"], ["-i", "a"]):
        with pytest.raises(ValueError):
            parsed(wrong)
    with pytest.raises(SystemExit):
        parsed(["--nothing"])


def test_a_run_and_going_on(spark, dem, tmp_path):
    o = Options(input=str(dem), output=str(tmp_path / "out"), max_depth=3, calculate_normals=True)
    first = run.convert(spark, o)
    assert set(first) == {0, 1, 2, 3} and all(n > 0 for n in first.values())
    layer = json.loads((tmp_path / "out" / "layer.json").read_text())
    assert len(layer["available"]) == 4 and layer["extensions"] == ["octvertexnormals"]
    some = sorted((tmp_path / "out").glob("3/*/*.terrain"))
    some[0].unlink()
    again = run.convert(spark, Options(**{**o.__dict__, "resume": True}))
    assert again == {0: 0, 1: 0, 2: 0, 3: 1} and some[0].exists()
    raw = some[0].read_bytes()
    state = run.state(spark, o, 3)
    assert state.count() == first[3]
    gone = spark.createDataFrame([(3, int(some[0].parent.name), int(some[0].stem)), (3, 0, 0)], "depth int, x int, y int")
    assert vectors.delete_tiles(gone, o.output) == 1 and not some[0].exists()
    tile = P.decode_tile(raw)
    assert tile["normals"].shape == (len(tile["u"]), 2) and len(tile["edges"]) == 4


def test_new_rasters_change_what_they_touch(spark, dem, tmp_path):
    out = tmp_path / "out"
    o = Options(input=str(dem), output=str(out), min_depth=0, max_depth=4)
    run.convert(spark, o)
    before = {p.relative_to(out): p.read_bytes() for p in out.glob("*/*/*.terrain")}
    write(tmp_path / "new", "b", np.full((8, 8), 5000.0), 102.0, 40.0, 0.25)
    counts = run.modify(spark, o, str(tmp_path / "new"))
    after = {p.relative_to(out): p.read_bytes() for p in out.glob("*/*/*.terrain")}
    changed = {p for p in before if before[p] != after[p]}
    assert set(before) == set(after) and 0 < len(changed) < len(before) and sum(counts.values()) < len(before)
    heights = [P.decode_tile(after[p])["high"] for p in changed if p.parts[0] == "4"]
    assert max(heights) > 4900


def test_borders_do_not_crack(spark, dem):
    rasters, cells = geotiff.read(spark, str(dem))
    c = {r["l"]: (r["pairs"], r["cracked"]) for r in P.cracks(P.pyramid(rasters, cells, 5, min_depth=4)).collect()}
    assert set(c) == {4, 5} and all(pairs > 5 and cracked == 0 for pairs, cracked in c.values())


def test_fans_close_a_border():
    u, v = np.array([0, 32767, 32767, 0]), np.array([0, 0, 32767, 32767])
    tri = np.array([[0, 1, 2], [0, 2, 3]])
    u, v, h, tri = P.with_border(u, v, np.zeros(4), tri, "west", np.array([0, 1000, 20000, 32767]), np.array([0.0, 5.0, 7.0, 0.0]))
    u, v, h, tri = P.with_border(u, v, h, tri, "south", np.array([0, 16000, 32767]), np.array([0.0, 3.0, 0.0]))
    area = sum((u[b] - u[a]) * (v[c] - v[a]) - (u[c] - u[a]) * (v[b] - v[a]) for a, b, c in tri.tolist())
    assert len(u) == 7 and len(tri) == 5 and area == 2 * 32767**2 and set(zip(u.tolist(), h.tolist())) >= {(0, 5.0), (0, 7.0), (16000, 3.0)}


@pytest.mark.parametrize("seed", [1, 2])
def test_no_sample_is_further_off_than_allowed(seed):
    rng = np.random.default_rng(seed)
    z = np.zeros((64, 64))
    for _ in range(12):  # plateaus and single peaks
        a, b, n = *rng.integers(0, 60, 2), rng.integers(1, 12)
        z[a : a + n, b : b + n] = rng.uniform(50, 900)
    surface = lambda c, r: z[np.clip((r / 4).astype(int), 0, 63), np.clip((c / 4).astype(int), 0, 63)]
    at, tri = P.bisected(40.0, surface, heights=z)
    h = surface(at[:, 0].astype(float), at[:, 1].astype(float))
    worst, n = 0.0, 0
    for t in tri.tolist():
        p = at[t].astype(float)
        if np.abs(p - p[[1, 2, 0]]).max() < 8:
            continue  # smaller than two samples: no sample's middle need lie within
        det = (p[1, 1] - p[2, 1]) * (p[0, 0] - p[2, 0]) + (p[2, 0] - p[1, 0]) * (p[0, 1] - p[2, 1])
        row, col = np.mgrid[:64, :64] * 4 + 2.0
        a = ((p[1, 1] - p[2, 1]) * (col - p[2, 0]) + (p[2, 0] - p[1, 0]) * (row - p[2, 1])) / det
        b = ((p[2, 1] - p[0, 1]) * (col - p[2, 0]) + (p[0, 0] - p[2, 0]) * (row - p[2, 1])) / det
        inside = (a > 0) & (b > 0) & (a + b < 1)
        off = np.abs(z - (a * h[t[0]] + b * h[t[1]] + (1 - a - b) * h[t[2]]))
        worst, n = max(worst, float(off[inside].max(initial=0))), n + int(inside.sum())
    assert n > 500 and worst <= 40.0


def test_tile_functions_in_sql(spark):
    run.register(spark)
    got = spark.sql("SELECT tile_x(0.0D, 3) AS x, tile_y(90.0D, 3) AS y, tile_x(-180.0D, 5) AS w, round(tile_size(0)) AS s, tile_angle(40) AS a").first()
    assert tuple(got) == (8, 7, 0, round(np.pi * 6378137.0), -1.0)


def test_listing_of_no_folder(spark, tmp_path):
    assert vectors.tile_tree_or_none(spark, str(tmp_path / "none")) is None
