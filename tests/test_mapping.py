import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.operators import mapping as M
from cairnflow.operators import sequence as S

RING = "id string, ring array<struct<x:double,y:double,z:double>>"


def verts(spark, shapes):
    return S.vertices(spark.createDataFrame([(k, [(float(x), float(y), 0.0) for x, y in s]) for k, s in shapes.items()], RING), "id", "ring")


def test_widths(spark):
    rays = spark.createDataFrame([("a", 0.0, 4.5, 0.0, -4.5), ("b", 10.0, 4.5, 10.0, -4.5)], "ray string, ax double, ay double, bx double, by double")
    truth = S.edges(verts(spark, {"l": [(-1, 2), (20, 2)], "far": [(-1, 4), (20, 4)], "r": [(-1, -1), (20, -1)]}))
    found = S.edges(verts(spark, {"l": [(-1, 3), (5, 3)], "r": [(-1, -1), (20, -1)]}))
    got = {r.ray: r for r in M.width_differences(rays, truth, found, 2.0).collect()}
    assert (got["a"].truth_width, got["a"].found_width, got["a"].difference, got["a"].is_skipped) == (3, 4, 1, False)
    assert got["b"].truth_width == 3 and got["b"].found_width is None and got["b"].is_skipped


def test_lights(spark):
    rows = [(1, 0.0, 0.0, 10.0, True, 1), (2, 3.0, 0.0, 12.0, True, 3), (3, 6.0, 0.0, 200.0, True, 4), (4, 0.0, 0.0, 5.0, False, 1), (5, 100.0, 0.0, 7.0, True, 2)]
    df = spark.createDataFrame(rows, "id int, x double, y double, heading double, is_single boolean, num_pts int")
    got = {r.light_id: r for r in M.merge_lights(df).collect()}
    assert set(got) == {600_000_001, 600_000_004, 600_000_005}
    one = got[600_000_001]
    assert (one.n, one.x, one.heading) == (3, pytest.approx((0 + 9 + 24) / 8), pytest.approx((10 + 36) / 4))
    assert got[600_000_004].heading == 5 and not got[600_000_004].is_single


def test_line_measures(spark):
    rows = [("a", float(i) / 10, 0.1 * (-1) ** i, 5.0 if i == 0 else 7.0) for i in range(101)] + [("b", 0.0, 0.0, 0.0), ("b", 0.01, 0.0, 0.0)]
    got = M.line_measures(spark.createDataFrame(rows, "k string, x double, y double, z double"), ["k"]).collect()
    assert len(got) == 1 and got[0].length == pytest.approx(10, abs=0.01) and got[0].thinness == pytest.approx(0.1, abs=0.01)
    assert sorted((got[0].z_first, got[0].z_last)) == [pytest.approx(6, abs=0.4), 7]


def test_marks_and_areas(spark):
    grid = [(i + 1, float(x), float(y)) for i, (x, y) in enumerate((x * 0.2, y * 0.2) for x in range(20) for y in range(5))]
    df = spark.createDataFrame(grid + [(900, 50.0, 50.0)], "id int, x double, y double")
    got = M.mark_boxes(df, 0.3, 3, None, 50, 1.0, 10.0).collect()
    assert len(got) == 1 and (got[0].n, got[0].length, got[0].width) == (100, pytest.approx(3.8), pytest.approx(0.8)) and got[0].area == pytest.approx(3.8 * 0.8)
    assert M.mark_boxes(df, 0.3, 3, None, 50, 1.0, 3.0).count() == 0
    areas = M.labelled_areas(df.withColumn("z", F.lit(2.0)).withColumn("label", F.lit(9)), 0.3, 3).orderBy("corner").collect()
    assert [(round(r.x, 6), round(r.y, 6), r.z) for r in areas] == [(0, 0, 2), (3.8, 0, 2), (3.8, 0.8, 2), (0, 0.8, 2)]


def test_repeated_lines(spark):
    v = verts(spark, {"a": [(0, 0), (100, 0)], "b": [(10, 1), (60, 1)], "c": [(0, 50), (100, 50)], "d": [(100, 50.5), (0, 50.5)]})
    assert {(r.line, r.covered_by) for r in M.repeated_lines(v, 2.0, 1.0).collect()} == {("b", "a"), ("d", "c")}


def test_shape(spark):
    rng = np.random.default_rng(1)
    line = [(i, float(i) * 0.1, 0.0, 0.0) for i in range(40)]
    plane = [(100 + i, 100 + float(x), float(y), 0.0) for i, (x, y) in enumerate(rng.uniform(0, 1, (60, 2)))]
    got = {r.id: r for r in M.shape_features(spark.createDataFrame(line + plane, "id bigint, x double, y double, z double"), 1.0).collect()}
    assert got[20].linearity > 0.999 and got[20].n == 21
    assert np.mean([got[100 + i].planarity for i in range(60)]) > 0.4 and all(got[100 + i].scattering < 1e-9 for i in range(60))


def test_simplify(spark):
    assert M.simplify(np.array([[0, 0], [1, 0.1], [2, -0.1], [3, 5], [4, 6], [5, 7]], float), 1.0).tolist() == [True, False, True, True, False, True]
    df = spark.createDataFrame([("a", [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (2.0, 0.0, 0.0)]), ("b", [(0.0, 0.0, 0.0)]), ("c", []), ("d", None)], RING)
    assert {r.id: r.kept for r in M.simplified(df, "id", "ring", 0.1).collect()} == {"a": [0, 2], "b": [0], "c": [], "d": []}


def test_graphs(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 2), (9, 9), (5, None)], "a int, b int")
    nodes = lambda *n: spark.createDataFrame([(i,) for i in n], "node int")
    assert {r.node: r.steps for r in M.reachable(edges, nodes(1)).collect()} == {1: 0, 2: 1, 3: 2, 4: 3}
    assert {(r.a, r.b) for r in M.splice(edges, nodes(2, 3)).collect()} == {(1, 4), (9, 9)}
    assert M.reachable(edges.limit(0), nodes(7)).count() == 1


def test_peaks(spark):
    rows = [("a", i, float(i), 0.0, 0.0, float(c)) for i, c in enumerate([5, 9, 8, 1, 7, 9])]
    df = spark.createDataFrame(rows, "ring string, k int, x double, y double, z double, curvature double")
    got = M.sector_peaks(df, "ring", "k", sectors=1, top=2, least=2.0, apart=1.5).collect()
    assert sorted(r.k for r in got) == [1, 5]


def test_clip_and_tiles(spark):
    box = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    df = spark.createDataFrame([(-1.0, 1.0, 3.0, 1.0), (3.0, 3.0, 4.0, 4.0), (1.0, 1.0, 1.0, 5.0), (-1.0, -1.0, -1.0, 5.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(G.clip_range(*map(F.col, "abcd"), box)).collect()]
    assert [g and (g.t0, g.t1) for g in got] == [(0.25, 0.75), None, (0, 0.25), None]
    pos = spark.createDataFrame([(30.23, 120.14), (-33.9, 18.4), (12.4, -70.2)], "lat double, lon double").withColumn("t", G.integer_tile(F.col("lat"), F.col("lon")))
    lat, lon = G.integer_tile_centre(F.col("t"))
    for r in pos.select("lat", "lon", lat.alias("p"), lon.alias("q")).collect():
        assert math.dist((r.lat, r.lon), (r.p, r.q)) < 180 / 8192
