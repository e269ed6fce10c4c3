import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.functions import text as X
from cairnflow.operators import aggregates as A
from cairnflow.operators import cluster
from cairnflow.operators import filters as C
from cairnflow.operators import sequence as S
from cairnflow.operators import spatial as J

POINTS = "array<struct<x:double,y:double,z:double>>"


def rings(spark, *shapes):
    return spark.createDataFrame([(i, [(float(x), float(y), 0.0) for x, y in s]) for i, s in enumerate(shapes)], f"id bigint, ring {POINTS}")


def verts(spark, *shapes):
    return S.vertices(rings(spark, *shapes), "id", "ring")


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_filters_and_nulls(spark):
    df = spark.createDataFrame([(None, "a"), ("x", None), ("3", "b"), ("nan", "c")], "c string, d string")

    def kept(operator, value):
        return [r.c for r in C.filter_rows(df, {"c": {"value": value, "operator": operator}}).collect()]

    assert kept("eq", "x") == ["x"] and kept("neq", "x") == [None, "3", "nan"]
    assert kept("in", ["x", "3"]) == ["x", "3"] and kept("not in", ["x"]) == [None, "3", "nan"] and kept("in", []) == [] and len(kept("not in", [])) == 4
    assert kept("gt", 2) == ["3"] and kept("le", 2) == []
    assert C.filter_rows(df, {}).count() == 4 and C.filter_rows(df, {"no": 0}).count() == 4 and C.filter_rows(df, {"no": {"value": 0, "operator": "neq"}}).count() == 0
    for bad in ({"c": {"value": 1, "operator": "like"}}, {"c": {"value": 1, "operator": "in"}}, {"c": {"operator": "eq"}}):
        with pytest.raises(ValueError):
            C.filter_rows(df, bad)


def test_angles_and_lines(spark):
    v = verts(spark, [(0, 0), (10, 0), (10, 10)], [(0, 0), (1, 0), (2, 0)], [(0, 0), (0, 0), (1, 0)])
    assert [(r.line, round(r.deflection, 6)) for r in S.sharp_turns(v).collect()] == [(0, 90.0)]
    assert {r.line: r.angle for r in S.turns(v).collect()}[2] == 180.0
    assert S.sharp_turns(v, fluctuation=8.0).count() == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(-50, 50)), min_size=2, max_size=9), st.sampled_from([1.0, 2.5, 7.0, 1000.0]))
def test_split_keeps_the_length(spark, shape, length):
    rows = S.split_by_length(verts(spark, shape), length).collect()
    total = sum(math.dist(a, b) for a, b in zip(shape, shape[1:]))
    by = {}
    for r in rows:
        by.setdefault(r.segment, []).append(r)
    lengths = [max(r.measure for r in p) - min(r.measure for r in p) for _, p in sorted(by.items())]
    assert sum(lengths) == pytest.approx(total, abs=1e-6)
    assert sorted(by) == list(range(len(by)))
    assert all(n == pytest.approx(length) for n in lengths[:-1])
    for p in by.values():
        p.sort(key=lambda r: r.measure)
        assert all(math.dist((a.x, a.y), (b.x, b.y)) == pytest.approx(b.measure - a.measure, abs=1e-6) for a, b in zip(p, p[1:]))


def test_split_example(spark):
    rows = S.split_by_length(verts(spark, [(0, 0), (2.5, 0)]), 1.0)
    assert [(r.segment, r.n) for r in rows.groupBy("segment").agg((F.max("measure") - F.min("measure")).alias("n")).orderBy("segment").collect()] == [(0, 1.0), (1, 1.0), (2, 0.5)]


def test_pieces_and_chain(spark):
    v = verts(spark, [(i, 0) for i in range(6)])
    p = S.split_at(v, F.col("seq").isin(0, 2, 5))
    assert sorted((r.piece, r.seq) for r in p.collect()) == [(1, 0), (1, 1), (1, 2), (2, 2), (2, 3), (2, 4), (2, 5)]
    assert [(r.piece, r.prev_piece, r.next_piece) for r in S.chain(p).orderBy("piece").collect()] == [(1, None, 2), (2, 1, None)]


def test_polygons(spark):
    df = rings(spark, [(0, 0), (4, 0), (4, 4), (0, 4)], [(0, 0), (4, 0), (1, 1), (0, 4), (0, 0)], [(0, 0)])
    assert one(df, G.signed_area(F.col("ring"))) == [16, 4, 0]
    assert one(df, G.is_concave(F.col("ring"))) == [False, True, False]
    assert one(df, G.point_in_ring(F.lit(2.0), F.lit(2.5), F.col("ring"))) == [True, False, False]
    assert one(df, G.polyline_distance(F.lit(2.0), F.lit(-3.0), F.col("ring"))) == [3, 3, None]
    at = one(df, G.point_at(F.col("ring"), F.lit(6.0)))
    assert (at[0].x, at[0].y) == (4, 2) and at[2] is None
    box = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]
    clipped = df.select(J.clip_to_convex("ring", box).alias("ring"))
    assert one(clipped, F.abs(G.signed_area(F.col("ring"))))[0] == 4
    again = clipped.select(J.clip_to_convex("ring", box).alias("ring"))
    assert one(again, F.abs(G.signed_area(F.col("ring")))) == one(clipped, F.abs(G.signed_area(F.col("ring"))))


def test_crossings(spark):
    def found(shapes, **kw):
        e = S.edges(verts(spark, *shapes))
        if kw.get("ring"):
            from pyspark.sql import Window

            e = e.withColumn("n_edges", F.count("*").over(Window.partitionBy("line")))
        return sorted((r.x, r.y) for r in J.crossings(e, 1.0, **kw).collect())

    assert found([[(0, 0), (2, 2)], [(2, 0), (0, 2)]]) == [(1, 1)]
    assert found([[(0, 0), (2, 0)], [(1, 0), (1, 2)]]) == []
    assert found([[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]], same_line=True, ring=True) == [(1, 1)]
    assert found([[(0, 0), (4, 0), (4, 4), (2, 4), (2, -2), (1, -2)]], same_line=True) == [(2, 0)]


def test_nearest_against_numpy(spark):
    rng = np.random.default_rng(2)
    a, b = rng.uniform(-5, 5, (80, 2)), rng.uniform(-5, 5, (120, 2))
    left = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(a)], "l_id int, l_x double, l_y double")
    right = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(b)], "r_id int, r_x double, r_y double")
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    want = {i: int(d[i].argmin()) for i in range(80) if d[i].min() <= 0.7}
    assert {r.l_id: r.r_id for r in J.nearest(left, right, 0.7, "l_id", "r_id").collect()} == want
    assert J.within(left, right, 0.7).count() == int((d <= 0.7).sum())


def test_count_within_pairs_nothing(spark):
    rng = np.random.default_rng(8)
    left = [(int(k) if k else None, float(x), float(y)) for k, (x, y) in zip(rng.integers(0, 40, 120), rng.uniform(0, 3, (120, 2)))]
    left += [(7, 1.0, 1.0), (7, 1.0, 1.25), (7, 1.0, 1.0), (8, None, 1.0), (9, math.nan, 1.0)]
    right = [(float(x), float(y)) for x, y in np.concatenate([rng.uniform(0, 3, (90, 2)), np.round(rng.uniform(0, 3, (90, 2)), 1)])] + [(1.0, 1.125)] * 2
    want = {}
    for k, x, y in left:
        if x is not None:
            want.setdefault(k, set()).update(q for q in right if math.sqrt((x - q[0]) ** 2 + (y - q[1]) ** 2) <= 0.2)
    df, other = spark.createDataFrame(left, "pid bigint, l_x double, l_y double"), spark.createDataFrame(right, "r_x double, r_y double")
    found = J.count_within(df, other, 0.2, "pid")
    assert {r.pid: r.n for r in found.collect()} == {k: len(v) for k, v in want.items() if v}
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_outliers_by_count_beside_full_cells(spark):
    rng = np.random.default_rng(3)
    p = [tuple(map(float, q)) for q in np.concatenate([rng.uniform(-2, 2, (60, 2)), rng.normal(0.2, 0.1, (200, 2))])] + [(1.5, 1.5)] * 6
    df = spark.createDataFrame([(i, *q) for i, q in enumerate([*p, (None, 1.0), (math.nan, 0.0)])], "pid bigint, x double, y double")
    n = [sum(math.sqrt((a - c) ** 2 + (b - d) ** 2) <= 0.5 for c, d in p) - 1 for a, b in p]
    assert {r.pid: r.n_near for r in J.outliers_by_count(df, 0.5, 12, "pid").collect()} == {i: k for i, k in enumerate(n) if k < 12}


def test_outliers_by_count_pairs_no_full_cells(spark):
    """A thousand places in one cell would be a million pairs."""
    df = spark.range(1000).select(F.col("id").alias("pid"), (F.col("id") / 10000).alias("x"), F.lit(0.0).alias("y"))
    found = J.outliers_by_count(df, 0.5, 12, "pid")
    assert found.count() == 0
    compared = [f for f in found.inputFiles() if "sparse-rows" in f]
    assert compared and spark.read.parquet(*compared).count() == 0


def brute_dbscan(p, eps, least):
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1)) <= eps + 1e-12
    core = d.sum(1) >= least
    label = np.zeros(len(p), int)
    for i in np.flatnonzero(core):
        if not label[i]:
            todo = [i]
            while todo:
                j = todo.pop()
                if not label[j]:
                    label[j] = i + 1
                    todo += [k for k in np.flatnonzero(d[j] & core) if not label[k]]
    for i in np.flatnonzero(~core):
        near = label[d[i] & core]
        label[i] = near.min() if len(near) else 0
    return label


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_dbscan_against_numpy(spark, dims):
    rng = np.random.default_rng(dims)
    p = np.concatenate([rng.normal(c, 0.3, (25, dims)) for c in (0, 1.2, 4)] + [rng.uniform(-3, 7, (15, dims))] + [np.zeros((6, dims)) + 6])
    axes = ["x", "y", "z"][:dims]
    df = spark.createDataFrame([(i + 1, *map(float, q)) for i, q in enumerate(p)], "pid int, " + ", ".join(f"{a} double" for a in axes))
    got = {r.pid: r.cluster for r in cluster.dbscan(df, "pid", axes, 0.35, 4).collect()}
    assert [got[i + 1] for i in range(len(p))] == brute_dbscan(p, 0.35, 4).tolist()


def test_dbscan_writes_full_cells_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.uniform(0, 3, (400, 2)), rng.uniform(6, 6.1, (3000, 2))])
    df = spark.createDataFrame([(i + 1, *map(float, q)) for i, q in enumerate(p)], "pid int, x double, y double")
    sizes, real = [], cluster.materialise

    def written(rows, name, by=None):
        out = real(rows, name, by)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(cluster, "materialise", written)
    got = {r.pid: r.cluster for r in cluster.dbscan(df, "pid", ["x", "y"], 0.2, 3).collect()}
    assert [got[i + 1] for i in range(len(p))] == brute_dbscan(p, 0.2, 3).tolist()
    assert [name for name, n in sizes if n >= 3000 and name != "edges"] == ["points"], sizes


def test_components(spark):
    rng = random.Random(4)
    nodes, edges = range(200), [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    parent = list(nodes)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = cluster.connected_components(spark.createDataFrame([(i,) for i in nodes], "node int"), spark.createDataFrame([*edges, (5, 999)], "a int, b int"))
    assert {r.node: r.component for r in got.collect()} == {i: root(i) for i in nodes}
    empty = spark.createDataFrame([], "node int")
    assert cluster.connected_components(empty, spark.createDataFrame([], "a int, b int")).count() == 0


def test_raster(spark):
    cells = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (5, 5), (6, 6)], "cx int, cy int")
    found = {(r.cx, r.cy): r.component for r in cluster.raster_components(cells).collect()}
    assert found == {(0, 0): "0,0", (0, 1): "0,0", (1, 1): "0,0", (5, 5): "5,5", (6, 6): "6,6"}
    assert cluster.large_regions(cells, 3).count() == 3
    block = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)] + [(9, 9)], "cx int, cy int")
    assert cluster.erode(block).count() == 4 and cluster.opened(block).count() == 16 and cluster.closed(block).count() == 17


def test_hulls(spark):
    assert cluster.hull(np.array([[0, 0], [2, 0], [2, 2], [0, 2], [1, 1], [1, 0]], float)).tolist() == [[0, 0], [2, 0], [2, 2], [0, 2]]
    assert len(cluster.hull(np.array([[i, i] for i in range(10)], float))) == 2
    df = spark.createDataFrame([("a", float(x), float(y)) for x in range(5) for y in range(5)] + [("b", 1.0, 1.0), (None, 0.0, 0.0)], "k string, x double, y double")
    got = cluster.convex_hulls(df, "k", "x", "y").collect()
    assert sorted((r.k, r.x, r.y) for r in got) == [("a", 0, 0), ("a", 0, 4), ("a", 4, 0), ("a", 4, 4), ("b", 1, 1)]


def test_layers(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 9.0), (2, 0.0, 0.0, 8.0), (3, 0.0, 0.0, 6.5), (4, 0.0, 0.0, 4.0), (5, 9.0, 9.0, 1.0)], "id int, x double, y double, z double")
    assert {r.id: r.layer for r in cluster.two_layers(df).collect()} == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1}


def test_two_layers_folds_no_arrays(spark):
    rng = random.Random(6)
    rows = [(i, rng.random() * 4, rng.random(), rng.choice([None, math.nan, rng.random() * 30, rng.random() * 3])) for i in range(400)]
    want, last = {}, {}
    tall = lambda z: (0, 0) if z is None else (2, 0) if math.isnan(z) else (1, z)
    for i, x, _, z in sorted(rows, key=lambda r: (tall(r[3]), r[0]), reverse=True):
        cell = math.floor(x / 0.2), math.floor(_ / 0.2)
        upper = last.get(cell) is None or (z is not None and last[cell] - z <= 2)
        want[i] = 1 if upper else 2
        if upper:
            last[cell] = z
    found = cluster.two_layers(spark.createDataFrame(rows, "id bigint, x double, y double, z double"))
    assert {r.id: r.layer for r in found.collect()} == want and set(want.values()) == {1, 2}
    assert "collect_list" not in found._jdf.queryExecution().executedPlan().toString()


def test_fits(spark):
    t = np.linspace(0, 5, 40)
    df = spark.createDataFrame([("c", float(3 + 2 * math.cos(a)), float(-1 + 2 * math.sin(a))) for a in t], "k string, x double, y double")
    r = A.circle_fit(df, ["k"], "x", "y").first()
    assert (r.centre_x, r.centre_y, r.radius) == pytest.approx((3, -1, 2))
    df = spark.createDataFrame([("c", float(x), float(1 + 2 * x - x**3)) for x in t], "k string, x double, y double")
    r = S.poly_fit(df, ["k"], "x", "y", 3).first()
    assert np.polynomial.polynomial.polyval(t - r.centre, r.coefficients) == pytest.approx(1 + 2 * t - t**3)


def test_spline():
    t = np.linspace(0, 10, 60)
    noisy = np.sin(t) + np.random.default_rng(0).normal(0, 0.2, 60)
    smooth = S.smoothing_spline(t, noisy, 0.9)
    assert smooth[0] == pytest.approx(noisy[0], abs=1e-6) and smooth[-1] == pytest.approx(noisy[-1], abs=1e-6)
    assert np.abs(np.diff(smooth, 2)).sum() < np.abs(np.diff(noisy, 2)).sum() / 3
    assert np.abs(smooth - np.sin(t))[5:-5].mean() < np.abs(noisy - np.sin(t))[5:-5].mean()
    assert S.smoothing_spline(t, 3 * t + 1, 0.01) == pytest.approx(3 * t + 1, abs=1e-6)


def test_long_line_is_smoothed_as_a_whole(spark):
    """Every vertex is as the dense system over the whole line gives it, without breaks every so many vertices."""
    n, p = 450, 0.0006
    rng = np.random.default_rng(3)
    x, y = np.arange(n) + rng.uniform(-0.2, 0.2, n), rng.normal(0, 0.3, n)
    df = spark.createDataFrame([("a", i, float(x[i]), float(y[i])) for i in range(n)], "line string, seq int, x double, y double")
    got = sorted((r.seq, r.x, r.y) for r in S.smooth(df, p).collect())
    h = np.hypot(np.diff(x), np.diff(y))
    q, r, w = np.zeros((n, n - 2)), np.zeros((n - 2, n - 2)), np.eye(n)
    w[0, 0] = w[-1, -1] = 1e-12
    for j in range(n - 2):
        q[j : j + 3, j] = 1 / h[j], -1 / h[j] - 1 / h[j + 1], 1 / h[j + 1]
        r[j, j] = (h[j] + h[j + 1]) / 3
        if j:
            r[j, j - 1] = r[j - 1, j] = h[j] / 6
    for axis, v in ((1, x), (2, y)):
        want = v - (1 - p) / p * w @ q @ np.linalg.solve(p * r + (1 - p) * q.T @ w @ q, p * q.T @ v)
        assert [g[axis] for g in got] == pytest.approx(want, abs=1e-6)


def test_projection_and_tiles(spark):
    df = spark.createDataFrame([(30.23384, 120.14515), (0.0, 0.0), (90.0, 180.0), (-33.9, 18.4)], "lat double, lon double")
    assert one(df, G.tile_id(F.col("lat"), F.col("lon")))[:2] == ["6829_3373", "4096_4096"]
    assert one(df, G.tile_id(F.col("lat"), F.col("lon")))[2] is None
    east, north = G.to_utm(F.col("lat"), F.col("lon"))
    e = one(df, east)
    assert e[1] == pytest.approx(166021.443, abs=0.01) and one(df, north)[1] == pytest.approx(0, abs=0.01)
    assert one(df, G.utm_zone(F.col("lon")))[0] == 51
    assert spark.range(1).select(G.quaternion_yaw(*map(F.lit, (math.sqrt(0.5), 0.0, 0.0, math.sqrt(0.5))))).first()[0] == pytest.approx(90)


def test_vector_helpers(spark):
    r = spark.range(1).select(
        G.lateral(*map(F.lit, (0.0, 2.0, 0.0, 0.0, 3.0, 0.0))).alias("left"), G.longitudinal(*map(F.lit, (5.0, 2.0, 0.0, 0.0, 3.0, 0.0))).alias("ahead"),
        G.angle_between(*map(F.lit, (1.0, 0.0, -1.0, 0.1)), acute=True).alias("acute"), G.azimuth(F.lit(1.0), F.lit(0.0)).alias("east"),
        G.angle_between(*map(F.lit, (0.0, 0.0, 1.0, 0.0))).alias("none"),
    ).first()
    assert (r.left, r.ahead, r.east, r.none) == (2, 5, 90, None) and r.acute == pytest.approx(5.7106, abs=1e-3)


def test_templates_and_env(spark):
    df = spark.createDataFrame([("{{ a }}-{{b}}-{{ c }}{{a}}",), ("none",), (None,), ("",)], "t string")
    values = F.create_map(F.lit("a"), F.lit("{{b}}"), F.lit("b"), F.lit("$1\\"))
    assert one(df, X.render(F.col("t"), values)) == ["{{b}}-$1\\-{{ c }}{{b}}", "none", None, ""]
    merged = X.merge_env(X.env_map(F.lit("FOO=p,BAR=p")), X.env_map(F.lit("FOO=f\n# x\nBAR=f"), "\n"), X.env_map(F.lit("FOO=i")))
    assert spark.range(1).select(merged).first()[0] == {"FOO": "i", "BAR": "f"}


@pytest.mark.parametrize("unix", [315964800, 362793599, 362793600, 1000000000, 1483228799, 1483228800, 1700000000])
def test_gps_round_trip(spark, unix):
    u = F.lit(unix)
    week, second = X.gps_week(u).cast("bigint"), X.gps_seconds_of_week(u)
    assert spark.range(1).select(X.from_gps(week, second)).first()[0] == unix
    if unix == 1700000000:
        assert spark.range(1).select(week, second).first()[:] == (2288, 252818)


def test_long_paths_in_few_rounds(spark):
    rng = random.Random(9)
    order = list(range(4000))
    rng.shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a int, b int")
    got = cluster.connected_components(spark.range(4000).selectExpr("cast(id AS int) AS node"), edges, rounds=20)
    assert got.select("component").distinct().collect() == [(0,)]


def test_numbers_over_partitions(spark):
    df = spark.range(0, 3000, 1, 7).selectExpr("cast(id % 1000 AS string) AS line")
    got = {r.line: r.n for r in S.numbered(df, "line", "n").collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))} and len(got) == 1000
    assert S.numbered(df.limit(0), "line", "n").count() == 0


def test_two_sigma(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 30)] + [(None,)], "v double")
    r = A.within_two_sigma(df, "v").first()
    assert (r.mean, r.n_kept, r.mean_kept) == (9, 3, 2)
    empty = A.within_two_sigma(df.limit(0), "v").first()
    assert (empty.mean, empty.n_kept, empty.mean_kept) == (None, 0, None)
