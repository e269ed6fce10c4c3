import numpy as np
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.operators import filters, scope


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def xy(x, y):
    return F.lit(x).cast("double"), F.lit(y).cast("double")


def test_scopes(spark):
    north, left, right = xy(0, 1), xy(-2, 0), xy(2, 0)
    assert [one(spark, scope.in_lane(xy(x, 5), left, right, north, 0.5)) for x in (-3, -2.5, 0, 2.5, 2.6)] == [False, True, True, True, False]
    assert [one(spark, scope.stop_line_in_lane(xy(x, 9), xy(0, 0), north, F.lit(3.0), 0.5)) for x in (-2.1, -2, 0, 2)] == [False, True, True, True]
    none = (F.lit(None).cast("double"), F.lit(None).cast("double"))
    road = lambda x, mode, middle=xy(0, 0), l=left, r=right: one(spark, scope.in_road(xy(x, 1), l, r, middle, north, 0.5, mode))
    assert [road(x, 0) for x in (-3, 0, 3)] == [False, True, False] and road(-3, 0, l=none) and road(3, 0, r=none)
    assert [road(x, 1) for x in (-1, -0.5, 1)] == [False, True, True] and [road(x, 2) for x in (-1, 0.4, 1)] == [True, True, False]
    assert road(0, 1, none) and not road(0, 2, none)


def test_points_along_a_line(spark):
    rng = np.random.default_rng(2)
    lines = {"a": np.cumsum(rng.normal(0, 60, (6, 2)), axis=0), "b": np.array([[0.0, 0.0], [0.0, 500.0], [0.0, 500.0]])}
    edges = [(n, k, *map(float, (*p, *q))) for n, ps in lines.items() for k, (p, q) in enumerate(zip(ps, ps[1:]))]
    points = [(i, *map(float, p)) for i, p in enumerate(rng.uniform(-200, 500, (300, 2)))]
    want = set()
    for i, x, y in points:
        for n, ps in lines.items():
            best = None
            for k, (p, q) in enumerate(zip(ps, ps[1:])):
                u = q - p
                t = 0.0 if not u.any() else float(np.clip(np.dot(np.array([x, y]) - p, u) / np.dot(u, u), 0, 1))
                away = float(np.hypot(*(np.array([x, y]) - p - t * u)))
                if best is None or away < best[0]:
                    best = away, k, t * np.hypot(*u), (1 - t) * np.hypot(*u)
            if best[0] <= 30 and not (best[1] == 0 and best[2] < 1e-5) and not (best[1] == len(ps) - 2 and best[3] < 1e-5):
                want.add((i, n, round(best[0], 6)))
    found = scope.along_line(spark.createDataFrame(points, "id int, x double, y double"), spark.createDataFrame(edges, "line string, k int, ax double, ay double, bx double, by double"))
    got = [(r.id, r.line, round(r.distance, 6)) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_isolated_points(spark):
    rng = np.random.default_rng(3)
    p = np.vstack((rng.normal(0, 1, (150, 3)), [[40, 0, 0], [0, 900, 0]], np.zeros((5, 3))))
    rows = [(i, *map(float, v)) for i, v in enumerate(p)]
    far = np.sort(np.linalg.norm(p[:, None] - p[None], axis=2), axis=1)[:, 1:9].mean(axis=1)
    df = spark.createDataFrame(rows + rows[:3] + [(999, None, 0.0, 0.0)], "id int, x double, y double, z double")
    got = {r.id: r.distance for r in scope.neighbour_distance(df, 8, 0.5).collect()}
    assert len(got) == len(p) and np.allclose([got[i] for i in range(len(p))], far)
    limit = far.mean() + 1.5 * far.std(ddof=1)
    assert {r.id for r in scope.statistical_outliers(df, 8, 1.5, 4.0).collect()} == set(np.flatnonzero(far > limit).tolist())
    assert scope.statistical_outliers(df.limit(0), 8, 1.0).count() == 0
    assert {r.id: r.distance for r in scope.neighbour_distance(spark.createDataFrame(rows[:2], df.schema), 8, 0.5).collect()}.keys() == {0, 1}


def test_sampling_and_shares(spark):
    windows = [one(spark, filters.sampling_window(F.lit(v))) for v in (-0.5, 2.9, 3.0, -6.0, 6.1)]
    assert [w and tuple(w) for w in windows] == [(4, 14), (4, 14), (6, 16), (8, 18), None]
    assert tuple(one(spark, filters.sampling_window(F.lit(13.0), 100.0))) == (14, 24) and tuple(one(spark, filters.sampling_window(F.lit(30.0), 100.0))) == (16, 26)
    share = lambda a, b: one(spark, filters.bad_share(F.lit(a), F.lit(b)))
    assert [share(1, 4), share(1, 3), share(0, 5), share(1, 0), share(1, 800)] == ["25.0%", "33.33%", "0.0%", "", "0.12%"]


def test_ends_parts_and_validity(spark):
    schema = "kind string, parts array<array<struct<x:double,y:double>>>"
    cross = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    rings = {"square": square, "cross": cross, "open": square[:-1], "flat": [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (0.0, 0.0)], "repeat": [square[0], *square], "touch": [*square[:3], (0.0, 2.0), (1.0, 0.0), (0.0, 0.0)], "spike": [*square[:2], (3.0, 0.0), (2.0, 0.0), *square[2:]], "short": square[:2], "back": [(0.0, 0.0), (2.0, 0.0), (1.0, 0.0), (2.0, 2.0), (0.0, 0.0)], "concave": [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]}
    df = spark.createDataFrame([(k, [r]) for k, r in rings.items()], schema)
    got = {r.kind: r.v for r in df.select("kind", G.ring_is_valid(F.col("parts")[0]).alias("v")).collect()}
    assert {k for k, v in got.items() if v} == {"square", "repeat", "concave"}
    g = spark.createDataFrame([("MultiLineString", [square, square[:1], cross]), ("polygon", [square]), ("line", [])], schema)
    assert [len(r[0]) for r in g.select(G.line_parts(F.struct("kind", "parts"))).collect()] == [2, 0, 0]
    p = F.get("parts", F.lit(0))
    e = g.select(G.endpoints(p).alias("e"), G.is_endpoint(p, F.lit(0.0), F.lit(1e-9)).alias("a"), G.is_endpoint(p, F.lit(2.0), F.lit(2.0)).alias("b")).first()
    assert [tuple(v) for v in e.e] == [(0, 0), (0, 0)] and e.a and not e.b
