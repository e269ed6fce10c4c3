import random

from pyspark.sql import functions as F

from cairnflow.operators import patches as P

SCHEMA = "k int, tv bigint, v bigint, change_id bigint, gone boolean, op string, a int, b string, deleted string"


def state(spark, rows, base=None, partial=None, image=("a", "b")):
    df = spark.createDataFrame(rows, SCHEMA)
    got = P.compose(df, ["k"], ["tv", "v"], ["change_id"], P.says_delete(F.col("gone"), F.col("op")), list(image), partial=partial)
    return sorted((r.k if r.k is not None else -1, r.a, r.b) for r in P.apply_patches(base, got, ["k"], list(image)).collect())


def test_order_not_arrival(spark):
    rows = [(1, 2, 1, 1, False, None, 20, "x", ""), (1, None, 9, 2, False, None, 10, "y", ""), (1, 2, 0, 3, True, None, None, None, ""), (2, 1, 1, 4, None, " Del ", 1, "z", ""), (2, 0, 5, 5, False, "I", 2, "q", ""), (None, 0, 0, 6, None, None, None, None, "")]
    assert state(spark, rows) == [(-1, None, None), (1, 20, "x")]


def test_full_images_set_nulls_and_base_stays(spark):
    base = spark.createDataFrame([(1, 5, "old"), (9, 6, "kept"), (3, 1, "gone")], "k int, a int, b string")
    rows = [(1, 1, 1, 1, False, None, None, None, ""), (3, 1, 1, 2, True, None, None, None, "")]
    assert state(spark, rows, base) == [(1, None, None), (9, 6, "kept")]


def test_against_a_fold(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(8), rng.choice([None, 0, 1, 17, 40]), rng.randrange(6), i, rng.random() < 0.2, None, rng.choice([None, 1, 2, 3]), rng.choice([None, "p", "q"]), "") for i in range(400)]
    rows += rng.sample(rows, 50)
    want = {}
    for r in sorted(rows, key=lambda r: (r[1] or 0, r[2], r[3])):
        want[r[0]] = None if r[4] else (r[6], r[7])
    assert state(spark, rows) == sorted((k, *v) for k, v in want.items() if v)
    want = {}
    for r in sorted(rows, key=lambda r: (r[1] or 0, r[2], r[3])):
        old = want.get(r[0]) or (None, None)
        full = r[2] % 2 == 0
        want[r[0]] = None if r[4] else (r[6], r[7]) if full else tuple(n if n is not None else o for n, o in zip((r[6], r[7]), old))
    assert state(spark, rows, partial=F.col("v") % 2 == 1) == sorted((k, *v) for k, v in want.items() if v)


def test_empty(spark):
    assert state(spark, []) == []


def test_partial_changes_keep_the_base(spark):
    base = spark.createDataFrame([(1, 5, "old"), (2, 6, "gone"), (3, None, "null"), (9, 7, "kept"), (None, 8, "no key")], "k int, a int, b string")
    rows = [(1, 1, 1, 1, False, None, 7, None, ""), (2, 1, 1, 2, True, None, None, None, ""), (2, 1, 3, 3, False, None, 1, None, ""), (3, 1, 1, 4, False, None, None, "new", ""), (4, 1, 1, 5, False, None, 4, None, ""), (None, 1, 1, 6, False, None, None, "x", "")]
    assert state(spark, rows, base, F.col("v") % 2 == 1) == [(-1, 8, "x"), (1, 7, "old"), (2, 1, None), (3, None, "new"), (4, 4, None), (9, 7, "kept")]


def test_partial_and_base_against_a_fold(spark):
    rng = random.Random(6)
    pick = lambda: (rng.choice([None, 1, 2, 3]), rng.choice([None, "p", "q"]))
    old = {k: pick() for k in range(6)}
    rows = [(rng.randrange(10), rng.choice([None, 0, 1, 17, 40]), rng.randrange(6), i, rng.random() < 0.1, None, *pick(), "") for i in range(60)]
    want = dict(old)
    for r in sorted(rows, key=lambda r: (r[1] or 0, r[2], r[3])):
        was = want.get(r[0]) or (None, None)
        want[r[0]] = None if r[4] else (r[6], r[7]) if r[2] % 3 == 0 else tuple(n if n is not None else o for n, o in zip((r[6], r[7]), was))
    base = spark.createDataFrame([(k, *v) for k, v in old.items()], "k int, a int, b string")
    assert state(spark, rows, base, F.col("v") % 3 != 0) == sorted((k, *v) for k, v in want.items() if v)
