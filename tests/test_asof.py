import random

from pyspark.sql import functions as F

from cairnflow.operators import asof


def test_times(spark):
    rows = [("1740963684.833", 1740963684833000), ("1740963684833", 1740963684833000), ("1740963684833.25", 1740963684833250), ("1740963684833123", 1740963684833123), ("1740963684833123456", 1740963684833123), ("0", None), ("nan", None), ("", None), (None, None), ("1e9", None), ("5", None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "t string")
    assert [r[0] for r in df.select(asof.epoch_micros(F.col("t"))).collect()] == [b for _, b in rows]


def pairs(spark, left, right, tolerance=30, bucket=100):
    a = spark.createDataFrame(left, "pid bigint, who string, t bigint, right_id string, slot string")
    b = spark.createDataFrame(right, "fid bigint, who string, t bigint, entity string")
    return sorted((r.left_id, r.right_id) for r in asof.nearest_time(a, b, "pid", "fid", "who", "t", tolerance, bucket).collect())


def test_against_all_pairs(spark):
    rng = random.Random(3)
    left = [(i, rng.choice("abh"), rng.randrange(5000), "", "") for i in range(300)]
    right = [(i, rng.choice("abh"), rng.randrange(5000), "") for i in range(600)]
    want = []
    for i, w, t, *_ in left:
        near = sorted((abs(t - u), u > t, j) for j, v, u, _ in right if v == w and abs(t - u) <= 30)
        if near:
            want.append((i, near[0][2]))
    assert pairs(spark, left + left[:20], right + right[:50]) == sorted(want)


def test_edges_and_nulls(spark):
    left = [(1, "a", 100, "", ""), (2, "a", None, "", ""), (3, None, 100, "", ""), (4, "a", -1, "", ""), (5, "a", 131, "", "")]
    right = [(1, "a", 130, ""), (2, "a", 99, ""), (3, None, 100, ""), (4, "a", None, ""), (9, "a", 99, "")]
    assert pairs(spark, left, right) == [(1, 2), (5, 1)]
    assert pairs(spark, [], right) == [] == pairs(spark, left, [])


def test_poses_in_every_unit_are_paired(spark, tmp_path):
    """One moment as milliseconds, with decimals, seconds and microseconds; and 999.5 and 1000 ms away."""
    from cairnflow.plans import spatial

    stamp = 1_741_082_689_879
    texts = ["1741082689871_1", "1741082689871.000_1", "1741082689.871_1", "1741082689871000_1", "1741082688879.5_1", "1741082688.879_1", "nan_1", None]
    spark.createDataFrame([(i, f" t{i} ", s) for i, s in enumerate(texts)], "pose_id bigint, trail_id string, frame_id_str string").write.parquet(f"{tmp_path}/key_poses.parquet")
    spark.createDataFrame([(10 + i, f"t{i}", stamp) for i in range(len(texts))], "frame_no bigint, trail_id string, stamp_ms bigint").write.parquet(f"{tmp_path}/frames.parquet")
    nearest = sorted(map(tuple, spatial.QUERIES["j14_nearest_pose_any_unit"](spark, str(tmp_path)).collect()))
    assert nearest == [(10 + i, i) for i in range(5)]
    exact = sorted(map(tuple, spatial.QUERIES["j15_exact_time_any_unit"](spark, str(tmp_path)).collect()))
    assert exact == [(i, 10 + i) for i in range(4)]
