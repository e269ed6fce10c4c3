import numpy as np

from cairnflow.operators import spikes
from cairnflow.plans.pipeline import POSITION_BOUNDS, SPIKE


def flagged(spark, rows, block=20_000):
    df = spark.createDataFrame(rows, "id bigint, source string, t bigint, v array<double>, block string")
    return {r.id: (r.impossible, r.spike, r.stuck) for r in spikes.implausible(df, "source", "t", "id", "v", POSITION_BOUNDS, block, SPIKE).collect()}


def trail(n=400, noise=0.05, seed=1, name="a", first=0):
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.integers(80, 120, n))
    x = np.stack((t * 0.01, 50 * np.sin(t / 9000), np.full(n, 20.0)), axis=1) + rng.normal(0, noise, (n, 3))
    return [[first + i, name, int(t[i]), x[i].tolist(), "clash"] for i in range(n)]


def test_spikes_runs_and_blocks(spark):
    rows = trail()
    for i in (50, 120, 121, 122, 199, 200, 201):
        rows[i][3][0] += 30
    for i in range(300, 306):
        rows[i][3][1] -= 30
    want = {50, 120, 121, 122, 199, 200, 201}
    assert {k for k, v in flagged(spark, rows).items() if v[1]} == want
    # The same with tiny blocks: nothing depends on where a block ends.
    assert {k for k, v in flagged(spark, rows, block=1_000).items() if v[1]} == want


def test_noise_is_the_trail_s_own(spark):
    quiet, loud = trail(noise=0.02), trail(noise=1.0, name="b", first=1000)
    for rows in (quiet, loud):
        rows[100][3][0] += 4
    assert {k for k, v in flagged(spark, quiet + loud).items() if v[1]} == {100}


def test_steps_and_pauses_are_no_spikes(spark):
    rows = trail(seed=4)
    for r in rows[150:]:
        r[3][0] += 40
    for r in rows[250:]:
        r[2] += 200_000
    assert not any(v[1] for v in flagged(spark, rows).values())


def test_stuck_across_blocks_and_impossible(spark):
    rows = trail(seed=2)
    for i in range(60, 66):
        rows[i][3][2] = 7.25
    for i in range(200, 205):
        rows[i][3][2] = 7.5
    rows[10][3][0], rows[11][3][1], rows[12][3][2] = float("nan"), float("-inf"), 1e7
    for block in (2_000, 100_000):
        got = flagged(spark, rows, block)
        assert {k for k, v in got.items() if v[2]} == set(range(60, 66))
        assert {k for k, v in got.items() if v[0]} == {10, 11, 12}


def test_odd_rows(spark):
    rows = [(1, None, 1, [1.0, 2.0, 3.0], ""), (2, "a", None, [1.0, 2.0, 3.0], ""), (3, "a", 1, None, ""), (4, "a", 1, [1.0, None, 2.0], ""), (5, "a", 1, [1.0], ""), (6, "a", 1, [], ""), (7, "a", 1, [1.0, 2.0, 3.0], "")]
    assert flagged(spark, rows * 8) == {}
    assert flagged(spark, []) == {}


def rates(spark, rows, **how):
    df = spark.createDataFrame(rows, "id bigint, source string, at bigint, bad int, total int, block string")
    got = spikes.implausible_rates(df, "source", "at", "id", "bad", "total", 5.0, block=how.pop("block", 7), **how)
    return {r.id: (r.impossible, r.spike, r.stuck) for r in got.collect()}


def test_rates(spark):
    rows = [(i, "v", i, 10 + i % 3, 1000, "") for i in range(30)] + [(100, "v", 30, 60, 1000, ""), (101, "v", 31, -1, 1000, ""), (102, "v", 32, 1001, 1000, ""), (103, "v", 33, None, 5, "")]
    rows += [(104, None, 1, 3, 0, ""), (105, "w", 1, 0, 9, ""), (106, "v", 34, 40, 1000, ""), (107, "v", None, 70, 1000, ""), (108, None, None, 5, 9, "")]
    rows += [(200 + i, "x", i, 4, 100 + i, "") for i in range(6)] + [(300 + i, "y", i, 4, None, "") for i in range(5)]
    for block in (3, 1000):
        assert rates(spark, rows + rows[:3], block=block) == {100: (False, True, False), 101: (True, False, False), 102: (True, False, False), 104: (True, False, False), 107: (False, True, False), **{200 + i: (False, False, True) for i in range(6)}}
    assert rates(spark, []) == {}


def test_the_hampel_rule_decides_on_rates(spark):
    """A rate five times the usual one amid others as high is no outlier of its neighbourhood; alone it is one."""
    rows = [(i, "v", i, 10 + i % 2, 1000, "") for i in range(60)] + [(100 + i, "v", 1000 + i, 60 + i % 2, 1000, "") for i in range(40)]
    assert not any(v[1] for k, v in rates(spark, rows, block=10_000).items() if k >= 111)
    rows = [(i, "v", i, 10 + i % 2, 1000, "") for i in range(60)] + [(100, "v", 30, 60, 1000, "")]
    assert {k for k, v in rates(spark, rows).items() if v[1]} == {100}


def test_sparse_blocks_reach_across_stretches(spark):
    """One reading a block and pauses of many stretches: the halo comes from wherever the neighbours are."""
    rows = trail(seed=6)
    for i in range(100, 106):
        rows[i][3][0] = 5.5
    for k, r in enumerate(rows[103:]):
        r[2] += 10**9
    for r in rows[200:]:
        r[2] += 10**12
    for i in range(197, 203):
        rows[i][3][1] = -7.5
    assert {k for k, v in flagged(spark, rows, 1_000).items() if v[2]} == {*range(100, 106), *range(197, 203)}


def test_rolling_median():
    x = np.random.default_rng(3).normal(size=50)
    for half in (2, 10, 30):
        assert np.allclose(spikes.rolling_median(x, half), [np.median(x[max(0, i - half) : i + half + 1]) for i in range(50)])
    assert len(spikes.rolling_median(x[:0], 2)) == 0


def test_histogram_median():
    values = np.abs(np.random.default_rng(1).normal(0, 3, 5000))
    assert abs(spikes.histogram_median(spikes._bin(values)) / np.median(values) - 1) < 0.1
