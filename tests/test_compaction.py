import posixpath

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnflow.operators import compaction as C
from cairnflow.plans import pipeline
from pyspark.sql import functions as F


def canonical(spark, rows):
    df = spark.createDataFrame(rows, "p string, r string, f string")
    return [r[0] for r in df.select(C.canonical_path(F.col("p"), F.col("r"), F.col("f"))).collect()]


def test_spellings(spark):
    same = ["/data/t/9/a/x.pcd", "a/x.pcd", "./a/x.pcd", " /data//t/./9/a/x.pcd  ", "file:///data/t/9/a/x.pcd", "../9/a/x.pcd", "/data/t/9/a/old/../x.pcd", "FILE://localhost/data/t/9/a/x.pcd", "//data/t/9/a//x.pcd"]
    assert set(canonical(spark, [(p, "/data/t/", "9") for p in same])) == {"/data/t/9/a/x.pcd"}
    assert canonical(spark, [(None, "/d", "1"), ("  ", "/d", "1"), ("/../../x", "/d", "1"), ("x", None, None)]) == [None, None, "/x", "/x"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", ".", "..", ""]), min_size=1, max_size=7), min_size=20, max_size=40))
def test_absolute_paths_as_posix(spark, parts):
    paths = ["/" + "/".join(p) for p in parts]
    want = ["/" + posixpath.normpath(p).lstrip("/") for p in paths]
    assert canonical(spark, [(p, "/r", "f") for p in paths]) == want


def brute(rows):
    def one(p, root, trail):
        if p is None or not p.strip():
            return None
        p = p.strip().removeprefix("file://")
        return "/" + posixpath.normpath(p if p.startswith("/") else f"{root}/{trail}/{p}").lstrip("/")

    first, out = {}, set()
    for r in sorted(rows, key=lambda r: r.entry_id):
        k = one(r.cloud_path, r.root_dir, r.trail_id), one(r.bev_json_path, r.root_dir, r.trail_id)
        if first.setdefault(k, r.entry_id) != r.entry_id:
            out.add(r.entry_id)
    return out


def test_repeated_entries(spark, small):
    want = brute(pipeline.table(spark, small, "flat_mapping_info").collect())
    got = [r[0] for r in pipeline.p3_found(spark, small).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want


def test_listing_of_odd_rows(spark, tmp_path):
    rows = [(1, "t", "/r", "a", 5, "b", None), (1, "t", "/r", "a", 5, "b", None), (2, "t", "/r", "./a", None, "b", -3), (3, "t", "/r", "a", 5, None, None), (4, "t", "/r", "a", 5, " ", None), (None, None, None, None, None, None, None)]
    spark.createDataFrame(rows, "entry_id bigint, trail_id string, root_dir string, cloud_path string, cloud_bytes bigint, bev_json_path string, bev_bytes bigint").write.parquet(str(tmp_path / "flat_mapping_info.parquet"))
    assert sorted(r[0] for r in pipeline.p3_found(spark, str(tmp_path)).collect()) == [2, 4]


def test_containers_hold_their_share(spark):
    df = spark.range(500).select(F.col("id").alias("entry_id"), (F.col("id") % 7 * 10).alias("bytes")).coalesce(2)
    rows = C.plan_containers(df, 100, 1).groupBy("container").agg(F.sum(F.col("bytes") + 1).alias("n"), F.count("*").alias("k")).collect()
    assert max(r.n for r in rows) <= 100
    assert sum(r.k for r in rows) == 500


def test_files_become_few_and_whole(spark, tmp_path):
    source = tmp_path / "many"
    source.mkdir()
    for i in range(60):
        (source / f"{i}.bin").write_bytes(bytes([i]) * i)
    out = C.consolidate_files(spark, str(source), str(tmp_path / "few"), max_bytes=1 << 20, open_cost=1 << 10)
    (source / "a b+c.bin").touch()
    out = C.consolidate_files(spark, str(source), str(tmp_path / "more"))
    assert out.where("path LIKE '%a b+c.bin' AND length = 0").count() == 1
    out = spark.read.parquet(str(tmp_path / "few"))
    assert {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in out.collect()} == {f"{i}.bin": bytes([i]) * i for i in range(60)}
    assert len(list((tmp_path / "few").glob("*.parquet"))) <= 2


def test_table_keeps_every_row(spark, tmp_path):
    spark.range(1000).selectExpr("id % 10 AS a", "cast(null AS string) AS b").repartition(40).write.parquet(str(tmp_path / "t"))
    out = C.consolidate_table(spark, str(tmp_path / "t"), str(tmp_path / "u"))
    assert out.groupBy("a").count().where("count = 100").count() == 10
    assert len(list((tmp_path / "u").glob("*.parquet"))) < 10


def test_a_loss_is_noticed(spark, tmp_path):
    df = spark.range(10)
    with pytest.raises(ValueError):
        C.publish(df.limit(9), str(tmp_path / "x"), C.checksum(df, ["id"]), lambda d: C.checksum(d, ["id"]))
    assert list(tmp_path.iterdir()) == []


def tasks_of_stages(spark, group, run):
    """The tasks of each stage that run() starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return [i.numTasks for s in stages if (i := tracker.getStageInfo(s))]


def test_reads_are_packed_when_they_run(spark, tmp_path):
    """Files that the session would read in many splits are read in one, and the kept listing is one file."""
    path = str(tmp_path / "flat_mapping_info.parquet")
    rows = spark.range(48).selectExpr("id AS entry_id", "'t' AS trail_id", "'/r' AS root_dir", "concat('a', id div 2) AS cloud_path", "id AS cloud_bytes", "'b' AS bev_json_path", "1L AS bev_bytes")
    rows.repartition(12).write.parquet(path)
    many = {"spark.sql.files.maxPartitionBytes": "4m", "spark.sql.files.openCostInBytes": "4m"}
    before = {k: spark.conf.get(k) for k in many}
    for k, v in many.items():
        spark.conf.set(k, v)
    try:
        assert spark.read.parquet(path).rdd.getNumPartitions() == 12
        assert max(tasks_of_stages(spark, "table", lambda: C.consolidate_table(spark, path, str(tmp_path / "table")))) < 12
        out = []
        assert max(tasks_of_stages(spark, "listing", lambda: out.append(pipeline._listing(spark, str(tmp_path))[0]))) < 12
        assert len(out[0].inputFiles()) == 1 and out[0].count() == 24
        assert max(tasks_of_stages(spark, "found", lambda: out.append(pipeline.p3_found(spark, str(tmp_path)).count()))) < 12 and out[1] == 24
        assert all(spark.conf.get(k) == v for k, v in many.items())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_files_are_found_and_hidden_ones_left(spark, tmp_path):
    source = tmp_path / "in"
    (source / "deep" / "_tmp").mkdir(parents=True)
    for name in ("a.bin", "b.bin", ".hidden", "deep/c.bin", "deep/_tmp/d.bin", "e.txt"):
        (source / name).write_bytes(b"x" if name != "b.bin" else b"")
    out = C.consolidate_files(spark, str(source), str(tmp_path / "out"), pattern="*.bin")
    assert sorted((r.path.split("/in/")[1], r.length) for r in out.collect()) == [("a.bin", 1), ("b.bin", 0), ("deep/c.bin", 1)]
    (tmp_path / "none").mkdir()
    assert C.consolidate_files(spark, str(tmp_path / "none"), str(tmp_path / "nothing")).count() == 0


def test_no_stage_has_a_task_per_file(spark, tmp_path):
    spark.range(1000).repartition(30).write.parquet(str(tmp_path / "t"))
    ran = tasks_of_stages(spark, "once", lambda: C.consolidate_table(spark, str(tmp_path / "t"), str(tmp_path / "u"), max_bytes=1 << 20, open_cost=1 << 10))
    assert ran and max(ran) == 1
