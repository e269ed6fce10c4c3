"""Consolidating very many small files into few well-sized ones, without losing or repeating a record.

The engine's own split packing does the reading: the maximum partition bytes and the cost of opening a file are set so
that one task reads many files as one combined split. Rows are coalesced without a shuffle and written to a staging folder;
the write itself observes their count and an order-free checksum, so the source is read once. The staged output is
read back against both and only then moved to its place.

Defined results: a path that is null or blank is missing and equals only a missing one; ``..`` above the root is
dropped; unknown or negative sizes count as the overhead alone; an entry repeated under its own key is one entry.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cairnflow.session import delete_path, rename_path, shared_dir


def canonical_path(path: Column, root: Column, folder: Column) -> Column:
    """The one spelling of a file's path; relative paths start in root/folder."""
    text = F.regexp_replace(path, r"^[\s 　﻿]+|[\s 　﻿]+$", "")
    text = F.regexp_replace(text, r"(?i)^file:(//(localhost)?)?(?=/)", "")
    text = F.regexp_replace(text, r"(?i)^file:/*", "")
    clean = lambda c: F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"(?i)^file:(//(localhost)?)?(?=/)", ""), "(?i)^file:/*", "")
    whole = F.when(text.startswith("/"), text).otherwise(F.concat_ws("/", clean(root), clean(folder), text))
    steps = F.filter(F.split(whole, "/+"), lambda s: ~s.isin("", "."))
    no_steps = F.array().cast("array<string>")
    kept = F.aggregate(steps, no_steps, lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(s))))
    # Most paths hold no ".." and need no fold.
    return F.when(F.length(text) > 0, F.concat(F.lit("/"), F.array_join(F.when(whole.contains(".."), kept).otherwise(steps), "/")))


@contextmanager
def split_packing(spark: SparkSession, max_bytes: int, open_cost: int):
    """Reads that run inside use these packing limits, as split sizes are taken when a scan runs; the former settings come back afterwards."""
    keys = {"spark.sql.files.maxPartitionBytes": str(max_bytes), "spark.sql.files.openCostInBytes": str(open_cost), "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checksum(df: DataFrame, columns: list[str]) -> tuple[int, int]:
    """Rows and an order-free checksum: the sum of row hashes, folded into 10^9+7 so that it can't overflow."""
    hashed = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(1_000_000_007))
    n, s = df.agg(F.count("*"), F.sum(hashed)).first()
    return int(n), int(s or 0)


def publish(df: DataFrame, target: str, expected: tuple[int, int], measure: Callable[[DataFrame], tuple[int, int]]) -> DataFrame:
    """Write to a staging folder beside target, verify, move into place. Raises and removes the staging if it differs."""
    staging = _staged(df, target)
    return _into_place(df.sparkSession, staging, target, expected, measure)


def publish_observed(df: DataFrame, target: str, columns: list[str], also: Callable[[tuple[int, int]], None] | None = None) -> DataFrame:
    """publish() against what the write itself saw of df: one read of the source. also: a further check of (rows, checksum)."""
    seen = Observation()
    hashed = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(1_000_000_007))
    staging = _staged(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("s")), target)
    expected = (int(seen.get["n"]), int(seen.get["s"] or 0))
    if also:
        try:
            also(expected)
        except ValueError:
            delete_path(df.sparkSession, staging)
            raise
    return _into_place(df.sparkSession, staging, target, expected, lambda staged: checksum(staged, columns))


def _staged(df: DataFrame, target: str) -> str:
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    df.write.parquet(staging)
    return staging


def _into_place(spark: SparkSession, staging: str, target: str, expected: tuple[int, int], measure: Callable[[DataFrame], tuple[int, int]]) -> DataFrame:
    found = measure(spark.read.parquet(staging))
    if found != expected:
        delete_path(spark, staging)
        raise ValueError(f"staged output holds {found} (rows, checksum), the source {expected}")
    if not rename_path(spark, staging, target):
        delete_path(spark, staging)
        raise ValueError(f"{target} can't be put into place")
    return spark.read.parquet(target)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _visible_files(spark: SparkSession, source: str, pattern: str) -> Iterator[tuple[str, int]]:
    """Path and length of the files the engine would read, one at a time from the file system's own iterator."""
    jvm, root, fs = _file_system(spark, source)
    root = fs.getFileStatus(root).getPath()
    accepted = jvm.org.apache.hadoop.fs.GlobFilter(pattern)
    above = root.toString().rstrip("/") + "/"
    listing = fs.listFiles(root, True)
    while listing.hasNext():
        status = listing.next()
        path = status.getPath()
        steps = path.toString().removeprefix(above).split("/")
        hidden = any(s.startswith(".") or s.startswith("_") and "=" not in s or s.endswith("._COPYING_") for s in steps)
        if not hidden and accepted.accept(path):
            yield path.toString(), status.getLen()


def consolidate_files(spark: SparkSession, source: str, target: str, max_bytes: int = 128 << 20, open_cost: int = 4 << 20, pattern: str = "*") -> DataFrame:
    """Pack the files under source, whole, into rows (path, length, content) of few parquet files at target.

    The engine leaves empty files out of its splits. Where fewer files were read than the file system counts, its
    listing is walked for them; they come as rows of length 0.
    """
    columns = ["path", "content"]
    with split_packing(spark, max_bytes, open_cost):
        _, root, fs = _file_system(spark, source)
        summary = fs.getContentSummary(root)
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(source).select("path", "length", "content")
        few = max(1, min(files.rdd.getNumPartitions(), math.ceil(summary.getLength() / max_bytes)))
        empty: list[str] = []

        def whole(seen: tuple[int, int]) -> None:
            if seen[0] == summary.getFileCount():
                return
            n = 0
            for path, length in _visible_files(spark, source, pattern):
                n += 1
                if not length:
                    empty.append(path)
            if seen[0] + len(empty) != n:
                raise ValueError(f"{n} files are listed, {seen[0]} and {len(empty)} empty ones were read")

        packed = publish_observed(files.coalesce(few), target, columns, whole)
        if not empty:
            return packed
        rest = spark.createDataFrame([(p,) for p in empty], "path string").select("path", F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("content"))
        rest.coalesce(1).write.mode("append").parquet(target)
        return spark.read.parquet(target)


def consolidate_table(spark: SparkSession, source: str, target: str, fmt: str = "parquet", max_bytes: int = 128 << 20, open_cost: int = 4 << 20) -> DataFrame:
    """Rewrite a table of many small files as few well-sized ones; every row exactly as often as before."""
    with split_packing(spark, max_bytes, open_cost):
        rows = spark.read.format(fmt).load(source)
        return publish_observed(rows.coalesce(max(1, rows.rdd.getNumPartitions())), target, rows.columns)


def _next_fit(max_bytes: int, overhead: int):
    """The engine's packing rule on a split's listing: fill a container until the next file would exceed it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seq, used = 0, 0
        for batch in batches:
            containers = []
            for size in batch.column("bytes").to_pylist():
                need = max(size or 0, 0) + overhead
                if used and used + need > max_bytes:
                    seq, used = seq + 1, 0
                used += need
                containers.append(part * (1 << 32) + seq)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(containers, pa.int64())], names=[*batch.schema.names, "container"])

    return run


def plan_containers(pairs: DataFrame, max_bytes: int, overhead: int) -> DataFrame:
    """Add ``container`` to a listing with ``bytes``; each partition is packed where it lies, without a shuffle."""
    fields = ", ".join(f"`{n}` {t}" for n, t in pairs.dtypes)
    return pairs.mapInArrow(_next_fit(max_bytes, overhead), f"{fields}, container bigint")


def consolidate_listing(
    spark: SparkSession, path: str, entry: str, root: str, folder: str, files: list[str], sizes: list[str], max_bytes: int = 128 << 20, overhead: int = 4 << 10, read_bytes: int = 64 << 20, open_cost: int = 4 << 20
) -> tuple[DataFrame, DataFrame]:
    """Plan the consolidation of the file pairs a listing names: (kept, entries).

    kept: entry and canonical paths of each distinct pair once, under its smallest entry, with bytes and container, as
    a staged and verified table. entries: entry and canonical paths of all rows of the listing, read when it is used.
    """
    # read_bytes and open_cost pack the listing's own files into splits; max_bytes and overhead (a record's frame) the containers.
    with split_packing(spark, read_bytes, open_cost):
        listing = spark.read.parquet(path)
        parts = listing.rdd.getNumPartitions()
        names = [f"file_{i}" for i in range(len(files))]
        total = sum((F.greatest(F.coalesce(F.col(s), F.lit(0)), F.lit(0)) for s in sizes[1:]), F.greatest(F.coalesce(F.col(sizes[0]), F.lit(0)), F.lit(0)))
        entries = listing.select(F.col(entry).alias("entry_id"), *[canonical_path(F.col(f), F.col(root), F.col(folder)).alias(n) for f, n in zip(files, names)], total.cast("bigint").alias("bytes"))
        # Each kept pair carries how many entries it stands for and the sum of their hashes: together they must be the listing.
        token = F.pmod(F.xxhash64("entry_id"), F.lit(1_000_000_007))
        pairs = entries.groupBy(*names).agg(F.min("entry_id").alias("entry_id"), F.max("bytes").alias("bytes"), F.count("*").alias("n_entries"), F.sum(token).alias("entry_hash"))
        expected = checksum(listing.select(F.col(entry).alias("entry_id")), ["entry_id"])

        def measure(staged: DataFrame) -> tuple[int, int]:
            n, s = staged.agg(F.coalesce(F.sum("n_entries"), F.lit(0)), F.coalesce(F.sum("entry_hash"), F.lit(0))).first()
            return int(n), int(s)

        columns = pairs.select("entry_id", *names, "bytes", "n_entries", "entry_hash").coalesce(max(1, parts))
        kept = publish(plan_containers(columns, max_bytes, overhead), f"{shared_dir(spark)}/listing-{uuid.uuid4().hex}", expected, measure)
        return kept.drop("entry_hash"), entries.drop("bytes")
