"""Pairing records of two tables by nearest time within a tolerance.

Both sides are cut into time buckets per entity, the right side also into the neighbouring bucket where it lies within
the tolerance of a border, and hashed into Arrow groups of bounded size. In each group DuckDB runs a backward and a
forward ASOF join and the nearer candidate within the tolerance is kept.

Before that, the right side keeps one row per (entity, time) and the left side one probe per (entity, time), both
with map-side aggregation: an entity that holds a third of all rows spreads over its time buckets, and copies never
meet in one group.

Defined results: rows with a null entity or time match nothing; of right rows with equal entity and time the smallest
id is taken; of a backward and a forward candidate equally near, the backward one; repeated left rows give one pair.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PAIR = "entity string, left_at bigint, right_id bigint, right_at bigint"
_ARROW = pa.schema([("entity", pa.string()), ("left_at", pa.int64()), ("right_id", pa.int64()), ("right_at", pa.int64())])


def epoch_micros(text: Column) -> Column:
    """Microseconds of an epoch time in seconds, milli-, micro- or nanoseconds, told apart by magnitude; null if unusable."""
    number = F.when(F.trim(text).rlike(r"^\d{9,20}(\.\d{1,9})?$"), F.trim(text)).try_cast("decimal(38,9)")
    scaled = F.when(number < 10**11, number * 1000000).when(number < 10**14, number * 1000).when(number < 10**17, number).otherwise(number / 1000)
    return F.when(number >= 10**8, F.round(scaled, 0).try_cast("bigint"))


def _nearest(tolerance: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _ARROW.empty_table()
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        try:
            con.register("l", left)
            con.register("r", right)
            found = con.sql(f"""
                WITH b AS (SELECT l.entity, l.left_at, r.right_id, r.right_at FROM l ASOF JOIN r ON l.entity = r.entity AND l.bucket = r.bucket AND l.left_at >= r.right_at),
                     f AS (SELECT l.entity, l.left_at, r.right_id, r.right_at FROM l ASOF JOIN r ON l.entity = r.entity AND l.bucket = r.bucket AND l.left_at <= r.right_at),
                     u AS (SELECT *, 0 AS side FROM b UNION ALL SELECT *, 1 FROM f)
                SELECT entity, left_at, arg_min(right_id, (abs(left_at - right_at), side)) AS right_id, arg_min(right_at, (abs(left_at - right_at), side)) AS right_at
                FROM u WHERE abs(left_at - right_at) <= {tolerance} GROUP BY entity, left_at""").to_arrow_table()
            return found.cast(_ARROW)
        finally:
            con.close()

    return run


def nearest_time(left: DataFrame, right: DataFrame, left_id: str, right_id: str, entity: str, at: str, tolerance: int, bucket: int, rows_per_group: int = 200_000) -> DataFrame:
    """left_id, right_id, left_at, right_at of the pairs. at and tolerance are integers in one unit; bucket is the width of a time bucket, well over the tolerance."""
    lefts = left.select(F.col(left_id).alias("left_id"), F.col(entity).alias("entity"), F.col(at).cast("bigint").alias("left_at")).where("entity IS NOT NULL AND left_at IS NOT NULL")
    rights = right.select(F.col(right_id).alias("right_id"), F.col(entity).alias("entity"), F.col(at).cast("bigint").alias("right_at")).where("entity IS NOT NULL AND right_at IS NOT NULL")
    groups = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((left.count() + right.count()) / rows_per_group))
    slot = F.pmod(F.xxhash64("entity", "bucket"), F.lit(groups)).cast("int").alias("slot")
    probes = lefts.select("entity", "left_at").distinct().withColumn("bucket", F.floor(F.col("left_at") / bucket)).select(slot, "entity", "bucket", "left_at")
    near = F.array_distinct(F.array(F.floor((F.col("right_at") - tolerance) / bucket), F.floor((F.col("right_at") + tolerance) / bucket)))
    targets = rights.groupBy("entity", "right_at").agg(F.min("right_id").alias("right_id")).withColumn("bucket", F.explode(near)).select(slot, "entity", "bucket", "right_at", "right_id")
    pairs = probes.groupBy("slot").cogroup(targets.groupBy("slot")).applyInArrow(_nearest(tolerance), _PAIR)
    return lefts.distinct().join(pairs, ["entity", "left_at"]).select("left_id", "right_id", "left_at", "right_at")
