"""Writing results: layers, reports, exports and keyed tables that are replaced as a whole."""

from __future__ import annotations

import shutil
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.session import delete_path, rename_path


def write_layers(layers: dict[str, DataFrame], target: str) -> dict[str, str]:
    """All layers into one table partitioned by layer; a layer that fails is reported and the others are written."""
    errors: dict[str, str] = {}
    mode = "overwrite"
    for name, df in layers.items():
        try:
            df.withColumn("layer", F.lit(name)).write.mode(mode).partitionBy("layer").parquet(target)
            mode = "append"
        except Exception as e:  # noqa: BLE001 - the error belongs to this layer alone
            errors[name] = str(e).splitlines()[0]
    return errors


def write_summary(df: DataFrame, target: str, headers: dict[str, str], order: str) -> None:
    """A report of few rows as one CSV file with a byte order mark, a row index and translated headers."""
    rows = df.orderBy(order).select(*headers).limit(1_000_001).collect()
    if len(rows) > 1_000_000:
        raise ValueError("a summary has at most 1,000,000 rows")
    quote = lambda v: "" if v is None else f'"{str(v).replace(chr(34), chr(34) * 2)}"' if any(c in str(v) for c in ',"\n') else str(v)
    lines = [",".join(["", *map(quote, headers.values())]), *(",".join([str(i), *map(quote, r)]) for i, r in enumerate(rows))]
    Path(target).write_text("\n".join(lines) + "\n", encoding="utf-8-sig")


def write_documents(df: DataFrame, target: str) -> None:
    """Each row as one JSON document per line, nulls included."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(target)


def wide_results(df: DataFrame, batch: str, kind: str, values: list[str], kinds: list[str]) -> DataFrame:
    """One row per batch with a column per kind of evaluation and value; the kinds are given, so no pass looks for them."""
    return df.groupBy(batch).pivot(kind, kinds).agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])


def archive(folder: str, keep: str = "output.json") -> str:
    """Move all but one file of a folder into its subfolder 'archive'; returns that."""
    root = Path(folder)
    target = root / "archive"
    target.mkdir(exist_ok=True)
    for p in sorted(root.iterdir()):
        if p.name not in (keep, "archive"):
            shutil.move(str(p), str(target / p.name))
    return str(target)


def obj_text(points: DataFrame, line: str = "line", order: str = "seq") -> DataFrame:
    """line, value: an OBJ text per line of at least two points, with vertex numbers from 1."""
    fixed = lambda c: F.format_string("%.3f", F.col(c))
    vertex = F.concat_ws(" ", F.lit("v"), fixed("x"), fixed("y"), fixed("z"))
    packed = points.groupBy(line).agg(F.array_sort(F.collect_list(F.struct(order, vertex.alias("v")))).alias("p")).where("size(p) >= 2")
    numbers = F.array_join(F.transform(F.sequence(F.lit(1), F.size("p")), lambda i: i.cast("string")), " ")
    return packed.select(line, F.concat(F.array_join(F.col("p.v"), "\n"), F.lit("\nl "), numbers, F.lit("\n")).alias("value"))


def lowest_raster(points: DataFrame, size: float, colour: str) -> DataFrame:
    """px, py, colour: each pixel takes the colour of its lowest point."""
    return points.groupBy(F.floor(F.col("x") / size).alias("px"), F.floor(F.col("y") / size).alias("py")).agg(F.min_by(colour, F.struct("z", colour)).alias(colour))


def upsert(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """stored with new rows put in by key; version counts up from the stored one, from 1. new has no version; of equal keys the last by all columns wins."""
    values = [c for c in stored.columns if c not in (key, "version")]
    one = new.groupBy(key).agg(F.max(F.struct(*values)).alias("_n")).select(key, *[F.col(f"_n.{c}").alias(c) for c in values])
    merged = one.join(stored.select(key, F.col("version").alias("_v")), key, "left")
    fresh = merged.select(key, *values, (F.coalesce("_v", F.lit(0)) + 1).cast("int").alias("version"))
    return stored.join(one.select(key), key, "left_anti").select(key, *values, "version").unionByName(fresh)


def delete_keys(stored: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return stored.join(keys.select(key).distinct(), key, "left_anti")


def replace_tables(spark: SparkSession, folder: str, tables: dict[str, DataFrame]) -> None:
    """Replace the tables of a folder together: write all beside it, then swap the folder by two renames."""
    staging, former = f"{folder}.new-{uuid.uuid4().hex}", f"{folder}.old-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{staging}/{name}")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    if exists and not rename_path(spark, folder, former):
        delete_path(spark, staging)
        raise ValueError(f"{folder} can't be moved")
    if not rename_path(spark, staging, folder):
        if exists:
            rename_path(spark, former, folder)
        raise ValueError(f"{folder} can't be replaced")
    if exists:
        delete_path(spark, former)
