"""Reading the engine's inputs: layers, frame lists, poses, point clouds, rasters, catalogues and archives."""

from __future__ import annotations

import re
import struct
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cairnflow.functions import text as X

POINT = "struct<x:double,y:double,z:double>"
GEOMETRY = f"struct<kind:string,parts:array<array<{POINT}>>>"


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet", kinds: list[str] | None = None, flat: bool = False, schema: str | StructType | None = None) -> DataFrame:
    """A vector layer: rows with a geometry, of the wanted kinds, without z if flat. fmt: parquet, json or shapefile."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    return clean_layer(df, kinds, flat)


def clean_layer(df: DataFrame, kinds: list[str] | None = None, flat: bool = False) -> DataFrame:
    df = df.where(F.col("geom").isNotNull() & F.col("geom.kind").isNotNull())
    if kinds:
        df = df.where(F.col("geom.kind").isin(*kinds))
    if flat:
        parts = F.transform("geom.parts", lambda part: F.transform(part, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(None).cast("double").alias("z"))))
        df = df.withColumn("geom", F.struct(F.col("geom.kind").alias("kind"), parts.alias("parts")))
    return df


def read_bundle(spark: SparkSession, folder: str, layers: dict[str, str | StructType], fmt: str = "parquet") -> tuple[dict[str, DataFrame], list[str]]:
    """Layers by name and the names of those that are missing, which come as empty tables. layers: name -> schema."""
    found, missing = {}, []
    jvm = spark.sparkContext._jvm
    for name, schema in layers.items():
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.{fmt}")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            found[name] = read_layer(spark, str(path.toString()), fmt, schema=schema)
        else:
            missing.append(name)
            found[name] = spark.createDataFrame([], schema)
    return found, missing


def find_input(base: str, pattern: str) -> Path:
    """The one input whose name matches: an archive before a folder; none or several are an error."""
    named = [p for p in sorted(Path(base).iterdir()) if re.search(pattern, p.name)]
    for group in ([p for p in named if p.suffix == ".zip"], [p for p in named if p.is_dir()]):
        if len(group) > 1:
            raise ValueError(f"{len(group)} inputs match {pattern!r}")
        if group:
            return group[0]
    raise FileNotFoundError(f"no input matches {pattern!r} in {base}")


def extract(archive: str, target: str) -> list[str]:
    """Unpack a zip archive below target; names that lead outside are an error."""
    root = Path(target).resolve()
    with zipfile.ZipFile(archive) as z:
        for name in z.namelist():
            if not (root / name).resolve().is_relative_to(root):
                raise ValueError(f"{name} lies outside {target}")
        z.extractall(root)
        return sorted(z.namelist())


def first_available(*readers):
    """The result of the first reader that works; the last one's error if none does."""
    error: Exception | None = None
    for read in readers:
        try:
            return read()
        except Exception as e:  # noqa: BLE001 - any failing source hands over to the next
            error = e
    raise error or ValueError("no readers")


def read_area(spark: SparkSession, url: str, relation: str, area_id: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Rows of one area over JDBC; the id is a pushed filter."""
    return spark.read.jdbc(url, relation, properties=properties or {}).where(F.col("id") == area_id)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """cloud_path, t, q of each frame of JSON frame lists {"data": [...]}."""
    schema = "data array<struct<cloud_path:string,t:array<double>,q:array<double>>>"
    return spark.read.schema(schema).option("multiLine", "true").json(path).select(F.inline("data"))


def parse_poses(lines: DataFrame, skip: int = 4) -> DataFrame:
    """file, line_no, ts (seconds, of milliseconds), frame_id, frame_id_str (time, underscore, frame), lat, lon (radians), alt, rot of pose texts.

    lines: file, line_no (from 0), value.

    The first lines are headers; lines of fewer than five fields are dropped.
    """
    f = F.filter(F.split(F.trim("value"), r"\s+"), lambda v: v != "")
    rows = lines.where(F.col("line_no") >= skip).withColumn("f", f).where("size(f) >= 5")
    number = lambda i: F.try_element_at("f", F.lit(i)).try_cast("double")
    rot = F.transform(F.slice("f", 6, 9), lambda v: v.try_cast("double"))
    return rows.select("file", "line_no", (number(1) / 1e3).alias("ts"), F.element_at("f", 2).alias("frame_id"), F.concat_ws("_", F.element_at("f", 1), F.element_at("f", 2)).alias("frame_id_str"), F.radians(number(3)).alias("lat"), F.radians(number(4)).alias("lon"), number(5).alias("alt"), rot.alias("rot"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, value of small text files, one row per line; each file is read whole by one task."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value"))
    return whole


def parse_wkt(text: Column) -> Column:
    """Geometry of POINT, LINESTRING, POLYGON, MULTIPOINT or MULTILINESTRING text; null for anything else."""
    kind = F.upper(F.regexp_extract(text, r"^\s*(?:SRID=\d+;)?\s*([A-Za-z]+)", 1))
    body = F.regexp_extract(text, r"\((.*)\)\s*$", 1)
    parts = F.split(F.regexp_replace(F.regexp_replace(body, r"^\s*\(|\)\s*$", ""), r"\)\s*,\s*\(", "|"), r"\|")

    def point(p: Column) -> Column:
        n = F.filter(F.split(F.trim(p), r"\s+"), lambda v: v != "")
        at = lambda i: F.try_element_at(n, F.lit(i)).try_cast("double")
        return F.struct(at(1).alias("x"), at(2).alias("y"), at(3).alias("z"))

    geometry = F.struct(F.lower(kind).alias("kind"), F.transform(parts, lambda part: F.transform(F.split(part, ","), point)).alias("parts"))
    return F.when(kind.isin("POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING"), geometry)


def parse_obj(lines: DataFrame) -> DataFrame:
    """file, line, seq, x, y, z of the polylines of OBJ texts. lines: file, line_no, value.

    Vertices are numbered within their file. An l record stands for all vertices from its first number to its last, which
    are looked up by an equi-join.
    """
    f = F.split(F.trim("value"), r"\s+")
    rows = lines.withColumn("f", f).withColumn("tag", F.element_at("f", 1))
    number = lambda i: F.try_element_at("f", F.lit(i)).try_cast("double")
    order = Window.partitionBy("file").orderBy("line_no")
    v = rows.where("tag = 'v'").select("file", F.row_number().over(order).alias("k"), number(2).alias("x"), number(3).alias("y"), number(4).alias("z"))
    l = rows.where("tag = 'l'").select("file", F.col("line_no").alias("line"), F.element_at("f", 2).try_cast("int").alias("a"), F.element_at("f", -1).try_cast("int").alias("b")).where("a <= b")  # noqa: E741
    return l.select("file", "line", F.posexplode(F.sequence("a", "b")).alias("seq", "k")).join(v, ["file", "k"]).select("file", "line", "seq", "x", "y", "z")


#: The corners of a mark in the order they are put together, and what a mark is.
CORNERS, MARK = ("RightFront", "LeftFront", "LeftRear", "RightRear"), 7


def parse_marks(documents: DataFrame) -> DataFrame:
    """id, label, mark_no, mark_type, arrow_type (null in the form without), corners of road-mark JSON.

    documents: id, value. A document is an object keyed by label, whose entries hold the four corners as [x, y, z].
    """
    corner = "array<double>"
    schema = "map<string, array<struct<" + ", ".join(f"{c}:{corner}" for c in CORNERS) + ", ArrowType:int>>>"
    rows = documents.select("id", F.explode(F.from_json("value", schema)).alias("label", "marks")).select("id", F.col("label").try_cast("int").alias("label"), F.posexplode("marks").alias("mark_no", "m"))
    point = lambda c: F.struct(*[F.get(F.col(f"m.{c}"), F.lit(i)).alias(n) for i, n in enumerate("xyz")])
    whole = [F.size(F.col(f"m.{c}")) >= 3 for c in CORNERS]
    return rows.where(whole[0] & whole[1] & whole[2] & whole[3]).select("id", "label", "mark_no", F.lit(MARK).alias("mark_type"), F.col("m.ArrowType").alias("arrow_type"), F.array(*map(point, CORNERS)).alias("corners"))


def decode_runs(content: bytes) -> tuple[int, int, list[tuple[int, int, int]]]:
    """Height, width and (start, length, label) runs of a label raster.

    Four bytes to skip, height and width as big-endian 16-bit numbers, then runs of 3 bytes: a label and a little-endian
    16-bit length. A run that leaves its row ends what can be read.
    """
    if len(content) < 8:
        return 0, 0, []
    height, width = struct.unpack(">HH", content[4:8])
    runs, at, x = [], 0, 0
    for label, length in struct.iter_unpack("<BH", content[8 : 8 + (len(content) - 8) // 3 * 3]):
        x += length
        if x > width or at + length > height * width:
            break
        if length:
            runs.append((at, length, label))
        at += length
        x = 0 if x == width else x
    return height, width, runs


def read_rasters(spark: SparkSession, path: str) -> DataFrame:
    """path, height, width, start, length, label: the runs of each raster file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, h, w, *r) for p, c in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()) for h, w, runs in [decode_runs(c or b"")] for r in runs]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "height", "width", "start", "length", "label"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, height bigint, width bigint, start bigint, length bigint, label bigint")


def pixels(runs: DataFrame) -> DataFrame:
    """path, row, col, label of every pixel of the runs; pixels beyond the raster are dropped."""
    p = runs.withColumn("i", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)))
    return p.where(F.col("i") < F.col("height") * F.col("width")).select("path", F.floor(F.col("i") / F.col("width")).alias("row"), (F.col("i") % F.col("width")).alias("col"), "label")


_PCD_TYPES = {("F", 4): "<f4", ("F", 8): "<f8", ("U", 1): "u1", ("U", 2): "<u2", ("U", 4): "<u4", ("I", 1): "i1", ("I", 2): "<i2", ("I", 4): "<i4"}


def decode_pcd(content: bytes) -> dict[str, np.ndarray]:
    """Columns of a point-cloud file with ASCII, binary or compressed binary data; one without a header has none."""
    head: dict[str, list[str]] = {}
    at = 0
    while at < len(content):
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)].decode("ascii", "replace").strip()
        at = end + 1 if end >= 0 else len(content)
        if line and not line.startswith("#"):
            key, *values = line.split()
            head[key] = values
            if key == "DATA":
                break
    if not {"FIELDS", "SIZE", "TYPE", "DATA"} <= set(head):
        return {}
    form = head["DATA"][0]
    if form not in ("ascii", "binary", "binary_compressed"):
        raise ValueError(f"point-cloud data of the form {form}")
    names = head["FIELDS"]
    kinds = [_PCD_TYPES[t, int(s)] for t, s in zip(head["TYPE"], head["SIZE"])]
    if form == "ascii":
        rows = [r.split() for r in content[at:].decode("ascii", "replace").splitlines() if r.strip()]
        return {n: np.array([float(r[i]) for r in rows if len(r) == len(names)]) for i, n in enumerate(names)}
    record = np.dtype([(n, k) for n, k in zip(names, kinds)])
    points = int(head.get("POINTS", ["0"])[0])
    if form == "binary_compressed":
        packed, size = struct.unpack("<II", content[at : at + 8])
        # Compressed data lies field by field.
        plain, out, start = unpack_lzf(content[at + 8 : at + 8 + packed], size), {}, 0
        for name, kind in zip(names, kinds):
            out[name] = np.frombuffer(plain, kind, points, start).astype(float)
            start += points * np.dtype(kind).itemsize
        return out
    n = min(points, (len(content) - at) // record.itemsize)
    data = np.frombuffer(content, record, n, at)
    return {name: data[name].astype(float) for name in names}


def unpack_lzf(packed: bytes, size: int) -> bytes:
    """LZF: a byte under 32 announces so many plain bytes more one; any other a copy of earlier output."""
    out = bytearray()
    at = 0
    while at < len(packed):
        control = packed[at]
        at += 1
        if control < 32:
            out += packed[at : at + control + 1]
            at += control + 1
            continue
        length = control >> 5
        if length == 7:
            length += packed[at]
            at += 1
        start = len(out) - ((control & 31) << 8) - packed[at] - 1
        at += 1
        if start < 0:
            raise ValueError("a copy of what was never there")
        for i in range(start, start + length + 2):
            out.append(out[i])
    if len(out) != size:
        raise ValueError(f"{len(out)} bytes were unpacked, {size} announced")
    return bytes(out)


def read_clouds(spark: SparkSession, path: str) -> DataFrame:
    """path, x, y, z, intensity of the points of point-cloud files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                c = decode_pcd(content or b"")
                if "x" in c and len(c["x"]):
                    n = len(c["x"])
                    yield pa.RecordBatch.from_arrays([pa.array([name] * n), *[pa.array(c.get(k, np.full(n, np.nan))) for k in ("x", "y", "z", "intensity")]], names=["path", "x", "y", "z", "intensity"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, x double, y double, z double, intensity double")


def read_cloud_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """line, seq, x, y, z: polylines kept as one point-cloud file each; the line's name is the file's after its last underscore."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                c = decode_pcd(content or b"")
                if "x" in c and len(c["x"]):
                    line = name.rsplit("/", 1)[-1].rsplit(".", 1)[0].rsplit("_", 1)[-1]
                    n = len(c["x"])
                    yield pa.RecordBatch.from_arrays([pa.array([line] * n), pa.array(np.arange(n, dtype=np.int32)), *[pa.array(c[k]) for k in "xyz"]], names=["line", "seq", "x", "y", "z"])

    return spark.read.format("binaryFile").load(pattern).select("path", "content").mapInArrow(run, "line string, seq int, x double, y double, z double")


def read_sqlite(spark: SparkSession, path: str, table: str) -> DataFrame:
    """path, row_no, row (JSON object) of a table in each SQLite file; a file without the table has no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json
        import sqlite3

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                con = sqlite3.connect(":memory:")
                con.deserialize(content)
                if con.execute("SELECT 1 FROM sqlite_master WHERE name = ?", (table,)).fetchone():
                    quoted = table.replace('"', '""')
                    cursor = con.execute(f'SELECT * FROM "{quoted}"')
                    names = [c[0] for c in cursor.description]
                    start = 0
                    while rows := cursor.fetchmany(10_000):
                        texts = [json.dumps(dict(zip(names, r)), ensure_ascii=False, default=lambda b: b.hex()) for r in rows]
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(range(start, start + len(rows)), pa.int64()), pa.array(texts)], names=["path", "row_no", "row"])
                        start += len(rows)
                con.close()

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, row_no bigint, row string")


def area_by_id(areas: DataFrame, area_id: str) -> DataFrame:
    """id, geom: one area of a layer (id, geom), the parts of all its rows together. Raises where there is none or it is no polygon."""
    own = areas.where(F.col("id") == area_id)
    kinds = {r[0] for r in own.select(F.lower("geom.kind")).distinct().collect()}
    if not kinds:
        raise LookupError(f"no area {area_id}")
    if not kinds <= {"polygon", "multipolygon"}:
        raise TypeError(f"area {area_id} is {', '.join(sorted(map(str, kinds)))}")
    return own.groupBy("id").agg(F.struct(F.lit("multipolygon").alias("kind"), F.array_distinct(F.flatten(F.collect_list("geom.parts"))).alias("parts")).alias("geom"))


def file_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """uri, name, mime, size of the files below root. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.col("path").alias("uri"), F.element_at(F.split("path", "/"), -1).alias("name"), X.mime_of(F.col("path")).alias("mime"), F.col("length").alias("size"))


def read_resources(spark: SparkSession, path: str) -> DataFrame:
    """uri, mime, text or blob (base64) of each file, by its suffix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    is_text = X.is_text_file(F.col("path"))
    return files.select(F.col("path").alias("uri"), X.mime_of(F.col("path")).alias("mime"), F.when(is_text, F.col("content").cast("string")).alias("text"), F.when(~is_text, F.base64("content")).alias("blob"))


def matching_files(spark: SparkSession, folder: str, part: str) -> DataFrame:
    """path of the files whose name contains a text, in order."""
    return file_catalogue(spark, folder).where(F.contains("name", F.lit(part))).select(F.col("uri").alias("path")).orderBy("path")


def side_files(catalogue: DataFrame, bad_trails: DataFrame) -> DataFrame:
    """trail_id, kind, path of the files kept beside each trail; trails with a data error are named <id>_bad."""
    parts = F.split("uri", "/")
    rows = catalogue.select(F.element_at(parts, -2).alias("trail_id"), F.coalesce(X.extension_of(F.col("uri")), F.lit("")).alias("kind"), F.col("uri").alias("path"))
    bad = bad_trails.select("trail_id").distinct().withColumn("bad", F.lit(True))
    return rows.join(bad, "trail_id", "left").select(F.when(F.col("bad"), F.concat("trail_id", F.lit("_bad"))).otherwise(F.col("trail_id")).alias("trail_id"), "kind", "path")
