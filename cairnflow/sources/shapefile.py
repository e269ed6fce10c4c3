"""A data source for shapefiles: spark.read.format("shapefile"), one partition per file, and df.write.format("shapefile").

A write makes one set of files (.shp, .shx, .dbf) per task in a folder that all executors share; they come into place
when all tasks are done. Rows: attributes (map of text), geom (kind and parts); all rows of a task have one kind.
"""

from __future__ import annotations

import glob
import os
import shutil
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Shape types of the format and the kinds they are read as.
KINDS = {1: "point", 3: "line", 5: "polygon", 8: "multipoint", 11: "point", 13: "line", 15: "polygon", 18: "multipoint"}


def shapes(content: bytes):
    """(kind, parts) of each record; null shapes give None."""
    at = 100
    while at + 8 <= len(content):
        _, words = struct.unpack(">ii", content[at : at + 8])
        body = content[at + 8 : at + 8 + 2 * words]
        at += 8 + 2 * words
        code = struct.unpack("<i", body[:4])[0]
        if code not in KINDS:
            yield None
            continue
        if code in (1, 11):
            x, y = struct.unpack("<2d", body[4:20])
            z = struct.unpack("<d", body[20:28])[0] if code == 11 else None
            yield KINDS[code], [[(x, y, z)]]
            continue
        if code in (8, 18):
            n_parts, n = 1, struct.unpack("<i", body[36:40])[0]
            starts, pos = [0], 40
        else:
            n_parts, n = struct.unpack("<ii", body[36:44])
            starts, pos = list(struct.unpack(f"<{n_parts}i", body[44 : 44 + 4 * n_parts])), 44 + 4 * n_parts
        xy = struct.unpack(f"<{2 * n}d", body[pos : pos + 16 * n])
        zs = struct.unpack(f"<{n}d", body[pos + 16 * n + 16 : pos + 24 * n + 16]) if code > 10 else [None] * n
        points = [(xy[2 * i], xy[2 * i + 1], zs[i]) for i in range(n)]
        yield KINDS[code], [points[a:b] for a, b in zip(starts, [*starts[1:], n])]


def records(content: bytes, encoding: str):
    """Attribute rows of a dBASE table as dictionaries of text; deleted rows stay, in step with the shapes."""
    n, head, size = struct.unpack("<IHH", content[4:12])
    fields, at = [], 32
    while content[at] != 0x0D:
        name = content[at : at + 11].split(b"\0")[0].decode(encoding)
        fields.append((name, content[at + 16]))
        at += 32
    for i in range(n):
        row, pos = {}, head + i * size + 1
        for name, width in fields:
            row[name] = content[pos : pos + width].decode(encoding, "replace").strip(" \0") or None
            pos += width
        yield row


class _Part(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str, encoding: str) -> None:
        self.path, self.encoding = path, encoding

    def partitions(self):
        path = self.path.removeprefix("file://")
        found = sorted(glob.glob(os.path.join(path, "*.shp"))) if os.path.isdir(path) else sorted(glob.glob(path))
        if not found:
            raise FileNotFoundError(self.path)
        return [_Part(p) for p in found]

    def read(self, partition):
        with open(partition.path, "rb") as f:
            geometries = list(shapes(f.read()))
        table = os.path.splitext(partition.path)[0] + ".dbf"
        rows = []
        if os.path.exists(table):
            with open(table, "rb") as f:
                rows = list(records(f.read(), self.encoding))
        for i, g in enumerate(geometries):
            yield partition.path, i, rows[i] if i < len(rows) else None, g


#: The type with heights that each kind is written as.
CODES = {"point": 11, "line": 13, "linestring": 13, "polygon": 15, "multipoint": 18}
_WIDEST = 254


def encoded(kind: str | None, parts: list | None) -> bytes:
    """The body of a record; a missing geometry is a null shape, a missing height 0."""
    if kind is None or not parts or not any(parts):
        return struct.pack("<i", 0)
    code = CODES[kind]
    points = [(p[0], p[1], p[2] if len(p) > 2 and p[2] is not None else 0.0) for part in parts for p in part]
    if code == 11:
        return struct.pack("<i4d", code, *points[0], 0.0)
    xs, ys, zs = zip(*points)
    n = len(points)
    starts = [] if code == 18 else [sum(map(len, parts[:i])) for i in range(len(parts))]
    counts = [n] if code == 18 else [len(parts), n]
    head = struct.pack(f"<i4d{len(counts)}i{len(starts)}i", code, min(xs), min(ys), max(xs), max(ys), *counts, *starts)
    flat = [v for p in points for v in p[:2]]
    # Points, then the range of heights and the heights, then the same for measures, which are none.
    return head + struct.pack(f"<{2 * n}d2d{n}d2d{n}d", *flat, min(zs), max(zs), *zs, 0.0, 0.0, *[0.0] * n)


def _head(code: int, words: int, box: list[float]) -> bytes:
    return struct.pack(">i5i", 9994, 0, 0, 0, 0, 0) + struct.pack(">i", words) + struct.pack("<2i8d", 1000, code, *box, 0.0, 0.0, 0.0, 0.0)


def _clipped(text: str, encoding: str) -> bytes:
    return text.encode(encoding, "replace")[:_WIDEST].decode(encoding, "ignore").encode(encoding)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceWriter):
    def __init__(self, path: str, encoding: str, overwrite: bool) -> None:
        self.path, self.encoding, self.overwrite = path.removeprefix("file:").replace("//", "/"), encoding, overwrite
        self.staging = os.path.join(self.path, f".staging-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        rows = [(r["attributes"] or {}, r["geom"]) for r in iterator]
        if not rows:
            return _Written([])
        kinds = {g["kind"].lower() for _, g in rows if g is not None and g["kind"]}
        if len(kinds) > 1 and len({CODES[k] for k in kinds}) > 1:
            raise ValueError(f"one file holds one kind, these are {sorted(kinds)}")
        code = CODES[kinds.pop()] if kinds else 0
        bodies = [encoded(g["kind"].lower() if g is not None and g["kind"] else None, g["parts"] if g is not None else None) for _, g in rows]
        all_points = [p for _, g in rows if g is not None for part in g["parts"] or [] for p in part]
        xs, ys = [p[0] for p in all_points] or [0.0], [p[1] for p in all_points] or [0.0]
        box = [min(xs), min(ys), max(xs), max(ys)]
        shp, shx, at = [], [], 50
        for i, body in enumerate(bodies, 1):
            shp.append(struct.pack(">2i", i, len(body) // 2) + body)
            shx.append(struct.pack(">2i", at, len(body) // 2))
            at += 4 + len(body) // 2
        # Names have ten bytes at most; the table's widest field has 254.
        keys = sorted({k for a, _ in rows for k in a})
        names = [k.encode(self.encoding)[:10] for k in keys]
        if len(set(names)) < len(names):
            raise ValueError(f"names that agree in their first ten bytes: {keys}")
        values = [[_clipped(a.get(k) or "", self.encoding) for k in keys] for a, _ in rows]
        widths = [max(1, *(len(v[i]) for v in values)) for i in range(len(keys))]
        fields = b"".join(n.ljust(11, b"\0") + b"C" + bytes(4) + bytes([w]) + bytes(15) for n, w in zip(names, widths)) + b"\r"
        dbf = b"\x03" + bytes(3) + struct.pack("<IHH", len(rows), 32 + len(fields), 1 + sum(widths)) + bytes(20) + fields
        dbf += b"".join(b" " + b"".join(v.ljust(w) for v, w in zip(row, widths)) for row in values) + b"\x1a"
        os.makedirs(self.staging, exist_ok=True)
        name = f"part-{uuid.uuid4().hex}"
        contents = {"shp": _head(code, at, box) + b"".join(shp), "shx": _head(code, 50 + 4 * len(bodies), box) + b"".join(shx), "dbf": dbf}
        for suffix, content in contents.items():
            with open(os.path.join(self.staging, f"{name}.{suffix}"), "wb") as f:
                f.write(content)
        return _Written([f"{name}.{suffix}" for suffix in contents])

    def commit(self, messages: list) -> None:
        os.makedirs(self.path, exist_ok=True)
        if self.overwrite:
            for old in os.listdir(self.path):
                if old.rsplit(".", 1)[-1] in ("shp", "shx", "dbf"):
                    os.remove(os.path.join(self.path, old))
        # Only what the finished tasks report is moved; a lost task's files stay behind and go with the folder.
        for message in messages:
            for name in message.names if message else []:
                os.rename(os.path.join(self.staging, name), os.path.join(self.path, name))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class ShapefileSource(DataSource):
    """Columns: path, row_no, attributes (map of text), geom (kind and parts; null for a null shape)."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return "path string, row_no int, attributes map<string,string>, geom struct<kind:string,parts:array<array<struct<x:double,y:double,z:double>>>>"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options.get("encoding", "utf-8"), overwrite)

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("encoding", "utf-8"))


def register(spark) -> None:
    spark.dataSource.register(ShapefileSource)


def write_layers(layers: dict, root: str, encoding: str = "utf-8") -> None:
    """Each layer (attributes, geom), name to DataFrame, as a folder of shapefiles below root."""
    for name, df in layers.items():
        register(df.sparkSession)
        df.select("attributes", "geom").write.format("shapefile").option("path", f"{root}/{name}").option("encoding", encoding).mode("overwrite").save()
