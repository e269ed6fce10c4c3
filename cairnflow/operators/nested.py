"""Flattening of deeply nested JSON records by Merkle subtree identities.

Every object of a record is brought to one canonical form and hashed bottom-up, so that an object's id depends on
nothing but its content. Objects are records, instances, attributes and geometries (the coordinates of a list of
points). One pass parses the records and writes each distinct object once, with its links to its children (field,
ordinal, child, for a geometry also the places of its points in their list): the bridge. Every occurrence of a record is a row of its own. Flat tables of records, instances,
attributes and points come from joins of occurrences, bridge and objects, one per level of depth, each level written
once; they carry the path of their parents.

Defined results: a null or blank text, text that is no JSON and JSON that is no object give a record row with
``status`` other than ``ok`` and no objects. Depth is bounded by nothing but memory: what the engine's own parser can't
take is parsed and walked with an explicit stack. Repeated deliveries of a record with equal content are one record.
Columns other than the key and the text are ignored.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.session import materialise

_SCHEMA = (
    "kind string, record_key bigint, id binary, status string, payload string, height int, "
    "children array<struct<field:string,ordinal:int,child:binary,places:array<int>>>, ends array<int>, coords array<double>"
)
_BLANK = " \t\r\n\f\v﻿ "
POINT_FIELDS = ("points", "3dbox")


def _reject(token: str) -> None:
    raise ValueError(f"{token} is no JSON")


_decode = json.JSONDecoder(parse_constant=_reject).decode
_encode = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode
_space = re.compile(r"[ \t\n\r]*").match
_scalar = re.compile(r"(?P<word>true|false|null)|(?P<whole>-?(?:0|[1-9]\d*))(?P<rest>(?:\.\d+)?(?:[eE][-+]?\d+)?)").match
_WORDS = {"true": True, "false": False, "null": None}


def _deep_decode(text: str):
    """JSON of any depth, with an explicit stack."""
    open_ones: list = []
    names: list[str] = []

    def name(at: int) -> int:
        if text[at : at + 1] != '"':
            raise ValueError("a name is missing")
        found, at = scanstring(text, at + 1)
        names.append(found)
        at = _space(text, at).end()
        if text[at : at + 1] != ":":
            raise ValueError("a colon is missing")
        return _space(text, at + 1).end()

    at = _space(text, 0).end()
    while True:
        sign = text[at : at + 1]
        if sign in ("{", "["):
            value = {} if sign == "{" else []
            at = _space(text, at + 1).end()
            if text[at : at + 1] != ("}" if sign == "{" else "]"):
                open_ones.append(value)
                at = name(at) if sign == "{" else at
                continue
            at += 1
        elif sign == '"':
            value, at = scanstring(text, at + 1)
        elif m := _scalar(text, at):
            value = _WORDS[m["word"]] if m["word"] else float(m.group()) if m["rest"] else int(m["whole"])
            at = m.end()
        else:
            raise ValueError("a value is missing")
        while True:
            at = _space(text, at).end()
            if not open_ones:
                if at < len(text):
                    raise ValueError("text after the value")
                return value
            top = open_ones[-1]
            keyed = isinstance(top, dict)
            if keyed:
                top[names.pop()] = value
            else:
                top.append(value)
            sign = text[at : at + 1]
            at += 1
            if sign == ",":
                at = _space(text, at).end()
                at = name(at) if keyed else at
                break
            if sign != ("}" if keyed else "]"):
                raise ValueError("an end is missing")
            value = open_ones.pop()


def _deep_encode(value) -> str:
    """The canonical text of a value of any depth."""
    out: list[str] = []
    todo: list = [(False, value)]
    while todo:
        done, v = todo.pop()
        if done:
            out.append(v)
        elif isinstance(v, dict):
            parts = [(True, "}")]
            for i, k in enumerate(sorted(v, reverse=True)):
                parts += [(False, v[k]), (True, f"{_encode(k)}:" if i == len(v) - 1 else f",{_encode(k)}:")]
            todo += [*parts, (True, "{")]
        elif isinstance(v, list):
            parts = [(True, "]")]
            for i, x in enumerate(reversed(v)):
                parts += [(False, x)] if i == len(v) - 1 else [(False, x), (True, ",")]
            todo += [*parts, (True, "[")]
        else:
            out.append(_encode(v))
    return "".join(out)


def _loads(text: str):
    try:
        return _decode(text)
    except RecursionError:
        return _deep_decode(text)


def _dumps(value) -> str:
    try:
        return _encode(value)
    except RecursionError:
        return _deep_encode(value)


def _plain(value):
    """A part that is JSON text stands for what the text holds; text that is no JSON stands for itself."""
    while isinstance(value, str):
        try:
            value = _loads(value.strip(_BLANK))
        except ValueError:
            return value
    return value


def _as_list(value) -> list:
    """The plain list a part stands for: a list, an object keyed by position, JSON text of either, or one object."""
    value = _plain(value)
    if isinstance(value, list):
        return value
    if isinstance(value, dict):
        if all(k.strip().isdigit() for k in value):
            return [v for _, v in sorted(value.items(), key=lambda kv: int(kv[0]))]
        return [value]
    return []


def _as_object(value) -> dict:
    """The plain object a part stands for: an object, JSON text, a list of objects, or a list of name and value pairs."""
    value = _plain(value)
    if isinstance(value, dict):
        return value
    merged: dict = {}
    if isinstance(value, list):
        for item in map(_plain, value):
            if isinstance(item, dict):
                merged.update({str(item["k"]): item.get("v")} if set(item) <= {"k", "v"} and "k" in item else item)
    return merged


def _number(value):
    if isinstance(value, bool):
        return None
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def _point(value) -> list | None:
    value = _plain(value)
    if value is None:
        return None
    if isinstance(value, dict):
        return [_number(value.get(axis)) for axis in ("x", "y", "z")]
    if isinstance(value, list):
        return [_number(v) for v in value]
    return [_number(value)]


def _flat_point(entry) -> bool:
    return type(entry) is list and len(entry) == 3 and type(entry[0]) is type(entry[1]) is type(entry[2]) is float


def _points(value) -> list:
    entries = _as_list(value)
    if len(entries) in (2, 3) and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in entries):
        return [entries]
    return entries


class _Frame:
    """An instance whose inner instances are being walked."""

    __slots__ = ("body", "data", "height", "inner", "links", "ordinal")

    def __init__(self, ordinal: int, body: dict, data: dict, inner: list) -> None:
        self.ordinal, self.body, self.data, self.inner = ordinal, body, data, iter(enumerate(inner))
        self.links: list[tuple] = []
        self.height = 0


_CACHED = 50_000
_NOWHERE = array("i")


@dataclass
class _Builder:
    """Collects the objects of a part of a batch, each distinct one once."""

    #: Attributes met before by name, type and value; only saves hashing them again.
    known: dict[tuple, tuple[bytes, str]] = field(default_factory=dict)
    seen: set[bytes] = field(default_factory=set)
    rows: list[tuple] = field(default_factory=list)
    links: list[tuple] = field(default_factory=list)
    link_ends: array = field(default_factory=lambda: array("i", [0]))
    ends: array = field(default_factory=lambda: array("i"))
    end_ends: array = field(default_factory=lambda: array("i", [0]))
    coords: array = field(default_factory=lambda: array("d"))
    coord_ends: array = field(default_factory=lambda: array("i", [0]))

    def _row(self, kind: str, key: int | None, identity: bytes | None, status: str | None, payload: str | None, height: int) -> None:
        self.rows.append((kind, key, identity, status, payload, height))
        self.link_ends.append(len(self.links))
        self.end_ends.append(len(self.ends))
        self.coord_ends.append(len(self.coords))

    def put(self, kind: str, text: str, links: list[tuple], height: int) -> bytes:
        h = blake2b(f"{kind}\0{text}".encode("utf-8", "surrogatepass"), digest_size=16)
        for name, ordinal, child, places in links:
            h.update(f"\0{name}\0{ordinal}\0".encode() + child + places.tobytes())
        identity = h.digest()
        if identity not in self.seen:
            self.seen.add(identity)
            self.links += links
            self._row(kind, None, identity, None, text, height)
        return identity

    def attribute(self, name: str, value) -> bytes:
        value = value["id"] if isinstance(value, dict) and set(value) == {"id"} else value
        simple = (name, type(value), value) if value is None or isinstance(value, (str, int, float, bool)) else None
        if simple is not None and (found := self.known.get(simple)):
            identity, text = found
            if identity not in self.seen:
                self.seen.add(identity)
                self._row("attribute", None, identity, None, text, 0)
            return identity
        text = _dumps({"name": name, "value": value})
        identity = self.put("attribute", text, [], 0)
        if simple is not None:
            if len(self.known) >= _CACHED:
                self.known.clear()
            self.known[simple] = identity, text
        return identity

    def geometry(self, entries: list) -> tuple[bytes, array]:
        """The object of a list of points, and the places of its entries that aren't null."""
        places, ends, coords = array("i"), array("i"), array("d")
        for i, entry in enumerate(entries):
            if _flat_point(entry):
                coords.extend(entry)
            elif (point := _point(entry)) is not None:
                coords.extend(float("nan") if v is None else v for v in point)
            else:
                continue
            places.append(i)
            ends.append(len(coords))
        identity = blake2b(b"geometry\0" + len(ends).to_bytes(8, "little") + ends.tobytes() + coords.tobytes(), digest_size=16).digest()
        if places and identity not in self.seen:
            self.seen.add(identity)
            self.ends += ends
            self.coords += coords
            self._row("geometry", None, identity, None, None, 0)
        return identity, places

    def _closed(self, frame: _Frame) -> bytes:
        links = [("attrs", i, self.attribute(name, v), _NOWHERE) for i, (name, v) in enumerate(sorted(_as_object(frame.body.get("attrs")).items()))]
        for name in POINT_FIELDS:
            shape, places = self.geometry(_points(frame.data.get(name)))
            if places:
                links.append((name, 0, shape, places))
        rest = {k: v for k, v in frame.body.items() if k not in ("attrs", "data")}
        rest |= {f"data.{k}": v for k, v in frame.data.items() if k not in (*POINT_FIELDS, "instance_list")}
        return self.put("instance", _dumps(rest), links + frame.links, frame.height)

    def instances(self, entries: list) -> tuple[list[tuple], int]:
        """Links to the instances of a list, and how deep they nest."""
        stack = [_Frame(0, {}, {}, entries)]
        while True:
            top = stack[-1]
            for i, entry in top.inner:
                if _plain(entry) is not None:
                    body = _as_object(entry)
                    data = _as_object(body.get("data"))
                    stack.append(_Frame(i, body, data, _as_list(data.get("instance_list"))))
                    break
            else:
                stack.pop()
                if not stack:
                    return top.links, top.height
                stack[-1].links.append(("instance_list", top.ordinal, self._closed(top), _NOWHERE))
                stack[-1].height = max(stack[-1].height, top.height + 1)

    def record(self, key: int | None, text: str | None) -> None:
        text = (text or "").strip(_BLANK)
        status, identity, height = "ok", None, 0
        try:
            body = _plain(_loads(text))
        except ValueError:
            status = "broken" if text else "empty"
        else:
            if isinstance(body, dict):
                detail = _as_object(body.get("detail"))
                links, height = self.instances(_as_list((detail if "instance_list" in detail else body).get("instance_list")))
                identity = self.put("record", _dumps({k: v for k, v in body.items() if k not in ("detail", "instance_list")}), links, height)
            else:
                status = "no object"
        self._row("occurrence", key, identity, status, None, height)

    def batch(self) -> pa.RecordBatch:
        kind, key, identity, status, payload, height = zip(*self.rows)
        lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        names, ordinals, children, places = zip(*self.links) if self.links else ((), (), (), ())
        flat, flat_ends = array("i"), array("i", [0])
        for own in places:
            flat += own
            flat_ends.append(len(flat))
        link = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(ordinals, pa.int32()), pa.array(children, pa.binary()), lists(flat_ends, pa.array(flat, pa.int32()))], names=["field", "ordinal", "child", "places"])
        columns = [
            pa.array(kind), pa.array(key, pa.int64()), pa.array(identity, pa.binary()), pa.array(status, pa.string()), pa.array([p if p is None or p.isascii() else p.encode("utf-8", "replace").decode() for p in payload], pa.string()), pa.array(height, pa.int32()),
            lists(self.link_ends, link), lists(self.end_ends, pa.array(self.ends, pa.int32())), lists(self.coord_ends, pa.array(self.coords, pa.float64(), from_pandas=True)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "record_key", "id", "status", "payload", "height", "children", "ends", "coords"])


#: Characters of text after which a part is handed on.
_PART = 4 << 20


def _walk():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            builder, n = _Builder(known), 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                builder.record(key, text)
                n += len(text or "")
                if n >= _PART:
                    yield builder.batch()
                    builder, n = _Builder(known), 0
            if builder.rows:
                yield builder.batch()

    return run


@dataclass
class NestedStore:
    """The content-addressed tables of a set of records; each distinct object and occurrence is one written row."""

    rows: DataFrame
    depth: int

    def occurrences(self) -> DataFrame:
        """record_key, root_id, status; one row per distinct delivery."""
        return self.rows.where("kind = 'occurrence'").select("record_key", F.col("id").alias("root_id"), "status")

    def objects(self, kind: str) -> DataFrame:
        """id, payload, height; each distinct object once. kind: record, instance or attribute."""
        return self.rows.where(F.col("kind") == kind).select("id", "payload", "height")

    def geometries(self) -> DataFrame:
        """id, ends, coords: the coordinates of a list's points, and where each point ends among them."""
        return self.rows.where("kind = 'geometry'").select("id", "ends", "coords")

    def bridge(self, *fields: str) -> DataFrame:
        """parent, field, ordinal, child, places; each distinct link once."""
        owners = ["record", "instance"] if "instance_list" in fields or not fields else ["instance"]
        links = self.rows.where(F.col("kind").isin(owners)).select(F.col("id").alias("parent"), F.explode(F.filter("children", lambda c: c["field"].isin(*fields)) if fields else "children").alias("c"))
        return links.select("parent", "c.field", "c.ordinal", "c.child", "c.places")

    def instances(self) -> DataFrame:
        """record_key, inst_path, parent_path, ordinal, inst_id: every occurrence of an instance, at any depth."""
        links = self.bridge("instance_list").select("parent", "ordinal", "child")
        level = self.occurrences().where("root_id IS NOT NULL").select("record_key", F.lit(None).cast("string").alias("inst_path"), F.col("root_id").alias("inst_id"))
        out = level.where("false").select("record_key", "inst_path", F.col("inst_path").alias("parent_path"), F.lit(0).alias("ordinal"), "inst_id")
        for depth in range(self.depth):
            parent = level.select("record_key", F.col("inst_path").alias("parent_path"), F.col("inst_id").alias("parent"))
            level = parent.join(links, "parent").select(
                "record_key", F.concat_ws(".", "parent_path", F.col("ordinal").cast("string")).alias("inst_path"), "parent_path", "ordinal", F.col("child").alias("inst_id")
            )
            level = materialise(level, "nested-level")
            out = out.unionByName(level) if depth else level
        return out

    def parts(self, *fields: str) -> DataFrame:
        """record_key, inst_path, field, ordinal, part_id, places: every occurrence of a part of an instance."""
        owned = self.bridge(*fields).select(F.col("parent").alias("inst_id"), "field", F.col("ordinal").alias("part_pos"), F.col("child").alias("part_id"), "places")
        return self.instances().join(owned, "inst_id").select("record_key", "inst_path", "field", F.col("part_pos").alias("ordinal"), "part_id", "places")

    def points(self, coordinates: bool = False) -> DataFrame:
        """record_key, inst_path, field, point_pos, with coordinates also x, y, z: every occurrence of a point."""
        owned = self.parts(*POINT_FIELDS)
        if not coordinates:
            return owned.select("record_key", "inst_path", "field", F.explode("places").alias("point_pos"))
        shapes = self.geometries().select(F.col("id").alias("part_id"), "ends", "coords")
        each = owned.join(shapes, "part_id").select("record_key", "inst_path", "field", "ends", "coords", F.posexplode("places").alias("nth", "point_pos"))
        start = F.when(F.col("nth") > 0, F.get("ends", F.col("nth") - 1)).otherwise(F.lit(0))

        def axis(i: int) -> Column:
            return F.when(start + i < F.get("ends", F.col("nth")), F.get("coords", start + i))

        return each.select("record_key", "inst_path", "field", "point_pos", *[axis(i).alias(n) for i, n in enumerate("xyz")])


def build_store(records: DataFrame, key: str, text: str) -> NestedStore:
    """Parse, canonicalise and hash the records once; the result is a written table of distinct rows, laid out by kind."""
    parsed = records.select(F.col(key).cast("bigint").alias("record_key"), F.col(text).alias("text")).mapInArrow(_walk(), _SCHEMA)
    rows = materialise(parsed.dropDuplicates(["kind", "record_key", "id", "status"]), "nested-store", by="kind")
    depth = rows.where("kind = 'occurrence'").agg(F.coalesce(F.max("height"), F.lit(0))).first()[0]
    return NestedStore(rows, int(depth))
