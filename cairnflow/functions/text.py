"""Strings, templates, maps, URIs and times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Media types by extension, and suffixes whose content is text.
MIME = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "wav": "audio/wav", "mp3": "audio/mpeg", "txt": "text/plain", "md": "text/markdown", "json": "application/json", "xml": "application/xml", "html": "text/html"}
TEXT_SUFFIXES = ("txt", "json", "md", "xml")
ERROR_CODES = {"invalid": -32600, "method": -32601, "internal": -32603, "service": -32000}
GPS_EPOCH, WEEK = 315964800, 604800
#: Unix times from which one more leap second holds between GPS and UTC.
LEAP_SECONDS = (362793600, 394329600, 425865600, 489024000, 567993600, 631152000, 662688000, 709948800, 741484800, 773020800, 820454400, 867715200, 915148800, 1136073600, 1230768000, 1341100800, 1435708800, 1483228800)


def version_of(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(v\d+\.\d+\.\d+)", 1), F.lit(""))


def task_id_of(text: Column, default: str | None = None) -> Column:
    found = F.nullif(F.regexp_extract(text, r"ID(\d+)\.zip$", 1), F.lit(""))
    return F.coalesce(found, F.lit(default)) if default is not None else found


def render(template: Column, values: Column) -> Column:
    """Replace {{ name }} by the map's value, in one pass; unknown names stay as they are.

    The text is cut at the marks; each piece is one literal or one mark, so a value that holds a mark isn't expanded.
    """
    marks = F.regexp_extract_all(template, F.lit(r"(\{\{\s*\w+\s*\}\})"), F.lit(1))
    pieces = F.split(template, r"\{\{\s*\w+\s*\}\}", -1)
    filled = F.transform(marks, lambda m: F.coalesce(F.element_at(values, F.regexp_extract(m, r"\{\{\s*(\w+)\s*\}\}", 1)), m))
    return F.array_join(F.flatten(F.zip_with(pieces, filled, lambda a, b: F.array(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))), "")


def cache_key(name: Column, args: Column) -> Column:
    """name, pipe, md5 of the name and its sorted arguments."""
    pairs = F.transform(F.array_sort(F.map_entries(args)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.concat_ws("|", name, F.md5(F.concat_ws("|", F.concat(F.array(name), pairs))))


def extension_of(uri: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(uri, r"\.([A-Za-z0-9]+)$", 1), F.lit("")))


def mime_of(uri: Column, default: str = "application/octet-stream") -> Column:
    known = F.create_map(*[F.lit(v) for pair in MIME.items() for v in pair])
    return F.coalesce(F.element_at(known, extension_of(uri)), F.lit(default))


def content_kind(uri: Column) -> Column:
    """text, image, audio or resource, by a data URI's type, else by scheme and extension."""
    data = F.lower(F.regexp_extract(uri, r"^data:([a-z]+)/", 1))
    mime = F.split(mime_of(uri), "/")[0]
    return F.when(data.isin("image", "audio"), data).when(uri.rlike(r"^[a-z][a-z0-9+.-]*://") & mime.isin("image", "audio"), mime).when(uri.rlike(r"^[a-z][a-z0-9+.-]*://"), F.lit("resource")).otherwise(F.lit("text"))


def is_text_file(uri: Column) -> Column:
    return F.coalesce(extension_of(uri).isin(*TEXT_SUFFIXES), F.lit(False))


def uri_parts(uri: Column) -> Column:
    """Struct host, port (80 if none), path (/ if none)."""
    host = F.regexp_extract(uri, r"^[a-z]+://([^/:]+)", 1)
    port = F.regexp_extract(uri, r"^[a-z]+://[^/:]+:(\d+)", 1)
    path = F.regexp_extract(uri, r"^[a-z]+://[^/]+(/.*)$", 1)
    return F.struct(host.alias("host"), F.coalesce(F.nullif(port, F.lit("")).try_cast("int"), F.lit(80)).alias("port"), F.coalesce(F.nullif(path, F.lit("")), F.lit("/")).alias("path"))


def env_map(text: Column, separator: str = ",") -> Column:
    """K=V pairs as a map; comment lines, blank keys and entries without = are dropped, the last of equal keys wins."""
    lines = F.filter(F.transform(F.split(text, "[\n]" if separator == "\n" else separator), lambda v: F.trim(v)), lambda v: ~v.startswith("#") & v.contains("="))
    pairs = F.transform(lines, lambda v: F.struct(F.trim(F.substring_index(v, "=", 1)).alias("key"), F.trim(F.substr(v, F.instr(v, "=") + 1)).alias("value")))
    kept = F.filter(pairs, lambda p: p["key"] != "")
    # Of equal keys only the last stays, so that no setting for duplicate keys matters.
    last = F.filter(F.transform(kept, lambda p, i: F.struct(p["key"].alias("key"), p["value"].alias("value"), i.alias("i"))), lambda p: ~F.exists(F.slice(kept, p["i"] + 2, F.size(kept)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], p["value"])))


def merge_env(parent: Column, file: Column, inline: Column, path_key: str = "LD_LIBRARY_PATH") -> Column:
    """Inline wins over file, file over parent; the library path is united instead of replaced."""
    keys = F.array_distinct(F.concat(F.map_keys(parent), F.map_keys(file), F.map_keys(inline)))
    paths = F.filter(F.array_distinct(F.flatten(F.transform(F.array(inline, file, parent), lambda m: F.split(F.coalesce(F.element_at(m, F.lit(path_key)), F.lit("")), ":")))), lambda v: v != "")
    value = lambda k: F.when(k == path_key, F.array_join(paths, ":")).otherwise(F.coalesce(F.element_at(inline, k), F.element_at(file, k), F.element_at(parent, k)))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), value(k).alias("value"))))


def path_union(a: Column, b: Column) -> Column:
    return F.array_join(F.filter(F.array_union(F.split(F.coalesce(a, F.lit("")), ":"), F.split(F.coalesce(b, F.lit("")), ":")), lambda v: v != ""), ":")


def decode(code: Column, names: dict, unknown: str = "UNKNOWN") -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(v) for pair in names.items() for v in pair]), code), F.lit(unknown))


def leap_seconds(unix: Column) -> Column:
    return sum((F.when(unix >= at, F.lit(1)).otherwise(F.lit(0)) for at in LEAP_SECONDS), F.lit(0))


def gps_week(unix: Column) -> Column:
    return F.floor((unix - GPS_EPOCH + leap_seconds(unix)) / WEEK).cast("int")


def gps_seconds_of_week(unix: Column) -> Column:
    return F.pmod(unix - GPS_EPOCH + leap_seconds(unix), F.lit(WEEK))


def from_gps(week: Column, seconds: Column) -> Column:
    """Unix seconds of a GPS time; inside an inserted leap second the second before it."""
    gps = week * WEEK + seconds + GPS_EPOCH
    return gps - sum((F.when(gps - i >= at, F.lit(1)).otherwise(F.lit(0)) for i, at in enumerate(LEAP_SECONDS, 1)), F.lit(0))


def route(method: Column) -> Column:
    """The service a method belongs to, by its prefix."""
    return F.when(method.startswith("prompts/"), "prompts").when(method.startswith("resources/"), "resources").when(method.startswith("tools/"), "tools").when(method == "initialize", "session")


def error_code(is_request: Column, known: Column, failed: Column) -> Column:
    return F.when(~is_request, ERROR_CODES["invalid"]).when(~known, ERROR_CODES["method"]).when(failed, ERROR_CODES["service"])
