import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnflow.sources import readers as R
from cairnflow.sources import shapefile, sinks


def test_discovery_and_archive(tmp_path):
    (tmp_path / "box1").mkdir()
    (tmp_path / "box1" / "a.txt").write_text("a")
    assert R.find_input(str(tmp_path), r"^box\d").name == "box1"
    with zipfile.ZipFile(tmp_path / "box1.zip", "w") as z:
        z.writestr("in/b.txt", "b")
    assert R.find_input(str(tmp_path), r"^box\d").name == "box1.zip"
    assert R.extract(str(tmp_path / "box1.zip"), str(tmp_path / "out")) == ["in/b.txt"]
    (tmp_path / "box2.zip").write_bytes(b"")
    with pytest.raises(ValueError):
        R.find_input(str(tmp_path), r"^box\d")
    with pytest.raises(FileNotFoundError):
        R.find_input(str(tmp_path), "none")
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../x", "b")
    with pytest.raises(ValueError):
        R.extract(str(tmp_path / "bad.zip"), str(tmp_path / "out"))
    (tmp_path / "out" / "output.json").write_text("{}")
    sinks.archive(str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["archive", "output.json"]


def test_failover():
    def broken():
        raise OSError("down")

    assert R.first_available(broken, lambda: 5) == 5
    with pytest.raises(OSError):
        R.first_available(broken)


def test_pose_texts(spark, tmp_path):
    (tmp_path / "p.txt").write_text("h\nh\nh\nh\n1500 17 180 90 7 1 0 0 0 1 0 0 0 1\nshort line 3\n2000 18 x 0 1\n")
    rows = R.parse_poses(R.numbered_lines(spark, str(tmp_path))).orderBy("line_no").collect()
    assert [(r.ts, r.frame_id, r.frame_id_str, r.alt) for r in rows] == [(1.5, "17", "1500_17", 7.0), (2.0, "18", "2000_18", 1.0)]
    assert abs(rows[0].lat - np.pi) < 1e-12 and rows[0].rot == [1, 0, 0, 0, 1, 0, 0, 0, 1] and rows[1].lat is None and rows[1].rot == []


def test_frames_wkt_obj_marks(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({"data": [{"cloud_path": "a", "t": [1, 2, 3], "q": [0, 0, 0, 1]}, {"cloud_path": None}]}))
    assert [r.cloud_path for r in R.read_frames(spark, str(tmp_path / "f.json")).collect()] == ["a", None]
    texts = ["LINESTRING (1 2, 3 4)", "polygon((0 0, 1 0, 1 1),(5 5, 6 5, 6 6))", "POINT Z (1 2 3)", "junk", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(R.parse_wkt(F.col("t"))).collect()]
    assert got[0].kind == "linestring" and [(p.x, p.y) for p in got[0].parts[0]] == [(1, 2), (3, 4)]
    assert len(got[1].parts) == 2 and got[1].parts[1][0].x == 5
    assert got[2].parts[0][0].z == 3 and got[3] is None and got[4] is None


def test_obj_lines_reach_from_their_first_to_their_last_vertex(spark, tmp_path):
    (tmp_path / "o.obj").write_text("# c\nv 0 0 0\nv 1 0 0\nv 2 0 5\nl 1 3\nv 3 0 0\nl 2 3 4\nl 3 9\nl 4\nl x\n")
    rows = R.parse_obj(R.numbered_lines(spark, str(tmp_path / "o.obj"))).orderBy("line", "seq").collect()
    assert [(r.line, r.seq, r.x) for r in rows] == [(4, 0, 0), (4, 1, 1), (4, 2, 2), (6, 0, 1), (6, 1, 2), (6, 2, 3), (7, 0, 2), (7, 1, 3), (8, 0, 3)]


def test_marks_are_kept_by_label(spark):
    corners = {"LeftFront": [1, 2, 3], "LeftRear": [4, 5, 6], "RightFront": [7, 8, 9], "RightRear": [10, 11, 12]}
    texts = [("a", json.dumps({"4": [corners, {"LeftFront": [1, 2, 3]}, {**corners, "ArrowType": 9}], "x": []})), ("b", "junk"), ("c", None)]
    rows = R.parse_marks(spark.createDataFrame(texts, "id string, value string")).orderBy("mark_no").collect()
    assert [(r.id, r.label, r.mark_no, r.mark_type, r.arrow_type) for r in rows] == [("a", 4, 0, 7, None), ("a", 4, 2, 7, 9)]
    assert [p.x for p in rows[0].corners] == [7, 1, 4, 10] and rows[0].corners[1].z == 3


def test_rasters(spark, tmp_path):
    # Four bytes to skip, 0x0002 high and 0x0103 wide; runs of a label and a little-endian length.
    wide = 0x0103
    (tmp_path / "r.bin").write_bytes(b"\xff\xee\xdd\xcc\x00\x02\x01\x03" + b"\x07\x02\x00" + b"\x09\x01\x01" + b"\x05\x03\x01")
    (tmp_path / "bad.bin").write_bytes(b"abc")
    (tmp_path / "over.bin").write_bytes(bytes(4) + b"\x00\x02\x00\x03" + b"\x01\x03\x00" + b"\x02\x04\x00" + b"\x03\x01\x00")
    rows = {(r.path[-7:], r.row, r.col): r.label for r in R.pixels(R.read_rasters(spark, str(tmp_path))).collect()}
    own = {k[1:]: v for k, v in rows.items() if k[0] == "m/r.bin" or k[0].endswith("/r.bin")}
    assert own == {**{(0, c): 7 if c < 2 else 9 for c in range(wide)}, **{(1, c): 5 for c in range(wide)}}
    assert sum(k[0] == "ver.bin" for k in rows) == 3 and not any(k[0] == "bad.bin" for k in rows)


def test_clouds(spark, tmp_path):
    head = "# .PCD\nVERSION .7\nFIELDS x y z intensity\nSIZE 4 4 4 4\nTYPE F F F F\nCOUNT 1 1 1 1\nWIDTH 2\nHEIGHT 1\nPOINTS 2\nDATA "
    (tmp_path / "a.pcd").write_text(head + "ascii\n1 2 3 4\n5 6 7 8\n")
    (tmp_path / "b.pcd").write_bytes((head + "binary\n").encode() + struct.pack("<8f", 1, 2, 3, 4, 5, 6, 7, 8))
    (tmp_path / "c.pcd").write_text("nothing")
    # By fields: x 1 5, y 2 6, z 3 3, intensity 4 4; a plain run of 20 bytes, a copy of the four before, eight plain, a copy.
    plain = struct.pack("<8f", 1, 5, 2, 6, 3, 3, 4, 4)
    packed = bytes([19]) + plain[:20] + bytes([(2 << 5), 3]) + bytes([3]) + plain[24:28] + bytes([(2 << 5), 3])
    (tmp_path / "d.pcd").write_bytes((head + "binary_compressed\n").encode() + struct.pack("<II", len(packed), 32) + packed)
    got = R.decode_pcd((tmp_path / "d.pcd").read_bytes())
    assert {k: v.tolist() for k, v in got.items()} == {"x": [1, 5], "y": [2, 6], "z": [3, 3], "intensity": [4, 4]}
    (tmp_path / "d.pcd").unlink()
    with pytest.raises(ValueError):
        R.decode_pcd((head + "binary_other\n").encode())
    with pytest.raises(ValueError):
        R.unpack_lzf(b"\x00a", 2)
    lines = R.read_cloud_lines(spark, str(tmp_path / "a.pcd")).orderBy("seq").collect()
    assert [(r.line, r.seq, r.x) for r in lines] == [("a", 0, 1.0), ("a", 1, 5.0)]
    rows = R.read_clouds(spark, str(tmp_path)).collect()
    assert sorted((r.path[-5:], r.x, r.intensity) for r in rows) == [(f"{n}.pcd", x, i) for n in "ab" for x, i in ((1.0, 4.0), (5.0, 8.0))]


def test_catalogue_and_resources(spark, tmp_path):
    (tmp_path / "t1").mkdir()
    (tmp_path / "t1" / "a.json").write_text("{}")
    (tmp_path / "t1" / "b.png").write_bytes(b"\x00\x01")
    rows = {r["name"]: r for r in R.file_catalogue(spark, str(tmp_path)).collect()}
    assert rows["a.json"].mime == "application/json" and rows["b.png"]["size"] == 2
    kinds = {r.uri[-6:]: (r.text, r.blob) for r in R.read_resources(spark, str(tmp_path)).collect()}
    assert kinds["a.json"] == ("{}", None) and kinds["/b.png"] == (None, "AAE=")
    bad = spark.createDataFrame([("t1",)], "trail_id string")
    assert {r.trail_id for r in R.side_files(R.file_catalogue(spark, str(tmp_path)), bad).collect()} == {"t1_bad"}
    assert [r.path[-6:] for r in R.matching_files(spark, str(tmp_path), "a.").collect()] == ["a.json"]


def shp(code, bodies):
    out = b""
    for i, b in enumerate(bodies, 1):
        body = struct.pack("<i", code if b is not None else 0) + (b or b"")
        out += struct.pack(">ii", i, len(body) // 2) + body
    return bytes(100) + out


def dbf(names, rows):
    fields = b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([10]) + bytes(15) for n in names) + b"\r"
    head = b"\x03" + bytes(3) + struct.pack("<IHH", len(rows), 32 + len(fields), 1 + 10 * len(names)) + bytes(20)
    return head + fields + b"".join(b" " + b"".join(v.encode().ljust(10) for v in r) for r in rows)


def test_shapefiles(spark, tmp_path):
    def line(parts):
        points = [p for part in parts for p in part]
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        return bytes(32) + struct.pack(f"<ii{len(parts)}i", len(parts), len(points), *starts) + struct.pack(f"<{2 * len(points)}d", *[v for p in points for v in p])

    (tmp_path / "lane.shp").write_bytes(shp(3, [line([[(0, 0), (1, 1)], [(5, 5), (6, 6)]]), None]))
    (tmp_path / "lane.dbf").write_bytes(dbf(["ID", "COLOR"], [("a", "1"), ("b", "")]))
    (tmp_path / "sign.shp").write_bytes(shp(1, [struct.pack("<2d", 3, 4)]))
    shapefile.register(spark)
    rows = {(r.path[-8:-4], r.row_no): r for r in spark.read.format("shapefile").load(str(tmp_path)).collect()}
    lane = rows["lane", 0]
    assert lane.geom.kind == "line" and [[(p.x, p.y) for p in part] for part in lane.geom.parts] == [[(0, 0), (1, 1)], [(5, 5), (6, 6)]]
    assert lane.attributes == {"ID": "a", "COLOR": "1"} and rows["lane", 1].geom is None and rows["lane", 1].attributes["COLOR"] is None
    assert rows["sign", 0].geom.kind == "point" and rows["sign", 0].attributes is None
    assert R.clean_layer(spark.read.format("shapefile").load(str(tmp_path)), ["line"]).count() == 1


def test_sinks(spark, tmp_path):
    a, b = spark.range(3), spark.range(2)
    assert sinks.write_layers({"a": a, "bad": a.select("id", F.lit(1).alias("id")), "b": b}, str(tmp_path / "l")).keys() == {"bad"}
    assert {(r.layer, r["count"]) for r in spark.read.parquet(str(tmp_path / "l")).groupBy("layer").count().collect()} == {("a", 3), ("b", 2)}
    sinks.write_summary(spark.createDataFrame([(2, 'x,"y"'), (1, None)], "k int, v string"), str(tmp_path / "s.csv"), {"k": "Nummer", "v": "Wert"}, "k")
    assert (tmp_path / "s.csv").read_bytes().decode("utf-8") == '﻿,Nummer,Wert\n0,1,\n1,2,"x,""y"""\n'
    sinks.write_documents(spark.createDataFrame([(1, None)], "k int, v string"), str(tmp_path / "d"))
    assert spark.read.text(str(tmp_path / "d")).first()[0] == '{"k":1,"v":null}'


def test_tables_are_replaced_together(spark, tmp_path):
    folder = str(tmp_path / "store")
    sinks.replace_tables(spark, folder, {"head": spark.range(1), "rows": spark.range(5)})
    sinks.replace_tables(spark, folder, {"head": spark.range(2), "rows": spark.range(7)})
    assert (spark.read.parquet(f"{folder}/head").count(), spark.read.parquet(f"{folder}/rows").count()) == (2, 7)
    assert [p.name for p in tmp_path.iterdir()] == ["store"]


def test_upsert_counts_versions(spark):
    stored = spark.createDataFrame([("a", 1, 4), ("b", 2, 1)], "k string, v int, version int")
    new = spark.createDataFrame([("a", 5), ("a", 6), ("c", None)], "k string, v int")
    assert sorted((r.k, r.v, r.version) for r in sinks.upsert(stored, new, "k").collect()) == [("a", 6, 5), ("b", 2, 1), ("c", None, 1)]


def test_shapefiles_are_written(spark, tmp_path):
    schema = "attributes map<string,string>, geom struct<kind:string,parts:array<array<struct<x:double,y:double,z:double>>>>"
    lines = [({"ID": "a", "NAME": "straße"}, ("line", [[(0.0, 1.0, 2.0), (3.0, 4.0, None)], [(5.0, 5.0, 5.0), (6.0, 6.0, 6.0)]])), ({"ID": "b"}, None), (None, ("linestring", [[(1.0, 1.0, 1.0), (2.0, 2.0, 2.0)]]))]
    layers = {"lanes": spark.createDataFrame(lines, schema).coalesce(1), "signs": spark.createDataFrame([({"ID": str(i)}, ("point", [[(float(i), 0.0, 1.0)]])) for i in range(20)], schema).repartition(4)}
    for _ in range(2):
        shapefile.write_layers(layers, str(tmp_path))
    back = spark.read.format("shapefile").load(str(tmp_path / "lanes")).orderBy("row_no").collect()
    assert [r.attributes for r in back] == [{"ID": "a", "NAME": "straße"}, {"ID": "b", "NAME": None}, {"ID": None, "NAME": None}]
    assert [[tuple(p) for p in part] for part in back[0].geom.parts] == [[(0, 1, 2), (3, 4, 0)], [(5, 5, 5), (6, 6, 6)]] and back[0].geom.kind == "line" and back[1].geom is None
    signs = spark.read.format("shapefile").load(str(tmp_path / "signs"))
    assert sorted(int(r.attributes["ID"]) for r in signs.collect()) == list(range(20)) == sorted(int(r.geom.parts[0][0].x) for r in signs.collect())
    shp = next((tmp_path / "lanes").glob("*.shp")).read_bytes()
    assert struct.unpack(">i", shp[:4])[0] == 9994 and struct.unpack(">i", shp[24:28])[0] * 2 == len(shp) and struct.unpack("<2i4d", shp[28:68]) == (1000, 13, 0, 1, 6, 6)
    shx = next((tmp_path / "lanes").glob("*.shx")).read_bytes()
    assert struct.unpack(">i", shx[24:28])[0] * 2 == len(shx) and struct.unpack(">2i", shx[100:108])[0] == 50
    mixed = spark.createDataFrame([(None, ("point", [[(0.0, 0.0, 0.0)]])), (None, ("line", [[(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)]]))], schema).coalesce(1)
    with pytest.raises(Exception, match="one kind"):
        shapefile.write_layers({"mixed": mixed}, str(tmp_path))


def test_sqlite_and_areas(spark, tmp_path):
    import sqlite3

    con = sqlite3.connect(tmp_path / "c.db")
    con.execute("CREATE TABLE prompts (name TEXT, n INT)")
    con.executemany("INSERT INTO prompts VALUES (?, ?)", [("a", 1), ("b", None)])
    con.commit()
    con.close()
    assert [(r.row_no, json.loads(r.row)) for r in R.read_sqlite(spark, str(tmp_path), "prompts").orderBy("row_no").collect()] == [(0, {"name": "a", "n": 1}), (1, {"name": "b", "n": None})]
    assert R.read_sqlite(spark, str(tmp_path), "other").count() == 0
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    areas = spark.createDataFrame([("a", ("polygon", [ring])), ("a", ("polygon", [[(5.0, 5.0), *ring[1:]]])), ("l", ("line", [ring]))], "id string, geom struct<kind:string,parts:array<array<struct<x:double,y:double>>>>")
    assert len(R.area_by_id(areas, "a").first().geom.parts) == 2
    with pytest.raises(LookupError):
        R.area_by_id(areas, "z")
    with pytest.raises(TypeError):
        R.area_by_id(areas, "l")
