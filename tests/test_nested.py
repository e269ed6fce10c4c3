import json

from cairnflow.operators import nested
from cairnflow.plans import pipeline

INSTANCE = {"id": 1, "attrs": {"type": 3, "tags": ["a"]}, "data": {"points": [[1, 2, 3], None, [4, 5, 6]], "instance_list": [{"data": {"3dbox": [{"x": 1, "y": 2, "z": 3}]}}]}}


def found(store):
    return sorted((r.record_key, r.inst_path, r.field, r.point_pos) for r in store.points().collect())


def store(spark, *texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "label_id bigint, label_json string, id string")
    return nested.build_store(df, "label_id", "label_json")


def test_positions_and_depth(spark):
    s = store(spark, json.dumps({"detail": {"instance_list": [None, INSTANCE]}}))
    assert s.depth == 2
    assert found(s) == [(0, "1", "points", 0), (0, "1", "points", 2), (0, "1.0", "3dbox", 0)]


def test_shapes_stand_for_the_plain_list(spark):
    plain = [{"data": {"points": [[i, i]]}} for i in range(11)]
    shapes = [
        {"detail": {"instance_list": plain}},
        {"detail": {"instance_list": {str(i): v for i, v in reversed(list(enumerate(plain)))}}},
        {"detail": json.dumps({"instance_list": json.dumps(plain)})},
        {"detail": [{"instance_list": plain}]},
        {"instance_list": plain},
        {"detail": {"instance_list": [{"data": [v["data"]]} for v in plain]}},
    ]
    s = store(spark, *("﻿ \n" + json.dumps(x) + " " for x in shapes))
    by = {}
    for key, path, field, i in found(s):
        by.setdefault(key, []).append((path, field, i))
    assert len(by) == len(shapes)
    assert all(v == by[0] for v in by.values())
    assert len(by[0]) == 11
    # The same content is stored once: every shape has the same instances and root.
    assert s.occurrences().select("root_id").distinct().count() == 1
    assert s.objects("instance").count() == 11


def test_broken_records_have_no_case(spark):
    s = store(spark, None, "", "{", "null", "[1]", '{"a": NaN}', "[" * 5000, '{"detail": null}', '{"detail": {"instance_list": "no json"}}', '{"detail": {"instance_list": [1, "x", []]}}')
    assert found(s) == []
    status = {r.record_key: r.status for r in s.occurrences().collect()}
    assert [status[i] for i in range(10)] == ["empty", "empty", "broken", "no object", "no object", "broken", "broken", "ok", "ok", "ok"]


def test_repeats_and_empty(spark):
    text = json.dumps({"detail": {"instance_list": [INSTANCE, INSTANCE]}})
    df = spark.createDataFrame([(7, text), (7, text)], "label_id bigint, label_json string")
    rows = found(nested.build_store(df, "label_id", "label_json"))
    assert rows == [(7, p, f, o) for p, f, o in [("0", "points", 0), ("0", "points", 2), ("0.0", "3dbox", 0), ("1", "points", 0), ("1", "points", 2), ("1.0", "3dbox", 0)]]
    assert found(nested.build_store(df.limit(0), "label_id", "label_json")) == []


def brute(text):
    """Positions by a plain walk over the parsed record."""
    out = []

    def load(v):
        while isinstance(v, str):
            try:
                v = json.loads(v)
            except ValueError:
                return v
        return v

    def listed(v):
        v = load(v)
        return [v[k] for k in sorted(v, key=int)] if isinstance(v, dict) else v if isinstance(v, list) else []

    def walk(instances, prefix):
        for i, inst in enumerate(listed(instances)):
            inst = load(inst)
            if not isinstance(inst, dict):
                continue
            data = load(inst.get("data"))
            merged = {}
            for part in data if isinstance(data, list) else [data]:
                merged.update(part or {})
            path = prefix + str(i)
            for field in ("points", "3dbox"):
                out.extend((path, k) for k, p in enumerate(listed(merged.get(field))) if p is not None)
            walk(merged.get("instance_list"), path + ".")

    try:
        body = json.loads((text or "").strip().strip("﻿").strip())
    except ValueError:
        return []
    if isinstance(body, dict):
        detail = load(body.get("detail"))
        detail = detail[0] if isinstance(detail, list) else detail
        walk((detail if isinstance(detail, dict) else body).get("instance_list"), "")
    return out


def test_whole_table_against_a_plain_walk(spark, small):
    want = set()
    for r in pipeline.table(spark, small, "bev_labels").select("label_id", "label_json").collect():
        want |= {(r.label_id, p, i) for p, i in brute(r.label_json)}
    got = [tuple(r) for r in pipeline.p1_found(spark, small).collect()]
    assert len(got) == len(set(got))
    assert set(got) == want


def test_coordinates(spark):
    data = {"points": [[1, 2.5, 3], None, {"x": 1, "z": "4"}, [7, 8], [1.0, 2.0, 3.0], "[9, null, 9]", [1, 2, 3, 4]]}
    rows = store(spark, json.dumps({"instance_list": [{"data": data}]})).points(coordinates=True).collect()
    assert sorted((r.point_pos, r.x, r.y, r.z) for r in rows) == [(0, 1, 2.5, 3), (2, 1, None, 4), (3, 7, 8, None), (4, 1, 2, 3), (5, 9, None, 9), (6, 1, 2, 3)]


def test_very_deep_records_keep_their_rows(spark):
    depth = 3000
    text = '{"instance_list": [{"x": ' + "[" * 20_000 + "1" + "]" * 20_000 + ', "data": {"points": [[1, 2, 3]]}}]}'
    s = store(spark, text)
    assert [(r.status, r.root_id is None) for r in s.occurrences().collect()] == [("ok", False)]
    assert found(s) == [(0, "0", "points", 0)]
    builder = nested._Builder()
    builder.record(1, '{"instance_list": ' + '[{"data": {"points": [[0, 0, 0]], "instance_list": ' * depth + "[]" + "}}]" * depth + "}")
    assert [r[3] for r in builder.rows if r[0] == "occurrence"] == ["ok"] and builder.rows[-1][5] == depth
    assert sum(r[0] == "instance" for r in builder.rows) == depth


def test_the_deep_forms_agree_with_the_plain_ones():
    texts = ['{"a": [1, -2.5e3, true, null, "x\\u00e9\\n", {}, []], "b": {"c": {"d": 0}}}', "[]", ' "x" ', "-0", "[1,[2,[3]]]"]
    for t in texts:
        assert nested._deep_decode(t) == json.loads(t)
        assert nested._deep_encode(json.loads(t)) == nested._encode(json.loads(t))
    for t in ("", "[1,]", "{", '{"a"}', '{"a":1,}', "[1 2]", "NaN", "01", "1]", "tru"):
        try:
            nested._deep_decode(t)
        except ValueError:
            continue
        raise AssertionError(t)


def test_objects_are_stored_once(spark):
    shared = {"attrs": {"type": 1}, "data": {"points": [[0, 0, 0]]}}
    s = store(spark, *(json.dumps({"header": {"n": i % 3}, "instance_list": [shared] * 4}) for i in range(60)))
    assert s.occurrences().count() == 60 and s.objects("record").count() == 3 and s.objects("instance").count() == 1 and s.geometries().count() == 1
    assert s.bridge("instance_list").count() == 12 and s.points().count() == 240
