"""Queries of the data-preparation problems 1 to 6 on the project's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.operators import asof, compaction, nested, patches, spikes
from cairnflow.operators import references as refs
from cairnflow.session import materialise, scratch, shared_dir, table

LAYER_TARGETS = {
    "lane_lines": {"pre_id": "lane_lines", "next_id": "lane_lines", "lane_id": "lanes"},
    "lanes": {"pre_id": "lanes", "next_id": "lanes", "road_id": "roads"},
    "roads": {"pre_id": "roads", "next_id": "roads", "lane_id": "lanes"},
}
FEATURE_KEY = ["tileid", "feat_type", "feature_id"]
FEATURE_IMAGE = ["last_editor", "color", "shape_type", "length_m"]
POSITION_BOUNDS = [(-50_000.0, 50_000.0), (-50_000.0, 50_000.0), (-1_000.0, 9_000.0)]
SPIKE = {"least": 1.0, "times": 15.0, "half": 5, "longest": 3, "near": 3_000.0}


def _store(spark: SparkSession, d: str) -> nested.NestedStore:
    return nested.build_store(table(spark, d, "bev_labels"), "label_id", "label_json")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _store(spark, d).points().select(F.col("record_key").alias("label_id"), "inst_path", "point_pos")


def p1_instances(spark: SparkSession, d: str) -> DataFrame:
    store = _store(spark, d)
    body = store.objects("instance").select(F.col("id").alias("inst_id"), "payload")
    return store.instances().join(body, "inst_id").select(F.col("record_key").alias("label_id"), "inst_path", "parent_path", "ordinal", F.hex("inst_id").alias("inst_id"), F.get_json_object("payload", "$.id").alias("instance_no"))


def p1_attributes(spark: SparkSession, d: str) -> DataFrame:
    store = _store(spark, d)
    body = store.objects("attribute").select(F.col("id").alias("part_id"), F.get_json_object("payload", "$.name").alias("attr"), F.get_json_object("payload", "$.value").alias("attr_value"))
    return store.parts("attrs").join(body, "part_id").select(F.col("record_key").alias("label_id"), "inst_path", "attr", "attr_value")


def p1_points(spark: SparkSession, d: str) -> DataFrame:
    return _store(spark, d).points(coordinates=True).select(F.col("record_key").alias("label_id"), "inst_path", "field", "point_pos", "x", "y", "z")


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    return _store(spark, d).occurrences().select(F.col("record_key").alias("label_id"), F.hex("root_id").alias("root_id"), "status")


def _layers(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {name: table(spark, d, name) for name in LAYER_TARGETS}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return refs.orphan_references(_layers(spark, d), LAYER_TARGETS).select("layer", "id", "field", "ref_id").distinct()


def p2_by_month(spark: SparkSession, d: str) -> DataFrame:
    rows = refs.orphan_references(_layers(spark, d), LAYER_TARGETS).withColumn("month", F.date_format("at", "yyyy-MM"))
    return rows.select("layer", "month", "id", "field", "ref_id").distinct().groupBy("layer", "month").agg(F.count("*").alias("n_orphans"))


def p2_current(spark: SparkSession, d: str) -> DataFrame:
    """Keys with references and no existence after the last delta."""
    return refs.current_orphans(refs.key_states(_layers(spark, d), LAYER_TARGETS)).select(F.col("target").alias("layer"), F.col("key").alias("ref_id"), F.col("refs").alias("n_refs"))


def p2_maintained(spark: SparkSession, d: str) -> DataFrame:
    """The same from stored states: deliveries of odd days of the month first, those of even days put onto them."""
    layers = _layers(spark, d)
    odd = F.coalesce(F.dayofmonth("loaded_at") % 2 == 1, F.lit(False))
    stored = materialise(refs.key_states({n: df.where(odd) for n, df in layers.items()}, LAYER_TARGETS), "key-states")
    found = refs.current_orphans(refs.maintain(stored, refs.key_states({n: df.where(~odd) for n, df in layers.items()}, LAYER_TARGETS)))
    return found.select(F.col("target").alias("layer"), F.col("key").alias("ref_id"), F.col("refs").alias("n_refs"))


def _listing(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return compaction.consolidate_listing(spark, f"{d}/flat_mapping_info.parquet", "entry_id", "root_dir", "trail_id", ["cloud_path", "bev_json_path"], ["cloud_bytes", "bev_bytes"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    kept, entries = _listing(spark, d)
    # The listing is read a second time, packed like the first.
    with compaction.split_packing(spark, 64 << 20, 4 << 20):
        return materialise(entries.where("entry_id IS NOT NULL").select("entry_id").join(kept.select("entry_id"), "entry_id", "left_anti").distinct(), "repeated-entries")


def p3_containers(spark: SparkSession, d: str) -> DataFrame:
    kept, _ = _listing(spark, d)
    return kept.groupBy("container").agg(F.count("*").alias("n_pairs"), F.sum("bytes").alias("n_bytes"))


def p3_totals(spark: SparkSession, d: str) -> DataFrame:
    """What the containers hold together, and how many are over the limit with more than one pair."""
    per = p3_containers(spark, d)
    over = F.count_if((F.col("n_pairs") > 1) & (F.col("n_bytes") > 128 << 20))
    return per.agg(F.sum("n_pairs").alias("n_pairs"), F.sum("n_bytes").alias("n_bytes"), over.alias("n_over"))


def p3_repacked(spark: SparkSession, d: str) -> DataFrame:
    """The label records, laid out as many small files and consolidated again; every row as often as before."""
    small, target = (f"{shared_dir(spark)}/{n}-{uuid.uuid4().hex}" for n in ("small-files", "well-sized"))
    rows = table(spark, d, "flat_mapping_info").select("entry_id", "trail_id", "cloud_path", "cloud_bytes")
    rows.withColumn("folder", F.pmod(F.xxhash64("trail_id", "cloud_path"), F.lit(64))).repartition(4).write.partitionBy("folder").parquet(small)
    out = compaction.consolidate_table(spark, small, target)
    scratch(spark, small, target)
    return out.drop("folder")


def _patches(spark: SparkSession, d: str) -> DataFrame:
    changes = table(spark, d, "feature_changes")
    return patches.compose(changes, FEATURE_KEY, ["tile_version", "version"], ["change_id"], patches.says_delete(F.col("is_deleted"), F.col("op")), FEATURE_IMAGE)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    state = patches.apply_patches(None, _patches(spark, d), FEATURE_KEY, FEATURE_IMAGE)
    return state.select(*FEATURE_KEY, F.col("order_tile_version").alias("tile_version"), F.col("order_version").alias("version"))


def p4_state(spark: SparkSession, d: str) -> DataFrame:
    state = patches.apply_patches(None, _patches(spark, d), FEATURE_KEY, FEATURE_IMAGE)
    return state.select(*FEATURE_KEY, *FEATURE_IMAGE)


def p4_onto_base(spark: SparkSession, d: str) -> DataFrame:
    """The changes from tile version 12 on, updates among them as partial changes, put onto the state the earlier ones left."""
    changes = table(spark, d, "feature_changes")
    gone = patches.says_delete(F.col("is_deleted"), F.col("op"))
    late = F.coalesce(F.col("tile_version"), F.lit(0)) >= 12
    how = {"keys": FEATURE_KEY, "order": ["tile_version", "version"], "tie": ["change_id"], "delete": gone, "image": FEATURE_IMAGE}
    base = patches.apply_patches(None, patches.compose(changes.where(~late), **how), FEATURE_KEY, FEATURE_IMAGE)
    partial = F.coalesce(F.lower(F.trim("op")).isin("u", "upd", "update", "modify"), F.lit(False))
    state = patches.apply_patches(base, patches.compose(changes.where(late), **how, partial=partial), FEATURE_KEY, FEATURE_IMAGE)
    return state.select(*FEATURE_KEY, *FEATURE_IMAGE)


def p5_pairs(spark: SparkSession, d: str) -> DataFrame:
    poses = table(spark, d, "key_poses").select("pose_id", F.trim("trail_id").alias("trail_id"), asof.epoch_micros(F.regexp_extract("frame_id_str", r"^\s*([0-9.]+)_", 1)).alias("at"))
    frames = table(spark, d, "frames").select("frame_no", F.trim("trail_id").alias("trail_id"), (F.col("stamp_ms") * 1000).alias("at"))
    return asof.nearest_time(poses, frames, "pose_id", "frame_no", "trail_id", "at", tolerance=30_000, bucket=60_000_000)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_pairs(spark, d).select(F.col("left_id").alias("pose_id"), F.col("right_id").alias("frame_no"))


def p6_frames(spark: SparkSession, d: str) -> DataFrame:
    return spikes.implausible(table(spark, d, "frames"), "trail_id", "stamp_ms", "frame_no", "opt_t_world_veh", POSITION_BOUNDS, block=600_000, spike=SPIKE)


def p6_trail_params(spark: SparkSession, d: str) -> DataFrame:
    params = table(spark, d, "trail_params").withColumn("at", F.unix_micros(F.col("run_at").cast("timestamp")))
    return spikes.implausible_rates(params, "vehicle_id", "at", "param_id", "bad_ins", "all_ins", 5.0, block=86_400_000_000)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    a = p6_frames(spark, d).select(F.lit("frames").alias("src"), F.col("id").alias("row_id"))
    return a.unionByName(p6_trail_params(spark, d).select(F.lit("trail_params").alias("src"), F.col("id").alias("row_id")))


def p6_impossible(spark: SparkSession, d: str) -> DataFrame:
    both = {"frames": p6_frames(spark, d), "trail_params": p6_trail_params(spark, d)}
    a, b = (df.where("impossible").select(F.lit(src).alias("src"), F.col("id").alias("row_id")) for src, df in both.items())
    return a.unionByName(b)


def p6_stuck(spark: SparkSession, d: str) -> DataFrame:
    both = {"frames": p6_frames(spark, d), "trail_params": p6_trail_params(spark, d)}
    a, b = (df.where("stuck").select(F.lit(src).alias("src"), F.col("id").alias("row_id")) for src, df in both.items())
    return a.unionByName(b)


def p6_high_rates(spark: SparkSession, d: str) -> DataFrame:
    return p6_trail_params(spark, d).where("spike").select("id")


QUERIES = {f.__name__: f for f in (
    p1_found, p1_records, p1_instances, p1_attributes, p1_points, p2_found, p2_by_month, p2_current, p2_maintained, p3_found, p3_containers, p3_totals, p3_repacked,
    p4_found, p4_state, p4_onto_base, p5_found, p5_pairs, p6_found, p6_frames, p6_trail_params, p6_impossible, p6_stuck, p6_high_rates,
)}

_LAYER_SQL = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, upper(trim(id, ' \t\n')) AS id, loaded_at AS moment, '{field}' AS field, '{target}' AS target, unnest(regexp_split_to_array(coalesce({field}, ''), '[,;|/\\s]+')) AS raw FROM {layer} WHERE NOT coalesce(is_deleted, false)"
    for layer, fields in LAYER_TARGETS.items()
    for field, target in fields.items()
)
_STATE_SQL = " UNION ALL ".join(f"SELECT '{n}' AS target, upper(trim(id, ' \t\n')) AS key, loaded_at AS moment, bool_and(coalesce(is_deleted, false)) AS gone FROM {n} GROUP BY ALL" for n in LAYER_TARGETS)
_ORPHAN_SQL = f"""WITH r AS (SELECT DISTINCT layer, id, moment, field, target, upper(trim(raw)) AS ref_id FROM ({_LAYER_SQL}) WHERE upper(trim(raw)) NOT IN ('', '0', '-1', 'NULL', 'NONE', 'NAN')),
 s AS ({_STATE_SQL}),
 o AS (SELECT r.* FROM r ASOF LEFT JOIN s ON r.target = s.target AND r.ref_id = s.key AND r.moment >= s.moment WHERE coalesce(s.gone, true))"""
_ENDS = " \t\n\r\f\u000b\u00a0\u3000\ufeff"
_SCHEME = "regexp_replace(regexp_replace({}, '^file:(//(localhost)?)?(/)', '\\3', 'i'), '^file:/*', '', 'i')"


def _path_sql(column: str) -> str:
    text = _SCHEME.format(f"trim({column}, '{_ENDS}')")
    start = f"concat_ws('/', {_SCHEME.format("trim(coalesce(root_dir, ''))")}, {_SCHEME.format("trim(coalesce(trail_id, ''))")}, {text})"
    steps = f"list_filter(regexp_split_to_array(CASE WHEN starts_with({text}, '/') THEN {text} ELSE {start} END, '/+'), lambda s: s NOT IN ('', '.'))"
    return f"CASE WHEN length({text}) > 0 THEN '/' || array_to_string(list_reduce({steps}, lambda done, s: CASE WHEN s = '..' THEN done[:-2] ELSE done || [s] END, CAST([] AS VARCHAR[])), '/') END"


_ENTRY_SQL = f"SELECT entry_id, {_path_sql('cloud_path')} AS a, {_path_sql('bev_json_path')} AS b, greatest(coalesce(cloud_bytes, 0), 0) + greatest(coalesce(bev_bytes, 0), 0) AS n FROM flat_mapping_info"
_CURRENT_SQL = f"""WITH n AS (SELECT target, ref, count(*) AS n_refs FROM (SELECT target, unnest(list_distinct(list_transform(list_filter(regexp_split_to_array(coalesce(packed, ''), '[,;|/\\s]+'), lambda v: upper(trim(v)) NOT IN ('', '0', '-1', 'NULL', 'NONE', 'NAN')), lambda v: upper(trim(v))))) AS ref FROM
 ({" UNION ALL ".join(f"SELECT '{t}' AS target, {f} AS packed FROM {n} WHERE NOT coalesce(is_deleted, false)" for n, fields in LAYER_TARGETS.items() for f, t in fields.items())})) GROUP BY ALL),
 l AS (SELECT target, key, arg_max(gone, moment) AS gone FROM ({_STATE_SQL}) GROUP BY ALL)
 SELECT n.target AS layer, n.ref AS ref_id, n_refs FROM n LEFT JOIN l ON n.target = l.target AND n.ref = l.key WHERE coalesce(gone, true)"""
_DELETE_SQL = "coalesce(is_deleted, false) OR coalesce(lower(trim(op)) IN ('d', 'del', 'delete', 'deleted', 'remove', 'removed', 'rm'), false)"
_LAST_SQL = f"SELECT *, {_DELETE_SQL} AS gone FROM feature_changes QUALIFY row_number() OVER (PARTITION BY tileid, feat_type, feature_id ORDER BY coalesce(tile_version, 0) DESC, coalesce(version, 0) DESC, change_id DESC) = 1"
_PLACE = "(coalesce(tile_version, 0), coalesce(version, 0), change_id)"
_BASE_SQL = f"""WITH c AS (SELECT *, {_DELETE_SQL} AS gone, {_PLACE} AS place,
   coalesce(lower(trim(op)) IN ('u', 'upd', 'update', 'modify') AND NOT ({_DELETE_SQL}) AND coalesce(tile_version, 0) >= 12, false) AS part FROM feature_changes),
 r AS (SELECT tileid, feat_type, feature_id, max(place) FILTER (WHERE NOT part) AS whole, arg_max(gone, place) AS gone FROM c GROUP BY ALL)
 SELECT c.tileid, c.feat_type, c.feature_id, {", ".join(f"(arg_max(struct_pack(v := {x}), place) FILTER (WHERE place = whole OR part AND {x} IS NOT NULL AND (whole IS NULL OR place > whole))).v AS {x}" for x in FEATURE_IMAGE)}
 FROM c JOIN r ON c.tileid IS NOT DISTINCT FROM r.tileid AND c.feat_type IS NOT DISTINCT FROM r.feat_type AND c.feature_id IS NOT DISTINCT FROM r.feature_id
 WHERE NOT r.gone GROUP BY ALL"""
_TIME_SQL = """SELECT DISTINCT pose_id, trim(trail_id) AS trail_id, v AS num FROM (SELECT *, try_cast(regexp_extract(frame_id_str, '^\\s*([0-9]{9,20}(\\.[0-9]{1,9})?)_', 1) AS DECIMAL(38, 9)) AS v FROM key_poses) WHERE v >= 100000000"""
_PAIR_SQL = f"""WITH p AS (SELECT pose_id, trail_id, CAST(round(CASE WHEN num < 1e11 THEN num * 1000000 WHEN num < 1e14 THEN num * 1000 WHEN num < 1e17 THEN num ELSE num / 1000 END) AS BIGINT) AS left_at FROM ({_TIME_SQL})),
 f AS (SELECT DISTINCT frame_no, trail_id, stamp_ms * 1000 AS right_at FROM frames WHERE stamp_ms IS NOT NULL)
 SELECT pose_id, frame_no, left_at, right_at FROM p JOIN f ON p.trail_id = f.trail_id AND right_at BETWEEN left_at - 30000 AND left_at + 30000
 QUALIFY row_number() OVER (PARTITION BY pose_id ORDER BY abs(left_at - right_at), right_at, frame_no) = 1"""

_READINGS_SQL = "SELECT DISTINCT frame_no, trail_id, stamp_ms, opt_t_world_veh[1] AS x, opt_t_world_veh[2] AS y, opt_t_world_veh[3] AS z FROM frames WHERE trail_id IS NOT NULL AND stamp_ms IS NOT NULL AND len(opt_t_world_veh) = 3 AND len(list_filter(opt_t_world_veh, lambda v: v IS NOT NULL)) = 3"
_PARAMS_SQL = "SELECT DISTINCT param_id, vehicle_id, run_at, CAST(bad_ins AS DOUBLE) AS bad, CAST(all_ins AS DOUBLE) AS total FROM trail_params WHERE bad_ins IS NOT NULL"
_WRONG_SQL = "(bad < 0 OR coalesce(bad > total, false))"


def _runs_sql(rows: str, src: str, key: str, source: str, order: str, value: str) -> str:
    by = f"PARTITION BY {source} ORDER BY {order}, {key}"
    starts = f"SELECT *, CASE WHEN {value} = lag({value}) OVER ({by}) AND NOT isnan({value}) THEN 0 ELSE 1 END AS begins FROM ({rows}) WHERE {source} IS NOT NULL AND {order} IS NOT NULL"
    runs = f"SELECT *, sum(begins) OVER ({by} ROWS UNBOUNDED PRECEDING) AS run FROM ({starts})"
    return f"SELECT '{src}' AS src, {key} AS row_id FROM ({runs}) QUALIFY count(*) OVER (PARTITION BY {source}, run) >= 6"


_STUCK_SQL = " UNION ".join([*[_runs_sql(_READINGS_SQL, "frames", "frame_no", "trail_id", "stamp_ms", axis) for axis in "xyz"], _runs_sql(_PARAMS_SQL, "trail_params", "param_id", "vehicle_id", "run_at", "bad")])
_IN_BOUNDS = " AND ".join(f"{a} BETWEEN {low} AND {high}" for a, (low, high) in zip("xyz", POSITION_BOUNDS))

ORACLE = {
    "p6_impossible": f"SELECT 'frames' AS src, frame_no AS row_id FROM ({_READINGS_SQL}) WHERE NOT ({_IN_BOUNDS}) UNION SELECT 'trail_params', param_id FROM ({_PARAMS_SQL}) WHERE {_WRONG_SQL}",
    "p6_stuck": _STUCK_SQL,
    "p6_high_rates": f"""WITH r AS (SELECT *, CASE WHEN NOT {_WRONG_SQL} AND total > 0 THEN bad / total END AS rate FROM ({_PARAMS_SQL})), u AS (SELECT vehicle_id, quantile_disc(rate, 0.5) AS usual FROM r GROUP BY vehicle_id)
 SELECT DISTINCT param_id AS id FROM r JOIN u ON r.vehicle_id IS NOT DISTINCT FROM u.vehicle_id WHERE rate > 0 AND rate >= 5 * usual""",
    "p2_found": f"{_ORPHAN_SQL} SELECT DISTINCT layer, id, field, ref_id FROM o",
    "p2_by_month": f"{_ORPHAN_SQL} SELECT layer, strftime(moment, '%Y-%m') AS month, count(DISTINCT (id, field, ref_id)) AS n_orphans FROM o GROUP BY ALL",
    "p2_current": _CURRENT_SQL,
    "p2_maintained": _CURRENT_SQL,
    "p3_found": f"SELECT DISTINCT entry_id FROM ({_ENTRY_SQL}) e JOIN (SELECT a, b, min(entry_id) AS first FROM ({_ENTRY_SQL}) GROUP BY a, b) k ON e.a IS NOT DISTINCT FROM k.a AND e.b IS NOT DISTINCT FROM k.b WHERE entry_id <> first",
    "p3_totals": f"SELECT count(*) AS n_pairs, sum(n) AS n_bytes, 0 AS n_over FROM (SELECT a, b, max(n) AS n FROM ({_ENTRY_SQL}) GROUP BY a, b)",
    "p3_repacked": "SELECT entry_id, trail_id, cloud_path, cloud_bytes FROM flat_mapping_info",
    "p4_found": f"SELECT tileid, feat_type, feature_id, coalesce(tile_version, 0) AS tile_version, version FROM ({_LAST_SQL}) WHERE NOT gone",
    "p4_state": f"SELECT tileid, feat_type, feature_id, last_editor, color, shape_type, length_m FROM ({_LAST_SQL}) WHERE NOT gone",
    "p4_onto_base": _BASE_SQL,
    "p5_found": f"SELECT pose_id, frame_no FROM ({_PAIR_SQL})",
    "p5_pairs": f"SELECT pose_id AS left_id, frame_no AS right_id, left_at, right_at FROM ({_PAIR_SQL})",
}
