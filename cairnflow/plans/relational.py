"""Queries of filters, aggregates, sets, top-k and text functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnflow.functions import text as X
from cairnflow.operators import aggregates as A
from cairnflow.operators import filters as C
from cairnflow.plans.catalog import Catalog
from cairnflow.session import table

catalog = Catalog()
add = catalog.add

# Filters


@add("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice >= 1000 AND o_orderpriority <> '5-LOW' AND o_custkey > 10")
def f1_conjunctive(spark: SparkSession, d: str) -> DataFrame:
    conditions = {"o_orderstatus": {"value": ["O", "F"], "operator": "in"}, "o_totalprice": {"value": 1000, "operator": "ge"}, "o_orderpriority": {"value": "5-LOW", "operator": "neq"}, "o_custkey": {"value": 10, "operator": "gt"}}
    return C.filter_rows(table(spark, d, "orders"), conditions).select("o_orderkey", "o_totalprice")


@add("SELECT id, loaded_at FROM lane_lines WHERE color = 1")
def f2_equals(spark: SparkSession, d: str) -> DataFrame:
    return C.filter_rows(table(spark, d, "lane_lines"), {"color": 1}).select("id", "loaded_at")


@add("SELECT id, loaded_at FROM lane_lines WHERE color IS DISTINCT FROM 1")
def f3_not_equals(spark: SparkSession, d: str) -> DataFrame:
    return C.filter_rows(table(spark, d, "lane_lines"), {"color": {"value": 1, "operator": "neq"}}).select("id", "loaded_at")


@add("SELECT pose_id, received_at FROM key_poses WHERE try_cast(replace(frame_id_str, '_', 'x') AS DOUBLE) >= 10 OR try_cast(trail_id AS DOUBLE) < 20000000")
def f4_numeric_text(spark: SparkSession, d: str) -> DataFrame:
    poses = table(spark, d, "key_poses")
    either = C.predicate(poses, "frame_id_str", C.Condition(10, "ge")) | C.predicate(poses, "trail_id", C.Condition(20000000, "lt"))
    return poses.where(either).select("pose_id", "received_at")


@add("SELECT id, loaded_at FROM roads WHERE kind IN (1, 2, 99)")
def f5_in(spark: SparkSession, d: str) -> DataFrame:
    return C.filter_rows(table(spark, d, "roads"), {"kind": {"value": [1, 2, 99], "operator": "in"}}).select("id", "loaded_at")


@add("SELECT id, loaded_at FROM roads WHERE kind IS NULL OR kind NOT IN (1, 2, 99)")
def f6_not_in(spark: SparkSession, d: str) -> DataFrame:
    return C.filter_rows(table(spark, d, "roads"), {"kind": {"value": [1, 2, 99], "operator": "not in"}}).select("id", "loaded_at")


@add("SELECT id, loaded_at FROM roads WHERE speed < 60")
def f8_missing_column(spark: SparkSession, d: str) -> DataFrame:
    """The column absent from the table is constant false, which equals 0."""
    return C.filter_rows(table(spark, d, "roads"), {"absent": 0, "speed": {"value": 60, "operator": "lt"}}).select("id", "loaded_at")


@add("SELECT 'kind is one of [1, 2] AND speed is at least 30' AS sentence, count(*) AS n FROM roads WHERE kind IN (1, 2) AND speed >= 30")
def f9_described(spark: SparkSession, d: str) -> DataFrame:
    conditions = {"kind": {"value": [1, 2], "operator": "in"}, "speed": {"value": 30, "operator": "ge"}}
    return C.filter_rows(table(spark, d, "roads"), conditions).agg(F.count("*").alias("n")).select(F.lit(C.describe(conditions)).alias("sentence"), "n")


@add("SELECT id, loaded_at, geom.kind AS kind FROM lane_lines WHERE geom.kind IN ('line', 'multiline')")
def f11_geometry_kind(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lane_lines").where(F.col("geom.kind").isin("line", "multiline")).select("id", "loaded_at", F.col("geom.kind").alias("kind"))


@add("SELECT id, loaded_at, part_no, len(part) AS n_vertices FROM (SELECT id, loaded_at, unnest(geom.parts) AS part, generate_subscripts(geom.parts, 1) - 1 AS part_no FROM lanes)")
def f12_single_parts(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "lanes").select("id", "loaded_at", F.posexplode("geom.parts").alias("part_no", "part"))
    return parts.select("id", "loaded_at", F.col("part_no").cast("bigint").alias("part_no"), F.size("part").cast("bigint").alias("n_vertices"))


@add("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag = 'R'")
def f13_field_range(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").where(F.col("l_quantity").between(10, 20) & (F.col("l_returnflag") == "R")).select("l_orderkey", "l_linenumber", "l_quantity")


@add("SELECT change_id, tileid FROM feature_changes WHERE (feat_type & 3) = 3")
def f14_label_bits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "feature_changes").where(F.col("feat_type").bitwiseAND(3) == 3).select("change_id", "tileid")


@add(
    """SELECT l_orderkey, l_linenumber, CASE WHEN y < 3 THEN 4.0 WHEN y < 6 THEN 6.0 ELSE 8.0 END AS start_x, CASE WHEN y < 3 THEN 14.0 WHEN y < 6 THEN 16.0 ELSE 18.0 END AS end_x
 FROM (SELECT l_orderkey, l_linenumber, abs(l_quantity / 5 - 4) AS y FROM lineitem) WHERE y <= 6 AND l_orderkey IS NOT NULL"""
)
def f16_bucketed_window(spark: SparkSession, d: str) -> DataFrame:
    """Quantities, scaled to sideways distances of -4 to 6 m, with the stretch each is sampled in."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C.sampling_window(F.col("l_quantity") / 5 - 4).alias("w"))
    return rows.where("w IS NOT NULL AND l_orderkey IS NOT NULL").select("l_orderkey", "l_linenumber", F.col("w.start").alias("start_x"), F.col("w.end").alias("end_x"))


@add("SELECT entry_id, cloud_bytes FROM flat_mapping_info WHERE cloud_bytes * 16 >= 512000")
def f17_whole_scans(spark: SparkSession, d: str) -> DataFrame:
    """The listing's sizes are a sixteenth of real scans', so they are scaled before the limit of 500 KiB applies."""
    scaled = table(spark, d, "flat_mapping_info").withColumn("scaled", F.col("cloud_bytes") * 16)
    return C.whole_scans(scaled, "scaled").select("entry_id", "cloud_bytes")


@add("SELECT vehicle_id, sum(bad_ins) AS n_bad, sum(all_ins) AS n_all, CASE WHEN sum(all_ins) > 0 THEN concat(CAST(round_even(100 * sum(bad_ins) / sum(all_ins), 2) AS VARCHAR), '%') ELSE '' END AS bad_share FROM trail_params GROUP BY vehicle_id")
def f18_bad_share(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "trail_params").groupBy("vehicle_id").agg(F.sum("bad_ins").alias("n_bad"), F.sum("all_ins").alias("n_all"))
    return rows.withColumn("bad_share", C.bad_share(F.col("n_bad"), F.col("n_all")))


@add("SELECT frame_no, received_at FROM frames WHERE len(opt_q_world_veh) = 4 AND len(opt_t_world_veh) = 3")
def f19_valid_pose(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "frames").where("size(opt_q_world_veh) = 4 AND size(opt_t_world_veh) = 3").select("frame_no", "received_at")


#: Allowed codes of the layers' columns.
_RULES = {
    "lane_lines": [C.Rule("id", nullable=False), C.Rule("color", "int", allowed=(1, 2, 3, 4, 5, 6, 7, 99)), C.Rule("shape_type", "int", allowed=(1, 2, 3, 4, 5, 6, 7, 99)), C.Rule("alg_id", "int", nullable=False), C.Rule("version", nullable=False)],
    "roads": [
        C.Rule("id", nullable=False), C.Rule("kind", "int", allowed=(0, 1, 2, 3, 4, 5, 6, 99)), C.Rule("is_bidir", "int", allowed=(1, 2)), C.Rule("scen_type", "int", allowed=(0, 1, 2, 3, 4, 5, 99)),
        C.Rule("road_type", "int", allowed=(*range(20), 99)), C.Rule("alg_id", "int", nullable=False), C.Rule("heading", "float"),
    ],
}


@add(
    """SELECT * FROM (
 SELECT 'lane_lines' AS layer, 'color' AS rule_column, 'domain' AS rule, count(*) AS n_bad FROM lane_lines WHERE color NOT IN (1, 2, 3, 4, 5, 6, 7, 99)
 UNION ALL SELECT 'lane_lines', 'shape_type', 'domain', count(*) FROM lane_lines WHERE shape_type NOT IN (1, 2, 3, 4, 5, 6, 7, 99)
 UNION ALL SELECT 'lane_lines', 'id', 'null', count(*) FROM lane_lines WHERE id IS NULL
 UNION ALL SELECT 'lane_lines', 'alg_id', 'null', count(*) FROM lane_lines WHERE alg_id IS NULL
 UNION ALL SELECT 'lane_lines', 'version', 'null', count(*) FROM lane_lines WHERE version IS NULL
 UNION ALL SELECT 'roads', 'id', 'null', count(*) FROM roads WHERE id IS NULL
 UNION ALL SELECT 'roads', 'kind', 'domain', count(*) FROM roads WHERE kind NOT IN (0, 1, 2, 3, 4, 5, 6, 99)
 UNION ALL SELECT 'roads', 'is_bidir', 'domain', count(*) FROM roads WHERE is_bidir NOT IN (1, 2)
 UNION ALL SELECT 'roads', 'scen_type', 'domain', count(*) FROM roads WHERE scen_type NOT IN (0, 1, 2, 3, 4, 5, 99)
 UNION ALL SELECT 'roads', 'road_type', 'domain', count(*) FROM roads WHERE road_type NOT BETWEEN 0 AND 19 AND road_type <> 99
 UNION ALL SELECT 'roads', 'alg_id', 'null', count(*) FROM roads WHERE alg_id IS NULL
 UNION ALL SELECT 'roads', 'heading', 'missing', 1) WHERE n_bad > 0"""
)
def f25_integrity(spark: SparkSession, d: str) -> DataFrame:
    a, b = (C.integrity(table(spark, d, n), n, rules) for n, rules in _RULES.items())
    return a.unionByName(b)


@add("SELECT entry_id, CASE WHEN contains(bev_json_path, 'bev_label_v2') THEN 'label2.json' WHEN contains(bev_json_path, 'bev_label') THEN 'label.json' ELSE bev_json_path END AS renamed FROM flat_mapping_info WHERE bev_json_path LIKE '%.json'")
def f26_renamed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "flat_mapping_info").where(F.col("bev_json_path").endswith(".json"))
    return rows.select("entry_id", C.first_match(F.col("bev_json_path"), {"bev_label_v2": "label2", "bev_label": "label"}, partial=True).alias("renamed"))


@add("SELECT event_type, CAST(sum(CASE WHEN value >= 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_success FROM events GROUP BY event_type")
def f28_status(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(F.when(F.col("value") >= 0, 1).otherwise(0)).alias("n_success"))


# Aggregates: checks are order priorities, their rows are lines


_CHECKS = """SELECT o_custkey, o_orderpriority, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'P0' WHEN '2' THEN 'P1' ELSE 'P2' END AS level,
 CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 3 WHEN '2' THEN 2 ELSE 1 END AS w, count(*) AS total_count, count(*) FILTER (WHERE l_returnflag = 'R') AS log_count
 FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL"""


def _checks(spark: SparkSession, d: str) -> DataFrame:
    digit = F.substring("o_orderpriority", 1, 1)
    rows = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    level, weight = F.when(digit == "1", "P0").when(digit == "2", "P1").otherwise("P2"), F.when(digit == "1", 3).when(digit == "2", 2).otherwise(1)
    counted = rows.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("total_count"), F.count_if(F.col("l_returnflag") == "R").alias("log_count"))
    return counted.withColumn("level", level).withColumn("level_weight", weight)


@add(f"SELECT o_custkey, round_even(round(CAST(sum((1 - log_count / total_count) * w) / sum(w) AS DOUBLE), 9), 3) AS score FROM ({_CHECKS}) GROUP BY o_custkey")
def a1_weighted_score(spark: SparkSession, d: str) -> DataFrame:
    return A.weighted_score(_checks(spark, d), ["o_custkey"])


@add(
    """SELECT c_mktsegment, CASE WHEN i > 0 THEN m / i ELSE 0 END AS precision, CASE WHEN t > 0 THEN m / t ELSE 0 END AS recall, CASE WHEN m > 0 THEN 2 * (m / i) * (m / t) / (m / i + m / t) ELSE 0 END AS f1
 FROM (SELECT c_mktsegment, count(*) FILTER (WHERE o_orderkey IS NOT NULL AND c_acctbal > 0) AS m, count(o_orderkey) AS i, count(*) FILTER (WHERE c_acctbal > 0) AS t FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment)"""
)
def a2_precision_recall(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    counted = rows.groupBy("c_mktsegment").agg(F.count_if(F.col("o_orderkey").isNotNull() & (F.col("c_acctbal") > 0)).alias("m"), F.count("o_orderkey").alias("i"), F.count_if(F.col("c_acctbal") > 0).alias("t"))
    return counted.select("c_mktsegment", *A.precision_recall(F.col("m"), F.col("i"), F.col("t")))


@add("SELECT event_type, round(avg(value), 6) AS mean_v, max(value) AS max_v, min(value) AS min_v FROM events GROUP BY event_type")
def a3_distance_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean_v"), F.max("value").alias("max_v"), F.min("value").alias("min_v"))


@add("WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events) SELECT round(m, 6) AS mean, round(s, 6) AS sigma, count(*) FILTER (WHERE value <= 2 * s) AS n_kept, round(avg(value) FILTER (WHERE value <= 2 * s), 6) AS mean_kept FROM events, s GROUP BY m, s")
def a4_two_sigma(spark: SparkSession, d: str) -> DataFrame:
    return A.within_two_sigma(table(spark, d, "events"), "value").select(F.round("mean", 6).alias("mean"), F.round("sigma", 6).alias("sigma"), "n_kept", F.round("mean_kept", 6).alias("mean_kept"))


@add("SELECT event_type, round(quantile_cont(value, 0.5), 6) AS med, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY event_type")
def a5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.median("value"), 6).alias("med"), F.round(F.percentile("value", 0.95), 6).alias("p95"))


@add(
    """WITH b AS (SELECT CAST(CASE WHEN v < 0.1 THEN 0 WHEN v < 0.2 THEN 1 WHEN v < 0.3 THEN 2 WHEN v < 0.4 THEN 3 WHEN v < 0.5 THEN 4 ELSE 5 END AS INT) AS bin, count(*) AS n
 FROM (SELECT l_discount * 10 AS v FROM lineitem) WHERE v BETWEEN 0 AND 1 GROUP BY 1)
 SELECT bin, n, round(n / CASE bin WHEN 5 THEN 0.5::DOUBLE WHEN 2 THEN 0.3::DOUBLE - 0.2::DOUBLE WHEN 3 THEN 0.4::DOUBLE - 0.3::DOUBLE ELSE 0.1::DOUBLE END / sum(n / CASE bin WHEN 5 THEN 0.5::DOUBLE ELSE 0.1::DOUBLE END) OVER (), 6) AS share FROM b"""
)
def a6_histogram(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select((F.col("l_discount") * 10).alias("v"))
    return A.density_histogram(rows, "v").select("bin", "n", F.round("share", 6).alias("share"))


@add("SELECT l_returnflag, round(sum(l_quantity), 2) AS total_len, min(l_extendedprice) AS least, max(l_extendedprice) AS most, round(avg(l_extendedprice), 4) AS mean, arg_max(l_orderkey, (l_extendedprice, l_orderkey, l_linenumber)) AS longest FROM lineitem GROUP BY l_returnflag")
def a7_length_stats(spark: SparkSession, d: str) -> DataFrame:
    longest = F.max_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey", "l_linenumber"))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum("l_quantity"), 2).alias("total_len"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most"), F.round(F.avg("l_extendedprice"), 4).alias("mean"), longest.alias("longest"))


@add("SELECT trail_id, count(*) AS n_points FROM (SELECT DISTINCT trail_id, opt_t_world_veh[1] AS x, opt_t_world_veh[2] AS y FROM frames WHERE len(opt_t_world_veh) = 3) GROUP BY trail_id")
def a8_point_union(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "frames").where("size(opt_t_world_veh) = 3").select("trail_id", F.col("opt_t_world_veh")[0].alias("x"), F.col("opt_t_world_veh")[1].alias("y")).distinct().groupBy("trail_id").agg(F.count("*").alias("n_points"))


_POINTS = "(SELECT l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 10 AS z, l_orderkey * 10 + l_linenumber AS pid, l_tax AS f FROM lineitem)"


def points(spark: SparkSession, d: str) -> DataFrame:
    """Lines as a cloud of points: x, y, z, an id and a label."""
    return table(spark, d, "lineitem").select(
        F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 10).alias("z"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pid"), F.col("l_tax").alias("f")
    )


@add(f"SELECT cx AS cell_x, cy AS cell_y, arg_min(pid, (f, pid)) AS pid FROM (SELECT CAST(round((x + 50000) / 2.0) AS BIGINT) AS cx, CAST(round((y + 50000) / 2.0) AS BIGINT) AS cy, pid, f FROM {_POINTS}) GROUP BY cx, cy")
def a11_voxel_best(spark: SparkSession, d: str) -> DataFrame:
    return A.voxel_best(points(spark, d), ["x", "y"], 2.0, F.struct("f", "pid"), ["pid"])


@add()
def a12_voxel_sample(spark: SparkSession, d: str) -> DataFrame:
    return A.voxel_sample(points(spark, d), ["x", "y", "z"], 2.0, "pid")


@add(f"SELECT CAST(trunc(x / 2.5) AS BIGINT) AS cell_x, CAST(trunc(y / 2.5) AS BIGINT) AS cell_y, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z, count(*) AS n FROM {_POINTS} GROUP BY 1, 2")
def a13_voxel_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = A.voxel_mean(points(spark, d), ["x", "y"], 2.5, ["x", "y", "z"], truncate=True)
    return rows.select("cell_x", "cell_y", *[F.round(c, 6).alias(c) for c in "xyz"], "n")


@add(f"SELECT CAST(floor(x / 2.5) AS BIGINT) AS cell_x, CAST(floor(y / 2.5) AS BIGINT) AS cell_y, CAST(floor(z / 0.5) AS BIGINT) AS cell_z, round(avg(x), 6) AS x, round(avg(y), 6) AS y, round(avg(z), 6) AS z, count(*) AS n FROM {_POINTS} GROUP BY 1, 2, 3")
def a14_voxel_centroid(spark: SparkSession, d: str) -> DataFrame:
    cells = [A.voxel(F.col(a), s).alias(f"cell_{a}") for a, s in (("x", 2.5), ("y", 2.5), ("z", 0.5))]
    return points(spark, d).groupBy(*cells).agg(*[F.round(F.avg(c), 6).alias(c) for c in "xyz"], F.count("*").alias("n"))


@add(
    f"""SELECT CAST(floor(x / 2.0) AS BIGINT) AS cell_x, CAST(floor(y / 2.0) AS BIGINT) AS cell_y,
 arg_min(pid, (round(pow(x - (floor(x / 2.0) + 0.5) * 2.0, 2) + pow(y - (floor(y / 2.0) + 0.5) * 2.0, 2), 9), pid)) AS pid FROM {_POINTS} GROUP BY 1, 2"""
)
def a14_uniform_sample(spark: SparkSession, d: str) -> DataFrame:
    return A.voxel_nearest(points(spark, d), ["x", "y"], 2.0, "pid")


@add(f"SELECT CAST(floor(x) AS BIGINT) AS cell_x, CAST(floor(y) AS BIGINT) AS cell_y, round(avg(z), 6) AS mean_z, arg_min(pid, (f, pid)) AS label, count(*) AS n FROM {_POINTS} GROUP BY 1, 2")
def a15_cell_height(spark: SparkSession, d: str) -> DataFrame:
    return points(spark, d).groupBy(F.floor("x").alias("cell_x"), F.floor("y").alias("cell_y")).agg(F.round(F.avg("z"), 6).alias("mean_z"), F.min_by("pid", F.struct("f", "pid")).alias("label"), F.count("*").alias("n"))


@add(f"SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0, max(x) AS x1, max(y) AS y1, max(z) AS z1 FROM {_POINTS}")
def a16_bounding_box(spark: SparkSession, d: str) -> DataFrame:
    return points(spark, d).agg(*[F.min(c).alias(f"{c}0") for c in "xyz"], *[F.max(c).alias(f"{c}1") for c in "xyz"])


@add(
    """SELECT tileid, arg_max(color, (n, -color)) AS mode, max(n) AS n_mode, max(n) / sum(n) AS rate FROM
 (SELECT tileid, color, count(*) AS n FROM feature_changes WHERE color IS NOT NULL GROUP BY ALL) GROUP BY tileid"""
)
def a17_mode_rate(spark: SparkSession, d: str) -> DataFrame:
    return A.mode_with_rate(table(spark, d, "feature_changes"), ["tileid"], "color")


@add(
    """SELECT feature_id, arg_max(color, (round(s, 9), color)) AS winner FROM (SELECT feature_id, color, sum(0.5 / (0.5 + length_m)) AS s FROM feature_changes WHERE color IS NOT NULL AND length_m IS NOT NULL GROUP BY ALL) GROUP BY feature_id"""
)
def a18_weighted_vote(spark: SparkSession, d: str) -> DataFrame:
    return A.vote_by_distance(table(spark, d, "feature_changes").where("color IS NOT NULL AND length_m IS NOT NULL"), ["feature_id"], "color", "length_m")


@add("SELECT user_id, sum(abs(value) * CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) / sum(abs(value)) > 0.3 AS is_clicker FROM events WHERE value <> 0 GROUP BY user_id")
def a19_flag_vote(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where("value <> 0").groupBy("user_id").agg(A.vote_flag(F.abs("value"), F.col("event_type") == "click", 0.3).alias("is_clicker"))


@add("SELECT l_suppkey, CAST(trunc(sum(l_quantity * l_linenumber) / sum(l_quantity) + 0.5) AS INT) AS vote FROM lineitem GROUP BY l_suppkey")
def a20_number_vote(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(A.vote_number(F.col("l_quantity"), F.col("l_linenumber")).alias("vote"))


@add(
    """WITH near AS (SELECT l_suppkey, l_orderkey, arg_min(l_linenumber, (l_discount, l_linenumber)) AS k FROM lineitem GROUP BY ALL), c AS (SELECT l_suppkey, k, count(*) AS n FROM near GROUP BY ALL)
 SELECT l_suppkey, arg_max(k, (n, -k)) AS winner FROM c GROUP BY l_suppkey"""
)
def a21_nearest_type_vote(spark: SparkSession, d: str) -> DataFrame:
    return A.vote_nearest_type(table(spark, d, "lineitem"), ["l_suppkey"], "l_orderkey", "l_linenumber", "l_discount")


@add(
    """WITH a AS (SELECT tileid, arg_max(color, (n, -color)) AS color FROM (SELECT tileid, color, count(*) AS n FROM feature_changes WHERE color IS NOT NULL GROUP BY ALL) GROUP BY tileid),
 b AS (SELECT tileid, arg_max(shape_type, (n, -shape_type)) AS shape_type FROM (SELECT tileid, shape_type, count(*) AS n FROM feature_changes WHERE shape_type IS NOT NULL GROUP BY ALL) GROUP BY tileid)
 SELECT t.tileid, coalesce(color, 99) AS color, coalesce(shape_type, 99) AS shape_type FROM (SELECT DISTINCT tileid FROM feature_changes) t LEFT JOIN a ON t.tileid = a.tileid LEFT JOIN b ON t.tileid = b.tileid"""
)
def a22_pair_vote(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "feature_changes")
    a = A.mode_with_rate(rows, ["tileid"], "color").select("tileid", F.col("mode").alias("color"))
    b = A.mode_with_rate(rows, ["tileid"], "shape_type").select("tileid", F.col("mode").alias("shape_type"))
    return rows.select("tileid").distinct().join(a, "tileid", "left").join(b, "tileid", "left").select("tileid", *[F.coalesce(c, F.lit(99)).alias(c) for c in ("color", "shape_type")])


@add("SELECT event_type, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, round(stddev_pop(value), 6) AS deviation, round(avg(value * value), 6) AS about_zero FROM events GROUP BY event_type")
def a23_moments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.var_pop("value"), 6).alias("variance"), F.round(F.stddev_pop("value"), 6).alias("deviation"), F.round(F.avg(F.col("value") * F.col("value")), 6).alias("about_zero"))


@add("SELECT l_partkey, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS x, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS y FROM lineitem GROUP BY l_partkey")
def a25_weighted_centroid(spark: SparkSession, d: str) -> DataFrame:
    w = F.col("l_quantity")
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.round(F.sum(F.col("l_extendedprice") * w) / F.sum(w), 4).alias("x"), F.round(F.sum(F.col("l_discount") * w) / F.sum(w), 6).alias("y"))


@add("SELECT user_id, round(atan2(2 * c, a - b) / 2, 5) AS angle, round(m, 4) AS mean_x, round((a + b - sqrt(pow(a - b, 2) + 4 * c * c)) / 2, 3) AS thickness FROM (SELECT user_id, var_pop(x) AS a, var_pop(value) AS b, covar_pop(x, value) AS c, avg(x) AS m FROM (SELECT user_id, value, CAST(event_id % 97 AS DOUBLE) AS x FROM events) GROUP BY user_id)")
def a27_principal_axis(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "value", (F.col("event_id") % 97).cast("double").alias("x"))
    fit = rows.groupBy("user_id").agg(*A.line_fit(F.col("x"), F.col("value")))
    return fit.select("user_id", F.round("angle", 5).alias("angle"), F.round("mean_x", 4).alias("mean_x"), F.round("thickness", 3).alias("thickness"))


@add("SELECT l_suppkey, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem GROUP BY l_suppkey")
def a28_line_fit(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"), F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 2).alias("intercept"))


_CIRCLE = "SELECT l_suppkey, mx, my, avg(u * u) AS uu, avg(v * v) AS vv, avg(u * v) AS uv, avg(u * (u * u + v * v)) / 2 AS p, avg(v * (u * u + v * v)) / 2 AS q FROM (SELECT l_suppkey, mx, my, x - mx AS u, y - my AS v FROM (SELECT l_suppkey, l_quantity AS x, l_extendedprice / 1000 AS y, avg(l_quantity) OVER (PARTITION BY l_suppkey) AS mx, avg(l_extendedprice / 1000) OVER (PARTITION BY l_suppkey) AS my FROM lineitem)) GROUP BY ALL"


@add(f"SELECT l_suppkey, round(a + mx, 3) AS centre_x, round(b + my, 3) AS centre_y, round(sqrt(a * a + b * b + uu + vv), 3) AS radius FROM (SELECT *, (p * vv - q * uv) / (uu * vv - uv * uv) AS a, (q * uu - p * uv) / (uu * vv - uv * uv) AS b FROM ({_CIRCLE}) WHERE uu * vv - uv * uv > 1e-12)")
def a28_circle_fit(spark: SparkSession, d: str) -> DataFrame:
    found = A.circle_fit(table(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y")), ["l_suppkey"], "x", "y")
    return found.where("radius IS NOT NULL").select("l_suppkey", *[F.round(c, 3).alias(c) for c in ("centre_x", "centre_y", "radius")])


@add("SELECT link_id, min(frame_no) AS first_frame, array_to_string(list_sort(list(DISTINCT trail_id)), ',') AS trails FROM frames WHERE link_id IS NOT NULL GROUP BY link_id")
def a30_link_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "frames").where("link_id IS NOT NULL").groupBy("link_id").agg(F.min("frame_no").alias("first_frame"), F.array_join(F.array_sort(F.collect_set("trail_id")), ",").alias("trails"))


# Top-k and order


@add("SELECT l_suppkey, l_orderkey, l_linenumber, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INT) AS rank FROM lineitem) WHERE rank <= 5")
def t1_top_per_group(spark: SparkSession, d: str) -> DataFrame:
    """The window group limit keeps five rows per group and task before the shuffle."""
    order = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return table(spark, d, "lineitem").withColumn("rank", F.row_number().over(order)).where("rank <= 5").select("l_suppkey", "l_orderkey", "l_linenumber", "rank")


@add("SELECT o_custkey, array_to_string(list(o_orderkey ORDER BY o_totalprice, o_orderkey), ',') AS by_price FROM orders GROUP BY o_custkey")
def t3_sorted_lists(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_totalprice", "o_orderkey"))).alias("s")).select("o_custkey", F.array_join(F.col("s.o_orderkey").cast("array<string>"), ",").alias("by_price"))


@add("SELECT l_orderkey, arg_min(l_linenumber, (l_shipdate, l_linenumber)) AS line FROM lineitem GROUP BY l_orderkey")
def t4_nearest_of_candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_linenumber", F.struct("l_shipdate", "l_linenumber")).alias("line"))


@add("WITH p AS (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 101 OFFSET 200) SELECT o_orderkey, CASE WHEN (SELECT count(*) FROM p) > 100 THEN '300' END AS next_cursor FROM p ORDER BY o_orderkey LIMIT 100")
def t5_page(spark: SparkSession, d: str) -> DataFrame:
    """A page of 100 from cursor 200; one row more tells whether a next page exists."""
    cursor, size = 200, 100
    probe = table(spark, d, "orders").select("o_orderkey").orderBy("o_orderkey").offset(cursor).limit(size + 1).collect()
    following = str(cursor + size) if len(probe) > size else None
    return spark.createDataFrame([(r[0], following) for r in probe[:size]], "o_orderkey bigint, next_cursor string")


@add("SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT 1")
def t6_most_frequent(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type").limit(1)


@add("SELECT c_nationkey, array_to_string(list(c_custkey ORDER BY round(atan2(c_acctbal - 4500, (c_custkey % 97) - 48), 9), c_custkey), ',') AS around FROM customer GROUP BY c_nationkey")
def t7_around_centre(spark: SparkSession, d: str) -> DataFrame:
    angle = F.round(F.atan2(F.col("c_acctbal") - 4500, (F.col("c_custkey") % 97) - 48), 9)
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct(angle.alias("a"), "c_custkey"))).alias("s")).select("c_nationkey", F.array_join(F.col("s.c_custkey").cast("array<string>"), ",").alias("around"))


@add("SELECT c_nationkey, array_to_string(list(c_custkey ORDER BY round(3 * (c_acctbal - 10) - 4 * ((c_custkey % 97) - 20), 6) DESC, c_custkey), ',') AS by_side FROM customer GROUP BY c_nationkey")
def t8_by_side(spark: SparkSession, d: str) -> DataFrame:
    side = F.round(3 * (F.col("c_acctbal") - 10) - 4 * ((F.col("c_custkey") % 97) - 20), 6)
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct((-side).alias("a"), "c_custkey"))).alias("s")).select("c_nationkey", F.array_join(F.col("s.c_custkey").cast("array<string>"), ",").alias("by_side"))


# Sets


@add("SELECT 'customer' AS kind, c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier")
def u1_union_by_name(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@add("SELECT DISTINCT opt_t_world_veh[1] AS x, opt_t_world_veh[2] AS y FROM frames WHERE len(opt_t_world_veh) = 3 AND isfinite(opt_t_world_veh[1]) AND isfinite(opt_t_world_veh[2])")
def u3_distinct_points(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("opt_t_world_veh")[0], F.col("opt_t_world_veh")[1]
    finite = lambda c: c.between(-1.7976931348623157e308, 1.7976931348623157e308)
    return table(spark, d, "frames").where("size(opt_t_world_veh) = 3").select(x.alias("x"), y.alias("y")).where(finite(F.col("x")) & finite(F.col("y"))).distinct()


@add("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def u4_except(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@add("SELECT p_partkey, CAST(p_size & 12 AS INT) AS meet, CAST(p_size | 12 AS INT) AS either, CAST(p_size & ~12 AS INT) AS without, CAST(bit_count(p_size) AS INT) AS n_bits FROM part")
def u5_bit_sets(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("p_size")
    return table(spark, d, "part").select("p_partkey", c.bitwiseAND(12).alias("meet"), c.bitwiseOR(12).alias("either"), c.bitwiseAND(~12).alias("without"), F.bit_count(c).alias("n_bits"))


@add("SELECT entry_id, array_to_string(list_filter(list_distinct_in_order, lambda v: v <> ''), ':') AS united FROM (SELECT entry_id, list_reduce([[x] for x in string_split(coalesce(root_dir, '') || ':' || coalesce(trail_id, '') || ':' || coalesce(root_dir, ''), ':')], lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE list_concat(a, b) END) AS list_distinct_in_order FROM flat_mapping_info)")
def u8_path_union(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "flat_mapping_info").select("entry_id", X.path_union(F.concat_ws(":", "root_dir", "trail_id"), F.col("root_dir")).alias("united"))


# Text


@add("SELECT id, loaded_at, nullif(regexp_extract(version, '(v[0-9]+\\.[0-9]+\\.[0-9]+)', 1), '') AS ver FROM lanes")
def x1_version(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lanes").select("id", "loaded_at", X.version_of(F.col("version")).alias("ver"))


@add("SELECT o_orderkey, coalesce(nullif(regexp_extract(n, 'ID([0-9]+)\\.zip$', 1), ''), 'UNKNOWN') AS task FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'box.zip' ELSE 'ID' || o_orderkey || '.zip' END AS n FROM orders)")
def x2_task_id(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("o_orderkey") % 3 == 0, "box.zip").otherwise(F.concat(F.lit("ID"), F.col("o_orderkey").cast("string"), F.lit(".zip")))
    return table(spark, d, "orders").select("o_orderkey", X.task_id_of(name, "UNKNOWN").alias("task"))


@add("SELECT c_custkey, 'Dear ' || c_name || ' of ' || c_mktsegment || ', {{ unknown }}' AS letter FROM customer")
def x3_template(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", X.render(F.lit("Dear {{ name }} of {{segment}}, {{ unknown }}"), F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))).alias("letter"))


@add("SELECT entry_id, CASE lower(nullif(regexp_extract(bev_json_path, '\\.([A-Za-z0-9]+)$', 1), '')) WHEN 'json' THEN 'application/json' ELSE 'application/octet-stream' END AS mime, coalesce(lower(nullif(regexp_extract(bev_json_path, '\\.([A-Za-z0-9]+)$', 1), '')) IN ('txt', 'json', 'md', 'xml'), false) AS is_text FROM flat_mapping_info")
def x4_media_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "flat_mapping_info").select("entry_id", X.mime_of(F.col("bev_json_path")).alias("mime"), X.is_text_file(F.col("bev_json_path")).alias("is_text"))


@add("SELECT c_custkey, c_name || '|' || md5(c_name || '|nation=' || c_nationkey || '|segment=' || c_mktsegment) AS cache_key FROM customer")
def x5_cache_key(spark: SparkSession, d: str) -> DataFrame:
    args = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    return table(spark, d, "customer").select("c_custkey", X.cache_key(F.col("c_name"), args).alias("cache_key"))


@add("SELECT s_suppkey, to_base64(encode(s_name)) AS b64 FROM supplier")
def x6_base64(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", F.base64(F.encode("s_name", "utf-8")).alias("b64"))


@add("SELECT c_custkey, 'inline' AS foo, 'file' || c_nationkey AS bar, 'parent' AS baz, '/b:/a' AS libs FROM customer")
def x8_env_merge(spark: SparkSession, d: str) -> DataFrame:
    parent = X.env_map(F.lit("FOO=parent,BAR=parent,BAZ=parent,LD_LIBRARY_PATH=/a"))
    file = X.env_map(F.concat(F.lit("# comment\nFOO = file\nBAR=old\nBAR=file"), F.col("c_nationkey").cast("string"), F.lit("\n =skip\nLD_LIBRARY_PATH=/b:/a")), "\n")
    merged = X.merge_env(parent, file, X.env_map(F.lit("FOO=inline")))
    get = lambda k: F.element_at("m", k)
    return table(spark, d, "customer").select("c_custkey", merged.alias("m")).select("c_custkey", get("FOO").alias("foo"), get("BAR").alias("bar"), get("BAZ").alias("baz"), get("LD_LIBRARY_PATH").alias("libs"))


@add("SELECT p_partkey, string_split(p_type, ' ')[1] AS head, replace(p_name, ' ', '_') AS snake, starts_with(p_brand, 'Brand') AS branded, strpos(p_name, 'a') AS first_a, try_cast(substr(p_brand, 7) AS INT) AS number FROM part")
def x9_strings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.split("p_type", " ")[0].alias("head"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("snake"), F.col("p_brand").startswith("Brand").alias("branded"), F.instr("p_name", "a").cast("bigint").alias("first_a"), F.substring("p_brand", 7, 100).try_cast("int").alias("number"))


@add("SELECT id, loaded_at, CASE color WHEN 1 THEN 'WHITE' WHEN 2 THEN 'YELLOW' ELSE 'UNKNOWN' END AS color_name FROM lane_lines")
def x10_enum(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lane_lines").select("id", "loaded_at", X.decode(F.col("color"), {1: "WHITE", 2: "YELLOW"}).alias("color_name"))


@add("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def x11_dimensions(spark: SparkSession, d: str) -> DataFrame:
    """Nations and regions are fixed dimensions; Spark broadcasts them by their size."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")


@add("SELECT event_id, CAST(floor((u - 315964800 + 18) / 604800) AS INT) AS week, CAST((u - 315964800 + 18) % 604800 AS BIGINT) AS tow, u AS back FROM (SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS u FROM events) WHERE u >= 1483228800")
def x12_gps_time(spark: SparkSession, d: str) -> DataFrame:
    u = F.unix_seconds(F.col("ts").cast("timestamp"))
    rows = table(spark, d, "events").select("event_id", u.alias("u")).where("u >= 1483228800")
    return rows.select("event_id", X.gps_week(F.col("u")).alias("week"), X.gps_seconds_of_week(F.col("u")).alias("tow"), X.from_gps(X.gps_week(F.col("u")).cast("bigint"), X.gps_seconds_of_week(F.col("u"))).alias("back"))


@add("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, CAST(day(o_orderdate) AS INT) AS d, year(o_orderdate) % 4 = 0 AND (year(o_orderdate) % 100 <> 0 OR year(o_orderdate) % 400 = 0) AS leap FROM orders")
def x13_calendar(spark: SparkSession, d: str) -> DataFrame:
    date, y = F.col("o_orderdate"), F.year("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", y.alias("y"), F.month(date).alias("m"), F.dayofmonth(date).alias("d"), ((y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))).alias("leap"))


@add("SELECT event_id, json_extract_string(props, '$.k') AS k, try_cast(json_extract_string(props, '$.v') AS DOUBLE) AS v FROM events")
def x14_json_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.v").try_cast("double").alias("v"))


@add(
    """SELECT event_id, CASE WHEN m LIKE 'prompts/%' THEN 'prompts' WHEN m LIKE 'tools/%' THEN 'tools' END AS service, CASE WHEN event_id % 7 = 0 THEN -32600 WHEN m NOT LIKE 'prompts/%' AND m NOT LIKE 'tools/%' THEN -32601 WHEN value < 0 THEN -32000 END AS code
 FROM (SELECT event_id, value, CASE event_id % 3 WHEN 0 THEN 'prompts/get' WHEN 1 THEN 'tools/call' ELSE 'other' END AS m FROM events)"""
)
def x16_routing(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 3
    method = F.when(k == 0, "prompts/get").when(k == 1, "tools/call").otherwise("other")
    service = X.route(method)
    return table(spark, d, "events").select("event_id", service.alias("service"), X.error_code(F.col("event_id") % 7 != 0, service.isNotNull(), F.col("value") < 0).alias("code"))


@add("SELECT c_custkey, 'host' || c_nationkey AS host, CASE WHEN c_custkey % 2 = 0 THEN 8080 ELSE 80 END AS port, CASE WHEN c_custkey % 5 = 0 THEN '/' ELSE '/a/b' END AS path FROM customer")
def x17_uri_parts(spark: SparkSession, d: str) -> DataFrame:
    uri = F.concat(F.lit("http://host"), F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, ":8080").otherwise(""), F.when(F.col("c_custkey") % 5 == 0, "").otherwise("/a/b"))
    return table(spark, d, "customer").select("c_custkey", X.uri_parts(uri).alias("u")).select("c_custkey", "u.host", "u.port", "u.path")


QUERIES, ORACLE = catalog.queries, catalog.sql
