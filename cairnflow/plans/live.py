"""Queries of the streaming operators, the check registry and the sinks on whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnflow.functions.registry import Checks
from cairnflow.operators import aggregates as A
from cairnflow.plans.catalog import Catalog
from cairnflow.sources import readers, sinks
from cairnflow.streaming import operators as L
from cairnflow.session import table

catalog = Catalog()
add = catalog.add


def _events(spark: SparkSession, d: str, stream: bool = False) -> DataFrame:
    """The events with a zoned time. A stream lists a folder of files, so a single file is found by its name in it."""
    path = f"{d}/events.parquet"
    if not stream:
        df = spark.read.parquet(path)
    elif os.path.isfile(path):
        df = spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "events.parquet").parquet(d)
    else:
        df = L.open_stream(spark, path)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def _calls(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    requests = events.where("event_type = 'click'").select(F.col("event_id").alias("req_id"), F.col("user_id").alias("req_key"), F.col("ts").alias("req_at"))
    responses = events.where("event_type = 'view'").select(F.col("event_id").alias("rsp_id"), F.col("user_id").alias("rsp_key"), F.col("ts").alias("rsp_at"))
    return requests, responses


_CALLS = """SELECT q.event_id AS req_id, r.event_id AS rsp_id FROM (SELECT * FROM events WHERE event_type = 'click') q {} JOIN (SELECT * FROM events WHERE event_type = 'view') r
 ON q.user_id = r.user_id AND r.ts >= q.ts AND r.ts <= q.ts + INTERVAL 3600 SECONDS"""


@add(_CALLS.format("LEFT"))
def st3_correlated(spark: SparkSession, d: str) -> DataFrame:
    return L.correlate(*_calls(_events(spark, d)), seconds=3600).select("req_id", "rsp_id")


@add(_CALLS.format(""))
def st3_correlated_stream(spark: SparkSession, d: str) -> DataFrame:
    """The answered requests, found by a stream-stream join over everything there is."""
    events = _events(spark, d, stream=True)
    requests, responses = _calls(events)
    return L.run_available(L.correlate(requests, responses, seconds=3600, outer=False, delay="60 days").select("req_id", "rsp_id"), "calls")


_SESSIONS = """SELECT user_id, count(*) AS n, min(ts) AS start, max(ts) AS last_seen FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM
 (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, k"""


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


@add(_SESSIONS)
def st6_sessions(spark: SparkSession, d: str) -> DataFrame:
    return _plain(L.sessions(_events(spark, d), "user_id", "ts", "6 hours"))


@add(_SESSIONS)
def st6_sessions_stream(spark: SparkSession, d: str) -> DataFrame:
    return _plain(L.run_available(L.sessions(_events(spark, d, stream=True), "user_id", "ts", "6 hours", "60 days"), "sessions", "complete"))


@add("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def st_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return _plain(L.windows(_events(spark, d), ["event_type"], "ts", "1 day", None, "value").withColumn("total", F.round("total", 4)))


@add("SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def st_tumbling_stream(spark: SparkSession, d: str) -> DataFrame:
    return _plain(L.run_available(L.windows(_events(spark, d, stream=True), ["event_type"], "ts", "1 day", None, "value"), "days", "complete").withColumn("total", F.round("total", 4)))


@add("SELECT event_type, s AS start, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY ALL")
def st_sliding(spark: SparkSession, d: str) -> DataFrame:
    return _plain(L.windows(_events(spark, d), ["event_type"], "ts", "12 hours", "6 hours", "value").withColumn("total", F.round("total", 4)))


@add("SELECT event_id, s_suppkey AS subscriber FROM events JOIN (SELECT s_suppkey, ['view', 'click', 'error', 'purchase', NULL][s_suppkey % 5 + 1] AS topic FROM supplier) ON topic = event_type OR topic IS NULL")
def st7_fan_out(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey") % 5
    topics = F.when(k == 0, "view").when(k == 1, "click").when(k == 2, "error").when(k == 3, "purchase")
    subscriptions = table(spark, d, "supplier").select(F.col("s_suppkey").alias("subscriber"), topics.alias("event_type"))
    return L.fan_out(_events(spark, d).select("event_id", "event_type"), subscriptions, "event_type").select("event_id", "subscriber")


_CHANGED = "SELECT user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events) WHERE p IS NOT NULL AND p <> event_type"


@add(_CHANGED)
def st9_changed(spark: SparkSession, d: str) -> DataFrame:
    return L.changed(_events(spark, d), "user_id", "ts", "event_type").select("user_id", "event_type")


@add(_CHANGED)
def st9_changed_stream(spark: SparkSession, d: str) -> DataFrame:
    return L.run_available(L.changed_stream(_events(spark, d, stream=True), "user_id", "ts", "event_type").select("user_id", "event_type"), "changes")


@add("SELECT user_id, CASE event_type WHEN 'signup' THEN 'Starting' ELSE 'Running' END AS state, ts AS since FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1 AND event_type NOT IN ('error', 'purchase')")
def st11_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    rows = _events(spark, d).withColumn("s", F.when(t == "signup", "Starting").when(t == "error", "Failed").when(t == "purchase", "Exited").otherwise("Running"))
    return _plain(L.lifecycle(rows, "user_id", "ts", "s"))


@add("SELECT event_id, CASE WHEN event_type = 'error' THEN 'error' WHEN json_extract(props, '$.k') IS NULL THEN 'unreadable' ELSE 'ok' END AS status, CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INT) END AS k FROM events")
def st16_typed(spark: SparkSession, d: str) -> DataFrame:
    r = L.typed_response(F.col("event_id").isNotNull(), F.when(F.col("event_type") == "error", 1).otherwise(0), F.col("props"), "k int")
    return _events(spark, d).select("event_id", r.alias("r")).select("event_id", "r.status", "r.value.k")


@add("SELECT kind, count(*) AS n FROM (SELECT CASE event_id % 4 WHEN 0 THEN 'notification' WHEN 1 THEN 'request' WHEN 2 THEN 'error' ELSE 'result' END AS kind FROM events) GROUP BY kind")
def st17_rpc_kinds(spark: SparkSession, d: str) -> DataFrame:
    k, i = F.col("event_id") % 4, F.col("event_id").cast("string")
    text = F.when(k == 0, F.lit('{"method":"changed"}')).when(k == 1, F.concat(F.lit('{"method":"get","id":'), i, F.lit("}"))).when(k == 2, F.concat(F.lit('{"error":{"code":1},"id":'), i, F.lit("}"))).otherwise(F.concat(F.lit('{"result":{},"id":'), i, F.lit("}")))
    return _events(spark, d).select(L.rpc_kind(text).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


# Registry

checks = Checks()


@checks.register("road_kind", "roads", "P0")
def _road_kind(df: DataFrame) -> DataFrame:
    return df.where(F.col("kind").isNull() | ~F.col("kind").isin(0, 1, 2, 3, 4, 5, 6, 99))


@checks.register("line_color", "lane_lines", "P1")
def _line_color(df: DataFrame) -> DataFrame:
    return df.where(F.col("color").isNull())


@checks.register("short_ring", "lanes", "P2")
def _short_ring(df: DataFrame) -> DataFrame:
    return df.where(F.size(F.col("geom.parts")[0]) < 5)


_STATS = """SELECT 'road_kind' AS inspector_name, 'P0' AS level, 3 AS level_weight, 'roads' AS feature_type, count(*) AS total_count, count(*) FILTER (WHERE kind IS NULL OR kind NOT IN (0, 1, 2, 3, 4, 5, 6, 99)) AS log_count FROM roads
 UNION ALL SELECT 'line_color', 'P1', 2, 'lane_lines', count(*), count(*) FILTER (WHERE color IS NULL) FROM lane_lines
 UNION ALL SELECT 'short_ring', 'P2', 1, 'lanes', count(*), count(*) FILTER (WHERE len(geom.parts[1]) < 5) FROM lanes"""


def _layers(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {n: table(spark, d, n) for n in ("roads", "lanes", "lane_lines")}


@add(_STATS)
def reg_checks(spark: SparkSession, d: str) -> DataFrame:
    return checks.run(spark, _layers(spark, d))[0]


@add(f"SELECT 'all' AS task, round_even(round(CAST(sum((1 - log_count / total_count) * level_weight) / sum(level_weight) AS DOUBLE), 9), 3) AS score FROM ({_STATS})")
def reg_score(spark: SparkSession, d: str) -> DataFrame:
    return A.weighted_score(checks.run(spark, _layers(spark, d))[0].withColumn("task", F.lit("all")), ["task"])


# Sources and sinks


@add("SELECT id, loaded_at, CAST(count(*) AS BIGINT) AS n_vertices, bool_and(z IS NULL) AS flat FROM (SELECT id, loaded_at, unnest(flatten(geom.parts)) AS v, NULL AS z, rn FROM (SELECT *, row_number() OVER () AS rn FROM lane_lines WHERE geom.kind = 'line')) GROUP BY id, loaded_at, rn")
def s1_layer_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.read_layer(spark, f"{d}/lane_lines.parquet", kinds=["line"], flat=True)
    every = F.flatten("geom.parts")
    return rows.select("id", "loaded_at", F.size(every).cast("bigint").alias("n_vertices"), F.forall(every, lambda p: p["z"].isNull()).alias("flat"))


@add("SELECT 'lanes' AS layer, count(*) AS n FROM lanes UNION ALL SELECT 'roads', count(*) FROM roads UNION ALL SELECT 'signs', 0")
def s3_bundle(spark: SparkSession, d: str) -> DataFrame:
    schemas = {n: spark.read.parquet(f"{d}/{n}.parquet").schema for n in ("lanes", "roads")}
    found, _ = readers.read_bundle(spark, d, {**schemas, "signs": f"id string, geom {readers.GEOMETRY}"})
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("layer"), "n") for n, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@add("SELECT id, loaded_at, 'LINESTRING (' || printf('%.2f %.2f', geom.parts[1][1].x, geom.parts[1][1].y) AS head, len(geom.parts[1]) AS n FROM lane_lines")
def s12_wkt(spark: SparkSession, d: str) -> DataFrame:
    """Lines written as text and read back."""
    fixed = lambda v: F.format_string("%.2f", v)
    wkt = F.concat(F.lit("LINESTRING ("), F.array_join(F.transform(F.col("geom.parts")[0], lambda p: F.concat(fixed(p["x"]), F.lit(" "), fixed(p["y"]))), ", "), F.lit(")"))
    rows = table(spark, d, "lane_lines").select("id", "loaded_at", readers.parse_wkt(wkt).alias("g"))
    first = F.col("g.parts")[0][0]
    return rows.select("id", "loaded_at", F.concat(F.lit("LINESTRING ("), fixed(first["x"]), F.lit(" "), fixed(first["y"])).alias("head"), F.size(F.col("g.parts")[0]).cast("bigint").alias("n"))


@add("SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS px, CAST(floor(l_extendedprice / 5000) AS BIGINT) AS py, arg_min(l_linenumber, (l_discount, l_linenumber)) AS colour FROM lineitem GROUP BY 1, 2")
def k12_lowest_raster(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select((F.col("l_quantity")).alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), F.col("l_discount").alias("z"), F.col("l_linenumber").alias("colour"))
    return sinks.lowest_raster(rows, 5.0, "colour")


@add("SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS F_price, sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS O_price FROM (SELECT o_custkey, o_orderstatus, min(o_totalprice) AS o_totalprice FROM orders GROUP BY ALL) GROUP BY o_custkey")
def k4_wide(spark: SparkSession, d: str) -> DataFrame:
    least = table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.min("o_totalprice").alias("price"))
    wide = sinks.wide_results(least, "o_custkey", "o_orderstatus", ["price"], ["F", "O"])
    return wide.select("o_custkey", F.col("F").alias("F_price"), F.col("O").alias("O_price"))


@add("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 2 = 1 AND c_custkey % 3 = 0 THEN 2 ELSE 1 END AS version FROM customer WHERE c_custkey % 2 = 1 OR c_custkey % 3 = 0")
def k13_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    stored, new = rows.where("c_custkey % 2 = 1").withColumn("version", F.lit(1)), rows.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return sinks.upsert(stored, new, "c_custkey")


@add("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def k15_delete(spark: SparkSession, d: str) -> DataFrame:
    gone = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return sinks.delete_keys(table(spark, d, "orders"), gone, "o_custkey").select("o_orderkey")


@add()
def k7_obj_text(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("geom.parts")[0]
    rows = table(spark, d, "roads").select(F.concat_ws("@", "id", F.col("loaded_at").cast("string")).alias("line"), F.posexplode(p).alias("seq", "p")).select("line", "seq", "p.x", "p.y", "p.z").distinct()
    return sinks.obj_text(rows)


QUERIES, ORACLE = catalog.queries, catalog.sql
