"""Queries of geometry, ordered-sequence, spatial-join and clustering operators on the map layers and trails."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.operators import aggregates as A
from cairnflow.operators import asof, cluster
from cairnflow.operators import references as R
from cairnflow.operators import sequence as S
from cairnflow.operators import spatial as J
from cairnflow.plans.catalog import Catalog
from cairnflow.plans.relational import _POINTS, points
from cairnflow.session import table

catalog = Catalog()
add = catalog.add


def current(spark: SparkSession, d: str, layer: str, *columns: str) -> DataFrame:
    """fid, ring and columns of the live features of a layer, in their last state: a row for each part of the geometry.

    A feature of several parts has the part's number after its id; one without any has a null ring.
    """
    df = table(spark, d, layer)
    last = F.max_by(F.struct("is_deleted", "geom", *columns), F.col("loaded_at")).alias("s")
    alive = df.groupBy(R.normal_id(F.col("id")).alias("fid")).agg(last).where("NOT s.is_deleted")
    each = alive.select("fid", "s", F.posexplode_outer("s.geom.parts").alias("part", "ring"))
    fid = F.when(F.size("s.geom.parts") > 1, F.concat_ws(".", "fid", F.col("part").cast("string"))).otherwise(F.col("fid"))
    return each.select(fid.alias("fid"), "ring", *[F.col(f"s.{c}").alias(c) for c in columns])


def _cur(layer: str, *columns: str) -> str:
    extra = "".join(f", arg_max({c}, loaded_at) AS {c}" for c in columns)
    names = "".join(", " + c for c in columns)
    alive = f"SELECT * FROM (SELECT upper(trim(id)) AS fid, arg_max(geom, loaded_at).parts AS parts, arg_max(is_deleted, loaded_at) AS gone{extra} FROM {layer} GROUP BY 1) WHERE NOT gone"
    each = f"SELECT *, unnest(CASE WHEN len(parts) > 0 THEN parts ELSE [NULL] END) AS ring, unnest(CASE WHEN len(parts) > 0 THEN range(len(parts)) ELSE [NULL] END) AS part FROM ({alive})"
    return f"(SELECT CASE WHEN len(parts) > 1 THEN concat_ws('.', fid, part) ELSE fid END AS fid, ring{names} FROM ({each}))"


def _vert(layer: str) -> str:
    return f"(SELECT fid AS line, seq - 1 AS seq, v.x AS x, v.y AS y, v.z AS z FROM (SELECT fid, unnest(ring) AS v, generate_subscripts(ring, 1) AS seq FROM {_cur(layer)}))"


def lines(spark: SparkSession, d: str, layer: str = "lane_lines") -> DataFrame:
    return S.vertices(current(spark, d, layer), "fid", "ring")


def trail_points(spark: SparkSession, d: str) -> DataFrame:
    """line, seq, id, x, y, z of the frames with a usable position, in time order."""
    p = F.col("opt_t_world_veh")
    rows = table(spark, d, "frames").where("stamp_ms IS NOT NULL AND size(opt_t_world_veh) = 3").select(F.col("trail_id").alias("line"), F.col("stamp_ms").alias("seq"), F.col("frame_no").alias("id"), p[0].alias("x"), p[1].alias("y"), p[2].alias("z"))
    return rows.where("abs(x) < 50000 AND abs(y) < 50000 AND abs(z) < 9000 AND NOT isnan(x) AND NOT isnan(y) AND NOT isnan(z)").distinct()


_TRAIL = """(SELECT DISTINCT trail_id AS line, stamp_ms AS seq, frame_no AS id, opt_t_world_veh[1] AS x, opt_t_world_veh[2] AS y, opt_t_world_veh[3] AS z FROM frames WHERE stamp_ms IS NOT NULL AND len(opt_t_world_veh) = 3
 AND abs(opt_t_world_veh[1]) < 50000 AND abs(opt_t_world_veh[2]) < 50000 AND abs(opt_t_world_veh[3]) < 9000 AND NOT isnan(opt_t_world_veh[1]) AND NOT isnan(opt_t_world_veh[2]) AND NOT isnan(opt_t_world_veh[3]))"""
_LEGS = f"""(SELECT *, sqrt(pow(lag(x) OVER w - x, 2) + pow(lag(y) OVER w - y, 2)) AS step, lag(x) OVER w - x AS ux, lag(y) OVER w - y AS uy, lead(x) OVER w - x AS vx, lead(y) OVER w - y AS vy FROM {_vert('lane_lines')} WINDOW w AS (PARTITION BY line ORDER BY seq))"""
_MEASURED = f"(SELECT *, coalesce(sum(step) OVER (PARTITION BY line ORDER BY seq), 0) AS measure FROM {_LEGS})"

# Scalar geometry


@add(f"SELECT line, CAST(seq AS INT) AS seq, round(degrees(acos(greatest(-1, least(1, (ux * vx + uy * vy) / sqrt((ux * ux + uy * uy) * (vx * vx + vy * vy)))))), 6) AS angle, round((ux * vy - uy * vx) / sqrt(ux * ux + uy * uy), 6) AS side FROM {_LEGS} WHERE ux IS NOT NULL AND vx IS NOT NULL AND (ux <> 0 OR uy <> 0) AND (vx <> 0 OR vy <> 0)")
def g2_vector_angles(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("line").orderBy("seq")
    r = lines(spark, d).withColumns({"ux": F.lag("x").over(w) - F.col("x"), "uy": F.lag("y").over(w) - F.col("y"), "vx": F.lead("x").over(w) - F.col("x"), "vy": F.lead("y").over(w) - F.col("y")})
    r = r.where("ux IS NOT NULL AND vx IS NOT NULL AND (ux <> 0 OR uy <> 0) AND (vx <> 0 OR vy <> 0)")
    zero = F.lit(0.0)
    return r.select("line", "seq", F.round(G.angle_between(F.col("ux"), F.col("uy"), F.col("vx"), F.col("vy")), 6).alias("angle"), F.round(G.lateral(F.col("vx"), F.col("vy"), zero, zero, F.col("ux"), F.col("uy")), 6).alias("side"))


@add("SELECT pid, round(x * cos(0.3) - y * sin(0.3), 6) AS rx, round(x * sin(0.3) + y * cos(0.3), 6) AS ry, round(exp(-pow(x - 2, 2) / 800), 9) AS score, round(greatest(0, least(x + 5, 30) - greatest(x, 20)) / (greatest(x + 5, 30) - least(x, 20)), 9) AS iou FROM " + _POINTS)
def g4_rotation_scores(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    rx, ry = G.rotate(x, y, F.lit(0.3))
    return points(spark, d).select("pid", F.round(rx, 6).alias("rx"), F.round(ry, 6).alias("ry"), F.round(G.gaussian(x, 20, 2), 9).alias("score"), F.round(G.interval_iou(x, x + 5, F.lit(20.0), F.lit(30.0)), 9).alias("iou"))


@add(f"SELECT fid, round(sum(sqrt(pow(bx - x, 2) + pow(by_ - y, 2))), 5) AS length FROM (SELECT line AS fid, x, y, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM {_vert('lane_lines')} WINDOW w AS (PARTITION BY line ORDER BY seq)) WHERE bx IS NOT NULL GROUP BY fid")
def g20_polyline_length(spark: SparkSession, d: str) -> DataFrame:
    rows = current(spark, d, "lane_lines").where("size(ring) > 1")
    return rows.select("fid", F.round(G.polyline_length(F.col("ring")), 5).alias("length"))


@add(f"SELECT fid, round(abs(sum(x * by_ - y * bx)) / 2, 3) AS area FROM (SELECT line AS fid, x, y, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM {_vert('lanes')} WINDOW w AS (PARTITION BY line ORDER BY seq)) WHERE bx IS NOT NULL GROUP BY fid")
def g21_polygon_area(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "lanes").where("size(ring) > 1").select("fid", F.round(F.abs(G.signed_area(F.col("ring"))), 3).alias("area"))


@add(
    f"""SELECT fid, count(*) FILTER (WHERE c > 0) > 0 AND count(*) FILTER (WHERE c < 0) > 0 AS concave FROM (SELECT line AS fid, (bx - x) * (cy - by_) - (by_ - y) * (cx - bx) AS c FROM
 (SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS bx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS by_,
 coalesce(lead(x, 2) OVER w, CASE WHEN lead(x) OVER w IS NULL THEN nth_value(x, 2) OVER f ELSE first_value(x) OVER w END) AS cx, coalesce(lead(y, 2) OVER w, CASE WHEN lead(y) OVER w IS NULL THEN nth_value(y, 2) OVER f ELSE first_value(y) OVER w END) AS cy
 FROM (SELECT *, max(seq) OVER (PARTITION BY line) AS last FROM {_vert('roads')}) WHERE seq < last
 WINDOW w AS (PARTITION BY line ORDER BY seq), f AS (PARTITION BY line ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))) GROUP BY fid"""
)
def g15_concave(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "roads").select("fid", G.is_concave(F.col("ring")).alias("concave"))


@add(f"SELECT line AS fid, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM {_vert('roads')} GROUP BY line")
def g19_envelopes(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "roads").select("fid", G.envelope(F.col("ring")).alias("b")).select("fid", "b.x0", "b.y0", "b.x1", "b.y1")


@add("SELECT frame_no, received_at, round(degrees(atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))), 4) AS yaw FROM (SELECT frame_no, received_at, opt_q_world_veh[4] AS w, opt_q_world_veh[1] AS x, opt_q_world_veh[2] AS y, opt_q_world_veh[3] AS z FROM frames WHERE len(opt_q_world_veh) = 4)")
def g27_yaw(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("opt_q_world_veh")
    return table(spark, d, "frames").where("size(opt_q_world_veh) = 4").select("frame_no", "received_at", F.round(G.quaternion_yaw(q[3], q[0], q[1], q[2]), 4).alias("yaw"))


@add(
    """SELECT DISTINCT pose_id, round((n + alt) * cos(p) * cos(q), 3) AS x, round((n + alt) * cos(p) * sin(q), 3) AS y, round((n * (1 - e) + alt) * sin(p), 3) AS z, CAST(floor((lon + 180) / 6) + 1 AS INT) AS zone FROM
 (SELECT *, 6378137.0 / sqrt(1 - e * sin(p) * sin(p)) AS n FROM (SELECT pose_id, lon, alt, radians(lat) AS p, radians(lon) AS q, (1 / 298.257223563::DOUBLE) * (2 - 1 / 298.257223563::DOUBLE) AS e FROM key_poses WHERE lat IS NOT NULL AND lon IS NOT NULL AND alt IS NOT NULL))"""
)
def g28_ecef(spark: SparkSession, d: str) -> DataFrame:
    x, y, z = G.to_ecef(F.col("lat"), F.col("lon"), F.col("alt"))
    rows = table(spark, d, "key_poses").where("lat IS NOT NULL AND lon IS NOT NULL AND alt IS NOT NULL")
    return rows.select("pose_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"), F.round(z, 3).alias("z"), G.utm_zone(F.col("lon")).alias("zone")).distinct()


@add()
def g28_utm(spark: SparkSession, d: str) -> DataFrame:
    east, north = G.to_utm(F.col("lat"), F.col("lon"))
    return table(spark, d, "key_poses").where("lat IS NOT NULL AND lon IS NOT NULL").select("pose_id", F.round(east, 3).alias("east"), F.round(north, 3).alias("north")).distinct()


@add("SELECT DISTINCT pose_id, CAST(trunc((lon + 180) / 360 * 8192) AS INT) || '_' || CAST(trunc((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 8192) AS INT) AS tile FROM key_poses WHERE abs(lat) < 90 AND lon IS NOT NULL")
def g29_tile(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "key_poses").where("abs(lat) < 90 AND lon IS NOT NULL").select("pose_id", G.tile_id(F.col("lat"), F.col("lon")).alias("tile")).distinct()


# Ordered sequences


@add(f"SELECT line, CAST(seq AS INT) AS seq, round(measure, 5) AS measure FROM {_MEASURED}")
def w1_measure(spark: SparkSession, d: str) -> DataFrame:
    return S.with_measure(lines(spark, d)).select("line", "seq", F.round("measure", 5).alias("measure"))


@add(f"SELECT line, CAST(k AS BIGINT) AS segment, round(least((k + 1) * 7.0, total) - k * 7.0, 5) AS seg_len FROM (SELECT line, total, unnest(range(CAST(greatest(1, ceil((total - 1e-8) / 7.0)) AS BIGINT))) AS k FROM (SELECT line, max(measure) AS total FROM {_MEASURED} GROUP BY line))")
def w2_fixed_segments(spark: SparkSession, d: str) -> DataFrame:
    cut = S.split_by_length(lines(spark, d), 7.0)
    return cut.groupBy("line", "segment").agg(F.round(F.max("measure") - F.min("measure"), 5).alias("seg_len"))


@add(
    f"""SELECT line, CAST(seq AS INT) AS seq, round(180 - coalesce(degrees(acos(greatest(-1, least(1, (ux * vx + uy * vy) / nullif(sqrt((ux * ux + uy * uy) * (vx * vx + vy * vy)), 0))))), 180), 5) AS deflection FROM {_LEGS}
 WHERE ux IS NOT NULL AND vx IS NOT NULL AND sqrt(ux * ux + uy * uy) >= 1e-9 AND sqrt(vx * vx + vy * vy) >= 1e-9 AND 180 - degrees(acos(greatest(-1, least(1, (ux * vx + uy * vy) / nullif(sqrt((ux * ux + uy * uy) * (vx * vx + vy * vy)), 0))))) > 15 + 1e-9"""
)
def w5_sharp_turns(spark: SparkSession, d: str) -> DataFrame:
    return S.sharp_turns(lines(spark, d)).select("line", "seq", F.round("deflection", 5).alias("deflection"))


@add(f"SELECT line, CAST(seq AS INT) AS seq, round(abs(ux * vy - uy * vx) / sqrt(pow(ux - vx, 2) + pow(uy - vy, 2)), 5) AS height FROM {_LEGS} WHERE ux IS NOT NULL AND vx IS NOT NULL AND (ux <> vx OR uy <> vy)")
def w6_fluctuation(spark: SparkSession, d: str) -> DataFrame:
    return S.turns(lines(spark, d)).where("height IS NOT NULL").select("line", "seq", F.round("height", 5).alias("height"))


@add(f"SELECT line, id, round(pow(s - 11 * z, 2), 4) AS curvature FROM (SELECT line, id, z, sum(z) OVER w AS s, count(*) OVER w AS n FROM {_TRAIL} WINDOW w AS (PARTITION BY line ORDER BY seq, id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) WHERE n = 11")
def w7_range_curvature(spark: SparkSession, d: str) -> DataFrame:
    rows = trail_points(spark, d).withColumn("order", F.struct("seq", "id"))
    return S.range_curvature(rows, "line", "order", "z").where("curvature IS NOT NULL").select("line", "id", F.round("curvature", 4).alias("curvature"))


@add(
    f"""SELECT line, id FROM (SELECT *, lag(x) OVER w AS px, lead(x) OVER w AS nx, lag(y) OVER w AS py, lead(y) OVER w AS ny FROM {_TRAIL} WINDOW w AS (PARTITION BY line ORDER BY seq, id))
 WHERE coalesce(abs(x - px) > 0.02 * abs(x), false) OR coalesce(abs(y - py) > 5, false) OR coalesce(abs(x - nx) > 0.02 * abs(x), false) OR coalesce(abs(y - ny) > 5, false)"""
)
def w8_occluded(spark: SparkSession, d: str) -> DataFrame:
    rows = trail_points(spark, d).withColumn("order", F.struct("seq", "id"))
    return S.occluded(rows, "line", "order", "x", "y", 0.02, 5.0).where("occluded").select("line", "id")


def _kept_sql(step: float) -> str:
    return f"len(list_reduce(ring[2:], lambda k, p: CASE WHEN sqrt(pow(k[-1].x - p.x, 2) + pow(k[-1].y - p.y, 2)) > {step} THEN k || [p] ELSE k END, ring[1:1]))"


@add(f"SELECT fid, CASE WHEN k < 2 THEN least(2, len(ring)) ELSE k END AS n_kept, len(ring) AS n_before FROM (SELECT fid, ring, {_kept_sql(8.0)} AS k FROM {_cur('lane_lines')} WHERE ring IS NOT NULL)")
def w9_without_repeats(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "lane_lines").where("ring IS NOT NULL").select("fid", F.size(G.drop_repeats(F.col("ring"), 8.0)).alias("n_kept"), F.size("ring").alias("n_before"))


@add(f"SELECT line, id, round(avg(x) OVER w, 4) AS x, round(avg(y) OVER w, 4) AS y FROM {_TRAIL} WINDOW w AS (PARTITION BY line ORDER BY seq, id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def w11_moving_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = trail_points(spark, d).withColumn("order", F.struct("seq", "id"))
    return S.moving_mean(rows, "line", "order", ["x", "y"], 2).select("line", "id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@add(f"SELECT line, id, round(gap, 4) AS gap FROM (SELECT line, id, sqrt(pow(lag(x) OVER w - x, 2) + pow(lag(y) OVER w - y, 2)) AS gap FROM {_TRAIL} WINDOW w AS (PARTITION BY line ORDER BY seq, id)) WHERE gap > 10")
def w12_jumps(spark: SparkSession, d: str) -> DataFrame:
    rows = trail_points(spark, d).withColumn("order", F.struct("seq", "id"))
    return S.jumps(rows, 10.0, "line", "order").select("line", "id", F.round("gap", 4).alias("gap"))


@add(
    f"""WITH f AS (SELECT line, id, seq, CAST(id % 50 = 0 AS INT) AS cut FROM {_TRAIL}), n AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY line ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM f),
 b AS (SELECT line, id, k AS piece FROM n UNION ALL SELECT line, id, k + 1 FROM n WHERE cut = 1) SELECT line, CAST(piece AS BIGINT) AS piece, count(*) AS n_rows, min(id) AS least_id FROM b GROUP BY ALL HAVING count(*) >= 2"""
)
def w13_pieces(spark: SparkSession, d: str) -> DataFrame:
    rows = trail_points(spark, d).withColumn("order", F.struct("seq", "id"))
    return S.split_at(rows, F.col("id") % 50 == 0, "line", "order").groupBy("line", "piece").agg(F.count("*").alias("n_rows"), F.min("id").alias("least_id"))


@add(
    f"""SELECT line, CAST(k AS BIGINT) AS station, round(x + (k * 5.0 - measure) / (m1 - measure) * (x1 - x), 4) AS x, round(y + (k * 5.0 - measure) / (m1 - measure) * (y1 - y), 4) AS y FROM
 (SELECT *, unnest(range(CAST(ceil(measure / 5.0) AS BIGINT), CAST(ceil(m1 / 5.0) AS BIGINT))) AS k FROM (SELECT *, lead(measure) OVER w AS m1, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM {_MEASURED} WINDOW w AS (PARTITION BY line ORDER BY seq)) WHERE m1 > measure)"""
)
def w14_stations(spark: SparkSession, d: str) -> DataFrame:
    return S.stations(lines(spark, d), 5.0).select("line", "station", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@add(
    f"""SELECT line, CAST(seq AS INT) AS seq, round(x - vy / n * 4.5, 4) AS ax, round(y + vx / n * 4.5, 4) AS ay, round(x + vy / n * 4.5, 4) AS bx, round(y - vx / n * 4.5, 4) AS by_end FROM (SELECT *, sqrt(vx * vx + vy * vy) AS n FROM {_LEGS}) WHERE n > 0"""
)
def w15_rays(spark: SparkSession, d: str) -> DataFrame:
    e = S.edges(lines(spark, d)).select("line", "seq", F.col("ax").alias("x"), F.col("ay").alias("y"), (F.col("bx") - F.col("ax")).alias("dx"), (F.col("by") - F.col("ay")).alias("dy")).where("dx <> 0 OR dy <> 0")
    return S.perpendicular_rays(e).select("line", "seq", *[F.round(c, 4).alias(n) for c, n in (("ax", "ax"), ("ay", "ay"), ("bx", "bx"), ("by", "by_end"))])


@add(f"SELECT line, CAST(seq AS INT) AS seq, CAST(row_number() OVER (PARTITION BY line ORDER BY seq) - 1 AS INT) AS point_no, CAST(dense_rank() OVER (ORDER BY line) - 1 AS INT) AS line_no FROM {_vert('roads')}")
def w17_ordinals(spark: SparkSession, d: str) -> DataFrame:
    return S.ordinals(lines(spark, d, "roads")).select("line", "seq", "point_no", "line_no")


@add(f"SELECT fid, {_kept_sql(9.0)} AS n_kept FROM {_cur('lane_lines')} WHERE ring IS NOT NULL")
def w19_spaced(spark: SparkSession, d: str) -> DataFrame:
    return current(spark, d, "lane_lines").where("ring IS NOT NULL").select("fid", F.size(S.keep_spaced(F.col("ring"), F.lit(9.0))).alias("n_kept"))


@add()
def w20_smoothed(spark: SparkSession, d: str) -> DataFrame:
    return S.smooth(lines(spark, d))


@add()
def a29_poly_fit(spark: SparkSession, d: str) -> DataFrame:
    return S.poly_fit(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", "l_extendedprice", 3)


# Spatial joins

_FIRST = "(SELECT fid, ring[1].x AS x, ring[1].y AS y FROM {})"


def _first(spark: SparkSession, d: str, layer: str, prefix: str) -> DataFrame:
    return current(spark, d, layer).select(F.col("fid").alias(f"{prefix}_id"), F.col("ring")[0]["x"].alias(f"{prefix}_x"), F.col("ring")[0]["y"].alias(f"{prefix}_y"))


def _near_sql(a: str, b: str, r: float) -> str:
    return f"(SELECT l.fid AS l_id, r.fid AS r_id, sqrt(pow(l.x - r.x, 2) + pow(l.y - r.y, 2)) AS distance FROM {_FIRST.format(_cur(a))} l JOIN {_FIRST.format(_cur(b))} r ON l.x BETWEEN r.x - {r} AND r.x + {r} AND l.y BETWEEN r.y - {r} AND r.y + {r} WHERE sqrt(pow(l.x - r.x, 2) + pow(l.y - r.y, 2)) <= {r})"


@add(f"SELECT fid AS l_id FROM {_cur('lanes')} WHERE fid NOT IN (SELECT l_id FROM {_near_sql('lanes', 'roads', 150)})")
def j1_spatial_anti(spark: SparkSession, d: str) -> DataFrame:
    left = _first(spark, d, "lanes", "l")
    return left.select("l_id").join(J.within(left, _first(spark, d, "roads", "r"), 150.0).select("l_id"), "l_id", "left_anti")


@add(f"SELECT road, count(*) AS n_lanes FROM (SELECT l.fid, upper(trim(l.road_id)) AS road, n.l_id IS NOT NULL AS near FROM {_cur('lanes', 'road_id')} l LEFT JOIN (SELECT DISTINCT l_id FROM {_near_sql('lanes', 'roads', 400)}) n ON n.l_id = l.fid) WHERE road IS NOT NULL GROUP BY road HAVING bool_and(near)")
def j2_all_within(spark: SparkSession, d: str) -> DataFrame:
    near = J.within(_first(spark, d, "lanes", "l"), _first(spark, d, "roads", "r"), 400.0).select(F.col("l_id").alias("fid")).distinct().withColumn("near", F.lit(True))
    lanes = current(spark, d, "lanes", "road_id").select("fid", F.upper(F.trim("road_id")).alias("road")).where("road IS NOT NULL")
    return lanes.join(near, "fid", "left").groupBy("road").agg(F.count("*").alias("n_lanes"), F.bool_and(F.coalesce("near", F.lit(False))).alias("every")).where("every").select("road", "n_lanes")


def _edges_sql(layer: str) -> str:
    return f"(SELECT line, seq, x AS ax, y AS ay, bx, by_ FROM (SELECT *, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM {_vert(layer)} WINDOW w AS (PARTITION BY line ORDER BY seq)) WHERE bx IS NOT NULL)"


_CROSS = """SELECT p_line, q_line, count(*) AS n FROM (SELECT DISTINCT p_line, p_seq, q_line, q_seq, round(pax + t * (pbx - pax), 6) AS x, round(pay + t * (pby - pay), 6) AS y, pax, pay, pbx, pby, qax, qay, qbx, qby FROM
 (SELECT *, ((qax - pax) * (qby - qay) - (qay - pay) * (qbx - qax)) / den AS t, ((qax - pax) * (pby - pay) - (qay - pay) * (pbx - pax)) / den AS u FROM
 (SELECT p.line AS p_line, p.seq AS p_seq, q.line AS q_line, q.seq AS q_seq, p.ax AS pax, p.ay AS pay, p.bx AS pbx, p.by_ AS pby, q.ax AS qax, q.ay AS qay, q.bx AS qbx, q.by_ AS qby,
 (p.bx - p.ax) * (q.by_ - q.ay) - (p.by_ - p.ay) * (q.bx - q.ax) AS den FROM {e} p JOIN {e} q ON {on}
 AND least(p.ax, p.bx) <= greatest(q.ax, q.bx) AND least(q.ax, q.bx) <= greatest(p.ax, p.bx) AND least(p.ay, p.by_) <= greatest(q.ay, q.by_) AND least(q.ay, q.by_) <= greatest(p.ay, p.by_)) WHERE abs(den) > 1e-12) WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1)
 {where} GROUP BY ALL"""
_NOT_END = "WHERE NOT (" + " OR ".join(f"(abs(x - {s}x) <= 1e-6 AND abs(y - {s}y) <= 1e-6)" for s in ("pa", "pb", "qa", "qb")) + ")"


@add(_CROSS.format(e=_edges_sql("lane_lines"), on="p.line < q.line", where=_NOT_END))
def j3_line_crossings(spark: SparkSession, d: str) -> DataFrame:
    return J.crossings(S.edges(lines(spark, d)), 50.0).groupBy("p_line", "q_line").agg(F.count("*").alias("n"))


@add(_CROSS.format(e=_edges_sql("roads"), on="p.line = q.line AND q.seq > p.seq + 1", where=""))
def j4_self_crossings(spark: SparkSession, d: str) -> DataFrame:
    return J.crossings(S.edges(lines(spark, d, "roads")), 50.0, same_line=True).groupBy("p_line", "q_line").agg(F.count("*").alias("n"))


@add(_CROSS.format(e=_edges_sql("lanes"), on="p.line = q.line AND q.seq > p.seq + 1 AND NOT (p.seq = 0 AND q.seq = (SELECT max(seq) FROM " + _edges_sql("lanes") + " m WHERE m.line = q.line))", where=""))
def j5_ring_crossings(spark: SparkSession, d: str) -> DataFrame:
    edges = S.edges(lines(spark, d, "lanes"))
    edges = edges.withColumn("n_edges", F.count("*").over(Window.partitionBy("line")))
    return J.crossings(edges, 50.0, same_line=True, ring=True).groupBy("p_line", "q_line").agg(F.count("*").alias("n"))


_ENDS = f"(SELECT fid, ring[1].x AS sx, ring[1].y AS sy, ring[len(ring)].x AS ex, ring[len(ring)].y AS ey, next_id FROM {_cur('lane_lines', 'next_id')})"


@add(
    f"""SELECT id, ref_id, CASE WHEN n.fid IS NULL THEN 'missing' ELSE 'apart' END AS problem FROM (SELECT DISTINCT fid AS id, ex, ey, upper(trim(v)) AS ref_id FROM (SELECT fid, ex, ey, unnest(regexp_split_to_array(coalesce(next_id, ''), '[,;|/\\s]+')) AS v FROM {_ENDS})
 WHERE upper(trim(v)) NOT IN ('', '0', '-1', 'NULL', 'NONE', 'NAN')) l LEFT JOIN {_ENDS} n ON n.fid = l.ref_id WHERE n.fid IS NULL OR sqrt(pow(l.ex - n.sx, 2) + pow(l.ey - n.sy, 2)) > 5"""
)
def j6_link_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = current(spark, d, "lane_lines", "next_id")
    end = F.element_at("ring", -1)
    features = rows.select(F.col("fid").alias("id"), F.col("ring")[0]["x"].alias("sx"), F.col("ring")[0]["y"].alias("sy"), end["x"].alias("ex"), end["y"].alias("ey"))
    links = rows.select(F.col("fid").alias("id"), F.explode(R.reference_list(F.col("next_id"))).alias("ref_id"), F.lit("next").alias("kind"))
    return J.link_errors(features, links, 5.0).select("id", "ref_id", "problem")


@add(f"SELECT l_id, array_to_string(list_sort(list(r_id)), ',') AS suspects FROM {_near_sql('lane_lines', 'lane_lines', 60)} WHERE l_id <> r_id GROUP BY l_id")
def j7_suspected_links(spark: SparkSession, d: str) -> DataFrame:
    pairs = J.within(_first(spark, d, "lane_lines", "l"), _first(spark, d, "lane_lines", "r"), 60.0).where("l_id <> r_id")
    return pairs.groupBy("l_id").agg(F.array_join(F.array_sort(F.collect_list("r_id")), ",").alias("suspects"))


@add(f"SELECT l_id, arg_min(r_id, (round(distance, 9), r_id)) AS r_id, round(min(distance), 6) AS distance FROM {_near_sql('lanes', 'roads', 400)} GROUP BY l_id")
def j8_nearest_match(spark: SparkSession, d: str) -> DataFrame:
    found = J.nearest(_first(spark, d, "lanes", "l"), _first(spark, d, "roads", "r"), 400.0, "l_id", "r_id")
    return found.select("l_id", "r_id", F.round("distance", 6).alias("distance"))


@add(f"SELECT fid AS r_id FROM {_cur('roads')} WHERE fid NOT IN (SELECT arg_min(r_id, (round(distance, 9), r_id)) FROM {_near_sql('lanes', 'roads', 400)} GROUP BY l_id)")
def j8_unmatched(spark: SparkSession, d: str) -> DataFrame:
    right = _first(spark, d, "roads", "r")
    return right.select("r_id").join(J.nearest(_first(spark, d, "lanes", "l"), right, 400.0, "l_id", "r_id"), "r_id", "left_anti")


@add()
def j9_truth_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Lanes in clusters of start points at most 120 m apart, with the cluster's least id; only clusters a road starts near."""
    left = _first(spark, d, "lanes", "l")
    linked = J.within(left, left.toDF("r_id", "r_x", "r_y"), 120.0).where("l_id < r_id").select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))
    found = cluster.connected_components(left.select(F.col("l_id").alias("node")), linked)
    touched = J.within(left, _first(spark, d, "roads", "r"), 120.0).select(F.col("l_id").alias("node")).distinct()
    hit = found.join(touched, "node").select("component").distinct()
    return found.join(hit, "component", "left_semi").select(F.col("node").alias("l_id"), "component")


@add(f"SELECT l_id, array_to_string(list(r_id ORDER BY round(distance, 9), r_id), ',') AS by_distance FROM {_near_sql('roads', 'lane_lines', 300)} GROUP BY l_id")
def j10_sorted_neighbours(spark: SparkSession, d: str) -> DataFrame:
    pairs = J.within(_first(spark, d, "roads", "l"), _first(spark, d, "lane_lines", "r"), 300.0)
    return pairs.groupBy("l_id").agg(F.array_sort(F.collect_list(F.struct(F.round("distance", 9).alias("d"), "r_id"))).alias("s")).select("l_id", F.array_join("s.r_id", ",").alias("by_distance"))


@add(f"SELECT pid, min(d2) AS d FROM (SELECT a.pid, round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)), 6) AS d2 FROM {_POINTS} a JOIN (SELECT DISTINCT CAST(p_size AS DOUBLE) AS x, p_retailprice / 50 AS y, 0.5 AS z FROM part) b ON a.x BETWEEN b.x - 1 AND b.x + 1 AND a.y BETWEEN b.y - 1 AND b.y + 1 AND abs(a.z - b.z) <= 1) WHERE d2 <= 1 GROUP BY pid")
def j12_nearest_3d(spark: SparkSession, d: str) -> DataFrame:
    left = points(spark, d).select("pid", F.col("x").alias("l_x"), F.col("y").alias("l_y"), F.col("z").alias("l_z"))
    right = table(spark, d, "part").select(F.col("p_size").cast("double").alias("r_x"), (F.col("p_retailprice") / 50).alias("r_y"), F.lit(0.5).alias("r_z")).distinct()
    pairs = J.within(left, right, 1.001, ["x", "y", "z"]).withColumn("d", F.round("distance", 6)).where("d <= 1")
    return pairs.groupBy("pid").agg(F.min("d").alias("d"))


_DIR = "(SELECT fid, ring[1].x AS x, ring[1].y AS y, ring[2].x - ring[1].x AS dx, ring[2].y - ring[1].y AS dy FROM {} WHERE len(ring) > 1 AND (ring[2].x <> ring[1].x OR ring[2].y <> ring[1].y))"


@add(
    f"""SELECT l.fid AS l_id, r.fid AS r_id FROM {_DIR.format(_cur('lane_lines'))} l JOIN {_DIR.format(_cur('lanes'))} r ON l.x BETWEEN r.x - 300 AND r.x + 300 AND l.y BETWEEN r.y - 300 AND r.y + 300
 WHERE sqrt(pow(l.x - r.x, 2) + pow(l.y - r.y, 2)) <= 300 AND abs((l.dx * (r.y - l.y) - l.dy * (r.x - l.x)) / sqrt(l.dx * l.dx + l.dy * l.dy)) <= 150 AND abs((l.dx * (r.x - l.x) + l.dy * (r.y - l.y)) / sqrt(l.dx * l.dx + l.dy * l.dy)) <= 250
 AND degrees(acos(greatest(-1, least(1, (l.dx * r.dx + l.dy * r.dy) / sqrt((l.dx * l.dx + l.dy * l.dy) * (r.dx * r.dx + r.dy * r.dy)))))) <= 30"""
)
def j13_band_join(spark: SparkSession, d: str) -> DataFrame:
    def directed(layer: str, p: str) -> DataFrame:
        a, b = F.col("ring")[0], F.col("ring")[1]
        rows = current(spark, d, layer).where("size(ring) > 1").select(F.col("fid").alias(f"{p}_id"), a["x"].alias(f"{p}_x"), a["y"].alias(f"{p}_y"), (b["x"] - a["x"]).alias(f"{p}_dx"), (b["y"] - a["y"]).alias(f"{p}_dy"))
        return rows.where(f"{p}_dx <> 0 OR {p}_dy <> 0")

    c = F.col
    pairs = J.within(directed("lane_lines", "l"), directed("lanes", "r"), 300.0)
    frame = (c("r_x"), c("r_y"), c("l_x"), c("l_y"), c("l_dx"), c("l_dy"))
    return pairs.where((F.abs(G.lateral(*frame)) <= 150) & (F.abs(G.longitudinal(*frame)) <= 250) & (G.angle_between(c("l_dx"), c("l_dy"), c("r_dx"), c("r_dy")) <= 30)).select("l_id", "r_id")


_POSE_TIMES = "(SELECT DISTINCT pose_id, trim(trail_id) AS who, try_cast(regexp_extract(frame_id_str, '^([0-9]{13})_', 1) AS BIGINT) AS b FROM key_poses)"


@add(f"SELECT frame_no, pose_id FROM (SELECT frame_no, pose_id, row_number() OVER (PARTITION BY frame_no ORDER BY abs(a - b), b, pose_id) AS k FROM (SELECT DISTINCT frame_no, trail_id, stamp_ms AS a FROM frames) f JOIN {_POSE_TIMES} p ON p.who = trail_id AND b BETWEEN a - 999 AND a + 999) WHERE k = 1")
def j14_nearest_pose(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "frames").select("frame_no", F.col("trail_id").alias("who"), F.col("stamp_ms").alias("moment"))
    right = table(spark, d, "key_poses").select("pose_id", F.trim("trail_id").alias("who"), F.nullif(F.regexp_extract("frame_id_str", r"^([0-9]{13})_", 1), F.lit("")).cast("bigint").alias("moment"))
    found = asof.nearest_time(left, right, "frame_no", "pose_id", "who", "moment", 999, 60_000)
    return found.select(F.col("left_id").alias("frame_no"), F.col("right_id").alias("pose_id"))


@add("SELECT DISTINCT k.pose_id, f.frame_no FROM key_poses k JOIN frames f ON trim(k.trail_id) = f.trail_id AND try_cast(regexp_extract(frame_id_str, '^([0-9]{13})_', 1) AS BIGINT) = f.stamp_ms - 8")
def j15_exact_time(spark: SparkSession, d: str) -> DataFrame:
    poses = table(spark, d, "key_poses").select("pose_id", F.trim("trail_id").alias("trail_id"), (F.nullif(F.regexp_extract("frame_id_str", r"^([0-9]{13})_", 1), F.lit("")).cast("bigint") + 8).alias("stamp_ms"))
    return poses.join(table(spark, d, "frames"), ["trail_id", "stamp_ms"]).select("pose_id", "frame_no").distinct()


_POSE_MICROS = """(SELECT DISTINCT pose_id, trim(trail_id) AS who, CAST(round(CASE WHEN v < 1e11 THEN v * 1000000 WHEN v < 1e14 THEN v * 1000 WHEN v < 1e17 THEN v ELSE v / 1000 END) AS BIGINT) AS b
 FROM (SELECT *, try_cast(regexp_extract(frame_id_str, '^\\s*([0-9]{9,20}(\\.[0-9]{1,9})?)_', 1) AS DECIMAL(38, 9)) AS v FROM key_poses) WHERE v >= 100000000)"""


def _pose_micros(spark: SparkSession, d: str) -> DataFrame:
    """pose_id, who, moment: a pose's time in microseconds, in whichever unit and precision it is written."""
    return table(spark, d, "key_poses").select("pose_id", F.trim("trail_id").alias("who"), asof.epoch_micros(F.regexp_extract("frame_id_str", r"^\s*([0-9.]+)_", 1)).alias("moment"))


@add(f"SELECT frame_no, pose_id FROM (SELECT frame_no, pose_id, row_number() OVER (PARTITION BY frame_no ORDER BY abs(a - b), b, pose_id) AS k FROM (SELECT DISTINCT frame_no, trim(trail_id) AS trail_id, stamp_ms * 1000 AS a FROM frames) f JOIN {_POSE_MICROS} p ON p.who = trail_id AND b BETWEEN a - 999999 AND a + 999999) WHERE k = 1")
def j14_nearest_pose_any_unit(spark: SparkSession, d: str) -> DataFrame:
    """The nearest pose under 1000 ms away, over all poses with a usable time; j14_nearest_pose, as its SQL, reads whole milliseconds only."""
    left = table(spark, d, "frames").select("frame_no", F.trim("trail_id").alias("who"), (F.col("stamp_ms") * 1000).alias("moment"))
    found = asof.nearest_time(left, _pose_micros(spark, d), "frame_no", "pose_id", "who", "moment", 999_999, 60_000_000)
    return found.select(F.col("left_id").alias("frame_no"), F.col("right_id").alias("pose_id"))


@add(f"SELECT DISTINCT p.pose_id, f.frame_no FROM {_POSE_MICROS} p JOIN frames f ON p.who = trim(f.trail_id) AND p.b = f.stamp_ms * 1000 - 8000")
def j15_exact_time_any_unit(spark: SparkSession, d: str) -> DataFrame:
    """Frames 8 ms after a pose, over all poses with a usable time; j15_exact_time, as its SQL, reads whole milliseconds only."""
    poses = _pose_micros(spark, d).withColumn("moment", F.col("moment") + 8000)
    frames = table(spark, d, "frames").select("frame_no", F.trim("trail_id").alias("who"), (F.col("stamp_ms") * 1000).alias("moment"))
    return poses.join(frames, ["who", "moment"]).select("pose_id", "frame_no").distinct()


@add("SELECT trail_id, count(*) AS n FROM (SELECT DISTINCT trail_id, frame_no FROM frames) WHERE trail_id IN (SELECT trail_id FROM flat_mapping_info) GROUP BY trail_id")
def j17_member_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "frames").select("trail_id", "frame_no").distinct().join(table(spark, d, "flat_mapping_info").select("trail_id"), "trail_id", "left_semi").groupBy("trail_id").agg(F.count("*").alias("n"))


@add(
    f"""SELECT p.line, g.fid FROM (SELECT line, avg(x) AS x, avg(y) AS y FROM {_vert('roads')} GROUP BY line) p JOIN (SELECT line AS fid, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM {_vert('roads')} GROUP BY line) g ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1
 JOIN {_edges_sql('roads')} e ON e.line = g.fid GROUP BY p.line, g.fid, x, y HAVING count(*) FILTER (WHERE (e.ay > y) <> (e.by_ > y) AND x < (e.bx - e.ax) * (y - e.ay) / (e.by_ - e.ay) + e.ax) % 2 = 1"""
)
def j18_points_in_polygons(spark: SparkSession, d: str) -> DataFrame:
    centres = lines(spark, d, "roads").groupBy("line").agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    return J.in_polygons(centres, current(spark, d, "roads"), 100.0).select("line", "fid")


@add(
    f"""WITH n AS (SELECT l.fid AS l_id, r.fid AS r_id, sqrt(pow(l.x - r.x, 2) + pow(l.y - r.y, 2)) AS dist, CASE WHEN l.dx * (r.y - l.y) - l.dy * (r.x - l.x) >= 0 THEN 'left' ELSE 'right' END AS side FROM {_DIR.format(_cur('roads'))} l JOIN {_FIRST.format(_cur('lane_lines'))} r ON l.x BETWEEN r.x - 300 AND r.x + 300 AND l.y BETWEEN r.y - 300 AND r.y + 300)
 SELECT l_id, side, arg_min(r_id, (round(dist, 9), r_id)) AS r_id FROM n WHERE dist <= 300 GROUP BY ALL"""
)
def j19_nearest_per_side(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("ring")[0], F.col("ring")[1]
    left = current(spark, d, "roads").where("size(ring) > 1").select(F.col("fid").alias("l_id"), a["x"].alias("l_x"), a["y"].alias("l_y"), (b["x"] - a["x"]).alias("dx"), (b["y"] - a["y"]).alias("dy")).where("dx <> 0 OR dy <> 0")
    pairs = J.within(left, _first(spark, d, "lane_lines", "r"), 300.0)
    side = F.when(G.cross(F.col("dx"), F.col("dy"), F.col("r_x") - F.col("l_x"), F.col("r_y") - F.col("l_y")) >= 0, "left").otherwise("right")
    return pairs.groupBy("l_id", side.alias("side")).agg(F.min_by("r_id", F.struct(F.round("distance", 9), "r_id")).alias("r_id"))


@add(f"SELECT l_id, count(*) AS n FROM (SELECT l.fid AS l_id FROM (SELECT *, 100 + 5 * (len(fid) % 3) + least(200, 10 * abs(dx)) AS rad FROM {_DIR.format(_cur('roads'))}) l JOIN {_FIRST.format(_cur('lane_lines'))} r ON l.x BETWEEN r.x - 320 AND r.x + 320 AND l.y BETWEEN r.y - 320 AND r.y + 320 WHERE sqrt(pow(l.x - r.x, 2) + pow(l.y - r.y, 2)) <= rad) GROUP BY l_id")
def j22_own_radius(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("ring")[0], F.col("ring")[1]
    left = current(spark, d, "roads").where("size(ring) > 1").select(F.col("fid").alias("l_id"), a["x"].alias("l_x"), a["y"].alias("l_y"), (b["x"] - a["x"]).alias("dx"), (b["y"] - a["y"]).alias("dy")).where("dx <> 0 OR dy <> 0")
    left = left.withColumn("rad", 100 + 5 * (F.length("l_id") % 3) + F.least(F.lit(200.0), 10 * F.abs("dx")))
    return J.within_own_radius(left, _first(spark, d, "lane_lines", "r"), "rad", 320.0).groupBy("l_id").agg(F.count("*").alias("n"))


@add("SELECT c_custkey, array_to_string(list(o_orderkey ORDER BY o_orderdate, o_orderkey), ',') AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey HAVING count(o_orderkey) > 0")
def j25_one_to_many(spark: SparkSession, d: str) -> DataFrame:
    packed = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))).alias("s"))
    return table(spark, d, "customer").join(packed, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", F.array_join(F.col("s.o_orderkey").cast("array<string>"), ",").alias("orders"))


@add("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def j26_cascade(spark: SparkSession, d: str) -> DataFrame:
    """What stays of the children once the parents with a status are deleted."""
    gone = table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_orderkey")
    return table(spark, d, "lineitem").join(gone, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("l_orderkey", "l_linenumber")


@add(f"WITH n AS (SELECT a.pid, (SELECT count(*) FROM {_POINTS} b WHERE b.x BETWEEN a.x - 0.5 AND a.x + 0.5 AND b.y BETWEEN a.y - 0.5 AND a.y + 0.5 AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.5) - 1 AS n_near FROM {_POINTS} a) SELECT pid, CAST(n_near AS BIGINT) AS n_near FROM n WHERE n_near < 12")
def f24_sparse_points(spark: SparkSession, d: str) -> DataFrame:
    return J.outliers_by_count(points(spark, d), 0.5, 12, "pid")


# Clusters


@add(
    f"""WITH RECURSIVE e AS (SELECT l_id AS a, r_id AS b FROM {_near_sql('lanes', 'lanes', 120)}), reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a) SELECT a AS node, min(b) AS component FROM reach GROUP BY a"""
)
def h2_components(spark: SparkSession, d: str) -> DataFrame:
    left = _first(spark, d, "lanes", "l")
    linked = J.within(left, left.toDF("r_id", "r_x", "r_y"), 120.0).where("l_id < r_id").select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))
    return cluster.connected_components(left.select(F.col("l_id").alias("node")), linked)


@add()
def h1_dbscan(spark: SparkSession, d: str) -> DataFrame:
    return cluster.dbscan(points(spark, d).select("pid", "x", "y"), "pid", ["x", "y"], 0.15, 3)


@add()
def h4_raster_components(spark: SparkSession, d: str) -> DataFrame:
    cells = points(spark, d).groupBy(F.floor("x").alias("cx"), F.floor("y").alias("cy")).agg(F.count("*").alias("n")).where("n >= 2")
    return cluster.raster_components(cells)


@add(
    """WITH c AS (SELECT DISTINCT CAST(floor(l_quantity) AS BIGINT) AS cx, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS cy FROM lineitem), o AS (SELECT a.range - 1 AS dx, b.range - 1 AS dy FROM range(3) a, range(3) b),
 e AS (SELECT cx + dx AS cx, cy + dy AS cy FROM c, o GROUP BY ALL HAVING count(*) = 9) SELECT DISTINCT cx + dx AS cx, cy + dy AS cy FROM e, o"""
)
def h5_opened(spark: SparkSession, d: str) -> DataFrame:
    return cluster.opened(points(spark, d).select(F.floor("x").alias("cx"), F.floor("y").alias("cy")))


_FOLD = "list_reduce(r, lambda s, p: CASE WHEN s.last IS NULL OR s.last - p.z <= 0.5 THEN {'last': p.z, 'out': s.out || [{'id': p.id, 'layer': 1}]} ELSE {'last': s.last, 'out': s.out || [{'id': p.id, 'layer': 2}]} END, {'last': CAST(NULL AS DOUBLE), 'out': CAST([] AS STRUCT(id BIGINT, layer INT)[])})"


@add(f"SELECT o.id AS id, o.layer AS layer FROM (SELECT unnest(({_FOLD}).out) AS o FROM (SELECT list({{'z': CAST(z AS DOUBLE), 'id': CAST(pid AS BIGINT)}} ORDER BY z DESC, pid DESC) AS r FROM {_POINTS} GROUP BY floor(x / 2), floor(y / 2)))")
def h6_two_layers(spark: SparkSession, d: str) -> DataFrame:
    return cluster.two_layers(points(spark, d).select("x", "y", (F.col("z") * 1.0).alias("z"), F.col("pid").alias("id")), 2.0, 0.5).select(F.col("id").cast("bigint").alias("id"), "layer")


@add(
    """WITH c AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS cx, CAST(floor(l_extendedprice / 1000) AS BIGINT) AS cy, avg(l_discount) AS z FROM lineitem GROUP BY 1, 2)
 SELECT a.cx, a.cy, round(sum(b.z * exp(-(pow(a.cx - b.cx, 2) + pow(a.cy - b.cy, 2)) / 8)) / sum(exp(-(pow(a.cx - b.cx, 2) + pow(a.cy - b.cy, 2)) / 8)), 6) AS z_mean, count(*) AS n_cells FROM c a JOIN c b ON abs(a.cx - b.cx) <= 3 AND abs(a.cy - b.cy) <= 3 GROUP BY ALL"""
)
def h7_smoothed_heights(spark: SparkSession, d: str) -> DataFrame:
    import math

    cells = table(spark, d, "lineitem").groupBy(F.floor("l_quantity").alias("cx"), F.floor(F.col("l_extendedprice") / 1000).alias("cy")).agg(F.avg("l_discount").alias("z"))
    return cluster.neighbour_mean(cells, "z", (3, 3), lambda a, b: math.exp(-(a * a + b * b) / 8)).select("cx", "cy", F.round("z_mean", 6).alias("z_mean"), "n_cells")


@add()
def h10_hulls(spark: SparkSession, d: str) -> DataFrame:
    return cluster.convex_hulls(trail_points(spark, d), "line", "x", "y")


@add("WITH t AS (SELECT l_partkey AS i, l_suppkey + 100000 AS j, l_orderkey + 200000 AS k FROM lineitem), e AS (SELECT least(i, j) AS a, greatest(i, j) AS b FROM t UNION ALL SELECT least(j, k), greatest(j, k) FROM t UNION ALL SELECT least(k, i), greatest(k, i) FROM t) SELECT a, b FROM e GROUP BY ALL HAVING count(*) = 1")
def h11_boundary_edges(spark: SparkSession, d: str) -> DataFrame:
    return cluster.boundary_edges(table(spark, d, "lineitem").select(F.col("l_partkey").alias("i"), (F.col("l_suppkey") + 100000).alias("j"), (F.col("l_orderkey") + 200000).alias("k")))


@add(f"WITH a AS (SELECT line, atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) / 2 AS t FROM {_TRAIL} GROUP BY line) SELECT line, round(max(x * cos(t) + y * sin(t)) - min(x * cos(t) + y * sin(t)), 2) AS length, round(max(y * cos(t) - x * sin(t)) - min(y * cos(t) - x * sin(t)), 2) AS width FROM {_TRAIL} JOIN a USING (line) GROUP BY line")
def h16_oriented_box(spark: SparkSession, d: str) -> DataFrame:
    angle = A.line_fit(F.col("x"), F.col("y"))[2]
    return cluster.oriented_box(trail_points(spark, d), ["line"], "x", "y", angle).select("line", F.round("length", 2).alias("length"), F.round("width", 2).alias("width"))


@add()
def u6_clipped(spark: SparkSession, d: str) -> DataFrame:
    """Roads clipped to a box, with the area that is left."""
    box = [(-4000.0, -4000.0), (4000.0, -4000.0), (4000.0, 4000.0), (-4000.0, 4000.0)]
    clipped = current(spark, d, "roads").select("fid", J.clip_to_convex("ring", box).alias("ring"))
    return clipped.where("size(ring) > 2").select("fid", F.round(F.abs(G.signed_area(F.col("ring"))), 3).alias("area"))


QUERIES, ORACLE = catalog.queries, catalog.sql
