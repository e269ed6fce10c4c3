"""Queries of the operators that make map features, and of the remaining joins, sets and geometry functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.operators import cluster
from cairnflow.operators import mapping as M
from cairnflow.operators import sequence as S
from cairnflow.operators import scope
from cairnflow.operators import spatial as J
from cairnflow.operators import references as R
from cairnflow.plans.catalog import Catalog
from cairnflow.plans.relational import _POINTS, points
from cairnflow.plans.spatial import _FIRST, _TRAIL, _cur, _edges_sql, _first, _near_sql, _vert, current, lines, trail_points
from cairnflow.session import table

catalog = Catalog()
add = catalog.add


@add(
    """SELECT frame_no, round((1 - 2 * (y * y + z * z)) * 1 + 2 * (x * y - w * z) * 2 + 2 * (x * z + w * y) * 0.5 + t1, 3) AS wx, round(2 * (x * y + w * z) * 1 + (1 - 2 * (x * x + z * z)) * 2 + 2 * (y * z - w * x) * 0.5 + t2, 3) AS wy
 FROM (SELECT DISTINCT frame_no, opt_q_world_veh[1] AS x, opt_q_world_veh[2] AS y, opt_q_world_veh[3] AS z, opt_q_world_veh[4] AS w, opt_t_world_veh[1] AS t1, opt_t_world_veh[2] AS t2 FROM frames WHERE len(opt_q_world_veh) = 4 AND len(opt_t_world_veh) = 3 AND abs(opt_t_world_veh[1]) < 50000 AND abs(opt_t_world_veh[2]) < 50000)"""
)
def g26_to_world(spark: SparkSession, d: str) -> DataFrame:
    frames = table(spark, d, "frames").select("frame_no", F.col("opt_q_world_veh").alias("q"), F.col("opt_t_world_veh").alias("t")).where("size(t) = 3 AND abs(t[0]) < 50000 AND abs(t[1]) < 50000").distinct()
    local = frames.select("frame_no", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.lit(0.5).alias("z"))
    return M.to_world(local, frames, "frame_no").select("frame_no", F.round("wx", 3).alias("wx"), F.round("wy", 3).alias("wy"))


_TILE = " + ".join(f"((cx >> {b}) & 1) * {1 << (2 * b)} + ((cy >> {b}) & 1) * {1 << (2 * b + 1)}" for b in range(13))


@add(f"SELECT DISTINCT pose_id, CAST({_TILE} + CASE WHEN lon < 0 THEN 67108864 ELSE 0 END AS BIGINT) AS tile FROM (SELECT pose_id, lon, CAST(floor(lon * 8192 / 180) AS BIGINT) & 8191 AS cx, CAST(floor(lat * 8192 / 180) AS BIGINT) & 8191 AS cy FROM key_poses WHERE lat IS NOT NULL AND lon IS NOT NULL)")
def g30_integer_tile(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "key_poses").where("lat IS NOT NULL AND lon IS NOT NULL").select("pose_id", G.integer_tile(F.col("lat"), F.col("lon")).alias("tile")).distinct()


@add(f"SELECT line, id, round(abs(x - 10) + abs(y - 20), 3) AS manhattan, round(sqrt(pow(x - 10, 2) + pow(y - 20, 2) + pow(z, 2)), 3) AS d3, round((3 * (y - 20) - 4 * (x - 10)) / 5, 3) AS lat, round((3 * (x - 10) + 4 * (y - 20)) / 5, 3) AS lon FROM {_TRAIL}")
def g3_frame_of_a_line(spark: SparkSession, d: str) -> DataFrame:
    x, y, z, n = F.col("x"), F.col("y"), F.col("z"), F.lit
    frame = (x, y, n(10.0), n(20.0), n(3.0), n(4.0))
    return trail_points(spark, d).select(
        "line", "id", F.round(F.abs(x - 10) + F.abs(y - 20), 3).alias("manhattan"), F.round(G.distance3((x, y, z), (n(10.0), n(20.0), n(0.0))), 3).alias("d3"), F.round(G.lateral(*frame), 3).alias("lat"), F.round(G.longitudinal(*frame), 3).alias("lon")
    )


_BOX = [(-3000.0, -2000.0), (3000.0, -2000.0), (3000.0, 2000.0), (-3000.0, 2000.0)]


@add(
    f"""SELECT line, round(sum((t1 - t0) * len), 3) AS inside FROM (SELECT line, sqrt(pow(bx - ax, 2) + pow(by_ - ay, 2)) AS len,
 greatest(0, CASE WHEN bx > ax THEN (-3000 - ax) / (bx - ax) WHEN bx < ax THEN (3000 - ax) / (bx - ax) ELSE 0 END, CASE WHEN by_ > ay THEN (-2000 - ay) / (by_ - ay) WHEN by_ < ay THEN (2000 - ay) / (by_ - ay) ELSE 0 END) AS t0,
 least(1, CASE WHEN bx > ax THEN (3000 - ax) / (bx - ax) WHEN bx < ax THEN (-3000 - ax) / (bx - ax) ELSE 1 END, CASE WHEN by_ > ay THEN (2000 - ay) / (by_ - ay) WHEN by_ < ay THEN (-2000 - ay) / (by_ - ay) ELSE 1 END) AS t1,
 (bx = ax AND abs(ax) > 3000) OR (by_ = ay AND abs(ay) > 2000) AS off FROM {_edges_sql('lane_lines')}) WHERE NOT off AND t0 <= t1 GROUP BY line"""
)
def g12_lines_in_box(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    e = S.edges(lines(spark, d)).withColumn("r", G.clip_range(c("ax"), c("ay"), c("bx"), c("by"), _BOX)).where("r IS NOT NULL")
    return e.groupBy("line").agg(F.round(F.sum((c("r.t1") - c("r.t0")) * G.distance(c("ax"), c("ay"), c("bx"), c("by"))), 3).alias("inside"))


@add(f"SELECT line, id, round(degrees(atan2(sqrt(nx * nx + ny * ny), abs(nz))), 3) AS slope FROM (SELECT line, id, uy * vz - uz * vy AS nx, uz * vx - ux * vz AS ny, ux * vy - uy * vx AS nz FROM (SELECT line, id, lead(x) OVER w - x AS ux, lead(y) OVER w - y AS uy, lead(z) OVER w - z AS uz, lead(x, 2) OVER w - x AS vx, lead(y, 2) OVER w - y AS vy, lead(z, 2) OVER w - z AS vz FROM {_TRAIL} WINDOW w AS (PARTITION BY line ORDER BY seq, id)) WHERE vx IS NOT NULL) WHERE abs(nz) > 1e-6")
def g24_triangle_slope(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("line").orderBy("seq", "id")
    p = [tuple(F.lead(a, k).over(w) if k else F.col(a) for a in "xyz") for k in range(3)]
    r = trail_points(spark, d).select("line", "id", *[p[k][i].alias(f"{a}{k}") for k in range(3) for i, a in enumerate("xyz")]).where("x2 IS NOT NULL")
    c = [tuple(F.col(f"{a}{k}") for a in "xyz") for k in range(3)]
    nz = (c[1][0] - c[0][0]) * (c[2][1] - c[0][1]) - (c[1][1] - c[0][1]) * (c[2][0] - c[0][0])
    return r.where(F.abs(nz) > 1e-6).select("line", "id", F.round(G.triangle_slope(*c)[0], 3).alias("slope"))


@add()
def g22_simplified(spark: SparkSession, d: str) -> DataFrame:
    return M.simplified(current(spark, d, "lane_lines"), "fid", "ring", 0.5)


_GAP = """SELECT g.l_id, g.r_id, min(sqrt(pow(v.x - ax - t * (bx - ax), 2) + pow(v.y - ay - t * (by_ - ay), 2))) AS gap FROM
 (SELECT n.l_id, n.r_id, v.x, v.y, e.ax, e.ay, e.bx, e.by_, CASE WHEN e.bx = e.ax AND e.by_ = e.ay THEN 0 ELSE least(1, greatest(0, ((v.x - e.ax) * (e.bx - e.ax) + (v.y - e.ay) * (e.by_ - e.ay)) / (pow(e.bx - e.ax, 2) + pow(e.by_ - e.ay, 2)))) END AS t
 FROM n JOIN {v} v ON v.line = n.{a} JOIN {e} e ON e.line = n.{b}) g, LATERAL (SELECT g.x, g.y) v GROUP BY ALL"""


@add(
    f"""WITH n AS (SELECT l.fid AS l_id, r.fid AS r_id FROM {_FIRST.format(_cur('roads'))} l JOIN {_FIRST.format(_cur('lane_lines'))} r ON l.x BETWEEN r.x - 150 AND r.x + 150 AND l.y BETWEEN r.y - 150 AND r.y + 150 WHERE sqrt(pow(l.x - r.x, 2) + pow(l.y - r.y, 2)) <= 150)
 SELECT l_id, r_id, round(min(gap), 4) AS gap FROM ({_GAP.format(v=_vert('roads'), e=_edges_sql('lane_lines'), a='l_id', b='r_id')} UNION ALL {_GAP.format(v=_vert('lane_lines'), e=_edges_sql('roads'), a='r_id', b='l_id')}) GROUP BY ALL"""
)
def g13_line_gap(spark: SparkSession, d: str) -> DataFrame:
    pairs = J.within(_first(spark, d, "roads", "l"), _first(spark, d, "lane_lines", "r"), 150.0).select("l_id", "r_id")
    a, b = current(spark, d, "roads").toDF("l_id", "l_ring"), current(spark, d, "lane_lines").toDF("r_id", "r_ring")
    return pairs.join(a, "l_id").join(b, "r_id").select("l_id", "r_id", F.round(G.polyline_gap(F.col("l_ring"), F.col("r_ring")), 4).alias("gap"))


@add(f"SELECT round(sum(a * cx) / sum(a), 2) AS x, round(sum(a * cy) / sum(a), 2) AS y FROM (SELECT line, abs(sum(x * by_ - y * bx)) / 2 AS a, avg(x) AS cx, avg(y) AS cy FROM (SELECT line, ax AS x, ay AS y, bx, by_ FROM {_edges_sql('lanes')}) GROUP BY line)")
def a10_layer_centre(spark: SparkSession, d: str) -> DataFrame:
    e = S.edges(lines(spark, d, "lanes"))
    per = e.groupBy("line").agg((F.abs(F.sum(G.cross(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")))) / 2).alias("a"), F.avg("ax").alias("cx"), F.avg("ay").alias("cy"))
    return per.agg(F.round(F.sum(F.col("a") * F.col("cx")) / F.sum("a"), 2).alias("x"), F.round(F.sum(F.col("a") * F.col("cy")) / F.sum("a"), 2).alias("y"))


@add(
    """WITH c AS (SELECT user_id, event_id, value, abs(value) + 1 AS w, sum(fresh) OVER (PARTITION BY user_id ORDER BY value, event_id) AS k FROM (SELECT *, CASE WHEN value - lag(value) OVER (PARTITION BY user_id ORDER BY value, event_id) <= 0.3 THEN 0 ELSE 1 END AS fresh FROM events)),
 g AS (SELECT user_id, k, count(*) AS n, sum(value * w) / sum(w) AS m FROM c GROUP BY ALL), b AS (SELECT user_id, arg_max(m, (n, -k)) AS m FROM g WHERE n >= 2 GROUP BY user_id)
 SELECT u.user_id, round(coalesce(b.m, u.v), 5) AS angle FROM (SELECT user_id, arg_max(value, (abs(value) + 1, event_id)) AS v FROM events GROUP BY user_id) u LEFT JOIN b ON b.user_id = u.user_id"""
)
def a24_angle_by_cluster(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("w", F.abs("value") + 1)
    return M.angle_by_cluster(rows, ["user_id"], "value", "w", "event_id", 0.3).select("user_id", F.round("angle", 5).alias("angle"))


@add(f"SELECT line, round(coalesce(sum(d), 0), 3) AS length FROM (SELECT line, sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)) AS d FROM {_TRAIL} WHERE id % 7 <> 0 WINDOW w AS (PARTITION BY line ORDER BY seq, id)) GROUP BY line")
def a26_valid_length(spark: SparkSession, d: str) -> DataFrame:
    rows = trail_points(spark, d).withColumn("order", F.struct("seq", "id"))
    return M.valid_length(rows, "line", "order", F.col("id") % 7 != 0).select("line", F.round("length", 3).alias("length"))


@add(f"SELECT l_id, arg_min(r_id, (round(abs(distance - 100), 9), r_id)) AS r_id FROM {_near_sql('roads', 'lane_lines', 300)} WHERE abs(distance - 100) <= 50 GROUP BY l_id")
def j11_nearest_offset(spark: SparkSession, d: str) -> DataFrame:
    """The lane line whose distance is nearest to the expected 100 m, within 50 m of it."""
    off = F.abs(F.col("distance") - 100)
    return J.within(_first(spark, d, "roads", "l"), _first(spark, d, "lane_lines", "r"), 300.0).where(off <= 50).groupBy("l_id").agg(F.min_by("r_id", F.struct(F.round(off, 9), "r_id")).alias("r_id"))


@add("SELECT frame_no, l.n_trails FROM (SELECT DISTINCT frame_no, link_id FROM frames) f JOIN (SELECT link_id, count(DISTINCT trail_id) AS n_trails FROM frames GROUP BY link_id) l ON f.link_id = l.link_id")
def j16_lookup(spark: SparkSession, d: str) -> DataFrame:
    frames = table(spark, d, "frames").select("frame_no", "link_id", "trail_id")
    per_link = frames.where("link_id IS NOT NULL").select("link_id", "trail_id").distinct().groupBy("link_id").agg(F.count("*").alias("n_trails"))
    return frames.select("frame_no", "link_id").distinct().join(per_link, "link_id").select("frame_no", "n_trails")


@add(f"SELECT fid AS l_id, 'alone' AS how FROM {_cur('roads')} WHERE fid NOT IN (SELECT l_id FROM {_near_sql('roads', 'lane_lines', 300)}) UNION ALL SELECT DISTINCT l_id, 'bound' FROM {_near_sql('roads', 'lane_lines', 300)}")
def j20_bound_or_alone(spark: SparkSession, d: str) -> DataFrame:
    left = _first(spark, d, "roads", "l")
    bound = J.within(left, _first(spark, d, "lane_lines", "r"), 300.0).select("l_id").distinct()
    return left.select("l_id").join(bound, "l_id", "left_anti").withColumn("how", F.lit("alone")).unionByName(bound.withColumn("how", F.lit("bound")))


@add(f"SELECT l_id AS road, count(*) AS n_lines, count(DISTINCT r_id) AS n_distinct FROM {_near_sql('roads', 'lane_lines', 300)} GROUP BY l_id HAVING count(*) >= 3")
def j23_near_nodes(spark: SparkSession, d: str) -> DataFrame:
    pairs = J.within(_first(spark, d, "roads", "l"), _first(spark, d, "lane_lines", "r"), 300.0)
    return pairs.groupBy(F.col("l_id").alias("road")).agg(F.count("*").alias("n_lines"), F.count_distinct("r_id").alias("n_distinct")).where("n_lines >= 3")


@add()
def w16_width_differences(spark: SparkSession, d: str) -> DataFrame:
    """Widths across lane lines between lane edges and between road edges."""
    e = S.edges(lines(spark, d)).where("ax <> bx OR ay <> by")
    c = F.col
    mid = e.select(F.concat_ws("#", "line", "seq").alias("ray"), ((c("ax") + c("bx")) / 2).alias("x"), ((c("ay") + c("by")) / 2).alias("y"), (c("bx") - c("ax")).alias("dx"), (c("by") - c("ay")).alias("dy"))
    rays = S.perpendicular_rays(mid, 150.0).select("ray", "ax", "ay", "bx", "by")
    return M.width_differences(rays, S.edges(lines(spark, d, "lanes")), S.edges(lines(spark, d, "roads")), 100.0)


@add(f"SELECT line, array_to_string(list(id ORDER BY round(-atan2(y, x), 9), id), ',') AS around FROM {_TRAIL} GROUP BY line")
def w18_by_azimuth(spark: SparkSession, d: str) -> DataFrame:
    a = F.round(-F.atan2("y", "x"), 9)
    return trail_points(spark, d).groupBy("line").agg(F.array_sort(F.collect_list(F.struct(a.alias("a"), "id"))).alias("s")).select("line", F.array_join(F.col("s.id").cast("array<string>"), ",").alias("around"))


@add()
def t1_sector_peaks(spark: SparkSession, d: str) -> DataFrame:
    rows = S.range_curvature(trail_points(spark, d).withColumn("order", F.struct("seq", "id")), "line", "order", "z").where("curvature IS NOT NULL").drop("order")
    return M.sector_peaks(rows, "line", "id", least=1.0)


@add("SELECT l_suppkey, array_to_string(list(l_linenumber ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber), ',') AS down FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey")
def t2_descending(spark: SparkSession, d: str) -> DataFrame:
    packed = F.array_sort(F.collect_list(F.struct((-F.col("l_extendedprice")).alias("p"), "l_orderkey", "l_linenumber")))
    return table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy("l_suppkey").agg(packed.alias("s")).select("l_suppkey", F.array_join(F.col("s.l_linenumber").cast("array<string>"), ",").alias("down"))


@add("SELECT id, count(*) AS n FROM (SELECT upper(trim(id)) AS id FROM lane_lines UNION ALL SELECT upper(trim(id)) FROM lanes UNION ALL SELECT upper(trim(id)) FROM roads) GROUP BY id")
def u2_union_all(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, n).select(R.normal_id(F.col("id")).alias("id")) for n in ("lane_lines", "lanes", "roads")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy("id").agg(F.count("*").alias("n"))


@add(
    f"""SELECT 'lanes' AS layer, line AS fid FROM (SELECT line, avg(ax) AS x, avg(ay) AS y FROM {_edges_sql('lanes')} GROUP BY line) WHERE x BETWEEN -3000 AND 3000 AND y BETWEEN -2000 AND 2000
 UNION ALL SELECT 'points', fid FROM {_FIRST.format(_cur('roads'))} WHERE x BETWEEN -3000 AND 3000 AND y BETWEEN -2000 AND 2000"""
)
def u7_clip_by_centre(spark: SparkSession, d: str) -> DataFrame:
    """Polygons kept by their centre, points by themselves."""
    inside = F.col("x").between(-3000, 3000) & F.col("y").between(-2000, 2000)
    centres = S.edges(lines(spark, d, "lanes")).groupBy(F.col("line").alias("fid")).agg(F.avg("ax").alias("x"), F.avg("ay").alias("y")).where(inside)
    starts = _first(spark, d, "roads", "l").toDF("fid", "x", "y").where(inside)
    return centres.select(F.lit("lanes").alias("layer"), "fid").unionByName(starts.select(F.lit("points").alias("layer"), "fid"))


@add(f"SELECT line, CAST(seq AS INT) AS seq, CAST(row_number() OVER (PARTITION BY line ORDER BY seq) - 1 AS INT) AS point_no, CAST(dense_rank() OVER (ORDER BY line) - 1 AS INT) AS line_no, round(x, 2) AS x FROM {_vert('lane_lines')}")
def k8_numbered_points(spark: SparkSession, d: str) -> DataFrame:
    return S.ordinals(lines(spark, d)).select("line", "seq", "point_no", "line_no", F.round("x", 2).alias("x"))


# Heavy operators


@add(
    """WITH c AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS cx, CAST(floor(l_extendedprice / 2000) AS BIGINT) AS cy, CAST(floor(l_discount * 50) AS BIGINT) AS cz, sum(l_tax) AS s, count(l_tax) AS n FROM lineitem GROUP BY 1, 2, 3)
 SELECT a.cx, a.cy, a.cz, round(sum(b.s) / sum(b.n), 10) AS v_mean, CAST(sum(b.n) AS BIGINT) AS n FROM c a JOIN c b ON b.cx BETWEEN a.cx - 2 AND a.cx + 2 AND b.cy BETWEEN a.cy - 2 AND a.cy + 2 AND b.cz BETWEEN a.cz - 1 AND a.cz + 1 GROUP BY ALL"""
)
def h8_box_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.floor("l_quantity").alias("cx"), F.floor(F.col("l_extendedprice") / 2000).alias("cy"), F.floor(F.col("l_discount") * 50).alias("cz"), F.col("l_tax").alias("v"))
    return M.box_mean(rows, ["cx", "cy", "cz"], [2, 2, 1], "v").select("cx", "cy", "cz", F.round("v_mean", 10).alias("v_mean"), "n")


@add()
def h12_merged_lights(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "key_poses").where("pose_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL").select("pose_id", "lat", "lon", "alt").distinct()
    east, north = G.to_utm(F.col("lat"), F.col("lon"))
    seen = rows.select(F.col("pose_id").alias("id"), east.alias("x"), north.alias("y"), (F.col("pose_id") % 360).cast("double").alias("heading"), (F.col("pose_id") % 2 == 0).alias("is_single"), (F.col("pose_id") % 9 + 1).alias("num_pts"))
    return M.merge_lights(seen)


@add()
def h14_shape_features(spark: SparkSession, d: str) -> DataFrame:
    return M.shape_features(trail_points(spark, d).select("id", "x", "y", "z").distinct(), 3.0)


@add()
def h18_spliced(spark: SparkSession, d: str) -> DataFrame:
    """Roads linked by next_id after those of kind 3 are taken out."""
    rows = current(spark, d, "roads", "next_id", "kind")
    edges = rows.select(F.col("fid").alias("a"), F.explode(R.reference_list(F.col("next_id"))).alias("b"))
    return M.splice(edges, rows.where("kind = 3").select(F.col("fid").alias("node")))


@add(
    f"""WITH RECURSIVE e AS (SELECT DISTINCT fid AS a, upper(trim(v)) AS b FROM (SELECT fid, unnest(regexp_split_to_array(coalesce(next_id, ''), '[,;|/\\s]+')) AS v FROM {_cur('roads', 'next_id', 'kind')}) WHERE upper(trim(v)) NOT IN ('', '0', '-1', 'NULL', 'NONE', 'NAN')),
 r(node) AS (SELECT fid FROM {_cur('roads', 'next_id', 'kind')} WHERE kind = 1 UNION SELECT e.b FROM r JOIN e ON r.node = e.a) SELECT node FROM r"""
)
def h19_reachable(spark: SparkSession, d: str) -> DataFrame:
    rows = current(spark, d, "roads", "next_id", "kind")
    edges = rows.select(F.col("fid").alias("a"), F.explode(R.reference_list(F.col("next_id"))).alias("b"))
    return M.reachable(edges, rows.where("kind = 1").select(F.col("fid").alias("node"))).select("node")


@add()
def h26_repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    return M.repeated_lines(lines(spark, d), 60.0, 5.0, 0.5)


@add()
def h28_mark_boxes(spark: SparkSession, d: str) -> DataFrame:
    return M.mark_boxes(points(spark, d).select(F.col("pid").alias("id"), "x", "y"), 0.45, 4, None, 8, 0.0, 200.0)


@add()
def h31_labelled_areas(spark: SparkSession, d: str) -> DataFrame:
    rows = points(spark, d).select(F.col("pid").alias("id"), "x", "y", "z", (F.col("pid") % 13).cast("int").alias("label"))
    return M.labelled_areas(rows, 1.5, 5)


_LINE_MEASURES = f"""WITH a AS (SELECT line, avg(x) AS mx, avg(y) AS my, atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) / 2 AS t FROM {_TRAIL} GROUP BY line),
 m AS (SELECT line, (x - mx) * cos(t) + (y - my) * sin(t) AS m, abs((y - my) * cos(t) - (x - mx) * sin(t)) AS o FROM {_TRAIL} JOIN a USING (line))
 SELECT line, round(max(m) - min(m), 2) AS length, round(avg(o), 3) AS thinness FROM m GROUP BY line HAVING max(m) - min(m) >= 0.05"""


@add(_LINE_MEASURES)
def h33_line_measures(spark: SparkSession, d: str) -> DataFrame:
    return M.line_measures(trail_points(spark, d), ["line"]).select("line", F.round("length", 2).alias("length"), F.round("thinness", 3).alias("thinness"))


@add(f"SELECT pid, CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT a.pid, b.x, b.y FROM {_POINTS} a JOIN (SELECT DISTINCT x, y FROM {_POINTS} WHERE z = 0) b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 0.2 AND a.y + 0.2 WHERE sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.2) GROUP BY pid")
def j21_bound_objects(spark: SparkSession, d: str) -> DataFrame:
    left = points(spark, d).select("pid", F.col("x").alias("l_x"), F.col("y").alias("l_y"))
    right = points(spark, d).where("z = 0").select(F.col("x").alias("r_x"), F.col("y").alias("r_y"))
    return J.count_within(left, right, 0.2, "pid")


@add()
def h3_places(spark: SparkSession, d: str) -> DataFrame:
    """Places of trails: clusters of their positions at most 5 m apart."""
    return cluster.dbscan(trail_points(spark, d).select("id", "x", "y").distinct(), "id", ["x", "y"], 5.0, 1)

# Scope of lanes and roads, points along a line, isolated points, ends and validity of geometries

_SIDE = f"(SELECT fid, ((b.x - a.x) * (c.y - {{o}}.y) - (b.y - a.y) * (c.x - {{o}}.x)) / -sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS s FROM (SELECT fid, ring[1] AS a, ring[2] AS b, ring[3] AS c FROM {_cur('lane_lines')} WHERE len(ring) >= 3) WHERE a.x <> b.x OR a.y <> b.y)"


def _three(spark: SparkSession, d: str) -> tuple[DataFrame, tuple, tuple, tuple, tuple]:
    """Lane lines of three points: the first two as edges and direction, the third as the target."""
    rows = current(spark, d, "lane_lines").where("size(ring) >= 3").select("fid", *[F.col("ring")[i].alias(n) for i, n in enumerate("abc")]).where("a.x <> b.x OR a.y <> b.y")
    a, b, c = ((F.col(f"{n}.x"), F.col(f"{n}.y")) for n in "abc")
    return rows, a, b, c, (b[0] - a[0], b[1] - a[1])


@add(f"SELECT l.fid, l.s + 0.5 >= 0 AND r.s - 0.5 <= 0 AS inside FROM {_SIDE.format(o='a')} l JOIN {_SIDE.format(o='b')} r ON l.fid = r.fid")
def f21_lane_scope(spark: SparkSession, d: str) -> DataFrame:
    rows, a, b, c, way = _three(spark, d)
    return rows.select("fid", scope.in_lane(c, a, b, way, 0.5).alias("inside"))


@add(f"SELECT fid, abs(s) <= 3.5 / 2 + 0.25 AS inside FROM {_SIDE.format(o='a')}")
def f22_stop_lines(spark: SparkSession, d: str) -> DataFrame:
    rows, a, _, c, way = _three(spark, d)
    return rows.select("fid", scope.stop_line_in_lane(c, a, way, F.lit(3.5), 0.25).alias("inside"))


@add(f"SELECT l.fid, l.s + 0.5 >= 0 AS anywhere, l.s + 0.5 >= 0 AND r.s + 0.5 >= 0 AS right_side, l.s + 0.5 >= 0 AND r.s - 0.5 < 0 AS left_side, l.s + 0.5 >= 0 AS without_middle FROM {_SIDE.format(o='a')} l JOIN {_SIDE.format(o='b')} r ON l.fid = r.fid")
def f23_road_scope(spark: SparkSession, d: str) -> DataFrame:
    rows, a, b, c, way = _three(spark, d)
    none = (F.lit(None).cast("double"), F.lit(None).cast("double"))
    modes = [scope.in_road(c, a, none, b, way, 0.5, m) for m in (0, 1, 2)]
    return rows.select("fid", *[m.alias(n) for m, n in zip(modes, ("anywhere", "right_side", "left_side"))], scope.in_road(c, a, none, none, way, 0.5, 1).alias("without_middle"))


@add(
    f"""WITH e AS (SELECT line, row_number() OVER (PARTITION BY line ORDER BY seq) - 1 AS k, ax, ay, bx, by_ FROM (SELECT line, seq, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM {_vert('lane_lines')} WINDOW w AS (PARTITION BY line ORDER BY seq)) WHERE bx IS NOT NULL),
 p AS (SELECT concat_ws('#', line, seq) AS id, x + 5 AS x, y + 5 AS y FROM {_vert('lane_lines')} WHERE x IS NOT NULL AND y IS NOT NULL),
 n AS (SELECT id, line, k, CASE WHEN q > 0 THEN least(1, greatest(0, ((x - ax) * ux + (y - ay) * uy) / q)) ELSE 0 END AS t, x, y, ax, ay, ux, uy, q, max(k) OVER (PARTITION BY line) AS last FROM (SELECT p.id, p.x, p.y, e.*, bx - ax AS ux, by_ - ay AS uy, pow(bx - ax, 2) + pow(by_ - ay, 2) AS q FROM p JOIN e ON p.x BETWEEN least(ax, bx) - 30 AND greatest(ax, bx) + 30 AND p.y BETWEEN least(ay, by_) - 30 AND greatest(ay, by_) + 30)),
 m AS (SELECT *, sqrt(pow(x - ax - t * ux, 2) + pow(y - ay - t * uy, 2)) AS distance FROM n), l AS (SELECT line, max(k) AS last FROM e GROUP BY line),
 b AS (SELECT * FROM m WHERE distance <= 30 QUALIFY row_number() OVER (PARTITION BY id, line ORDER BY distance, k) = 1)
 SELECT id, b.line, round(distance, 6) AS distance FROM b JOIN l ON b.line = l.line WHERE NOT (k = 0 AND t * sqrt(q) < 1e-5) AND NOT (k = l.last AND (1 - t) * sqrt(q) < 1e-5)"""
)
def f15_along_line(spark: SparkSession, d: str) -> DataFrame:
    """The lane lines' points, moved by 5 m, within 30 m beside a lane line."""
    w = Window.partitionBy("line").orderBy("seq")
    edges = lines(spark, d).select("line", (F.row_number().over(w) - 1).alias("k"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.lead("x").over(w).alias("bx"), F.lead("y").over(w).alias("by")).where("bx IS NOT NULL")
    near = lines(spark, d).select(F.concat_ws("#", "line", "seq").alias("id"), (F.col("x") + 5).alias("x"), (F.col("y") + 5).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    return scope.along_line(near, edges).select("id", "line", F.round("distance", 6).alias("distance"))


@add(
    f"""WITH p AS (SELECT concat_ws('#', line, seq) AS id, x, y, z FROM {_vert('lane_lines')} WHERE x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL),
 n AS (SELECT a.id, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) AS away FROM p a JOIN p b ON a.id <> b.id),
 k AS (SELECT id, avg(away) AS distance FROM (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY id ORDER BY away) <= 5) GROUP BY id)
 SELECT id, round(distance, 6) AS distance FROM k WHERE distance > (SELECT avg(distance) + 2 * stddev_samp(distance) FROM k)"""
)
def f24_statistical(spark: SparkSession, d: str) -> DataFrame:
    """Lane-line points that lie far from their five nearest neighbours, by two standard deviations."""
    points = lines(spark, d).select(F.concat_ws("#", "line", "seq").alias("id"), "x", "y", "z")
    return scope.statistical_outliers(points, 5, 2.0, radius=200.0).select("id", F.round("distance", 6).alias("distance"))


@add(f"SELECT fid, ring[1].x AS first_x, ring[1].y AS first_y, ring[-1].x AS last_x, ring[-1].y AS last_y, sqrt(pow(ring[1].x - ring[2].x, 2) + pow(ring[1].y - ring[2].y, 2)) <= 1e-8 OR sqrt(pow(ring[-1].x - ring[2].x, 2) + pow(ring[-1].y - ring[2].y, 2)) <= 1e-8 AS second_ends FROM {_cur('lane_lines')} WHERE len(ring) >= 2")
def g17_endpoints(spark: SparkSession, d: str) -> DataFrame:
    rows = current(spark, d, "lane_lines").where("size(ring) >= 2").withColumn("e", G.endpoints(F.col("ring")))
    second = F.col("ring")[1]
    return rows.select("fid", *[F.col("e")[i][c].alias(f"{n}_{c}") for i, n in ((0, "first"), (1, "last")) for c in "xy"], G.is_endpoint(F.col("ring"), second["x"], second["y"]).alias("second_ends"))


@add()
def g14_valid_rings(spark: SparkSession, d: str) -> DataFrame:
    """Whether each lane, closed, bounds a valid area."""
    rows = current(spark, d, "lanes").where("size(ring) >= 3")
    return rows.select("fid", G.ring_is_valid(F.concat("ring", F.slice("ring", 1, 1))).alias("valid"))


QUERIES, ORACLE = catalog.queries, catalog.sql
