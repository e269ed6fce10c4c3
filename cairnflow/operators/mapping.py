"""Operators that turn clouds, frames and detections into map features."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.operators import aggregates as A
from cairnflow.operators import cluster
from cairnflow.operators import sequence as S
from cairnflow.operators import spatial as J
from cairnflow.session import materialise


def to_world(points: DataFrame, frames: DataFrame, frame: str) -> DataFrame:
    """points with wx, wy, wz: their place in the world by their frame's q (x, y, z, w) and t; frames without a whole pose drop out."""
    posed = frames.where("size(q) = 4 AND size(t) = 3").select(frame, "q", "t")
    q = tuple(F.col("q")[i] for i in (3, 0, 1, 2))
    x, y, z = G.rotate_by_quaternion(q, (F.col("x"), F.col("y"), F.col("z")))
    t = F.col("t")
    return points.join(posed, frame).withColumns({"wx": x + t[0], "wy": y + t[1], "wz": z + t[2]}).drop("q", "t")


def angle_by_cluster(df: DataFrame, by: list[str], value: str, weight: str, row_id: str, gap: float = 10.0) -> DataFrame:
    """by, angle: weighted mean of the largest cluster of values chained by gaps of at most ``gap``.

    A cluster has two members at least; without one, the value of greatest weight. Of equally large clusters the lowest.
    """
    w = Window.partitionBy(*by).orderBy(value, row_id)
    chained = df.withColumn("_new", F.when(F.col(value) - F.lag(value).over(w) <= gap, 0).otherwise(1)).withColumn("_k", F.sum("_new").over(w))
    groups = chained.groupBy(*by, "_k").agg(F.count("*").alias("_n"), (F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("_m"), F.max_by(value, F.struct(weight, row_id)).alias("_v"), F.max(F.struct(weight, row_id)).alias("_w"))
    best = F.max_by("_m", F.when(F.col("_n") >= 2, F.struct("_n", (-F.col("_k")).alias("k"))))
    return groups.groupBy(*by).agg(F.coalesce(best, F.max_by("_v", "_w")).alias("angle"))


def merge_lights(detections: DataFrame, eps: float = 5.0, first_id: int = 600_000_000) -> DataFrame:
    """light_id, x, y, heading, is_single, n: detections (id, x, y, heading, is_single, num_pts) merged per place and kind.

    Places chain detections at most eps apart; the heading is that of the largest cluster of headings; points weigh.
    """
    placed = materialise(detections.join(cluster.dbscan(detections, "id", ["x", "y"], eps, 1, by="is_single"), "id"), "lights")
    by = ["is_single", "cluster"]
    centre = placed.groupBy(*by).agg((F.sum(F.col("x") * F.col("num_pts")) / F.sum("num_pts")).alias("x"), (F.sum(F.col("y") * F.col("num_pts")) / F.sum("num_pts")).alias("y"), F.count("*").alias("n"))
    angle = angle_by_cluster(placed, by, "heading", "num_pts", "id").withColumnRenamed("angle", "heading")
    return centre.join(angle, by).withColumn("light_id", F.col("cluster") + first_id).drop("cluster")


def line_measures(df: DataFrame, by: list[str], reach: float = 0.2, least: float = 0.05) -> DataFrame:
    """by, length, thinness (mean distance from the axis), z_first, z_last of clouds of lines; shorter ones drop out.

    The axis is the total least-squares line; an end's height is the mean within reach of it along the axis.
    """
    fit = df.groupBy(*by).agg(*A.line_fit(F.col("x"), F.col("y"))).select(*by, "mean_x", "mean_y", "angle")
    dx, dy = F.col("x") - F.col("mean_x"), F.col("y") - F.col("mean_y")
    m = df.join(fit, by).withColumn("_m", dx * F.cos("angle") + dy * F.sin("angle")).withColumn("_o", F.abs(dy * F.cos("angle") - dx * F.sin("angle")))
    ends = m.groupBy(*by).agg(F.min("_m").alias("_a"), F.max("_m").alias("_b"), F.avg("_o").alias("thinness"))
    heights = m.join(ends.drop("thinness"), by).groupBy(*by).agg(F.avg(F.when(F.col("_m") - F.col("_a") < reach, F.col("z"))).alias("z_first"), F.avg(F.when(F.col("_b") - F.col("_m") < reach, F.col("z"))).alias("z_last"))
    return ends.join(heights, by).withColumn("length", F.col("_b") - F.col("_a")).where(F.col("length") >= least).select(*by, "length", "thinness", "z_first", "z_last")


def mark_boxes(points: DataFrame, eps: float, least: int, voxel: float | None, min_points: int, min_area: float, max_side: float) -> DataFrame:
    """cluster, n, area, length, width of compact marks in a cloud (id, x, y): thin, cluster, keep by size, box along the main axis."""
    if voxel:
        points = points.groupBy(A.voxel(F.col("x"), voxel).alias("_vx"), A.voxel(F.col("y"), voxel).alias("_vy")).agg(F.min("id").alias("id"), F.avg("x").alias("x"), F.avg("y").alias("y")).drop("_vx", "_vy")
    found = materialise(points.select("id", "x", "y").join(cluster.dbscan(points, "id", ["x", "y"], eps, least).where("cluster <> 0"), "id").select("cluster", "x", "y"), "marks")
    size = cluster.few(materialise(found.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") >= min_points), "mark-sizes"))
    kept = found.join(size.select("cluster"), "cluster", "left_semi")
    corners = cluster.convex_hulls(kept, "cluster", "x", "y")
    ring = corners.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("corner", "x", "y"))).alias("ring"))
    area = ring.select("cluster", F.abs(G.signed_area(F.col("ring"))).alias("area")).where(F.col("area") >= min_area)
    box = cluster.oriented_box(kept, ["cluster"], "x", "y", A.line_fit(F.col("x"), F.col("y"))[2])
    return size.join(area, "cluster").join(box, "cluster").where((F.col("length") <= max_side) & (F.col("width") <= max_side))


def labelled_areas(points: DataFrame, eps: float = 1.0, least: int = 10, labels: tuple[int, int] = (8, 12)) -> DataFrame:
    """label, cluster, corner, x, y, z: hulls of clusters per label, anticlockwise from the leftmost, each corner with the height of a point there."""
    own = points.where(F.col("label").between(*labels))
    found = materialise(own.join(cluster.dbscan(own, "id", ["x", "y"], eps, least, by="label"), "id").where("cluster <> 0"), "areas")
    corners = cluster.few(materialise(cluster.convex_hulls(found, "cluster", "x", "y"), "corners"))
    heights = found.join(corners.select("cluster", "x", "y"), ["cluster", "x", "y"], "left_semi").groupBy("cluster", "x", "y").agg(F.min("z").alias("z"), F.min("label").alias("label"))
    out = corners.join(heights, ["cluster", "x", "y"]).select("label", "cluster", "corner", "x", "y", "z")
    sized = out.groupBy("label", "cluster").agg(F.count("*").alias("n")).where("n >= 3")
    return out.join(sized, ["label", "cluster"], "left_semi")


def repeated_lines(vertices: DataFrame, tolerance: float, step: float, share: float = 0.9) -> DataFrame:
    """line, covered_by: lines most of whose stations lie near another, longer line (of equals the smaller name stays)."""
    s = materialise(S.stations(vertices, step), "stations")
    length = S.with_measure(vertices).groupBy("line").agg(F.max("measure").alias("len"))
    own = s.groupBy("line").agg(F.count("*").alias("n"))
    left = s.select(F.col("line").alias("l_line"), "station", F.col("x").alias("l_x"), F.col("y").alias("l_y"))
    right = s.select(F.col("line").alias("r_line"), F.col("x").alias("r_x"), F.col("y").alias("r_y"))
    near = J.within(left, right, tolerance).where("l_line <> r_line").select("l_line", "r_line", "station").distinct().groupBy("l_line", "r_line").agg(F.count("*").alias("hit"))
    p = near.join(own.withColumnRenamed("line", "l_line"), "l_line").where(F.col("hit") >= share * F.col("n"))
    a, b = length.toDF("l_line", "l_len"), length.toDF("r_line", "r_len")
    longer = (F.col("r_len") > F.col("l_len")) | ((F.col("r_len") == F.col("l_len")) & (F.col("r_line") < F.col("l_line")))
    return p.join(a, "l_line").join(b, "r_line").where(longer).groupBy(F.col("l_line").alias("line")).agg(F.max_by("r_line", F.struct("r_len", "r_line")).alias("covered_by"))


def shape_features(points: DataFrame, radius: float) -> DataFrame:
    """id, n, linearity, planarity, scattering from the eigenvalues of each point's neighbourhood. points: id, x, y, z.

    Spark adds up the moments of the neighbours; only ten numbers per point reach Python.
    """
    left = points.select(F.col("id").alias("l_id"), *[F.col(a).alias(f"l_{a}") for a in "xyz"])
    right = points.select(*[F.col(a).alias(f"r_{a}") for a in "xyz"])
    pairs = J.within(left, right, radius, ["x", "y", "z"])
    off = {a: F.col(f"r_{a}") - F.col(f"l_{a}") for a in "xyz"}
    products = list(itertools.combinations_with_replacement("xyz", 2))
    m = pairs.groupBy("l_id").agg(F.count("*").alias("n"), *[F.avg(off[a]).alias(f"m{a}") for a in "xyz"], *[F.avg(off[a] * off[b]).alias(f"m{a}{b}") for a, b in products])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            cov = np.empty((batch.num_rows, 3, 3))
            for (a, b), (i, j) in zip(products, itertools.combinations_with_replacement(range(3), 2)):
                cov[:, i, j] = cov[:, j, i] = get(f"m{a}{b}") - get(f"m{a}") * get(f"m{b}")
            e = np.maximum(np.linalg.eigvalsh(cov)[:, ::-1], 0)
            top = np.maximum(e[:, 0], 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column("l_id"), batch.column("n"), *map(pa.array, ((e[:, 0] - e[:, 1]) / top, (e[:, 1] - e[:, 2]) / top, e[:, 2] / top))], names=["id", "n", "linearity", "planarity", "scattering"])

    return m.mapInArrow(run, "id bigint, n bigint, linearity double, planarity double, scattering double")


def simplify(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Mask of the vertices Douglas and Peucker keep."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        d = points[b] - points[a]
        n = math.hypot(*d)
        inner = points[a + 1 : b] - points[a]
        away = np.abs(d[0] * inner[:, 1] - d[1] * inner[:, 0]) / n if n > 0 else np.hypot(inner[:, 0], inner[:, 1])
        k = int(away.argmax())
        if away[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def simplified(lines: DataFrame, line: str, points: str, tolerance: float) -> DataFrame:
    """line, kept: the positions of the vertices each polyline keeps."""
    kind = dict(lines.dtypes)[line]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for row in batch.column(1).to_pylist():
                xy = np.array([(p["x"], p["y"]) for p in row or []], float).reshape(-1, 2)
                kept.append(np.flatnonzero(simplify(xy, tolerance)).tolist() if len(xy) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.list_(pa.int32()))], names=[line, "kept"])

    return lines.select(line, points).mapInArrow(run, f"`{line}` {kind}, kept array<int>")


def sector_peaks(df: DataFrame, ring: str, order: str, sectors: int = 6, top: int = 5, least: float = 2000.0, apart: float = 0.4) -> DataFrame:
    """Rows of greatest curvature: per sector of a ring at most ``top`` over ``least``, none within ``apart`` of a taken one.

    Only candidates over the limit are shuffled to the order-dependent choice. df: x, y, z, curvature and the named columns.
    """
    w = Window.partitionBy(ring).orderBy(order)
    cut = df.withColumn("sector", F.ntile(sectors).over(w)).where(F.col("curvature") > least)
    kinds = dict(cut.dtypes)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (-r["curvature"], r[order]))
        taken: list[dict] = []
        for r in rows:
            if len(taken) == top:
                break
            if all(math.dist((r["x"], r["y"], r["z"]), (t["x"], t["y"], t["z"])) >= apart for t in taken):
                taken.append(r)
        return pa.Table.from_pylist([{ring: r[ring], "sector": r["sector"], order: r[order]} for r in taken], schema=pa.schema([table.schema.field(c) for c in (ring, "sector", order)]))

    return cut.select(ring, "sector", order, "x", "y", "z", "curvature").groupBy(ring, "sector").applyInArrow(run, f"`{ring}` {kinds[ring]}, sector int, `{order}` {kinds[order]}")


def hits(rays: DataFrame, edges: DataFrame, size: float) -> DataFrame:
    """ray, left, right: distances from each ray's middle to the nearest edge on either side. rays: ray, ax, ay (left end), bx, by."""
    r = J._named(J._edge_cells(rays, size), "p", ["ray", "ax", "ay", "bx", "by"])
    e = J._named(J._edge_cells(edges, size), "q", ["ax", "ay", "bx", "by"])
    x, y = J._meeting()
    met = r.join(e, ["_cx", "_cy"]).withColumn("x", x).withColumn("y", y).where("x IS NOT NULL")
    mx, my = (F.col("p_ax") + F.col("p_bx")) / 2, (F.col("p_ay") + F.col("p_by")) / 2
    along = G.longitudinal(F.col("x"), F.col("y"), mx, my, F.col("p_ax") - F.col("p_bx"), F.col("p_ay") - F.col("p_by"))
    return met.withColumn("_s", along).groupBy(F.col("p_ray").alias("ray")).agg(F.min(F.when(F.col("_s") >= 0, F.col("_s"))).alias("left"), F.min(F.when(F.col("_s") < 0, -F.col("_s"))).alias("right"))


def width_differences(rays: DataFrame, truth: DataFrame, found: DataFrame, size: float) -> DataFrame:
    """ray, truth_width, found_width, difference, is_skipped: widths between the nearest edges left and right of each ray."""
    wide = lambda df, name: hits(rays, df, size).select("ray", (F.col("left") + F.col("right")).alias(name))
    both = rays.select("ray").join(wide(truth, "truth_width"), "ray", "left").join(wide(found, "found_width"), "ray", "left")
    gap = F.abs(F.col("truth_width") - F.col("found_width"))
    return both.select("ray", "truth_width", "found_width", gap.alias("difference"), gap.isNull().alias("is_skipped"))


def reachable(edges: DataFrame, seeds: DataFrame, most: int = 1_000) -> DataFrame:
    """node, steps: what directed edges (a, b) lead to from the seeds (node), by the fewest steps."""
    links = materialise(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    seen = materialise(seeds.select("node").distinct().withColumn("steps", F.lit(0)), "reached")
    fresh = seen
    for step in range(1, most + 1):
        fresh = materialise(fresh.join(links, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("steps", F.lit(step)), "reached")
        if fresh.isEmpty():
            return seen
        seen = seen.unionByName(fresh)
        if step % 10 == 0:
            seen = materialise(seen, "reached")
    raise RuntimeError(f"more than {most} steps")


def splice(edges: DataFrame, removed: DataFrame, rounds: int = 60) -> DataFrame:
    """a, b: edges after nodes are taken out; what led into a removed node leads on to where it led. removed: node."""
    links = materialise(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    gone = removed.select(F.col("node").alias("b")).distinct()
    for _ in range(rounds):
        into = links.join(gone, "b", "left_semi")
        stay = links.join(gone, "b", "left_anti")
        on = into.select("a", F.col("b").alias("m")).join(links.select(F.col("a").alias("m"), F.col("b").alias("n")), "m").select("a", F.col("n").alias("b")).where("a <> b")
        links = materialise(stay.unionByName(on).distinct(), "links")
        if links.join(gone, "b", "left_semi").join(gone.withColumnRenamed("b", "a"), "a", "left_anti").isEmpty():
            return links.join(gone, "b", "left_anti").join(gone.withColumnRenamed("b", "a"), "a", "left_anti")
    raise RuntimeError(f"nodes remain after {rounds} rounds")


def box_mean(cells: DataFrame, axes: list[str], reach: list[int], value: str) -> DataFrame:
    """axes, value_mean, n: mean over a box of cells, by one pass per axis instead of one over the whole box."""
    sums = cells.groupBy(*axes).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    own = sums.select(*axes)
    for axis, r in zip(axes, reach):
        moved = sums.withColumn("_o", F.explode(F.array(*[F.lit(i) for i in range(-r, r + 1)]))).withColumn(axis, F.col(axis) + F.col("_o"))
        sums = moved.groupBy(*axes).agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    return own.join(sums, axes).select(*axes, (F.col("_s") / F.col("_n")).alias(f"{value}_mean"), F.col("_n").alias("n"))


def valid_length(df: DataFrame, line: str, order: str, valid: Column) -> DataFrame:
    """line, length over the valid vertices alone; the ones between are stepped over."""
    w = Window.partitionBy(line).orderBy(order)
    kept = df.where(valid)
    step = G.distance(F.lag("x").over(w), F.lag("y").over(w), F.col("x"), F.col("y"))
    return kept.withColumn("_d", step).groupBy(line).agg(F.coalesce(F.sum("_d"), F.lit(0.0)).alias("length"))
