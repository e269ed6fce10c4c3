"""Joins in the plane by grid cells: an equi-join on cells, then the exact test.

Cells are as wide as the search radius, so partners lie in the same or a neighbouring cell. Only one side is copied to
neighbouring cells, preferably the smaller. The equi-join lets Spark broadcast a small side, or shuffle by cell and
split cells that hold too many rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.session import materialise


def _cells(size: float, axes: list[str], prefix: str) -> list[Column]:
    return [F.floor(F.col(f"{prefix}{a}") / size).alias(f"_c{a}") for a in axes]


def within(left: DataFrame, right: DataFrame, radius: float, axes: list[str] | None = None) -> DataFrame:
    """Pairs at most radius apart, with distance. left has l_x, l_y(, l_z), right r_x, r_y(, r_z); other columns pass."""
    axes = axes or ["x", "y"]
    a = left.select("*", *_cells(radius, axes, "l_"))
    b = right
    for axis in axes:
        own = F.floor(F.col(f"r_{axis}") / radius)
        b = b.withColumn(f"_c{axis}", F.explode(F.array(own - 1, own, own + 1)))
    apart = F.sqrt(sum(((F.col(f"l_{x}") - F.col(f"r_{x}")) * (F.col(f"l_{x}") - F.col(f"r_{x}")) for x in axes), F.lit(0.0)))
    cells = [f"_c{x}" for x in axes]
    return a.join(b, cells).withColumn("distance", apart).where(F.col("distance") <= radius).drop(*cells)


def _strips(x: np.ndarray, y: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """The sorted ys of each x."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    cuts = np.flatnonzero(np.diff(x)) + 1
    return [(part_x[0], part_y) for part_x, part_y in zip(np.split(x, cuts), np.split(y, cuts)) if len(part_x)]


def _near_counts(strips: list[tuple[float, np.ndarray]], x: np.ndarray, y: np.ndarray, radius: float) -> np.ndarray:
    """How many of the strips' places lie within radius of each (x, y): in a strip they follow one another."""
    n = np.zeros(len(x), np.int64)
    for at, ys in strips:
        some = np.flatnonzero(np.abs(x - at) <= radius)
        if not len(some):
            continue
        own, across = y[some], np.square(x[some] - at)
        half = np.sqrt(np.maximum(radius * radius - across, 0))
        is_near = lambda k: np.sqrt(across + np.square(own - ys[np.clip(k, 0, len(ys) - 1)])) <= radius  # noqa: B023, E731
        low, high = np.searchsorted(ys, own - half), np.searchsorted(ys, own + half, "right")
        # The half chord is rounded; the distances themselves decide at both ends.
        while (step := (low > 0) & is_near(low - 1)).any():
            low -= step
        while (step := (high < len(ys)) & is_near(high)).any():
            high += step
        while (step := (low < high) & ~is_near(low)).any():
            low += step
        while (step := (low < high) & ~is_near(high - 1)).any():
            high -= step
        n[some] += high - low
    return n


def _block_counts(radius: float, row_id: str):
    """Rows sorted by block, right ones first: a block's right places are held, left rows pass in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, strips = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, is_left, x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_block", "_left", "x", "y"))
            earlier = batch.column("_earlier")
            taken = np.flatnonzero(earlier.is_valid().to_numpy(zero_copy_only=False))
            n = np.zeros(len(x), np.int64)
            ends = [*(np.flatnonzero((np.diff(key) != 0) | (is_left[1:] != is_left[:-1])) + 1), len(x)]
            for a, b in zip([0, *ends], ends):
                if key[a] != block:
                    block, held, strips = key[a], [], None
                if not is_left[a]:
                    held.append((x[a:b], y[a:b]))
                elif held:
                    strips = strips or _strips(*map(np.concatenate, zip(*held)))
                    n[a:b] = _near_counts(strips, x[a:b], y[a:b], radius)
                    for i in taken[(taken >= a) & (taken < b)]:
                        rx, ry = map(np.concatenate, zip(*held))
                        fresh = np.sqrt(np.square(x[i] - rx) + np.square(y[i] - ry)) <= radius
                        for q in earlier[int(i)].as_py():
                            fresh &= ~(np.sqrt(np.square(q["x"] - rx) + np.square(q["y"] - ry)) <= radius)
                        n[i] = fresh.sum()
            found = pa.array(np.flatnonzero(n > 0))
            yield pa.RecordBatch.from_arrays([batch.column(row_id).take(found), pa.array(n[n > 0])], names=[row_id, "n"])

    return run


def count_within(left: DataFrame, right: DataFrame, radius: float, row_id: str) -> DataFrame:
    """row_id, n: how many places of right lie within radius of any place of the id; ids without any drop out.

    left: row_id, l_x, l_y; right: r_x, r_y. An id may have several places; a right place near more than one of them
    counts for the first in order of x and y. No pair is written: blocks of space hold their right places as sorted
    strips, in which left rows are looked up. Rows without coordinates count nothing.
    """
    kind = dict(left.dtypes)[row_id]
    usable = lambda p: " AND ".join(f"abs({p}{a}) < double('infinity')" for a in "xy")
    # Only shuffles by the id and by the block: a null id is a group like others.
    own = left.where(usable("l_")).select(row_id, F.col("l_x").cast("double").alias("x"), F.col("l_y").cast("double").alias("y")).repartition(row_id).dropDuplicates([row_id, "x", "y"])
    reach = 2.001 * radius
    before = F.expr(f"collect_list(struct(x, y)) OVER (PARTITION BY `{row_id}` ORDER BY x RANGE BETWEEN {reach!r}D PRECEDING AND CURRENT ROW)")
    earlier = F.filter("_b", lambda q: (F.abs(q["y"] - F.col("y")) <= reach) & ((q["x"] < F.col("x")) | ((q["x"] == F.col("x")) & (q["y"] < F.col("y")))))
    own = own.withColumn("_b", before).withColumn("_b", earlier).withColumn("_earlier", F.when(F.size("_b") > 0, F.col("_b")))
    side = 4 * radius
    block = lambda x, y: F.xxhash64(x, y)  # noqa: E731 - blocks that share a hash only share a task's places
    cell = lambda v: F.floor(v / side)
    around = lambda c: F.explode(F.sequence(cell(F.col(c) - 1.001 * radius), cell(F.col(c) + 1.001 * radius)))
    there = right.where(usable("r_")).select(F.col("r_x").cast("double").alias("x"), F.col("r_y").cast("double").alias("y"))
    there = there.select("x", "y", around("x").alias("_cx")).select("x", "y", "_cx", around("y").alias("_cy")).select(block(F.col("_cx"), F.col("_cy")).alias("_block"), "x", "y").distinct()
    rows = own.select(block(cell(F.col("x")), cell(F.col("y"))).alias("_block"), F.lit(True).alias("_left"), row_id, "x", "y", "_earlier").unionByName(
        there.select("_block", F.lit(False).alias("_left"), F.lit(None).cast(kind).alias(row_id), "x", "y", F.lit(None).cast("array<struct<x:double,y:double>>").alias("_earlier"))
    )
    counted = rows.repartition("_block").sortWithinPartitions("_block", "_left").mapInArrow(_block_counts(radius, row_id), f"`{row_id}` {kind}, n bigint")
    return counted.groupBy(row_id).agg(F.sum("n").alias("n"))


def within_own_radius(left: DataFrame, right: DataFrame, radius: str, largest: float) -> DataFrame:
    """Pairs at most the left row's radius apart; largest bounds all radii."""
    return within(left, right, largest).where(F.col("distance") <= F.col(radius))


def nearest(left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str, axes: list[str] | None = None) -> DataFrame:
    """left_id, right_id, distance of the nearest right row within radius; ties go to the smaller id. Right rows may serve many."""
    pairs = within(left, right, radius, axes)
    best = F.min(F.struct(F.round("distance", 9).alias("d"), F.col(right_id).alias("i")))
    return pairs.groupBy(left_id).agg(best.alias("_b")).select(left_id, F.col("_b.i").alias(right_id), F.col("_b.d").alias("distance"))


def _edge_cells(edges: DataFrame, size: float) -> DataFrame:
    """Edges copied to the cells their bounding boxes touch."""
    low, high = lambda a: F.floor(F.least(f"a{a}", f"b{a}") / size), lambda a: F.floor(F.greatest(f"a{a}", f"b{a}") / size)
    out = edges.withColumn("_cx", F.explode(F.sequence(low("x"), high("x")))).withColumn("_cy", F.explode(F.sequence(low("y"), high("y"))))
    return out


def _meeting() -> tuple[Column, Column]:
    point = lambda s, e: (F.col(f"{s}_{e}x"), F.col(f"{s}_{e}y"))
    return G.line_crossing(point("p", "a"), point("p", "b"), point("q", "a"), point("q", "b"))


def _named(df: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    return df.select("_cx", "_cy", *[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def crossings(edges: DataFrame, size: float, same_line: bool = False, ring: bool = False, skip_endpoints: bool = True) -> DataFrame:
    """p_line, p_seq, q_line, q_seq, x, y: where edges meet. edges: line, seq, ax, ay, bx, by (, n_edges for rings).

    Between lines p_line < q_line and meetings at an end of either edge don't count. Within a line neighbouring edges
    are skipped (for rings the first and last too). Coordinates are rounded to 1e-6; each meeting comes once.
    """
    columns = ["line", "seq", "ax", "ay", "bx", "by", *(["n_edges"] if ring else [])]
    cut = _edge_cells(edges, size)
    p, q = _named(cut, "p", columns), _named(cut, "q", columns)
    if same_line:
        both = p.join(q, (p._cx == q._cx) & (p._cy == q._cy) & (F.col("p_line") == F.col("q_line")) & (F.col("q_seq") > F.col("p_seq") + 1))
        if ring:
            both = both.where(~((F.col("p_seq") == 0) & (F.col("q_seq") == F.col("p_n_edges") - 1)))
    else:
        both = p.join(q, (p._cx == q._cx) & (p._cy == q._cy) & (F.col("p_line") < F.col("q_line")))
    x, y = _meeting()
    met = both.withColumn("x", F.round(x, 6)).withColumn("y", F.round(y, 6)).where("x IS NOT NULL")
    if skip_endpoints and not same_line:
        at = lambda s, e: (F.abs(F.col("x") - F.col(f"{s}_{e}x")) <= 1e-6) & (F.abs(F.col("y") - F.col(f"{s}_{e}y")) <= 1e-6)
        met = met.where(~(at("p", "a") | at("p", "b") | at("q", "a") | at("q", "b")))
    return met.select("p_line", "p_seq", "q_line", "q_seq", "x", "y").distinct()


def in_polygons(points: DataFrame, polygons: DataFrame, size: float) -> DataFrame:
    """Points joined to the polygons that hold them. points: x, y; polygons: ring and any key columns.

    Each polygon is copied to the cells of its bounding box; its edges are tested only for points in these cells.
    """
    boxed = polygons.withColumn("_b", G.envelope(F.col("ring"))).where("_b.x0 IS NOT NULL")
    side = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(f"_b.{lo}") / size), F.floor(F.col(f"_b.{hi}") / size)))
    cut = boxed.withColumn("_cx", side("x0", "x1")).withColumn("_cy", side("y0", "y1"))
    at = points.withColumn("_cx", F.floor(F.col("x") / size)).withColumn("_cy", F.floor(F.col("y") / size))
    near = at.join(cut, ["_cx", "_cy"]).where((F.col("x") >= F.col("_b.x0")) & (F.col("x") <= F.col("_b.x1")) & (F.col("y") >= F.col("_b.y0")) & (F.col("y") <= F.col("_b.y1")))
    return near.where(G.point_in_ring(F.col("x"), F.col("y"), F.col("ring"))).drop("_cx", "_cy", "_b", "ring")


def clip_to_convex(points: str, area: list[tuple[float, float]]) -> Column:
    """The ring clipped to a convex anticlockwise area, one side after the other; an empty array where nothing is left.

    The sides are folded over as data, so the expression doesn't grow with their number.
    """
    ring = F.transform(F.col(points), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    sides = F.array(*[F.struct(F.lit(a[0]).alias("ax"), F.lit(a[1]).alias("ay"), F.lit(b[0]).alias("bx"), F.lit(b[1]).alias("by")) for a, b in zip(area, area[1:] + area[:1])])

    def cut(r: Column, e: Column) -> Column:
        marked = F.transform(r, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), ((e["bx"] - e["ax"]) * (p["y"] - e["ay"]) - (e["by"] - e["ay"]) * (p["x"] - e["ax"])).alias("s")))
        pairs = F.zip_with(marked, F.concat(F.slice(marked, 2, F.size(r)), F.slice(marked, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

        def left_of(o: Column) -> Column:
            p, q = o["p"], o["q"]
            t = p["s"] / (p["s"] - q["s"])
            met = F.struct((p["x"] + t * (q["x"] - p["x"])).alias("x"), (p["y"] + t * (q["y"] - p["y"])).alias("y"))
            end = F.struct(q["x"].alias("x"), q["y"].alias("y"))
            return F.when((p["s"] >= 0) & (q["s"] >= 0), F.array(end)).when(p["s"] >= 0, F.array(met)).when(q["s"] >= 0, F.array(met, end)).otherwise(F.slice(F.array(end), 1, 0))

        return F.flatten(F.transform(pairs, left_of))

    return F.aggregate(sides, ring, cut)


def link_errors(features: DataFrame, links: DataFrame, reach: float) -> DataFrame:
    """id, ref_id, problem: references along a line that name nothing ('missing') or something whose end isn't near ('apart').

    features: id, sx, sy (start), ex, ey (end). links: id, ref_id, kind ('next' or 'pre').
    """
    own = features.select(F.col("id"), F.col("sx").alias("o_sx"), F.col("sy").alias("o_sy"), F.col("ex").alias("o_ex"), F.col("ey").alias("o_ey"))
    other = features.withColumnRenamed("id", "ref_id")
    r = links.join(own, "id").join(other, "ref_id", "left")
    gap = F.when(F.col("kind") == "next", G.distance(F.col("o_ex"), F.col("o_ey"), F.col("sx"), F.col("sy"))).otherwise(G.distance(F.col("o_sx"), F.col("o_sy"), F.col("ex"), F.col("ey")))
    problem = F.when(F.col("sx").isNull(), "missing").when(gap > reach, "apart")
    return r.select("id", "ref_id", "kind", problem.alias("problem")).where("problem IS NOT NULL")


def outliers_by_count(points: DataFrame, radius: float, least: int, row_id: str) -> DataFrame:
    """Rows with fewer than so many others within radius. points: row_id, x, y. Rows without coordinates drop out.

    Cells are a little narrower than the radius' square: all rows of one are neighbours. Where a cell holds more than
    ``least`` rows none is an outlier, so only rows of the other cells are compared with those around.
    """
    side, reach = 0.999 * radius / math.sqrt(2), 2
    cells = ["_cx", "_cy"]
    usable = points.select(row_id, "x", "y").where(" AND ".join(f"abs({a}) < double('infinity')" for a in "xy"))
    usable = usable.withColumns({f"_c{a}": F.floor(F.col(a) / side) for a in "xy"})
    # Written, their size is known when the join is planned: a few cells don't move all rows.
    sparse = materialise(usable.groupBy(*cells).agg(F.count("*").alias("n")).where(F.col("n") <= least).select(*cells), "sparse-cells")
    shifts = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1)])

    def around(df: DataFrame) -> DataFrame:
        moved = df.withColumn("_o", F.explode(shifts))
        return moved.withColumns({c: F.col(c) + F.col(f"_o.{a}") for a, c in zip("xy", cells)}).drop("_o")

    rows = materialise(usable.join(sparse, cells, "left_semi"), "sparse-rows")
    near = materialise(around(sparse).distinct(), "near-cells")
    right = usable.join(near, cells, "left_semi").groupBy(*cells, F.col("x").alias("r_x"), F.col("y").alias("r_y")).agg(F.count("*").alias("n"))
    left = around(rows.select(F.col("x").alias("l_x"), F.col("y").alias("l_y"), *cells).distinct())
    apart = F.sqrt((F.col("l_x") - F.col("r_x")) * (F.col("l_x") - F.col("r_x")) + (F.col("l_y") - F.col("r_y")) * (F.col("l_y") - F.col("r_y")))
    pairs = left.join(right, cells).where(apart <= radius)
    counted = pairs.groupBy(F.col("l_x").alias("x"), F.col("l_y").alias("y")).agg((F.sum("n") - 1).alias("n_near")).where(F.col("n_near") < least)
    return rows.select(row_id, "x", "y").join(counted, ["x", "y"]).select(row_id, "n_near")
