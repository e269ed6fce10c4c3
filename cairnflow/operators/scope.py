"""Which points belong to a lane, a road or a polyline: signed distances to edges, and distances along a line.

Distances across a direction are positive to its right. Nulls in a target give null; a missing edge bounds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.session import materialise

Point = tuple[Column, Column]


def across(p: Point, origin: Point, direction: Point) -> Column:
    """Distance of p to the right of the line through origin along direction."""
    return -G.lateral(*p, *origin, *direction)


def in_lane(p: Point, left: Point, right: Point, direction: Point, buffer: Column | float) -> Column:
    """Whether p lies between the left and the right edge of a lane, or within the buffer beyond them."""
    buffer = F.lit(buffer) if isinstance(buffer, float) else buffer
    return (across(p, left, direction) + buffer >= 0) & (across(p, right, direction) - buffer <= 0)


def stop_line_in_lane(p: Point, centre: Point, direction: Point, length: Column, buffer: Column | float) -> Column:
    """Whether the middle p of a stop line of this length reaches the lane's centre line, within the buffer."""
    return F.abs(across(p, centre, direction)) <= length / 2 + buffer


def in_road(p: Point, left: Point, right: Point, middle: Point, direction: Point, buffer: Column | float, mode: int) -> Column:
    """Whether p lies on a road, of which each edge and the middle line may be missing (null).

    mode 0: anywhere between the edges. mode 1: only on the right of the middle line, or within the buffer of it; all of
    the road where there is no middle line. Any other mode: only on its left, by more than the buffer; nothing without one.
    """
    there = lambda q: q[0].isNotNull() & q[1].isNotNull()
    edges = F.coalesce(across(p, left, direction) + buffer >= 0, ~there(left)) & F.coalesce(across(p, right, direction) - buffer <= 0, ~there(right))
    if mode == 0:
        return edges
    side = across(p, middle, direction)
    own = side + buffer >= 0 if mode == 1 else side - buffer < 0
    return edges & F.when(there(middle), own).otherwise(F.lit(mode == 1))


def _walked_cells(size: float) -> Column:
    """The grid cells an edge passes, column by column along x, each with the rows it passes there."""
    cell = lambda c: F.floor(c / size).cast("bigint")
    steep = F.col("bx") - F.col("ax")
    low, high = F.least("ax", "bx"), F.greatest("ax", "bx")

    def rows(cx: Column) -> Column:
        y_at = lambda x: F.when(steep == 0, F.col("ay")).otherwise(F.col("ay") + (F.col("by") - F.col("ay")) * (F.least(F.greatest(x, low), high) - F.col("ax")) / steep)
        enter, leave = y_at(cx * size), F.when(steep == 0, F.col("by")).otherwise(y_at((cx + 1) * size))
        return F.transform(F.sequence(cell(F.least(enter, leave)), cell(F.greatest(enter, leave))), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))

    return F.flatten(F.transform(F.sequence(cell(low), cell(high)), rows))


def along_line(points: DataFrame, edges: DataFrame, reach: float = 30.0, tolerance: float = 1e-5) -> DataFrame:
    """The points at most reach beside a polyline, without those whose nearest place is one of its two ends.

    points: id, x, y and any more. edges: line, k (from 0), ax, ay, bx, by. A point near several lines comes out for
    each, with line and distance. Of edges equally near, the earlier one counts. Points meet edges by grid cell: an edge
    is in the cells it passes, a point in its own cell and the eight around it.
    """
    last = edges.groupBy("line").agg(F.max("k").alias("last"))
    placed = edges.select("line", "k", "ax", "ay", "bx", "by", F.explode(_walked_cells(reach)).alias("c")).select("line", "k", "ax", "ay", "bx", "by", "c.cx", "c.cy").distinct()
    around = [F.struct((F.floor(F.col("x") / reach) + i).cast("bigint").alias("cx"), (F.floor(F.col("y") / reach) + j).cast("bigint").alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    near = points.select("id", "x", "y", F.explode(F.array(*around)).alias("c")).select("id", "x", "y", "c.cx", "c.cy").join(placed, ["cx", "cy"])
    ux, uy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    square = ux * ux + uy * uy
    t = F.when(square > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((F.col("x") - F.col("ax")) * ux + (F.col("y") - F.col("ay")) * uy) / square))).otherwise(0.0)
    near = near.withColumn("t", t).withColumn("distance", G.distance(F.col("x"), F.col("y"), F.col("ax") + F.col("t") * ux, F.col("ay") + F.col("t") * uy)).where(F.col("distance") <= reach)
    length = F.sqrt(square)
    best = near.groupBy("id", "line").agg(F.min(F.struct("distance", "k", (F.col("t") * length).alias("from_a"), ((1 - F.col("t")) * length).alias("from_b"))).alias("b"))
    best = best.join(last, "line")
    at_end = ((F.col("b.k") == 0) & (F.col("b.from_a") < tolerance)) | ((F.col("b.k") == F.col("last")) & (F.col("b.from_b") < tolerance))
    kept = best.where(~at_end).select("id", "line", F.col("b.distance").alias("distance"))
    return points.join(kept, "id")


def neighbour_distance(points: DataFrame, k: int, radius: float, rounds: int = 40) -> DataFrame:
    """id, distance: the mean distance of each point to its k nearest others, fewer where there are fewer points.

    points: id, x, y, z. Points meet within the radius by grid cell; those with fewer than k others there are searched
    again with twice the radius until all of them are in reach. Repeated ids are one point.
    """
    points = points.groupBy("id").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.first("z").alias("z")).where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
    points = materialise(points, "neighbour-points")
    total = points.count()
    left, done = points, None
    for _ in range(rounds):
        place = lambda c: F.floor(F.col(c) / radius).cast("bigint")  # noqa: E731, B023
        cells = [F.struct(*[(place(a) + o).alias(f"c{a}") for a, o in zip("xyz", (i, j, m))]) for i in (-1, 0, 1) for j in (-1, 0, 1) for m in (-1, 0, 1)]
        probes = left.select(F.col("id").alias("own"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("z").alias("pz"), F.explode(F.array(*cells)).alias("c")).select("own", "px", "py", "pz", "c.*")
        others = points.select("id", "x", "y", "z", *[place(a).alias(f"c{a}") for a in "xyz"])
        away = G.distance3((F.col("px"), F.col("py"), F.col("pz")), (F.col("x"), F.col("y"), F.col("z")))
        near = probes.join(others, ["cx", "cy", "cz"]).where("own <> id").select("own", away.alias("away")).where(F.col("away") <= radius)
        # The engine keeps k rows of a point before it shuffles, however dense its surroundings are.
        first = near.withColumn("nth", F.row_number().over(Window.partitionBy("own").orderBy("away"))).where(F.col("nth") <= k)
        ranked = first.groupBy("own").agg(F.count("*").alias("n"), F.avg("away").alias("distance"))
        enough = min(k, max(total - 1, 0))
        found = materialise(left.join(ranked, left["id"] == ranked["own"], "left").select(left["*"], F.coalesce("n", F.lit(0)).alias("n"), "distance"), "neighbours")
        good = found.where(F.col("n") >= enough).select("id", "distance")
        done = good if done is None else done.unionByName(good)
        left = found.where(F.col("n") < enough).select("id", "x", "y", "z")
        if left.isEmpty():
            return done
        radius *= 2
    raise ValueError(f"points farther apart than {radius}")


def statistical_outliers(points: DataFrame, k: int, sigmas: float, radius: float = 1.0) -> DataFrame:
    """The points whose mean distance to their k nearest others is over the mean of all by more than sigmas standard deviations."""
    far = neighbour_distance(points, k, radius)
    limit = far.agg((F.avg("distance") + sigmas * F.stddev_samp("distance")).alias("limit"))
    return far.join(F.broadcast(limit), F.col("distance") > F.col("limit")).select("id", "distance")
