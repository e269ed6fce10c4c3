"""Operators on ordered rows: vertices of polylines, samples of scans, frames of trails.

Each takes rows with a line key and a total order within the line. Lines are cut where an operator allows it; where a
result depends on all of a line, the line is one window partition, which Spark sorts outside memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.functions import geometry as G
from cairnflow.session import materialise


def vertices(df: DataFrame, line: str, points: str, keep: list[str] | None = None) -> DataFrame:
    """line, seq, x, y, z: one row per vertex of an array of points."""
    rows = df.select(F.col(line).alias("line"), *(keep or []), F.posexplode(points).alias("seq", "p"))
    return rows.select("line", *(keep or []), "seq", F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("p.z").alias("z"))


def _along(line: str, order: str) -> Window:
    return Window.partitionBy(line).orderBy(order)


def with_measure(df: DataFrame, line: str = "line", order: str = "seq") -> DataFrame:
    """Add measure, the length along the line up to each vertex."""
    w = _along(line, order)
    step = F.coalesce(G.distance(F.lag("x").over(w), F.lag("y").over(w), F.col("x"), F.col("y")), F.lit(0.0))
    return df.withColumn("_step", step).withColumn("measure", F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def edges(df: DataFrame, line: str = "line", order: str = "seq") -> DataFrame:
    """line, seq, ax, ay, bx, by: one row per pair of neighbouring vertices."""
    w = _along(line, order)
    return df.withColumn("bx", F.lead("x").over(w)).withColumn("by", F.lead("y").over(w)).where("bx IS NOT NULL").select(line, order, F.col("x").alias("ax"), F.col("y").alias("ay"), "bx", "by")


def split_by_length(df: DataFrame, length: float, line: str = "line", order: str = "seq") -> DataFrame:
    """line, segment, measure, x, y: the line cut every so far; a cut belongs to both of its segments.

    Each edge makes its own cuts from the measures of its ends, so nothing is joined. Cuts within 1e-8 of an end of an
    edge are that vertex. Lines up to the length stay whole.
    """
    w = _along(line, order)
    m = with_measure(df, line, order)
    m = m.withColumn("_m1", F.lead("measure").over(w)).withColumn("_x1", F.lead("x").over(w)).withColumn("_y1", F.lead("y").over(w))
    tiny = 1e-8
    first, last = F.floor((F.col("measure") + tiny) / length) + 1, F.ceil((F.col("_m1") - tiny) / length) - 1
    cuts = F.when(F.col("_m1").isNotNull() & (last >= first), F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    t = lambda k: (k * length - F.col("measure")) / (F.col("_m1") - F.col("measure"))
    made = F.flatten(F.transform(cuts, lambda k: F.array(*[
        F.struct((k + o).alias("segment"), (k * length).alias("measure"), (F.col("x") + t(k) * (F.col("_x1") - F.col("x"))).alias("x"), (F.col("y") + t(k) * (F.col("_y1") - F.col("y"))).alias("y")) for o in (-1, 0)
    ])))
    near = F.round(F.col("measure") / length)
    on_cut = (F.abs(F.col("measure") - near * length) <= tiny) & (near > 0)
    own = lambda segment: F.struct(segment.cast("bigint").alias("segment"), F.col("measure"), F.col("x"), F.col("y"))
    kept = F.when(on_cut & F.col("_m1").isNotNull(), F.array(own(near - 1), own(near))).when(on_cut, F.array(own(near - 1))).otherwise(F.array(own(F.floor(F.col("measure") / length))))
    return m.select(line, F.explode(F.concat(kept, made)).alias("s")).select(line, "s.*")


def turns(df: DataFrame, line: str = "line", order: str = "seq") -> DataFrame:
    """Inner vertices with before and after (lengths of the legs), angle (inner, 180 at a zero leg) and deflection, in degrees."""
    w = _along(line, order)
    r = df.withColumn("_ax", F.lag("x").over(w)).withColumn("_ay", F.lag("y").over(w)).withColumn("_bx", F.lead("x").over(w)).withColumn("_by", F.lead("y").over(w))
    r = r.where("_ax IS NOT NULL AND _bx IS NOT NULL")
    ux, uy, vx, vy = F.col("_ax") - F.col("x"), F.col("_ay") - F.col("y"), F.col("_bx") - F.col("x"), F.col("_by") - F.col("y")
    before, after = F.sqrt(ux * ux + uy * uy), F.sqrt(vx * vx + vy * vy)
    angle = F.coalesce(G.angle_between(ux, uy, vx, vy), F.lit(180.0))
    height = F.abs(G.cross(ux, uy, vx, vy)) / G.distance(F.col("_ax"), F.col("_ay"), F.col("_bx"), F.col("_by"))
    return r.select(*df.columns, before.alias("before"), after.alias("after"), angle.alias("angle"), (180 - angle).alias("deflection"), height.alias("height"))


def sharp_turns(df: DataFrame, degrees: float = 15.0, fluctuation: float | None = None, line: str = "line", order: str = "seq") -> DataFrame:
    """Turns whose deflection exceeds the limit, without legs under 1e-9; given a fluctuation, flat triangles are left out too."""
    found = turns(df, line, order).where((F.col("before") >= 1e-9) & (F.col("after") >= 1e-9) & (F.col("deflection") > degrees + 1e-9))
    return found if fluctuation is None else found.where(F.coalesce(F.col("height"), F.lit(0.0)) > fluctuation)


def range_curvature(df: DataFrame, line: str, order: str, value: str, reach: int = 5) -> DataFrame:
    """Add curvature: (sum of the neighbours - 2*reach*own)^2; null within reach of an end."""
    w = _along(line, order)
    window = w.rowsBetween(-reach, reach)
    full = F.count("*").over(window) == 2 * reach + 1
    return df.withColumn("curvature", F.when(full, F.pow(F.sum(value).over(window) - (2 * reach + 1) * F.col(value), 2)))


def occluded(df: DataFrame, line: str, order: str, distance: str, azimuth: str, share: float = 0.02, degrees: float = 0.2) -> DataFrame:
    """Add occluded: the range or the azimuth jumps against either neighbour."""
    w = _along(line, order)
    jump = F.lit(False)
    for other in (F.lag, F.lead):
        jump = jump | F.coalesce((F.abs(F.col(distance) - other(distance).over(w)) > share * F.abs(F.col(distance))) | (F.abs(F.col(azimuth) - other(azimuth).over(w)) > degrees), F.lit(False))
    return df.withColumn("occluded", jump)


def moving_mean(df: DataFrame, line: str, order: str, columns: list[str], reach: int) -> DataFrame:
    window = _along(line, order).rowsBetween(-reach, reach)
    return df.withColumns({c: F.avg(c).over(window) for c in columns})


def jumps(df: DataFrame, limit: float, line: str = "line", order: str = "seq") -> DataFrame:
    """Vertices farther than the limit from the one before."""
    w = _along(line, order)
    return df.withColumn("gap", G.distance(F.lag("x").over(w), F.lag("y").over(w), F.col("x"), F.col("y"))).where(F.col("gap") > limit)


def split_at(df: DataFrame, flag: Column, line: str = "line", order: str = "seq") -> DataFrame:
    """Rows with piece, cut at flagged rows; a flagged row ends one piece and begins the next; pieces of one row are dropped."""
    w = _along(line, order)
    marked = df.withColumn("_f", F.coalesce(flag, F.lit(False)).cast("int"))
    marked = marked.withColumn("_n", F.coalesce(F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    both = F.when(F.col("_f") == 1, F.array(F.col("_n"), F.col("_n") + 1)).otherwise(F.array(F.col("_n")))
    pieces = marked.withColumn("piece", F.explode(both)).drop("_f", "_n")
    size = F.count("*").over(Window.partitionBy(line, "piece"))
    return pieces.withColumn("_size", size).where("_size >= 2").drop("_size")


def chain(pieces: DataFrame, line: str = "line") -> DataFrame:
    """line, piece, prev_piece, next_piece of cut lines."""
    w = Window.partitionBy(line).orderBy("piece")
    return pieces.select(line, "piece").distinct().withColumn("prev_piece", F.lag("piece").over(w)).withColumn("next_piece", F.lead("piece").over(w))


def stations(df: DataFrame, step: float, line: str = "line", order: str = "seq") -> DataFrame:
    """line, station, measure, x, y: points every step from the start, the end excluded."""
    w = _along(line, order)
    m = with_measure(df, line, order).withColumn("_m1", F.lead("measure").over(w)).withColumn("_x1", F.lead("x").over(w)).withColumn("_y1", F.lead("y").over(w)).where("_m1 > measure")
    first, last = F.ceil(F.col("measure") / step), F.ceil(F.col("_m1") / step) - 1
    k = m.where(last >= first).withColumn("station", F.explode(F.sequence(first, last)))
    t = (F.col("station") * step - F.col("measure")) / (F.col("_m1") - F.col("measure"))
    return k.select(line, "station", (F.col("station") * step).alias("measure"), (F.col("x") + t * (F.col("_x1") - F.col("x"))).alias("x"), (F.col("y") + t * (F.col("_y1") - F.col("y"))).alias("y"))


def perpendicular_rays(points: DataFrame, reach: float = 4.5) -> DataFrame:
    """Rays across the direction at each station: adds ax, ay (left end), bx, by (right end). points: x, y, dx, dy."""
    n = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
    ox, oy = -F.col("dy") / n * reach, F.col("dx") / n * reach
    return points.withColumns({"ax": F.col("x") + ox, "ay": F.col("y") + oy, "bx": F.col("x") - ox, "by": F.col("y") - oy})


def numbered(keys: DataFrame, column: str, name: str) -> DataFrame:
    """The distinct values of a column with their place in the order of all, from 0, without one task seeing them all.

    Values are range-partitioned and sorted; the partitions' sizes, a number each, give the offsets.
    """
    ordered = keys.select(column).distinct().repartitionByRange(column).sortWithinPartitions(column)
    placed = materialise(ordered.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part, inside = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    sizes = sorted(placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for p, n in sizes:
        offsets += [F.lit(p), F.lit(total)]
        total += n
    start = F.element_at(F.create_map(*offsets), part) if offsets else F.lit(0)
    return placed.select(column, (start + inside).cast("int").alias(name))


def ordinals(df: DataFrame, line: str = "line", order: str = "seq") -> DataFrame:
    """Add point_no, dense within the line, and line_no, dense over lines; line numbers come from the distinct lines alone."""
    return df.withColumn("point_no", F.row_number().over(_along(line, order)) - 1).join(numbered(df, line, "line_no"), line)


def keep_spaced(points: Column, spacing: Column) -> Column:
    """Vertices farther from the last kept one than the spacing; the first vertex is kept."""
    far = lambda k, p: G.distance(F.element_at(k, -1)["x"], F.element_at(k, -1)["y"], p["x"], p["y"]) > spacing
    return F.aggregate(points, F.slice(points, 1, 0), lambda k, p: F.when((F.size(k) == 0) | far(k, p), F.concat(k, F.array(p))).otherwise(k))


def smoothing_spline(t: np.ndarray, y: np.ndarray, p: float) -> np.ndarray:
    """Values of the natural cubic smoothing spline at its knots; ends pinned. p is the weight of the fit against roughness.

    The system has two diagonals on either side and is solved in linear time and memory.
    """
    n = len(t)
    if n < 3:
        return y.copy()
    h = np.diff(t)
    first, mid, last = 1 / h[:-1], -1 / h[:-1] - 1 / h[1:], 1 / h[1:]
    # Pinned ends carry so much weight that they stay.
    inverse = np.ones(n)
    inverse[[0, -1]] = 1e-12
    main = p * (h[:-1] + h[1:]) / 3 + (1 - p) * (first * first * inverse[:-2] + mid * mid * inverse[1:-1] + last * last * inverse[2:])
    next1 = p * h[1:-1] / 6 + (1 - p) * (mid[:-1] * first[1:] * inverse[1:-2] + last[:-1] * mid[1:] * inverse[2:-1])
    next2 = (1 - p) * last[:-2] * first[2:] * inverse[2:-2]
    gamma = _five_diagonals(main, next1, next2, p * (first * y[:-2] + mid * y[1:-1] + last * y[2:]))
    bend = np.zeros(n)
    bend[:-2] += first * gamma
    bend[1:-1] += mid * gamma
    bend[2:] += last * gamma
    return y - (1 - p) / p * inverse * bend


def _five_diagonals(main: np.ndarray, next1: np.ndarray, next2: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a symmetric positive definite system with two diagonals on either side, by its LDL' factors."""
    n = len(main)
    d, e, f, z = main.tolist(), [*next1.tolist(), 0.0], [*next2.tolist(), 0.0, 0.0], right.tolist()
    for i in range(n):
        if i + 1 < n:
            u, v = e[i] / d[i], f[i] / d[i]
            d[i + 1] -= u * e[i]
            e[i + 1] -= u * f[i]
            z[i + 1] -= u * z[i]
            if i + 2 < n:
                d[i + 2] -= v * f[i]
                z[i + 2] -= v * z[i]
            e[i], f[i] = u, v
        z[i] /= d[i]
    for i in range(n - 2, -1, -1):
        z[i] -= e[i] * z[i + 1] + (f[i] * z[i + 2] if i + 2 < n else 0.0)
    return np.array(z)


def smooth(df: DataFrame, p: float = 0.0006, line: str = "line", order: str = "seq") -> DataFrame:
    """line, seq, x, y: each line smoothed as a whole over its chord length."""
    measured = with_measure(df, line, order)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        t = table.column("measure").to_numpy()
        keep = np.concatenate(([True], np.diff(t) > 1e-9))
        out = {}
        for axis in ("x", "y"):
            v = table.column(axis).to_numpy().copy()
            v[keep] = smoothing_spline(t[keep], v[keep], p)
            out[axis] = v
        return pa.table({line: table.column(line), order: table.column(order), "x": out["x"], "y": out["y"]})

    kinds = dict(df.dtypes)
    return measured.groupBy(line).applyInArrow(run, f"`{line}` {kinds[line]}, `{order}` {kinds[order]}, x double, y double")


def poly_fit(df: DataFrame, by: list[str], x: str, y: str, degree: int = 3) -> DataFrame:
    """by, coefficients (lowest first) of a least-squares polynomial, from power sums that Spark adds map-side.

    x is centred per group first, so the sums stay well conditioned; coefficients hold for x - centre.
    """
    centre = df.groupBy(*by).agg(F.avg(x).alias("centre"))
    rows = df.join(centre, by).withColumn("_x", F.col(x) - F.col("centre"))
    sums = [F.sum(F.pow("_x", F.lit(k))).alias(f"s{k}") for k in range(2 * degree + 1)] + [F.sum(F.pow("_x", F.lit(k)) * F.col(y)).alias(f"t{k}") for k in range(degree + 1)]
    moments = rows.groupBy(*by, "centre").agg(*sums)
    kinds = dict(moments.dtypes)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.stack([batch.column(f"s{k}").to_numpy(zero_copy_only=False) for k in range(2 * degree + 1)], axis=1)
            t = np.stack([batch.column(f"t{k}").to_numpy(zero_copy_only=False) for k in range(degree + 1)], axis=1)
            m = s[:, np.add.outer(np.arange(degree + 1), np.arange(degree + 1))]
            c = (np.linalg.pinv(m, rcond=1e-12, hermitian=True) @ t[:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_arrays([*[batch.column(b) for b in by], batch.column("centre"), pa.array(c.tolist(), pa.list_(pa.float64()))], names=[*by, "centre", "coefficients"])

    return moments.mapInArrow(solve, ", ".join(f"`{b}` {kinds[b]}" for b in by) + ", centre double, coefficients array<double>")


