"""Scores, votes, voxel reductions and fits as plain aggregations, so that Spark combines them map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights of the levels of a check.
LEVEL_WEIGHTS = {"P00": 0, "P0": 3, "P1": 2, "P2": 1}
HISTOGRAM_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 1.0]


def weighted_score(stats: DataFrame, by: list[str]) -> DataFrame:
    """by, score of check statistics (level, level_weight, total_count, log_count); a P00 makes the score 0, no weight gives 0."""
    zero = (F.col("level") == "P00") | (F.coalesce("total_count", F.lit(0)) == 0)
    one = F.when(zero, F.lit(0.0)).otherwise(1 - F.col("log_count") / F.col("total_count"))
    rows = stats.withColumn("_s", one)
    out = rows.groupBy(*by).agg(F.sum(F.col("_s") * F.col("level_weight")).alias("_n"), F.sum("level_weight").alias("_d"), F.bool_or(F.col("level") == "P00").alias("_p"))
    return out.select(*by, F.when(F.col("_p") | (F.coalesce("_d", F.lit(0)) <= 0), F.lit(0.0)).otherwise(F.bround(F.round(F.col("_n") / F.col("_d"), 9), 3)).alias("score"))


def precision_recall(matched: Column, inputs: Column, truths: Column) -> list[Column]:
    """precision, recall, f1 from counts, 0 where a denominator is 0."""
    p = F.when(inputs != 0, matched / inputs).otherwise(F.lit(0.0))
    r = F.when(truths != 0, matched / truths).otherwise(F.lit(0.0))
    return [p.alias("precision"), r.alias("recall"), F.when(p + r != 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1")]


def within_two_sigma(df: DataFrame, value: str) -> DataFrame:
    """mean, sigma, n_kept, mean_kept; kept are values of at most twice the population standard deviation."""
    mean, sigma = df.agg(F.avg(value), F.stddev_pop(value)).first()
    kept = F.col(value) <= (2 * sigma if sigma is not None else None)
    constant = [F.lit(mean).cast("double").alias("mean"), F.lit(sigma).cast("double").alias("sigma")]
    return df.agg(F.count_if(kept).alias("n_kept"), F.avg(F.when(kept, F.col(value))).alias("mean_kept")).select(*constant, "n_kept", "mean_kept")


def density_histogram(df: DataFrame, value: str, edges: list[float] | None = None) -> DataFrame:
    """bin, n, share: counts per bin, divided by bin width, then normalised to sum to 1; the last edge is inside."""
    edges = edges or HISTOGRAM_EDGES
    v = F.col(value)
    at = None
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = (v >= low) & ((v < high) if i < len(edges) - 2 else (v <= high))
        at = F.when(inside, F.lit(i)) if at is None else at.when(inside, F.lit(i))
    widths = F.element_at(F.array(*[F.lit(b - a) for a, b in zip(edges, edges[1:])]), F.col("bin") + 1)
    counted = df.select(at.alias("bin")).where("bin IS NOT NULL").groupBy("bin").agg(F.count("*").alias("n")).withColumn("_density", F.col("n") / widths)
    return counted.withColumn("share", F.col("_density") / F.sum("_density").over(Window.partitionBy())).drop("_density")


def mode_with_rate(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, mode, n_mode, rate; of equally frequent values the smallest."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    best = F.max_by(value, F.struct(F.col("_n"), (-F.col(value)).alias("v")))
    return counted.groupBy(*by).agg(best.alias("mode"), F.max("_n").alias("n_mode"), (F.max("_n") / F.sum("_n")).alias("rate"))


def vote_by_distance(df: DataFrame, by: list[str], choice: str, distance: str, half: float = 0.5) -> DataFrame:
    """by, winner: the choice with the greatest sum of half/(half+distance); ties go to the larger choice."""
    summed = df.groupBy(*by, choice).agg(F.sum(half / (half + F.col(distance))).alias("_s"))
    return summed.groupBy(*by).agg(F.max_by(choice, F.struct(F.round("_s", 9), choice)).alias("winner"))


def vote_flag(weight: Column, flag: Column, least: float = 0.7) -> Column:
    return F.sum(weight * flag.cast("double")) / F.sum(weight) > least


def vote_number(weight: Column, value: Column) -> Column:
    """Weighted mean, half up to an integer by truncation."""
    return (F.sum(weight * value) / F.sum(weight) + 0.5).cast("int")


def vote_nearest_type(df: DataFrame, by: list[str], line: str, kind: str, distance: str) -> DataFrame:
    """by, winner: each line votes with its nearest sample; the most frequent kind wins, the smallest of equals."""
    nearest = df.groupBy(*by, line).agg(F.min_by(kind, F.struct(distance, kind)).alias(kind))
    counted = nearest.groupBy(*by, kind).agg(F.count("*").alias("_n"))
    return counted.groupBy(*by).agg(F.max_by(kind, F.struct(F.col("_n"), (-F.col(kind)).alias("k"))).alias("winner"))


def voxel(column: Column, size: float, truncate: bool = False) -> Column:
    """Cell of a coordinate; truncation makes the cells at zero twice as wide."""
    scaled = column / F.lit(size)
    return scaled.cast("bigint") if truncate else F.floor(scaled)


def voxel_best(df: DataFrame, axes: list[str], size: float, key: Column, keep: list[str]) -> DataFrame:
    """One row per voxel: the one with the smallest key. key must be total for a defined result."""
    cells = [F.round((F.col(a) + 50000) / size).cast("bigint").alias(f"cell_{a}") for a in axes]
    return df.groupBy(*cells).agg(F.min_by(F.struct(*keep), key).alias("_r")).select(*[f"cell_{a}" for a in axes], *[F.col(f"_r.{k}").alias(k) for k in keep])


def voxel_mean(df: DataFrame, cell_axes: list[str], size: float, mean_axes: list[str], truncate: bool = False) -> DataFrame:
    cells = [voxel(F.col(a), size, truncate).alias(f"cell_{a}") for a in cell_axes]
    return df.groupBy(*cells).agg(*[F.avg(a).alias(a) for a in mean_axes], F.count("*").alias("n"))


def voxel_sample(df: DataFrame, axes: list[str], size: float, row_id: str, seed: int = 0) -> DataFrame:
    """One row per voxel, uniformly by a seeded hash of its id: the same rows at every run, on any partitioning."""
    cells = [voxel(F.col(a), size).alias(f"cell_{a}") for a in axes]
    columns = df.columns
    draw = F.xxhash64(F.lit(seed), F.col(row_id))
    return df.groupBy(*cells).agg(F.min_by(F.struct(*columns), F.struct(draw, F.col(row_id))).alias("_r")).select("_r.*")


def voxel_nearest(df: DataFrame, axes: list[str], size: float, row_id: str) -> DataFrame:
    """Per voxel the row nearest to its centre."""
    cells = [voxel(F.col(a), size) for a in axes]
    away = sum((F.pow(F.col(a) - (c + 0.5) * size, 2) for a, c in zip(axes, cells)), F.lit(0.0))
    return df.groupBy(*[c.alias(f"cell_{a}") for a, c in zip(axes, cells)]).agg(F.min_by(row_id, F.struct(F.round(away, 9), F.col(row_id))).alias(row_id))


def line_fit(x: Column, y: Column) -> list[Column]:
    """Total least squares through centroid: mean_x, mean_y, angle (radians of the principal direction), thickness (variance across)."""
    cxx, cyy, cxy = F.var_pop(x), F.var_pop(y), F.covar_pop(x, y)
    spread = F.sqrt(F.pow(cxx - cyy, 2) + 4 * cxy * cxy)
    return [F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"), (0.5 * F.atan2(2 * cxy, cxx - cyy)).alias("angle"), ((cxx + cyy - spread) / 2).alias("thickness")]


def circle_fit(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """by, centre_x, centre_y, radius of the algebraic circle fit, in closed form from centred moments; null where points are collinear."""
    means = df.groupBy(*by).agg(F.avg(x).alias("_mx"), F.avg(y).alias("_my"))
    u, v = F.col(x) - F.col("_mx"), F.col(y) - F.col("_my")
    m = df.join(means, by).groupBy(*by, "_mx", "_my").agg(
        F.avg(u * u).alias("uu"), F.avg(v * v).alias("vv"), F.avg(u * v).alias("uv"), F.avg(u * (u * u + v * v) / 2).alias("p"), F.avg(v * (u * u + v * v) / 2).alias("q")
    )
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    a, b = (F.col("p") * F.col("vv") - F.col("q") * F.col("uv")) / det, (F.col("q") * F.col("uu") - F.col("p") * F.col("uv")) / det
    ok = det > 1e-12
    return m.select(*by, F.when(ok, a + F.col("_mx")).alias("centre_x"), F.when(ok, b + F.col("_my")).alias("centre_y"), F.when(ok, F.sqrt(a * a + b * b + F.col("uu") + F.col("vv"))).alias("radius"))
