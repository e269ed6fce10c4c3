"""Connected components, density clusters, raster components, morphology, hulls and layered grids."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnflow.session import delete_path, materialise, materialise_at


def connected_components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its smallest node). nodes: node; edges: a, b in any direction; edges of unknown nodes are ignored.

    Each node keeps a parent and a grandparent. In a round every node takes the smallest grandparent among its
    neighbours for itself and offers it to its parent, so whole trees are hooked at once and paths halve (the FastSV
    scheme); rounds grow as the logarithm of the number of nodes. Labels are written between rounds. Raises if the
    rounds don't suffice.
    """
    kind = dict(nodes.dtypes)["node"]
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    known = nodes.select("node").where("node IS NOT NULL").distinct()
    both = both.join(known.withColumnRenamed("node", "a"), "a", "left_semi").join(known.withColumnRenamed("node", "b"), "b", "left_semi")
    both = materialise(both.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b")), "edges")
    labels, path = materialise_at(known.select("node", F.col("node").alias("parent"), F.col("node").alias("top"), F.lit(True).alias("moved")), "labels")
    for _ in range(rounds):
        seen = both.join(labels.select(F.col("node").alias("b"), "top"), "b").groupBy(F.col("a").alias("node")).agg(F.min("top").alias("offer"))
        with_offer = labels.join(seen, "node", "left")
        none = F.lit(None).cast(kind)
        own = with_offer.select("node", F.least("top", F.coalesce("offer", "top")).alias("parent"), F.col("top").alias("was"))
        hooked = with_offer.where("offer IS NOT NULL").select(F.col("parent").alias("node"), F.col("offer").alias("parent"), none.alias("was"))
        parents = own.unionByName(hooked).groupBy("node").agg(F.min("parent").alias("parent"), F.max("was").alias("was"))
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        before = path
        labels, path = materialise_at(parents.join(above, "parent").select("node", "parent", "top", (F.col("top") != F.col("was")).alias("moved")), "labels")
        delete_path(nodes.sparkSession, before)
        if labels.where("moved").isEmpty():
            return labels.select("node", F.col("top").alias("component"))
    raise RuntimeError(f"components not found in {rounds} rounds")


def _grid(points: DataFrame, axes: list[str], side: float) -> DataFrame:
    return points.withColumns({f"_c{a}": F.floor(F.col(a) / side) for a in axes})


def few(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A written table, broadcast in joins where it has at most so many rows, so that the other side isn't moved."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def dbscan(points: DataFrame, row_id: str, axes: list[str], eps: float, least: int, by: str | None = None) -> DataFrame:
    """row_id, cluster: 0 for noise, else the smallest row_id among the cluster's cores. A point counts itself.

    Cells have a diagonal just under eps: where one holds ``least`` points, all of them are cores of one cluster, so
    only the points of sparse cells are compared with those around. Cells, not points, are linked: by their outermost
    cores where these are near, and only between cells still apart then by all cores near the other cell's box. A
    border point joins its smallest cluster. Of rows with one id the smallest counts; rows without id or coordinates
    drop out. Given ``by``, points of different values of it are never neighbours; all values are clustered in the same
    pass.
    """
    extra = [by] if by else []
    side = 0.999 * eps / math.sqrt(len(axes))
    reach = math.ceil(eps / side)
    cells = [f"_c{a}" for a in axes]
    where = [*cells, *extra]
    single = points.where(F.col(row_id).isNotNull()).groupBy(F.col(row_id).alias("id")).agg(F.min(F.struct(*axes, *extra)).alias("_p")).select("id", *[F.col(f"_p.{a}").alias(a) for a in (*axes, *extra)])
    usable = single.where(" AND ".join(f"{a} IS NOT NULL AND NOT isnan({a})" for a in axes)).where(F.lit(True) if by is None else F.col(by).isNotNull())
    # Cells are computed again at each read, they aren't written.
    p = _grid(materialise(usable, "points"), axes, side)
    # What is near in no axis by the gap between cells alone can't be near.
    shifts = [s for s in itertools.product(range(-reach, reach + 1), repeat=len(axes)) if sum(max(abs(o) - 1, 0) ** 2 for o in s) * side * side <= eps * eps * 1.001]
    offsets = F.array(*[F.struct(*[F.lit(o).cast("bigint").alias(f"o{a}") for a, o in zip(axes, shift)]) for shift in shifts])

    def spread(df: DataFrame, prefix: str) -> DataFrame:
        """Rows copied to the cells around; the own cell is kept as prefix columns."""
        out = df.withColumn("_o", F.explode(offsets))
        return out.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns], *[(F.col(c) + F.col(f"_o.o{a}")).alias(c) for a, c in zip(axes, cells)], *extra)

    def near(left: DataFrame, right: DataFrame) -> DataFrame:
        apart = sum(((F.col(a) - F.col(f"s_{a}")) * (F.col(a) - F.col(f"s_{a}")) for a in axes), F.lit(0.0))
        return left.join(right, where).where(apart <= eps * eps + 1e-12)

    # The tables below are those of cells, or of the points of sparse cells and around them.
    sparse_cells = few(materialise(p.groupBy(*where).agg(F.count("*").alias("n_cell")).where(F.col("n_cell") < least).select(*where), "sparse-cells"))
    sparse = materialise(p.join(sparse_cells, where, "left_semi").select("id", *axes, *where), "sparse")
    around = few(materialise(spread(sparse_cells, "s_").select(*where).distinct(), "near-cells"))
    places = p.join(around, where, "left_semi").groupBy(*axes, *where).agg(F.count("*").alias("n"))
    counted = near(places, spread(sparse, "s_")).groupBy(F.col("s_id").alias("id")).agg(F.sum("n").alias("n_near")).where(F.col("n_near") >= least).select("id")
    sparse_cores = materialise(sparse.join(counted, "id", "left_semi"), "sparse-cores")
    dense = p.join(sparse_cells, where, "left_anti").select("id", *axes, *where)
    cores = dense.unionByName(sparse_cores)
    key = lambda prefix="": F.concat_ws(",", *[F.col(f"{prefix}{c}").cast("string") for c in where])
    turns = [F.struct(*axes[k:], *axes[:k]) for k in range(len(axes))]
    outer = [f(turn).alias(f"_e{n}{k}") for k, turn in enumerate(turns) for n, f in enumerate((F.min, F.max))]
    box = [x for a in axes for x in (F.min(a).alias(f"_low{a}"), F.max(a).alias(f"_high{a}"))]
    core_cells = few(materialise(cores.groupBy(*where).agg(F.min("id").alias("first"), *outer, *box), "core-cells"))
    outermost = core_cells.select(*where, F.explode(F.array_distinct(F.array(*[F.struct(*[F.col(f"_e{n}{k}.{a}").alias(a) for a in axes]) for k in range(len(axes)) for n in (0, 1)]))).alias("_e")).select(*where, *[F.col(f"_e.{a}").alias(a) for a in axes])
    nodes = core_cells.select(key().alias("node"))
    ends = lambda pairs: pairs.select(key().alias("a"), key("s_").alias("b")).where("a < b").distinct()
    links = materialise(ends(near(outermost, spread(outermost, "s_"))), "links")
    groups = materialise(connected_components(nodes, links), "groups")
    # Neighbouring cells that are still apart: their cores near the other's box decide.
    boxes = core_cells.withColumn("node", key()).join(groups, "node").drop("node")
    gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"_low{a}") - F.col(f"s__high{a}"), F.col(f"s__low{a}") - F.col(f"_high{a}")), F.lit(2)) for a in axes), F.lit(0.0))
    bounds = [f"_{n}{a}" for a in axes for n in ("low", "high")]
    open_pairs = boxes.select(*where, *bounds, "component").join(spread(boxes.select(*where, *bounds, "component"), "s_"), where).where((F.col("component") != F.col("s_component")) & (gap <= eps * eps * 1.001 + 1e-12))
    open_pairs = few(materialise(open_pairs.select(*where, *[f"s_{c}" for c in (*where, *bounds)]), "open-pairs"))
    if not open_pairs.isEmpty():
        off = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"s__low{a}") - F.col(a), F.col(a) - F.col(f"s__high{a}")), F.lit(2)) for a in axes), F.lit(0.0))
        facing = cores.join(open_pairs, where).where(off <= eps * eps * 1.001 + 1e-12).select(*axes, *where, *[f"s_{c}" for c in where]).distinct()
        facing = materialise(facing, "facing")
        other = facing.select(*[F.col(a).alias(f"t_{a}") for a in axes], *[F.col(c).alias(f"s_{c}") for c in where], *[F.col(f"s_{c}").alias(c) for c in where])
        apart = sum(((F.col(a) - F.col(f"t_{a}")) * (F.col(a) - F.col(f"t_{a}")) for a in axes), F.lit(0.0))
        more = ends(facing.join(other, [*where, *[f"s_{c}" for c in where]]).where(apart <= eps * eps + 1e-12))
        groups = materialise(connected_components(nodes, links.unionByName(more)), "all-groups")
    known = core_cells.withColumn("node", key()).join(groups, "node").select(*where, "first", "component")
    smallest = known.groupBy("component").agg(F.min("first").alias("cluster"))
    label = few(materialise(known.join(smallest, "component").select(*where, "cluster"), "cell-clusters"))
    rest = sparse.join(sparse_cores.select("id"), "id", "left_anti")
    facing_rest = cores.join(around, where, "left_semi").select(*axes, *where).distinct().join(label, where)
    border = near(facing_rest, spread(rest, "s_")).groupBy(F.col("s_id").alias("id")).agg(F.min("cluster").alias("cluster"))
    out = cores.join(label, where).select("id", "cluster").unionByName(rest.select("id").join(border, "id", "left").select("id", F.coalesce("cluster", F.lit(0)).alias("cluster")))
    return out.select(F.col("id").alias(row_id), "cluster")


_FOUR = ((1, 0), (0, 1))
SQUARE = tuple(itertools.product((-1, 0, 1), repeat=2))


def raster_components(cells: DataFrame) -> DataFrame:
    """cx, cy, component of a set of cells, joined over sides."""
    own = cells.select(F.col("cx").cast("bigint").alias("cx"), F.col("cy").cast("bigint").alias("cy")).distinct()
    name = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    moved = own.select("cx", "cy", F.explode(F.array(*[F.struct((F.col("cx") + dx).alias("x"), (F.col("cy") + dy).alias("y")) for dx, dy in _FOUR])).alias("m"))
    pairs = moved.select(F.concat_ws(",", "cx", "cy").alias("a"), F.col("m.x").alias("cx"), F.col("m.y").alias("cy")).join(own, ["cx", "cy"]).select("a", F.concat_ws(",", "cx", "cy").alias("b"))
    found = connected_components(own.select(F.concat_ws(",", "cx", "cy").alias("node")), pairs)
    first = own.withColumn("node", F.concat_ws(",", "cx", "cy")).join(found, "node")
    label = first.groupBy("component").agg(F.min(name(F.col("cx"), F.col("cy"))).alias("corner"))
    return first.join(label, "component").select("cx", "cy", F.concat_ws(",", "corner.x", "corner.y").alias("component"))


def large_regions(cells: DataFrame, least: int) -> DataFrame:
    found = raster_components(cells)
    big = found.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return found.join(big, "component", "left_semi")


def _shifted(cells: DataFrame, offsets) -> DataFrame:
    return cells.select("cx", "cy").distinct().withColumn("_o", F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in offsets]))).select((F.col("cx") + F.col("_o.x")).alias("cx"), (F.col("cy") + F.col("_o.y")).alias("cy"))


def dilate(cells: DataFrame, offsets=SQUARE) -> DataFrame:
    return _shifted(cells, offsets).distinct()


def erode(cells: DataFrame, offsets=SQUARE) -> DataFrame:
    """Cells all of whose neighbours are set."""
    back = [(-a, -b) for a, b in offsets]
    return _shifted(cells, back).groupBy("cx", "cy").agg(F.count("*").alias("n")).where(F.col("n") == len(back)).select("cx", "cy")


def opened(cells: DataFrame) -> DataFrame:
    return dilate(erode(cells))


def closed(cells: DataFrame) -> DataFrame:
    return erode(dilate(cells))


def neighbour_mean(cells: DataFrame, value: str, reach: tuple[int, int], weight=None) -> DataFrame:
    """cx, cy, value smoothed over a window of cells; weight(dx, dy) gives the kernel. Empty cells don't count."""
    shifts = [(a, b, 1.0 if weight is None else weight(a, b)) for a in range(-reach[0], reach[0] + 1) for b in range(-reach[1], reach[1] + 1)]
    offsets = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.lit(w).alias("w")) for a, b, w in shifts])
    spread = cells.select("cx", "cy", value).withColumn("_o", F.explode(offsets)).select((F.col("cx") + F.col("_o.x")).alias("cx"), (F.col("cy") + F.col("_o.y")).alias("cy"), F.col("_o.w").alias("w"), value)
    meant = spread.groupBy("cx", "cy").agg((F.sum(F.col("w") * F.col(value)) / F.sum("w")).alias(f"{value}_mean"), F.count("*").alias("n_cells"))
    return cells.join(meant, ["cx", "cy"])


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, anticlockwise from the leftmost; collinear points are left out."""
    p = points[np.isfinite(points).all(axis=1)]
    p = p[np.lexsort((p[:, 1], p[:, 0]))]
    # Of equal x only the lowest and the highest can be corners.
    turn = np.diff(p[:, 0]) != 0
    p = p[np.append(True, turn)[: len(p)] | np.append(turn, True)[: len(p)]]
    p = p[np.append(True, (np.diff(p, axis=0) != 0).any(axis=1))[: len(p)]]
    if len(p) < 3:
        return p

    def half(seq):
        out: list[np.ndarray] = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def convex_hulls(df: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """by, corner, x, y: each group's hull. Every batch is first reduced to its own hulls, so only corners are shuffled."""
    kind = dict(df.dtypes)[by]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            codes = keys.dictionary_encode()
            xy = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)], axis=1).astype(float)
            index = codes.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(index, kind="stable")
            cuts = np.flatnonzero(np.diff(index[order])) + 1
            parts = [(index[g[0]], hull(xy[g])) for g in np.split(order, cuts) if len(g)]
            parts = [(k, h) for k, h in parts if len(h)]
            if parts:
                k = pa.array(np.concatenate([np.full(len(h), k) for k, h in parts]), pa.int32())
                xs = np.concatenate([h for _, h in parts])
                yield pa.RecordBatch.from_arrays([codes.dictionary.take(k), pa.array(xs[:, 0]), pa.array(xs[:, 1])], names=[by, "x", "y"])

    def final(table: pa.Table) -> pa.Table:
        h = hull(np.stack([table.column("x").to_numpy(), table.column("y").to_numpy()], axis=1))
        return pa.table({by: pa.array([table.column(by)[0].as_py()] * len(h), table.schema.field(by).type), "corner": pa.array(range(len(h)), pa.int32()), "x": h[:, 0], "y": h[:, 1]})

    rows = df.where(F.col(by).isNotNull()).select(F.col(by), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    reduced = rows.mapInArrow(partial, f"`{by}` {kind}, x double, y double")
    return reduced.groupBy(by).applyInArrow(final, f"`{by}` {kind}, corner int, x double, y double")


def two_layers(df: DataFrame, size: float = 0.2, gap: float = 2.0) -> DataFrame:
    """Rows with layer 1 or 2: within a cell the points from the top down; more than gap below the last of layer 1 is layer 2.

    A point within the gap joins layer 1 and becomes its last. All below the first wider gap are still farther from that
    last point, so a sort of the cell's heights and a running flag tell the layers; no cell is held as an array. Points
    without height come last, below any that has one.
    """
    cells = [F.floor(F.col(a) / size).alias(f"c{a}") for a in ("x", "y")]
    w = Window.partitionBy("cx", "cy").orderBy(F.desc_nulls_last("z"), F.desc_nulls_last("id"))
    above = F.lag("z").over(w)
    rows = df.select(*cells, "id", "z").withColumn("_gap", F.coalesce(above - F.col("z") > gap, above.isNotNull()))
    return rows.select("cx", "cy", "id", "z", F.when(F.max("_gap").over(w.rowsBetween(Window.unboundedPreceding, 0)), 2).otherwise(1).alias("layer"))


def boundary_edges(triangles: DataFrame) -> DataFrame:
    """a, b: edges of triangles (i, j, k) that belong to one triangle only."""
    sides = F.array(*[F.struct(F.least(p, q).alias("a"), F.greatest(p, q).alias("b")) for p, q in (("i", "j"), ("j", "k"), ("k", "i"))])
    return triangles.select(F.explode(sides).alias("e")).groupBy("e.a", "e.b").agg(F.count("*").alias("n")).where("n = 1").select("a", "b")


def oriented_box(df: DataFrame, by: list[str], x: str, y: str, angle: Column) -> DataFrame:
    """by, length, width of the rectangle along each group's angle. angle: an aggregate, e.g. the principal direction."""
    axis = few(materialise(df.groupBy(*by).agg(angle.alias("_a")), "axes"))
    u = F.col(x) * F.cos("_a") + F.col(y) * F.sin("_a")
    v = F.col(y) * F.cos("_a") - F.col(x) * F.sin("_a")
    return df.join(axis, by).groupBy(*by).agg((F.max(u) - F.min(u)).alias("length"), (F.max(v) - F.min(v)).alias("width"))
