"""Implausible readings per source: spikes, stuck values and physically impossible values.

Readings of a source are packed into time blocks by an aggregation that also drops repeated rows; the blocks are written
once. Each gets the nearest readings before and after it, so that a rolling window or a run never ends at a block's
border, and a block's work is bounded however many readings a source has. These halos are a prefix scan in two levels:
within stretches of ``STRETCH`` blocks, then over the stretches of a source, which are as many as its span of time
holds, whatever its number of rows. The usual deviation of a source is a median from log-scale histograms that add up
the same way.

For positions the Hampel rule (rolling median and the source's scaled median absolute deviation) proposes outliers. A
proposal stands if it leaves a local straight fit of its unproposed neighbours by the limits and if the run of such
readings is short and has neighbours on both sides. For rates the Hampel rule proposes too, and a proposal stands if it
is so many times the source's median. Stuck values come from run lengths, impossible ones from bounds.

Defined results: rows without source, order value or reading are left out; a reading holding a null or a number that
is not finite is impossible (null readings are left out before); equal order values are ordered by id. A rate without an
order value has no neighbours and is compared with its source's median alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnflow.session import materialise

#: Residual histogram: bins of an eighth of an octave from 2^-20 on.
_BINS, _STEP, _LOW = 400, 8, -20


def _bin(residuals: np.ndarray) -> np.ndarray:
    at = np.floor((np.log2(np.maximum(residuals, 2.0**_LOW)) - _LOW) * _STEP).astype(int)
    return np.bincount(np.clip(at, 0, _BINS - 1), minlength=_BINS)


def histogram_median(hist: np.ndarray) -> float:
    """The median a residual histogram stands for; 0 for an empty one."""
    total = hist.sum()
    if not total:
        return 0.0
    return float(2.0 ** (_LOW + (np.searchsorted(np.cumsum(hist), total / 2) + 0.5) / _STEP))


def interpolation_residuals(t: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distance per axis (averaged over axes) of each inner reading from the line between its neighbours."""
    if len(t) < 3:
        return np.empty(0)
    span = np.maximum(t[2:] - t[:-2], 1e-9)
    inner = x[1:-1] - (x[:-2] + (x[2:] - x[:-2]) * ((t[1:-1] - t[:-2]) / span)[:, None])
    return np.abs(inner[:, :2]).mean(axis=1)


def _bounded(x: np.ndarray, bounds: list[tuple[float, float] | None]) -> np.ndarray:
    """Rows within the bounds; an axis whose bounds are None may hold anything."""
    ok = np.ones(len(x), bool)
    for axis, limits in enumerate(bounds):
        if limits is not None:
            with np.errstate(invalid="ignore"):
                ok &= np.isfinite(x[:, axis]) & (x[:, axis] >= limits[0]) & (x[:, axis] <= limits[1])
    return ok


def leaves_path(t: np.ndarray, x: np.ndarray, noise: float, least: float, times: float, half: int, longest: int, near: float) -> np.ndarray:
    """Readings of short runs that leave the path and come back. t ascending, all of x finite."""
    n = len(t)
    out = np.zeros(n, bool)
    if n < 2 * half + 1:
        half = max(1, (n - 1) // 2)
    if n < 5:
        return out
    padded = np.pad(x, ((half, half), (0, 0)), mode="edge")
    middle = np.median(sliding_window_view(padded, 2 * half + 1, axis=0), axis=2)
    away = np.sqrt(((x - middle) ** 2).sum(axis=1))
    proposed = away >= max(0.6 * least, 0.4 * times * noise)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], proposed.astype(np.int8), [0]))))
    good = np.flatnonzero(~proposed)
    limit = max(least, times * noise)
    for start, end in edges.reshape(-1, 2):
        k = np.searchsorted(good, start)
        before, after = good[max(0, k - 4) : k], good[k : k + 4]
        if not len(before) or not len(after):
            continue
        around = np.concatenate((before[t[start] - t[before] <= near], after[t[after] - t[end - 1] <= near]))
        if len(around) < 2:
            continue
        centre = t[start]
        a = np.vstack((np.ones(len(around)), t[around] - centre)).T
        fit, *_ = np.linalg.lstsq(a, x[around], rcond=None)
        off = np.sqrt(((x[around] - a @ fit) ** 2).sum(axis=1)).max()
        inside = np.vstack((np.ones(end - start), t[start:end] - centre)).T @ fit
        leaves = np.sqrt(((x[start:end] - inside) ** 2).sum(axis=1)) >= max(limit, 3 * off)
        bounds = np.flatnonzero(np.diff(np.concatenate(([0], leaves.astype(np.int8), [0])))).reshape(-1, 2)
        for a0, b0 in bounds:
            if b0 - a0 <= longest:
                out[start + a0 : start + b0] = True
    return out


def rolling_median(x: np.ndarray, half: int) -> np.ndarray:
    """The median of each value and up to half neighbours on each side."""
    if len(x) <= 2 * half:
        return np.array([np.median(x[max(0, i - half) : i + half + 1]) for i in range(len(x))])
    inner = np.median(sliding_window_view(x, 2 * half + 1), axis=1)
    ends = [np.median(x[: i + half + 1]) for i in range(half)], [np.median(x[i - half :]) for i in range(len(x) - half, len(x))]
    return np.concatenate((ends[0], inner, ends[1]))


def run_members(x: np.ndarray, least: int) -> np.ndarray:
    """Rows that belong to a run of at least so many equal values in some column; NaN equals nothing."""
    n = len(x)
    out = np.zeros(n, bool)
    for column in x.T:
        starts = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1)) if n else np.empty(0, int)
        lengths = np.diff(np.concatenate((starts, [n])))
        out |= np.repeat(lengths >= least, lengths) if n else out
    return out


#: Blocks of a stretch, the unit the halos are first carried within.
STRETCH = 512


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(int)


def _blocks_of(batch: pa.RecordBatch, axes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """id, t, readings of each row's block, in order."""
    (t, ends), (ids, _) = _flat(batch.column("t")), _flat(batch.column("id"))
    v = np.stack([_flat(batch.column(f"v{a}"))[0].astype(float) for a in range(axes)], axis=1) if axes else np.empty((len(t), 0))
    for a, b in zip(ends, ends[1:]):
        order = np.lexsort((ids[a:b], t[a:b])) + a
        yield ids[order], t[order], v[order]


class _Rule:
    """How a kind of reading is judged: its halo, the deviations that make up a source's usual one, and its outliers."""

    def __init__(self, bounds: list, spike: dict | None, rate: dict | None, stuck: int, runs_on: list[int]) -> None:
        self.bounds, self.spike, self.rate, self.stuck, self.runs_on = bounds, spike, rate, stuck, runs_on
        self.halo = max(stuck, 2 * spike["half"] + spike["longest"] + 4 if spike else 0, rate["half"] if rate else 0)

    def deviations(self, t: np.ndarray, x: np.ndarray) -> np.ndarray:
        ok = _bounded(x, self.bounds)
        if self.spike:
            return interpolation_residuals(t[ok], x[ok])
        if self.rate:
            r = x[ok & np.isfinite(x[:, -1]), -1]
            return np.abs(r - rolling_median(r, self.rate["half"]))
        return np.empty(0)

    def outliers(self, t: np.ndarray, x: np.ndarray, ok: np.ndarray, usual: float) -> np.ndarray:
        out = np.zeros(len(t), bool)
        if self.spike:
            # |r| of a Gaussian residual has its median at 0.6745 sigma; the mean of two axes at 0.75; interpolation adds half the variance.
            where = np.flatnonzero(ok)
            out[where[leaves_path(t[ok], x[ok], usual / 0.75 / np.sqrt(1.5), **self.spike)]] = True
        elif self.rate:
            where = np.flatnonzero(ok & np.isfinite(x[:, -1]))
            r = x[where, -1]
            out[where[r - rolling_median(r, self.rate["half"]) > self.rate["sigmas"] * 1.4826 * usual]] = True
        return out


_HALO = [("ht", pa.list_(pa.int64())), ("hv", pa.list_(pa.float64())), ("tt", pa.list_(pa.int64())), ("tv", pa.list_(pa.float64()))]
_HIST = [("bins", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
_KEYS = [("source", pa.string()), ("stretch", pa.int64()), ("block", pa.int64())]


def _ddl(fields: list) -> str:
    names = {pa.string(): "string", pa.int64(): "bigint", pa.float64(): "double", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.float64()): "array<double>", pa.list_(pa.int32()): "array<int>"}
    return ", ".join(f"{n} {names[t]}" for n, t in fields)


def _table(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def _profile(rule: _Rule):
    """Per block its first and last readings and the histogram of its deviations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            keys = zip(batch.column("source").to_pylist(), batch.column("stretch").to_pylist(), batch.column("block").to_pylist())
            for key, (_, t, x) in zip(keys, _blocks_of(batch, len(rule.bounds))):
                hist = _bin(rule.deviations(t, x))
                at = np.flatnonzero(hist)
                h = rule.halo
                rows.append((*key, t[:h], x[:h].ravel(), t[-h:], x[-h:].ravel(), at.astype(np.int32), hist[at]))
            if rows:
                yield _table(rows, _KEYS + _HALO + _HIST)

    return run


def _carried(parts: list[tuple[np.ndarray, np.ndarray]], halo: int, axes: int, last: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each part, the halo readings next to it among the parts before it (last) or, the list being reversed, after it."""
    t, v = np.empty(0, np.int64), np.empty(0)
    out = []
    for own_t, own_v in parts:
        out.append((t, v))
        if last:
            t, v = np.concatenate((t, own_t))[-halo:], np.concatenate((v, own_v))[-halo * axes :]
        else:
            t, v = np.concatenate((own_t, t))[:halo], np.concatenate((own_v, v))[: halo * axes]
    return [*out, (t, v)]


def _scan(rule: _Rule, by: str):
    """The halo of each row of a group from the others, in the order of by; then one row for the whole group."""
    halo, axes = rule.halo, len(rule.bounds)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by(by)
        cut = {n: _flat(group.column(n)) for n, _ in (*_HALO, *_HIST)}
        lists = lambda n: [cut[n][0][a:b] for a, b in zip(cut[n][1], cut[n][1][1:])]
        heads, tails = list(zip(lists("ht"), lists("hv"))), list(zip(lists("tt"), lists("tv")))
        before = _carried(tails, halo, axes, True)
        after = _carried(heads[::-1], halo, axes, False)
        hist = np.zeros(_BINS, np.int64)
        np.add.at(hist, cut["bins"][0].astype(int), cut["counts"][0].astype(np.int64))
        at = np.flatnonzero(hist)
        source, stretches, blocks = (group.column(n).to_pylist() for n, _ in _KEYS)
        none = np.empty(0, np.int32), np.empty(0, np.int64)
        # A row of the group: its halo before and after; the group's own row: its first and last readings.
        rows = [(s, k, b, *after[len(heads) - 1 - i], *before[i], *none) for i, (s, k, b) in enumerate(zip(source, stretches, blocks))]
        rows.append((source[0], stretches[0] if by == "block" else None, None, *after[-1], *before[-1], at.astype(np.int32), hist[at]))
        return pa.Table.from_batches([_table(rows, _KEYS + _HALO + _HIST)])

    return run


def _judge(rule: _Rule):
    halo, axes = rule.halo, len(rule.bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            around = {n: _flat(batch.column(n)) for n in ("bt", "bv", "at", "av")}
            piece = lambda n, i: around[n][0][around[n][1][i] : around[n][1][i + 1]]
            usual = batch.column("usual").to_numpy(zero_copy_only=False)
            ids, flags = [], []
            for i, (own, t, x) in enumerate(_blocks_of(batch, axes)):
                bt, at = piece("bt", i)[-halo:], piece("at", i)[:halo]
                core = slice(len(bt), len(bt) + len(t))
                t = np.concatenate((bt, t, at))
                x = np.concatenate((piece("bv", i)[-halo * axes :].reshape(-1, axes), x, piece("av", i)[: halo * axes].reshape(-1, axes)))
                ok = _bounded(x, rule.bounds)
                found = np.stack((~ok, rule.outliers(t.astype(float), x, ok, usual[i]), run_members(x[:, rule.runs_on], rule.stuck)))[:, core]
                hit = found.any(axis=0)
                ids.append(own[hit])
                flags.append(found[:, hit])
            if ids:
                flat = np.concatenate(flags, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), pa.int64()), *[pa.array(c, pa.bool_()) for c in flat]], names=["id", "impossible", "spike", "stuck"])

    return run


def _usual(column: str) -> Column:
    """The median a histogram of bins and counts stands for; 0 for an empty one."""
    pairs = F.arrays_zip("bins", "counts")
    half = F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, n: s + n) / 2
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(None).cast("int").alias("bin"))
    # The first bin at which the running count reaches half of all.
    at = F.aggregate(pairs, start, lambda a, p: F.struct((a["sum"] + p["counts"]).alias("sum"), F.coalesce(a["bin"], F.when(a["sum"] + p["counts"] >= half, p["bins"])).alias("bin")))["bin"]
    return F.coalesce(F.pow(F.lit(2.0), _LOW + (at + 0.5) / _STEP), F.lit(0.0)).alias(column)


def implausible(
    df: DataFrame, source: str, order: str, row_id: str, reading: str, bounds: list[tuple[float, float] | None], block: int, spike: dict | None = None, stuck: int = 6, rate: dict | None = None, runs_on: list[int] | None = None
) -> DataFrame:
    """id, impossible, spike, stuck for the readings that are any of these.

    order: integer; reading: array of as many doubles as bounds, where an axis with bounds None may hold NaN for no
    value; block: width of a time block in units of order. spike, for positions: least (smallest distance), times
    (multiple of the usual noise), half (rows each side in the rolling median), longest (rows of a run), near (farthest
    neighbour in units of order). rate, for a rate on the last axis: half and sigmas of the Hampel rule. runs_on: axes on
    which equal values are stuck, all by default.
    """
    rule = _Rule(bounds, spike, rate, stuck, runs_on if runs_on is not None else list(range(len(bounds))))
    valid = df.where(F.col(source).isNotNull() & F.col(order).isNotNull() & (F.size(F.filter(F.col(reading), lambda v: v.isNotNull())) == len(bounds)) & (F.size(reading) == len(bounds)))
    axes = [F.col(reading)[a].cast("double").alias(f"v{a}") for a in range(len(bounds))]
    rows = valid.select(F.col(source).cast("string").alias("source"), F.floor(F.col(order) / block).cast("bigint").alias("block"), F.struct(F.col(order).cast("bigint").alias("t"), F.col(row_id).cast("bigint").alias("id"), *axes).alias("r"))
    packed = rows.groupBy("source", "block").agg(F.collect_set("r").alias("r"))
    stretch = F.floor(F.col("block") / STRETCH).cast("bigint").alias("stretch")
    blocks = materialise(packed.select("source", stretch, "block", "r.t", "r.id", *[f"r.v{a}" for a in range(len(bounds))]), "reading-blocks")
    form = _ddl(_KEYS + _HALO + _HIST)
    within = materialise(blocks.mapInArrow(_profile(rule), form).groupBy("source", "stretch").applyInArrow(_scan(rule, "block"), form), "reading-halos")
    groups = within.where("block IS NULL").groupBy("source").applyInArrow(_scan(rule, "stretch"), form)
    groups = materialise(groups, "source-halos")
    usual = groups.where("stretch IS NULL").select("source", _usual("usual"))
    outer = groups.where("stretch IS NOT NULL").join(usual, "source").select("source", "stretch", "usual", *[F.col(n).alias(f"outer_{n}") for n, _ in _HALO])
    edges = within.where("block IS NOT NULL").join(outer, ["source", "stretch"]).select(
        "source", "block", "usual", F.concat("outer_tt", "tt").alias("bt"), F.concat("outer_tv", "tv").alias("bv"), F.concat("ht", "outer_ht").alias("at"), F.concat("hv", "outer_hv").alias("av")
    )
    judged = blocks.join(edges, ["source", "block"]).drop("source", "stretch", "block").mapInArrow(_judge(rule), "id bigint, impossible boolean, spike boolean, stuck boolean")
    return judged.groupBy("id").agg(*[F.max(c).alias(c) for c in ("impossible", "spike", "stuck")])


def implausible_rates(df: DataFrame, source: str, order: str, row_id: str, part: str, whole: str, times: float, block: int, stuck: int = 6, half: int = 10, sigmas: float = 3.0) -> DataFrame:
    """id, impossible, spike, stuck of rows whose part/whole is impossible, at least so many times the source's usual rate, or stuck.

    The usual rate is the source's median over its possible rows, from a mergeable quantile sketch. The Hampel rule over
    the source's rows in order proposes the high rates; a rate whose row has no order value is compared directly.
    Repeated rows count once; a part without a whole has no rate.
    """
    rows = df.where(F.col(part).isNotNull()).select(
        F.col(source).cast("string").alias("source"), F.col(order).cast("bigint").alias("at"), F.col(row_id).cast("bigint").alias("id"), F.col(part).cast("double").alias("part"), F.col(whole).cast("double").alias("whole")
    )
    wrong = F.coalesce((F.col("part") < 0) | (F.col("part") > F.col("whole")), F.col("part") < 0, F.lit(False))
    rows = rows.withColumn("impossible", wrong).withColumn("rate", F.when(~F.col("impossible") & (F.col("whole") > 0), F.col("part") / F.col("whole")))
    series = rows.withColumn("reading", F.array("part", F.coalesce("rate", F.lit(float("nan")))))
    judged = implausible(series, "source", "at", "id", "reading", [None, None], block, stuck=stuck, rate={"half": half, "sigmas": sigmas}, runs_on=[0])
    usual = rows.groupBy("source").agg(F.percentile_approx("rate", 0.5, 10000).alias("usual"))
    alone = rows.where("at IS NULL OR source IS NULL").select("id")
    proposed = judged.where("spike").select("id").unionByName(alone).distinct()
    high = rows.where("rate > 0").select("source", "id", "rate").join(proposed, "id").join(usual, rows["source"].eqNullSafe(usual["source"])).where(F.col("rate") >= times * F.col("usual"))
    no, yes = F.lit(False), F.lit(True)
    flags = (
        judged.where("stuck").select("id", no.alias("impossible"), no.alias("spike"), "stuck")
        .unionByName(high.select("id", no.alias("impossible"), yes.alias("spike"), no.alias("stuck")))
        .unionByName(rows.where("impossible").select("id", "impossible", no.alias("spike"), no.alias("stuck")))
    )
    return flags.groupBy("id").agg(*[F.max(c).alias(c) for c in ("impossible", "spike", "stuck")])
