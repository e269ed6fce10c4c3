"""Placing documents into windows of fixed capacity, neighbours in content together.

Each document's bytes are hashed, by threes, into a vector; a fixed random projection takes it to few dimensions, and
the cell of a Hilbert curve through these dimensions is its key. Documents are range-sorted by that key, so that
similar ones lie side by side, and packed along the curve: within a stretch of neighbours the longest first, each into
the fullest open window it fits; windows left open pass on to the next stretch. Only (doc_id, size, key) is shuffled.

A document is split only if it is larger than the capacity: into full windows and one rest, which is packed like a
document. Defined results: a null text is not placed; an empty one has its end mark; repeated rows of a document are
one document, the longest; capacities that are null or below 1 are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnflow.session import materialise

BUCKETS, DIMS, BITS = 256, 4, 8
_SLICE = 1 << 20


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and UTF-8 bytes of a string column, without a copy."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return offsets, data


def trigram_counts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Counts of hashed byte trigrams per document; whole texts, in slices of bounded size."""
    n = len(offsets) - 1
    counts = np.zeros((n, BUCKETS), np.float32)
    end = int(offsets[-1])
    for start in range(int(offsets[0]), max(int(offsets[0]), end - 2), _SLICE):
        stop = min(start + _SLICE, end - 2)
        if stop <= start:
            break
        d = data[start : stop + 2].astype(np.uint32)
        code = (d[:-2] * np.uint32(0x9E3779B1)) ^ (d[1:-1] * np.uint32(0x85EBCA77)) ^ (d[2:] * np.uint32(0xC2B2AE3D))
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        bucket = (code >> np.uint32(24)).astype(np.int64)
        first, last = np.searchsorted(offsets, start, "right") - 1, np.searchsorted(offsets, stop - 1, "right") - 1
        bounds = np.clip(offsets[first : last + 2], start, stop) - start
        doc = np.repeat(np.arange(last - first + 1), np.diff(bounds))
        # A trigram that reaches into the next document belongs to none.
        inside = np.arange(start, stop) + 2 < offsets[first + 1 + doc]
        counts[first : last + 1] += np.bincount((doc * BUCKETS + bucket)[inside], minlength=(last - first + 1) * BUCKETS).reshape(-1, BUCKETS)
    return counts


def _projection() -> np.ndarray:
    return np.random.default_rng(20250301).standard_normal((BUCKETS, DIMS)).astype(np.float32)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    projection = _projection()
    for batch in batches:
        offsets, data = text_buffers(batch.column("text"))
        counts = np.sqrt(trigram_counts(offsets, data))
        norm = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        points = (counts / np.maximum(norm, 1e-9)) @ projection
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets) + 1, pa.int64()), *[pa.array(points[:, i].astype(float)) for i in range(DIMS)]],
            names=["doc_id", "size", *[f"v{i}" for i in range(DIMS)]],
        )


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (rows), by the transpose form of the curve."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for shift in range(bits - 1, 0, -1):
        q = np.int64(1) << shift
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        q = np.int64(1) << shift
        flip = np.where(x[dims - 1] & q, flip ^ (q - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for shift in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> shift) & 1)
    return key


def _keys(centre: list[float], spread: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([batch.column(f"v{i}").to_numpy(zero_copy_only=False) for i in range(DIMS)], axis=1)
            scaled = np.clip((points - centre) / spread, -3, 3)
            cells = np.minimum(((scaled + 3) / 6 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("size"), pa.array(hilbert_key(cells, BITS), pa.int64())], names=["doc_id", "size", "curve_key"])

    return run


class Windows:
    """Open windows of one capacity, sorted by free space."""

    def __init__(self, capacity: int, keep: int) -> None:
        self.capacity, self.keep, self.next, self.open = capacity, keep, 0, []

    def put(self, size: int) -> int:
        """The number of the fullest open window with room, else of a new one."""
        at = bisect_left(self.open, (size, -1))
        if at < len(self.open):
            free, window = self.open.pop(at)
        else:
            free, window = self.capacity, self.next
            self.next += 1
        if free > size:
            insort(self.open, (free - size, window))
        return window

    def close_fullest(self) -> None:
        """Keep only the emptiest windows open, so that what is carried along the curve stays bounded."""
        del self.open[: max(0, len(self.open) - self.keep)]


def _pack(capacities: list[tuple[int, int]], stretch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        windows = [Windows(n, 256) for _, n in capacities]
        for batch in batches:
            ids, sizes = batch.column("doc_id").to_numpy(), batch.column("size").to_numpy()
            for start in range(0, len(ids), stretch):
                i, s = ids[start : start + stretch], sizes[start : start + stretch]
                for (capacity_id, capacity), space in zip(capacities, windows):
                    pieces = np.maximum(-(-s // capacity), 1)
                    doc = np.repeat(np.arange(len(i)), pieces)
                    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                    tokens = np.minimum(s[doc] - piece * capacity, capacity)
                    window = np.empty(len(doc), np.int64)
                    order = np.argsort(-tokens, kind="stable")
                    for k, size in zip(order.tolist(), tokens[order].tolist()):
                        window[k] = space.put(size)
                    space.close_fullest()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(doc), capacity_id), pa.int32()), pa.array(i[doc], pa.int64()), pa.array(piece, pa.int32()), pa.array(pieces[doc], pa.int32()),
                         pa.array(piece * capacity, pa.int64()), pa.array(tokens, pa.int64()), pa.array((np.int64(part) << 40) + window, pa.int64())],
                        names=["capacity_id", "doc_id", "piece", "n_pieces", "first_token", "n_tokens", "window_id"],
                    )

    return run


def curve_order(documents: DataFrame) -> DataFrame:
    """doc_id, size, curve_key of each document."""
    texts = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    fields = ", ".join(f"v{i} double" for i in range(DIMS))
    vectors = materialise(texts.mapInArrow(_vectors, f"doc_id bigint, size bigint, {fields}"), "doc-vectors")
    stats = vectors.agg(*[f(f"v{i}") for i in range(DIMS) for f in (F.avg, F.stddev_pop)]).first()
    centre, spread = [stats[2 * i] or 0.0 for i in range(DIMS)], [max(stats[2 * i + 1] or 0.0, 1e-9) for i in range(DIMS)]
    keyed = vectors.mapInArrow(_keys(centre, spread), "doc_id bigint, size bigint, curve_key bigint")
    return keyed.groupBy("doc_id").agg(F.max("size").alias("size"), F.max_by("curve_key", F.struct("size", "curve_key")).alias("curve_key"))


def pack(documents: DataFrame, capacities: DataFrame, stretch: int = 2_000) -> DataFrame:
    """capacity_id, doc_id, piece, n_pieces, first_token, n_tokens, window_id. capacities: capacity_id, n_tokens; a few rows."""
    wanted = sorted({(int(r[0]), int(r[1])) for r in capacities.where("capacity_id IS NOT NULL AND n_tokens >= 1").select("capacity_id", "n_tokens").limit(1001).collect()})
    if len(wanted) > 1000:
        raise ValueError("at most 1000 capacities")
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    along = curve_order(documents).repartitionByRange(parts, "curve_key", "doc_id").sortWithinPartitions("curve_key", "doc_id")
    return along.mapInArrow(_pack(wanted, stretch), "capacity_id int, doc_id bigint, piece int, n_pieces int, first_token bigint, n_tokens bigint, window_id bigint")
