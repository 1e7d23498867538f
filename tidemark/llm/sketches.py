"""Count-min sketches that tell values seen once from values that may be repeated.

Counters stop at two, so a row of the sketch is two sets of cells: met, and met again. Partitions send the cells they met,
packed and split by segments; segments are merged by Spark; the merged sketch keeps one bit per cell, ``again``. Its size
is fixed by a bound on values and a parameter, so it may be broadcast. An estimate is never too low.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import mix
from tidemark.session import discard, stage

ROWS = 2
SEGMENT_BITS = 20  # cells of a segment, as a power of two
MOST_BITS = 29  # cells of a row, as a power of two: 64 MiB a row at most
FLUSH = 2_000_000  # values a task gathers before it sends their cells
FAN_IN = 256  # partial sketches of a segment that one task merges at a time
_SCHEMA = "segment int, part int, met binary, again binary"
_TYPES = pa.schema([("segment", pa.int32()), ("part", pa.int32()), ("met", pa.binary()), ("again", pa.binary())])


def cell_bits(values: int) -> int:
    """Cells of a row for about ``values`` values: four for each, as far as the bound allows."""
    return min(MOST_BITS, max(SEGMENT_BITS, math.ceil(math.log2(max(4 * values, 2)))))


def cells(values: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(values + np.uint64(row + 1)) >> np.uint64(64 - bits)).astype(np.uint32)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers, compressed byte by byte of all of them, since the upper bytes of small numbers are zero."""
    import zstandard

    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes, kind) -> np.ndarray:
    import zstandard

    data = np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(packed), np.uint8)
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack(sorted_cells: np.ndarray) -> bytes:
    return pack(np.diff(sorted_cells, prepend=np.uint32(0)).astype("<u4"))


def _unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, "<u4"), dtype=np.int64)


def _send(gathered: list[np.ndarray], bits: int, part: int) -> Iterator[pa.RecordBatch]:
    values = np.concatenate(gathered)
    for row in range(ROWS):
        found, counts = np.unique(cells(values, row, bits), return_counts=True)
        again = found[counts > 1]
        borders = np.arange(0, (1 << bits) + 1, 1 << SEGMENT_BITS, dtype=np.int64)
        a, b = np.searchsorted(found, borders), np.searchsorted(again, borders)
        out = []
        for s in range(len(borders) - 1):
            if a[s] < a[s + 1]:
                low = np.uint32(borders[s])
                out.append((row * (len(borders) - 1) + s, part, _pack(found[a[s] : a[s + 1]] - low), _pack(again[b[s] : b[s + 1]] - low)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES.types, strict=True)], schema=_TYPES)


def _merge(batches: Iterator[pa.RecordBatch], finish: bool) -> Iterator[pa.RecordBatch]:
    """Merge rows that come ordered by (segment, part); with ``finish`` the bits of ``again``, packed, else cells as before."""
    key, met, again = None, None, None

    def result():
        if finish:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([b""], pa.binary()), pa.array([np.packbits(again).tobytes()], pa.binary())], schema=_TYPES)
        packed = [_pack(np.flatnonzero(x).astype(np.uint32)) for x in (met, again)]
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), *(pa.array([p], pa.binary()) for p in packed)], schema=_TYPES)

    for batch in batches:
        for segment, part, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (segment, part) != key:
                if key is not None:
                    yield result()
                key, met, again = (segment, part), np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
            found = _unpack(a)
            again[found[met[found]]] = True
            met[found] = True
            again[_unpack(b)] = True
    if key is not None:
        yield result()


def sketch_repeats(rows: DataFrame, values_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, values: int) -> Broadcast:
    """The merged sketch of all values (uint64) that ``values_of`` finds in batches of ``rows``, as a broadcast array of bits.

    ``values``, about how many there are, sets in how many steps partial sketches are merged.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        gathered, n = [], 0
        for batch in batches:
            for found in values_of(batch):
                gathered.append(found)
                n += len(found)
                if n >= FLUSH:
                    yield from _send(gathered, bits, part)
                    gathered, n = [], 0
        if n:
            yield from _send(gathered, bits, part)

    # A segment gets a partial sketch from every task and flush; more than a task should merge are merged in groups first.
    parts = rows.mapInArrow(partial, _SCHEMA)
    most = rows.rdd.getNumPartitions() + values // FLUSH
    while True:
        groups = max(1, math.ceil(most / FAN_IN))
        last = groups == 1
        dealt = parts.withColumn("part", F.pmod(F.hash("part", F.length("met")), F.lit(groups)))
        dealt = dealt.repartition("segment", "part").sortWithinPartitions("segment", "part")
        parts = dealt.mapInArrow(lambda batches, finish=last: _merge(batches, finish), _SCHEMA)
        if last:
            break
        most = groups
    # Segments are merged side by side and written, then read in few parts: every part that is read costs the driver a job.
    parts = stage(parts.select("segment", "again").coalesce(ROWS << (bits - SEGMENT_BITS)), "sketch")
    step = (1 << SEGMENT_BITS) // 8
    merged = np.zeros((ROWS, (1 << bits) // 8), np.uint8)
    flat = merged.reshape(-1)
    for row in parts.toLocalIterator():  # a bounded number of segments
        flat[row["segment"] * step : (row["segment"] + 1) * step] = np.frombuffer(row["again"], np.uint8)
    discard(parts)
    return rows.sparkSession.sparkContext.broadcast(merged)


def sketch_members(ids: DataFrame, bits: int, values: int) -> Broadcast:
    """A sketch for which ``may_repeat`` tells the ids (one integer column) that may be among these from those that are not."""

    def twice(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        found = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        yield np.concatenate([found, found])

    return sketch_repeats(ids, twice, bits, 2 * values)


def may_repeat(values: np.ndarray, merged: np.ndarray, bits: int) -> np.ndarray:
    """Whether the estimated count is two or more."""
    out = np.ones(len(values), bool)
    for row in range(ROWS):
        cell = cells(values, row, bits)
        out &= (merged[row][cell >> np.uint32(3)] >> (np.uint32(7) - (cell & np.uint32(7))).astype(np.uint8)) & 1 > 0
    return out
