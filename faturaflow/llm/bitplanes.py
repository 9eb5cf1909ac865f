"""Counts that stop at two, kept in two bit planes: a Bloom filter or count-min sketch that merges.

A cell's bit in `ones` is set once a key has hit it, in `twos` once it was hit again. A key
counts as seen n times if all its cells were hit at least n times, so counts are never too
low. Planes of different partitions merge exactly: twos = a2 | b2 | (a1 & b1), ones = a1 | b1.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells per key, and the bounds of the plane's size: at most 2**29 cells, 64 MB a plane.
CELLS_PER_KEY, LEAST_LOG2, MOST_LOG2 = 8, 16, 29
#: Bits of a plane that travel, compressed, in one row: 8 KB, so that an Arrow batch stays small.
SEGMENT_LOG2 = 16
PARTS = "segment int, ones binary, twos binary"


def trim() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def frugal(run):
    """A function for mapInArrow that gives memory back at its end, as an idle worker stays for later tasks."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return wrapped


def log2_cells(keys: int, per_key: int = CELLS_PER_KEY) -> int:
    """Beyond the upper bound the filter lets more keys through; it never loses one."""
    return min(MOST_LOG2, max(LEAST_LOG2, int(max(1, keys) * per_key - 1).bit_length()))


def cells(a: np.ndarray, b: np.ndarray, log2: int, hashes: int) -> np.ndarray:
    """Cell numbers, one row per hash function; a and b are independent 64-bit hashes."""
    a, b = a.view(np.uint64), b.view(np.uint64) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(a + np.uint64(i) * b) >> np.uint64(64 - log2) for i in range(hashes)])


class Planes:
    """Planes of one task."""

    def __init__(self, log2: int, hashes: int):
        self.log2, self.hashes = log2, hashes
        self.ones = np.zeros(1 << (log2 - 3), np.uint8)
        self.twos = np.zeros(1 << (log2 - 3), np.uint8)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for hit in cells(a, b, self.log2, self.hashes):
            at, n = np.unique(hit, return_counts=True)
            byte, bit = (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, at & np.uint64(7)).astype(np.uint8)
            again = (n > 1) | ((self.ones[byte] & bit) != 0)
            np.bitwise_or.at(self.twos, byte[again], bit[again])
            np.bitwise_or.at(self.ones, byte, bit)

    def segments(self) -> Iterator[pa.RecordBatch]:
        size = 1 << (min(SEGMENT_LOG2, self.log2) - 3)
        for k in range(len(self.ones) // size):
            one, two = (x[k * size : (k + 1) * size] for x in (self.ones, self.twos))
            if one.any():
                yield parts_batch(k, one, two)


def parts_batch(segment: int, ones: np.ndarray, twos: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), *(pa.array([zlib.compress(x, 1)]) for x in (ones, twos))],
        ["segment", "ones", "twos"],
    )


def _unpacked(part: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(part), np.uint8)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by segment; one segment is held at a time."""
    now, ones, twos = None, None, None
    for batch in batches:
        for segment, one, two in zip(*(c.to_pylist() for c in batch.columns)):
            one, two = _unpacked(one), _unpacked(two)
            if segment != now:
                if now is not None:
                    yield parts_batch(now, ones, twos)
                now, ones, twos = segment, one.copy(), two.copy()
            else:
                twos |= two | (ones & one)
                ones |= one
    if now is not None:
        yield parts_batch(now, ones, twos)


def merged(parts: DataFrame, log2: int, seen: int) -> np.ndarray:
    """The plane of cells hit at least `seen` times (1 or 2). Its size is bounded by MOST_LOG2."""
    keep = "ones" if seen == 1 else "twos"
    whole = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(frugal(_merge), PARTS)
    plane = np.zeros(1 << (log2 - 3), np.uint8)
    size = 1 << (min(SEGMENT_LOG2, log2) - 3)
    for row in whole.select("segment", keep).toLocalIterator():
        plane[row[0] * size : (row[0] + 1) * size] = _unpacked(row[1])
    return plane


def few_tasks(df: DataFrame) -> DataFrame:
    """Twice as many tasks as cores at most: each sends planes of its own."""
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


def test_plane(plane: np.ndarray, a: np.ndarray, b: np.ndarray, log2: int, hashes: int) -> np.ndarray:
    out = np.ones(len(a), bool)
    for hit in cells(a, b, log2, hashes):
        out &= (plane[(hit >> np.uint64(3)).astype(np.int64)] >> (hit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


class RepeatFilter:
    """Broadcast filter of the keys seen at least `seen` times."""

    def __init__(self, spark, plane: np.ndarray, log2: int, hashes: int):
        self.plane, self.log2, self.hashes = spark.sparkContext.broadcast(plane), log2, hashes

    @classmethod
    def build(cls, halves: DataFrame, keys: int, seen: int = 2, hashes: int = 3) -> RepeatFilter:
        """halves: two long columns, the hashes of each key; keys: how many there are."""
        log2 = log2_cells(keys, 2 * CELLS_PER_KEY)

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            planes = Planes(log2, hashes)
            for batch in batches:
                planes.add(*(np.asarray(c, np.int64) for c in batch.columns))
            yield from planes.segments()

        parts = few_tasks(halves).mapInArrow(frugal(fill), PARTS)
        return cls(halves.sparkSession, merged(parts, log2, seen), log2, hashes)

    @staticmethod
    def ranges(keys: int) -> int:
        """Ranges of the hash space to cut `keys` into, so that each has a plane with all its cells."""
        return max(1, -(-keys * 2 * CELLS_PER_KEY >> MOST_LOG2))

    def drop(self) -> None:
        self.plane.destroy()

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return test_plane(self.plane.value, a, b, self.log2, self.hashes)

    def test(self, a: Column, b: Column) -> Column:
        plane, log2, hashes = self.plane, self.log2, self.hashes

        @F.arrow_udf("boolean")
        def possibly(a: pa.Array, b: pa.Array) -> pa.Array:
            x, y = (np.asarray(s, np.int64) for s in (a, b))
            return pa.array(test_plane(plane.value, x, y, log2, hashes))

        return possibly(a, b)
