"""Bloom filters over 64-bit hashes, built in tasks and merged slice by slice.

A filter of seen hashes may come with a second one, of hashes seen twice: what two tasks have both seen once is in the second filter of their
merger, as the bits that both have set. So mergers may be done in any order, and a hash that was seen twice anywhere passes the second filter.
Hashes that pass without reason are for the caller to sort out; none is ever missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: bits that a hash sets
HASHES = 3
#: slices that are merged apart from each other
SLICES = 64
#: the largest filter: 32 MB, which is what a task holds twice and a broadcast once
MOST_BITS = 1 << 28
_CODEC = "zstd"
SCHEMA = "slice int, once binary, twice binary"


def bits_for(entries: int, each: int = 16) -> int:
    """A power of two with ``each`` bits for an entry, at most ``MOST_BITS``: beyond that more hashes pass without reason."""
    return min(MOST_BITS, max(SLICES * 64, 1 << (entries * each).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """Hashes of hashes: each bit depends on all."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _places(h: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    h = mix(h)
    step = (h >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        at = (h + np.uint64(i) * step) & np.uint64(bits - 1)
        yield (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)


def has(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in a filter."""
    found = np.ones(len(h), bool)
    for at, bit in _places(h, len(filter_) * 8):
        found &= (filter_[at] & bit) != 0
    return found


def add(filter_: np.ndarray, h: np.ndarray) -> None:
    for at, bit in _places(h, len(filter_) * 8):
        np.bitwise_or.at(filter_, at, bit)


class Seen:
    """The two filters of one task."""

    def __init__(self, bits: int):
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def meet(self, h: np.ndarray) -> None:
        """Take in hashes; one that occurs twice in ``h`` has been seen twice."""
        distinct, n = np.unique(h, return_counts=True)
        before = has(self.once, distinct)
        add(self.twice, distinct[before | (n > 1)])
        add(self.once, distinct[~before])

    def parts(self) -> Iterator[pa.RecordBatch]:
        """Rows of ``SCHEMA``: the slices that are not empty."""
        for i, (once, twice) in enumerate(zip(np.split(self.once, SLICES), np.split(self.twice, SLICES), strict=True)):
            if once.any():
                yield _row(i, once, twice)


def _row(i: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    packed = [pa.compress(x.tobytes(), _CODEC, asbytes=True) for x in (once, twice)]
    return pa.RecordBatch.from_pydict(
        {"slice": pa.array([i], pa.int32()), "once": pa.array(packed[:1], pa.binary()), "twice": pa.array(packed[1:], pa.binary())}
    )


def merged(parts: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two filters of all tasks' parts. A slice is merged by one task, row by row; the driver gets ``bits / 4`` bytes at most."""
    size = bits // 8 // SLICES

    def merge(batches):
        slices: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                once, twice = (np.frombuffer(pa.decompress(row[k], size, _CODEC, asbytes=True), np.uint8) for k in ("once", "twice"))
                if row["slice"] in slices:
                    had, had_twice = slices[row["slice"]]
                    had_twice |= twice
                    had_twice |= had & once
                    had |= once
                else:
                    slices[row["slice"]] = once.copy(), twice.copy()
        for i, (once, twice) in slices.items():
            yield _row(i, once, twice)

    once, twice = np.zeros((SLICES, size), np.uint8), np.zeros((SLICES, size), np.uint8)
    for row in parts.repartition("slice").mapInArrow(merge, SCHEMA).collect():
        once[row["slice"]], twice[row["slice"]] = (
            np.frombuffer(pa.decompress(bytes(row[k]), size, _CODEC, asbytes=True), np.uint8) for k in ("once", "twice")
        )
    return once.ravel(), twice.ravel()
