"""A count-min sketch that only tells "seen once at most" from "perhaps repeated".

Every task counts its hashes into a sketch of its own, saturating at two. Sketches are sparse, so
they travel as gaps between occupied counters, cut into ranges of counters; a reducer merges one
range and keeps a bit per counter. The merged bits have a fixed size, whatever the input: counters
only ever overestimate, so a sketch too narrow for its input lets more hashes through and loses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Counters a row; the merged bits of the two rows take 2**30 / 8 bytes = 128 MB at 2**29.
DEFAULT_BITS = 28
ROWS = 2
# Ranges of counters that are merged apart.
RANGES = 64
# Hashes a task gathers before it sends its sketch.
FLUSH = 2_000_000

SKETCH_SCHEMA = "range int, once binary, twice binary"


def counters(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Counter of each hash in a row of the sketch, offset by the row."""
    part = hashes >> np.uint64(64 - bits) if row == 0 else (hashes * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - bits)
    return part.astype(np.int64) + (row << bits)


def _pack(sorted_values: np.ndarray) -> bytes:
    """Gaps of ascending numbers, seven bits a byte."""
    gaps = np.diff(sorted_values, prepend=0).astype(np.uint64)
    out = np.zeros((len(gaps), 5), np.uint8)
    keep = np.zeros((len(gaps), 5), bool)
    for i in range(5):
        rest = gaps >> np.uint64(7 * (i + 1))
        out[:, i] = (gaps >> np.uint64(7 * i)) & np.uint64(127)
        keep[:, i] = True if i == 0 else gaps >= np.uint64(1 << 7 * i)
        out[:, i] |= np.where(rest > 0, 128, 0).astype(np.uint8)
    return out[keep].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.int64)
    last = np.flatnonzero(raw < 128)
    start = np.concatenate(([0], last[:-1] + 1))
    place = np.arange(len(raw)) - np.repeat(start, last - start + 1)
    return np.cumsum(np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), start))


class TaskSketch:
    """Counts the hashes of one task."""

    def __init__(self, bits: int):
        self.bits, self.parts, self.size = bits, [], 0

    def add(self, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(hashes)
        self.size += len(hashes)
        if self.size >= FLUSH:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        hashes = np.concatenate(self.parts) if self.parts else np.empty(0, np.uint64)
        self.parts, self.size = [], 0
        span = (ROWS << self.bits) // RANGES
        rows: list[tuple[int, bytes, bytes]] = []
        for row in range(ROWS):
            found = counters(hashes, row, self.bits)
            found.sort()
            cuts = np.searchsorted(found, np.arange(RANGES + 1) * span)
            for r in range(RANGES):
                if cuts[r] < cuts[r + 1]:
                    at, n = np.unique(found[cuts[r] : cuts[r + 1]] - r * span, return_counts=True)
                    rows.append((r, _pack(at[n == 1]), _pack(at[n > 1])))
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary()), pa.array([x[2] for x in rows], pa.binary())],
            names=["range", "once", "twice"],
        )


def merge(sketches: DataFrame, bits: int) -> list[bytes]:
    """One bit per counter: two hashes or more fell on it. A compressed piece per range, in order; all
    of them have a fixed size, so the driver may hold them."""
    span = (ROWS << bits) // RANGES

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for r, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                one, two = seen.setdefault(r, [np.zeros(span, bool), np.zeros(span, bool)])
                at = _unpack(once)
                two[at] |= one[at]
                one[at] = True
                two[_unpack(twice)] = True
        for r, (_, two) in seen.items():
            piece = zstandard.compress(np.packbits(two).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([piece], pa.binary())], names=["range", "bits"])

    # One job, so that ranges are merged side by side.
    rows = sketches.repartition(RANGES, F.col("range")).mapInArrow(merged, "range int, bits binary").collect()
    pieces = [b""] * RANGES
    for row in rows:
        pieces[row["range"]] = bytes(row["bits"])
    return pieces


def merged_bits(shared: Broadcast, bits: int) -> np.ndarray:
    """The bits of a merged sketch that was broadcast. A task unpacks them for itself, so that a worker
    holds them no longer than a task."""
    size = (ROWS << bits) // RANGES // 8
    out = np.zeros(size * RANGES, np.uint8)
    for r, piece in enumerate(shared.value):
        if piece:
            out[r * size : (r + 1) * size] = np.frombuffer(zstandard.decompress(piece), np.uint8)
    return out


def repeated(hashes: np.ndarray, merged: np.ndarray, bits: int) -> np.ndarray:
    """Whether each hash may have been counted twice; never false for one that was."""
    found = np.ones(len(hashes), bool)
    for row in range(ROWS):
        at = counters(hashes, row, bits)
        found &= (merged[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return found
