"""Words of texts: as Spark expressions, and as hashes computed over whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\x0c\r"

# Texts hashed at once; a longer single text makes a group of its own.
GROUP_BYTES = 1 << 20

_U = np.uint64
_LETTERS = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)
_BYTE_BASE, _WORD_BASE, _WORD_BASE_2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key(id_column: str, text_column: str) -> Column:
    """128 bits that rows share only if they have one id and one text."""
    text = F.coalesce(F.md5(F.col(text_column).cast("string").cast("binary")), F.lit(""))
    return F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit("/"), text))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def space_words(text: Column) -> Column:
    """Array of the runs of other characters than the six ASCII spaces; null counts as empty."""
    one = F.coalesce(text, F.lit(""))
    for space in SPACES[1:]:
        one = F.replace(one, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(one, " "), "")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a uint64 over all others."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.empty(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            made = []
            for base in (self.base, self.inverse):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                made.append(np.cumprod(powers, dtype=np.uint64))
            self.up, self.down = made
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers, _word_powers_2 = (_Powers(b) for b in (_BYTE_BASE, _WORD_BASE, _WORD_BASE_2))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Polynomial hashes of ``values[start:end]``."""
    up, down = powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _U(_BYTE_BASE))


class Texts:
    """Word hashes of a group of texts; words are runs of other bytes than ASCII spaces.

    ``words`` holds all hashes in order, ``first[i]:first[i + 1]`` those of text i.
    """

    def __init__(self, texts: pa.Array, lower: bool):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
        at = offsets - offsets[0]
        if lower:
            raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
        inside = (raw != 32) & ((raw < 9) | (raw > 13))
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True
        starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
        ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        self.raw, self.starts, self.ends = raw, starts, ends
        self.first = np.searchsorted(starts, at)
        self.words = _ranges(_LETTERS[raw], starts, ends, _byte_powers)

    def windows(self, size: int, whole_if_shorter: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start words of all windows, the text of each, and the length of each.

        A text of fewer words than ``size`` has one window of all of them, or none.
        """
        counts = np.diff(self.first)
        many = np.maximum(counts - size + 1, 0)
        if whole_if_shorter:
            many = np.where((counts > 0) & (counts < size), 1, many)
        text = np.repeat(np.arange(len(counts)), many)
        before = np.cumsum(many) - many
        start = np.arange(many.sum()) - np.repeat(before, many) + np.repeat(self.first[:-1], many)
        return start, text, np.minimum(counts[text], size)

    def hashes(self, start: np.ndarray, length: np.ndarray, second: bool = False) -> np.ndarray:
        return _ranges(self.words, start, start + length, _word_powers_2 if second else _word_powers)


def groups(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts have GROUP_BYTES at most, or are one row. At the end freed
    memory goes back to the system: workers outlive their task, and later stages need it."""
    for batch in batches:
        texts = batch.column(column)
        sizes = np.asarray(pc.binary_length(texts).fill_null(0)).astype(np.int64)
        done, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total + size > GROUP_BYTES and i > done:
                yield batch.slice(done, i - done)
                done, total = i, 0
            total += size
        if done < len(sizes):
            yield batch.slice(done)
        del batch, texts
    pa.default_memory_pool().release_unused()
