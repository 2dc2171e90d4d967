"""Maximal periodic runs of words, by branching tandems of an enhanced suffix array.

The texts of a group stand in one sequence of words in which equal words of different texts differ, so
one suffix array serves them all. Suffixes are ranked by doubling; each ranking is kept, since two
stretches of 2**k words are equal where their ranks of that step are. The array, its inverse and the
lengths of common prefixes give the intervals of equal prefixes, and no tree is built: the bounds of an
interval are the next smaller lengths on either side, its children lie between its places of least
length.

If a stretch of words w is followed by w again and by something else after that, the two occurrences
lie in different children of the interval whose depth is the length of w. So for all suffixes of all
children but the largest, it is looked up whether the suffix ``depth`` words further on or back lies in
the interval, in another child. That visits a suffix once a doubling. Each square found is rotated to
the left as long as words agree, which gives the run; squares of a multiple of its period with the same
end belong to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import Texts, groups, let

MIN_LENGTH = 6
MIN_EXPONENT = 4
_RUN = "struct<start:long,length:long,period:long>"


def _ranked(words: np.ndarray, text: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of suffixes by their first 1, 2, 4, ... words, until all differ. A rank is the number of
    suffixes that are smaller, so it stays when others are told apart."""
    n = len(words)
    order = np.lexsort((words, text))
    new = np.ones(n, bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (text[order][1:] != text[order][:-1])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank], 1
    # Places whose rank is shared, in order of rank.
    last = np.append(new[1:], True)
    open_ = order[~(new & last)]
    while len(open_):
        before = levels[-1]
        beyond = open_ + step
        inside = beyond < end[open_]
        next_rank = np.where(inside, before[np.where(inside, beyond, 0)] + 1, 0)
        key = before[open_].astype(np.int64) * (n + 1) + next_rank
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        base = before[open_]
        head = np.ones(len(open_), bool)
        head[1:] = base[1:] != base[:-1]
        place = np.arange(len(open_))
        within = place - np.maximum.accumulate(np.where(head, place, 0))
        new = np.ones(len(open_), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(new, place, 0))
        rank = before.copy()
        rank[open_] = base + within[first]
        levels.append(rank)
        open_ = open_[~(new & np.append(new[1:], True))]
        step *= 2
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes a and b of one text each, a != b."""
    a, b = a.copy(), b.copy()
    length = np.zeros(len(a), np.int64)
    stop_a, stop_b = end[a], end[b]
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        fits = np.flatnonzero((a + step <= stop_a) & (b + step <= stop_b))
        fits = fits[levels[k][a[fits]] == levels[k][b[fits]]]
        a[fits] += step
        b[fits] += step
        length[fits] += step
    return length


def _smaller_before(values: np.ndarray) -> np.ndarray:
    """Place of the nearest smaller value before each; -1 without one. Pointers jump over what is no smaller."""
    at = np.arange(-1, len(values) - 1)
    left = np.arange(len(values))
    while True:
        left = left[at[left] >= 0]
        left = left[values[at[left]] >= values[left]]
        if not len(left):
            return at
        at[left] = at[at[left]]


def _squares(levels: list[np.ndarray], text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares that the next word doesn't continue."""
    n = len(text)
    inverse = levels[-1].astype(np.int64)
    suffixes = np.empty(n, np.int64)
    suffixes[inverse] = np.arange(n)
    common = np.zeros(n + 1, np.int64)
    near = np.flatnonzero(text[suffixes[1:]] == text[suffixes[:-1]]) + 1
    common[near] = _common(levels, suffixes[near - 1], suffixes[near], end)
    places = np.flatnonzero(common)
    if not len(places):
        return places, places
    low = _smaller_before(common[:n])[places]
    high = n - _smaller_before(common[::-1])[::-1][places] - 1
    # Places of one interval together, in order; each begins a child, and one begins at ``low``.
    order = np.lexsort((places, high, low))
    places, low, high = places[order], low[order], high[order]
    first = np.ones(len(places), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    interval = np.cumsum(first) - 1
    heads = np.flatnonzero(first)
    owner = np.concatenate((np.arange(len(heads)), interval))
    start = np.concatenate((low[heads], places))
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    stop = np.append(start[1:], 0)
    last = np.append(owner[1:] != owner[:-1], True)
    stop[last] = high[heads][owner[last]] + 1
    size = stop - start
    child_heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    largest = np.maximum.reduceat(size, child_heads)[owner]
    is_largest = np.flatnonzero(size == largest)
    is_largest = is_largest[np.append(True, owner[is_largest][1:] != owner[is_largest][:-1])]
    small = np.ones(len(size), bool)
    small[is_largest] = False
    owner, start, size = owner[small], start[small], size[small]
    child = np.repeat(np.arange(len(size)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + start[child]
    suffix = suffixes[at]
    depth = common[places[heads]][owner][child]
    left, right = low[heads][owner][child], high[heads][owner][child]
    child_left, child_right = start[child], (start + size)[child] - 1
    starts, periods = [], []
    for sign in (1, -1):
        other = suffix + sign * depth
        held = np.flatnonzero((other < end[suffix]) & (other >= begin[suffix]))
        place = inverse[other[held]]
        met = (place >= left[held]) & (place <= right[held]) & ((place < child_left[held]) | (place > child_right[held]))
        held = held[met]
        starts.append(np.minimum(suffix, other)[held])
        periods.append(depth[held])
    both = np.unique(np.stack((np.concatenate(starts), np.concatenate(periods))), axis=1)
    return both[0], both[1]


def _rotated(levels: list[np.ndarray], start: np.ndarray, period: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where runs begin: squares move left as long as the word before equals the one a period on."""
    least = begin[start]
    start = start.copy()
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        fits = np.flatnonzero(start - step >= least)
        back = start[fits] - step
        start[fits] -= step * (levels[k][back] == levels[k][back + period[fits]])
    return start


def maximal_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of two periods or more, by text, start and period.

    ``words[first[i]:first[i + 1]]`` are the words of text i, equal numbers for equal words; starts
    count from the text's first word.
    """
    none = np.empty(0, np.int64)
    if not len(words):
        return none, none, none, none
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin, end = first[:-1][text], first[1:][text]
    levels = _ranked(words, text, end)
    start, period = _squares(levels, text, begin, end)
    ends = start + 2 * period
    found = []
    # Squares of one end by period: the least is a run, its multiples within the run go; then the next.
    order = np.lexsort((period, ends))
    start, period, ends = start[order], period[order], ends[order]
    while len(start):
        head = np.ones(len(start), bool)
        head[1:] = ends[1:] != ends[:-1]
        run = np.cumsum(head) - 1
        origin, step = _rotated(levels, start[head], period[head], begin), period[head]
        found.append((origin, ends[head] - origin, step))
        left = ~head & ~((period % step[run] == 0) & (start >= origin[run]))
        start, period, ends = start[left], period[left], ends[left]
    if not found:
        return none, none, none, none
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return text[start], start - begin[start], length, period


def _detector(min_length: int, min_exponent: int):
    def detected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            found = Texts(batch.column("text"), lower=False)
            first = found.first.astype(np.int64)
            text, start, length, period = maximal_runs(found.words, first)
            long = (length >= min_length) & (length >= min_exponent * period)
            text, start, length, period = text[long], start[long], length[long], period[long]
            # Words a run covers after its first period.
            edges = np.zeros(len(found.words) + 1, np.int64)
            np.add.at(edges, first[text] + start + period, 1)
            np.add.at(edges, first[text] + start + length, -1)
            kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
            # The bytes of kept words and a space after each, text after text.
            lengths = found.ends[kept] - found.starts[kept] + 1
            sizes = np.concatenate(([0], np.cumsum(lengths)))
            at = np.arange(sizes[-1]) + np.repeat(found.starts[kept] - sizes[:-1], lengths)
            out = np.append(found.raw, np.uint8(32))[at]
            out[sizes[1:] - 1] = 32
            data = out.tobytes()
            cuts = sizes[np.searchsorted(kept, first)].tolist()
            texts = [data[cuts[i] : max(cuts[i + 1] - 1, cuts[i])].decode() for i in range(batch.num_rows)]
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
            offsets = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(offsets), runs), pa.array(texts, pa.string())],
                names=["id", "n_words", "runs", "collapsed"],
            )

    return detected


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row; nothing is shuffled.

    Words are runs of other characters than ASCII spaces, compared by 64-bit hashes within one text.
    ``runs`` holds (start, length, period) of the stretches of ``min_length`` words and
    ``min_exponent`` (2 or more) smallest periods at least that no neighbouring word continues, by
    start, then period. ``collapsed`` joins by one space the words that no run holds after its first
    period. Null and empty texts have no words, no runs and an empty ``collapsed``. A long text is
    one group; its rankings take 4 bytes a word for each doubling up to its longest repeat. Rows that
    repeat an id stand side by side, null ids stay null; an empty table gives an empty result. Other
    columns aren't read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, n_words long, runs array<{_RUN}>, collapsed string"
    found = rows.mapInArrow(_detector(min_length, min_exponent), schema)
    return found.select(F.col("id").alias(id_column), "n_words", "runs", "collapsed")


def repeated_tail(id_column: Column, text: Column, words: Column, every: int = 10) -> Column:
    """The text, but of one id in ``every`` (by crc32 of its decimal digits) with a tail made periodic:
    word i from a on becomes word a + (i - a) % p. Null ids and texts without words stay."""
    h = F.crc32(id_column.cast("string").cast("binary"))

    def tailed(w: Column) -> Column:
        g, n = F.floor(h / every), F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    return F.when((h % every == 0) & F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)), let(words, tailed)).otherwise(text)
