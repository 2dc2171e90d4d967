"""Removal of passages that repeat anywhere, with a count-min prefilter.

Pass one counts the window hashes of every task in a sketch; the sketches are merged to a bit per
counter, which says that two windows or more fell there. Pass two hashes all windows again, leaves
those whose counters stayed below two (they are certainly unique) and groups the others exactly, by
96 bits of hash. The sketch only ever overestimates, so no repeated window is lost, and what it
lets through by mistake the grouping finds to be unique.

Copies that a task sees within one gathering are settled there, and one row tells the others about
the window. So a window held by a third of all texts gives its group as many rows as there are
gatherings, not as many as there are texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm import sketch
from tripflow.llm.tables import stored
from tripflow.llm.words import Texts, groups, mix

WINDOW = 35
# The merged sketch holds 2 * 2**29 bits, 128 MB.
BITS = 29
# Windows gathered by a task before it settles copies among them.
GATHER = 1_000_000

# length: windows in a run whose places are settled, or -1 for one that has yet to be grouped. A null
# row_key marks a row that only tells that its window occurred twice.
_WINDOWS = "h1 long, h2 int, row_key long, at int, length int"


def _sketcher(window: int, bits: int):
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sketch.TaskSketch(bits)
        for batch in groups(batches):
            texts = Texts(batch.column("text"), lower=False)
            start, _, length = texts.windows(window, whole_if_shorter=False)
            yield from own.add(texts.hashes(start, length))
        yield own.flush()

    return sketched


def _record(h1, h2, key, at, length) -> pa.RecordBatch:
    nobody = key == np.iinfo(np.int64).min
    h2 = (h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(h1.view(np.int64)), pa.array(h2), pa.array(key, mask=nobody), pa.array(at.astype(np.int32)), pa.array(length.astype(np.int32))],
        names=["h1", "h2", "row_key", "at", "length"],
    )


def _settle(h1: np.ndarray, h2: np.ndarray, key: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows seen once here go on to the grouping; of others one row does, and their places are settled."""
    order = np.lexsort((h2, h1))
    h1, h2, key, at = h1[order], h2[order], key[order], at[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(h1)))
    single = first[many == 1]
    yield _record(h1[single], h2[single], key[single], at[single], np.full(len(single), -1))
    told = first[many > 1]
    none = np.full(len(told), np.iinfo(np.int64).min)
    yield _record(h1[told], h2[told], none, np.zeros(len(told)), np.ones(len(told)))
    # Settled places, as runs of neighbouring windows of one text.
    mine = np.repeat(many > 1, many)
    key, at = key[mine], at[mine]
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (at[1:] > at[:-1] + 1)
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(at)) - 1
        # Their hash only has to spread them.
        spread = mix(key[start].view(np.uint64) + at[start].astype(np.uint64))
        yield _record(spread, spread, key[start], at[start], at[end] - at[start] + 1)


def _windower(window: int, bits: int, shared):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = sketch.merged_bits(shared, bits)
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in groups(batches):
            texts = Texts(batch.column("text"), lower=False)
            start, text, length = texts.windows(window, whole_if_shorter=False)
            h1 = texts.hashes(start, length)
            many = sketch.repeated(h1, merged, bits)
            start, text, length = start[many], text[many], length[many]
            keys = np.asarray(batch.column("row_key"))
            held.append((h1[many], texts.hashes(start, length, second=True), keys[text], start - texts.first[text]))
            size += len(start)
            if size >= GATHER:
                yield from _settle(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, size = [], 0
        if size:
            yield from _settle(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return made


def _cutter(window: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            texts = Texts(batch.column("text"), lower=False)
            counts = np.diff(texts.first)
            removed, kept = [], []
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                low, high = texts.first[i], texts.first[i + 1]
                gone = np.zeros(counts[i] + 1, np.int64)
                for run in runs or ():
                    gone[run["at"]] += 1
                    gone[run["at"] + run["length"] + window - 1] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                removed.append(int(counts[i] - stay.sum()))
                # Bytes of the words that stay, each with a space after it.
                s, e = texts.starts[low:high][stay], texts.ends[low:high][stay]
                lengths = e - s + 1
                ends = np.cumsum(lengths)
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(s - (ends - lengths), lengths)
                out = texts.raw[np.minimum(at, len(texts.raw) - 1)] if len(at) else np.empty(0, np.uint8)
                out[ends - 1] = 32
                kept.append(out[:-1].tobytes().decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array(counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["row_id", "n_words", "n_removed", "kept_text"],
            )

    return made


def _key() -> Column:
    """64 bits of id and text, which stand in every window row."""
    return F.xxhash64("row_id", "text")


def _told_apart(rows: DataFrame) -> DataFrame:
    """Rows with ``row_key``, which only equal rows share. At 10**11 rows some 270 pairs share the first
    64 bits: they are found by 64 other bits, a small row for each text, and take those for their key."""
    other = F.xxhash64(F.lit(1), "row_id", "text")
    keyed = rows.withColumn("row_key", _key())
    bounds = keyed.groupBy("row_key").agg(F.min(other).alias("low"), F.max(other).alias("high"))
    shared = stored(bounds.where("low < high").select("row_key", F.lit(True).alias("shared")), "shared-keys")
    if shared.isEmpty():
        return keyed
    marked = keyed.join(shared, "row_key", "left")
    return marked.select("row_id", "text", F.when(F.col("shared"), other).otherwise(F.col("row_key")).alias("row_key"))


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, bits: int = BITS
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for each row.

    A window is ``window`` consecutive words of one text, words being runs of other characters than
    ASCII spaces, as they are written. Every word goes that lies in a window whose words also start
    anywhere else, in the same text or another; all copies go. Kept words are joined by one space.
    Null and empty texts, and those shorter than a window, have no windows and keep all words. Rows
    that repeat an id, even with the same text, are rows of their own. A null id stays null. An empty
    table gives an empty result. Columns besides id and text are not read.
    """
    spark = docs.sparkSession
    rows = _told_apart(
        docs.select(
            F.col(id_column).cast("long").alias("row_id"),
            F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        )
    )
    merged = sketch.merge(rows.select("text").mapInArrow(_sketcher(window, bits), sketch.SKETCH_SCHEMA), bits)
    shared = spark.sparkContext.broadcast(merged)
    del merged
    candidates = rows.select("row_key", "text").mapInArrow(_windower(window, bits, shared), _WINDOWS)
    same = Window.partitionBy("h1", "h2")
    often = F.sum(F.when(F.col("length") < 0, 1).otherwise(2)).over(same)
    repeated = candidates.withColumn("often", often).where("often > 1 and row_key is not null")
    # Equal rows share a key and have the same runs, so these may hold a run twice.
    runs = repeated.groupBy("row_key").agg(F.collect_set(F.struct("at", F.abs("length").alias("length"))).alias("runs"))
    joined = rows.join(runs, "row_key", "left").select("row_id", "text", "runs")
    kept = joined.mapInArrow(_cutter(window), "row_id long, n_words long, n_removed long, kept_text string")
    return kept.withColumnRenamed("row_id", id_column)
