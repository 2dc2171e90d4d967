"""Vector code compression: product codes whose nearest entries are looked up by grid cell.

A vector is scaled to whole numbers and cut into equal parts; each part is coded by the nearest entry
of its codebook. A part first falls into a cell of a coarse grid. For a cell not met before, the least
and greatest distance from its box to every entry are computed: an entry whose least distance is over
the smallest greatest distance of all is dominated, it can't be nearest anywhere in the box. The
entries left are remembered under the hash of the cell, and only those are evaluated exactly for the
parts that fall into it. The bounds hold for whole numbers, so the result is that of a full search.

Every round is one pass over the table. A task adds up its parts per entry, and the sums are added by
Spark; a codebook has ``parts * entries`` rows whatever the input, so the driver may hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.tables import stored
from tripflow.llm.words import mix

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Scaled components below this keep all squared distances and sums of up to 1024 components in longs.
LIMIT = 1 << 25
# Cells between the smallest and the largest component of a codebook.
GRID = 4
# Cells that a task remembers for a part; beyond that it starts afresh.
REMEMBERED = 1 << 16

Codebooks = list[np.ndarray]


def _scaled(vectors: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kept, coded, whole numbers of the coded): kept vectors hold finite components only, coded
    ones also have the length and components within the limit."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(vectors.offsets)
    values = vectors.values
    whole = np.asarray(values.is_valid()) if values.null_count else np.ones(len(values), bool)
    numbers = np.asarray(values.fill_null(0.0))
    bad = np.concatenate(([0], np.cumsum(~(whole & np.isfinite(numbers)))))
    kept = np.asarray(vectors.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    with np.errstate(over="ignore", invalid="ignore"):
        numbers = np.floor(numbers * SCALE)
    wide = np.concatenate(([0], np.cumsum(~(np.abs(numbers) < LIMIT))))
    coded = kept & (np.diff(offsets) == length) & (length > 0) & (wide[offsets[1:]] == wide[offsets[:-1]])
    at = offsets[:-1][coded][:, None] + np.arange(length)
    return kept, coded, numbers[at].astype(np.int64).reshape(len(at), length)


def _distinct(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells, and which of them each row is: told apart by hash, then compared."""
    hashes = mix(mix(cells.astype(np.uint64) + np.arange(1, cells.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).sum(axis=1))
    _, first, cell = np.unique(hashes, return_index=True, return_inverse=True)
    if (cells[first][cell] != cells).any():
        found, cell = np.unique(cells, axis=0, return_inverse=True)
        return found, cell.reshape(-1)
    return cells[first], cell


class GridCells:
    """Nearest entries of one codebook, by remembered grid cells."""

    def __init__(self, codebook: np.ndarray, grid: int = GRID):
        self.codebook = codebook
        self.width = max(int(codebook.max() - codebook.min()) // grid, 1)
        self.known: dict[bytes, np.ndarray] = {}

    def _candidates(self, cells: np.ndarray) -> np.ndarray:
        """Per cell, which entries aren't dominated over its box."""
        low = (cells * self.width)[:, None, :]
        high = low + self.width - 1
        below, above = low - self.codebook, self.codebook - high
        nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
        farthest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
        return nearest <= farthest.min(axis=1, keepdims=True)

    def _looked_up(self, cells: np.ndarray) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        keys = [c.tobytes() for c in cells]
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            self.known.update(zip((keys[i] for i in new), self._candidates(cells[new]), strict=True))
        return np.array([self.known[k] for k in keys])

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, ties to the lower, and its squared distance."""
        if not len(parts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        cells, cell = _distinct(parts // self.width)
        candidates = self._looked_up(cells)[cell]
        best = np.full(len(parts), np.iinfo(np.int64).max)
        code = np.zeros(len(parts), np.int64)
        for e, entry in enumerate(self.codebook):
            rows = np.flatnonzero(candidates[:, e])
            distance = ((parts[rows] - entry) ** 2).sum(axis=1)
            closer = distance < best[rows]
            best[rows[closer]], code[rows[closer]] = distance[closer], e
        return code, best


def _summed(codebooks: Codebooks):
    """Per task, part and entry: number of parts and their componentwise sums."""
    width = codebooks[0].shape[1]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [GridCells(c) for c in codebooks]
        n = np.zeros((len(grids), len(codebooks[0])), np.int64)
        total = np.zeros((*n.shape, width), np.int64)
        for batch in batches:
            numbers = _scaled(batch.column("vector"), width * len(grids))[2]
            for p, grid in enumerate(grids):
                part = numbers[:, p * width : (p + 1) * width]
                code = grid.nearest(part)[0]
                n[p] += np.bincount(code, minlength=len(n[p]))
                for e in np.unique(code):
                    total[p, e] += part[code == e].sum(axis=0)
        part, entry = np.nonzero(n)
        names = ["part", "entry", "n", *(f"s{i}" for i in range(width))]
        arrays = [part, entry, n[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a), pa.int64()) for a in arrays], names=names)

    return summed


def _coder(codebooks: Codebooks, length: int):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [GridCells(c) for c in codebooks]
        for batch in batches:
            kept, coded, numbers = _scaled(batch.column("vector"), length)
            error = np.zeros(len(numbers), np.int64)
            codes = np.empty((len(numbers), len(grids)), np.uint8)
            for p, part in enumerate(np.split(numbers, len(grids), axis=1) if grids else ()):
                codes[:, p], distance = grids[p].nearest(part)
                error += distance
            place = np.full(batch.num_rows, -1)
            place[coded] = np.arange(len(numbers))
            take = pa.array(place[kept], mask=place[kept] < 0)
            texts = pa.array([c.tobytes().hex() for c in codes], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(pa.array(kept)), batch.column("label").filter(pa.array(kept)), texts.take(take), pa.array(error).take(take)],
                names=["id", "label", "code", "error"],
            )

    return coded


def _first_vectors(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Whole numbers of the vectors with the smallest ids that can be coded, those of equal length
    with the first of them."""
    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column("vector").cast(pa.large_list(pa.float64())).offsets))
            for size in np.unique(sizes[(sizes > 0) & (sizes % parts == 0)]).tolist():
                _, coded, whole = _scaled(batch.column("vector"), size)
                ids = batch.column("id").filter(pa.array(coded))
                yield pa.RecordBatch.from_arrays([ids, pa.array(list(whole), pa.list_(pa.int64()))], names=["id", "numbers"])

    def smallest(frame: DataFrame, many: int) -> list:
        return frame.orderBy(F.col("id").asc_nulls_last(), "numbers").limit(many).collect()

    found = rows.select("id", "vector").mapInArrow(numbers, f"id {dict(rows.dtypes)['id']}, numbers array<long>")
    first = smallest(found, 1)
    if not first:
        return np.empty((0, 0), np.int64)
    length = len(first[0]["numbers"])
    return np.array([r["numbers"] for r in smallest(found.where(F.size("numbers") == length), entries)], np.int64)


def train_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """One codebook per part, from rows of (id, label, vector): the first vectors, moved ``rounds``
    times to the rounded-down mean of the parts nearest to them. Empty without any vector to code."""
    first = _first_vectors(rows, parts, entries)
    if not len(first):
        return []
    codebooks = [np.ascontiguousarray(c) for c in np.split(first, parts, axis=1)]
    width = codebooks[0].shape[1]
    sums = [f"s{i}" for i in range(width)]
    schema = "part long, entry long, n long, " + ", ".join(f"{s} long" for s in sums)
    for _ in range(rounds):
        found = rows.select("vector").mapInArrow(_summed(codebooks), schema)
        moved = [c.copy() for c in codebooks]
        for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in sums)).collect():
            moved[r["part"]][r["entry"]] = [r[s] // r["n"] for s in sums]
        codebooks = moved
    return codebooks


def codebooks_text(codebooks: Codebooks) -> str:
    """All components by part, entry and place, comma-joined."""
    return ",".join(str(x) for c in codebooks for x in c.reshape(-1).tolist())


def compress_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error, label_error) of each kept vector, and the codebooks.

    A vector that is null or holds null or non-finite components is left out. The first vector by id
    whose length is a positive multiple of ``parts`` sets the length. A vector of another length, or
    with a component of 8192 or more either way, whose distances don't fit into longs, is returned
    with null code and error and has no part in the codebooks. Null ids come last in the order of
    ids; rows of one id are ordered by their components, and all are coded. With fewer vectors than
    entries the codebooks are smaller; an empty table gives an empty result. ``label_error`` sums the
    errors of equal labels, nulls together; null if none of them has one. Other columns aren't read.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    codebooks = train_codebooks(rows, parts, entries, rounds)
    length = len(codebooks) * codebooks[0].shape[1] if codebooks else 0
    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    coded = stored(rows.mapInArrow(_coder(codebooks, length), schema), "vector-codes")
    # Summed per label in each task before anything moves; joined in the way its size allows.
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("of")), "left")
    result = joined.select(F.col("id").alias(id_column), F.col("label").alias(label_column), "code", "error", "label_error")
    return result, codebooks


def codebooks_sha256(codebooks: Codebooks) -> str:
    return hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
