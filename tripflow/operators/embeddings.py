"""Signed hashing of tokens into normalised vectors."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tripflow.settings import EMBEDDING_DIM


# White space as Unicode has it. Listed, because the pattern engine is several
# times slower with its Unicode classes switched on.
WHITE_SPACE = (
    r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)


def tokens(text: Column) -> Column:
    """Lower-case words between any white space; an empty one may stand at either end."""
    return F.split(F.lower(text), WHITE_SPACE)


# A task remembers this many hashed tokens, and adds up this many cells at once.
TOKENS_KNOWN = 1 << 20
CELLS_AT_ONCE = 1 << 22


def _cells(documents: DataFrame, key: str, text: str, dim: int) -> DataFrame:
    """key, idx, weight: the cells of the texts that one Arrow batch holds under a key, as two lists.

    A token's index is its hash modulo the dimension, its sign the hash's second bit. Tokens are
    summed in the task that reads the text, where each is hashed once; a batch sends one row per key.
    """
    if dim & (dim - 1) or not 2 <= dim <= 1 << 20:
        raise ValueError("dim must be a power of two, between 2 and 2**20")
    kind = documents.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("idx", T.ArrayType(T.IntegerType())),
            T.StructField("weight", T.ArrayType(T.LongType())),
        ]
    )

    def summed(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known: dict[bytes, int] = {}

        def low_bits(token: bytes) -> int:
            if token not in known:
                if len(known) >= TOKENS_KNOWN:
                    known.clear()
                known[token] = int.from_bytes(hashlib.sha256(token).digest()[-4:], "big")
            return known[token]

        for batch in batches:
            # Rows of one key stand together, so that a slice of them holds whole keys.
            keys = batch.column(0).dictionary_encode(null_encoding="encode")
            groups = keys.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(groups, kind="stable")
            groups, words = groups[order], batch.column(1).take(pa.array(order))
            step = max(1, CELLS_AT_ONCE // dim)
            for start in range(0, len(keys.dictionary), step):
                stop = min(start + step, len(keys.dictionary))
                first, last = np.searchsorted(groups, [start, stop])
                part = words.slice(first, last - first)
                sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                coded = part.flatten().cast(pa.binary()).dictionary_encode()
                names = coded.dictionary.to_pylist()
                low = np.fromiter(map(low_bits, names), np.int64, len(names))
                # An empty token counts nothing.
                signs = np.where([name == b"" for name in names], 0, np.where(low & 2, -1, 1))
                tokens_of = coded.indices.to_numpy(zero_copy_only=False)
                owners = np.repeat(groups[first:last].astype(np.int64) - start, sizes)
                cells = np.bincount(
                    owners * dim + (low & (dim - 1))[tokens_of], signs[tokens_of], (stop - start) * dim
                ).astype(np.int64)
                filled = np.flatnonzero(cells)
                ends = np.searchsorted(filled, np.arange(stop - start + 1) * dim).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.dictionary.slice(start, stop - start),
                        pa.ListArray.from_arrays(ends, pa.array(filled % dim, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(cells[filled], pa.int64())),
                    ],
                    names=[key, "idx", "weight"],
                )

    return documents.select(key, tokens(F.col(text)).alias("_tokens")).mapInArrow(summed, schema)


def hashed_cells(documents: DataFrame, key: str, text: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Non-zero cells of each document's vector before scaling: key, idx, weight."""
    listed = _cells(documents, key, text, dim)
    cells = listed.select(key, F.inline(F.arrays_zip("idx", "weight")))
    return cells.groupBy(key, "idx").agg(F.sum("weight").alias("weight")).filter(F.col("weight") != 0)


def hash_vectors(documents: DataFrame, key: str, text: str, dim: int = EMBEDDING_DIM) -> DataFrame:
    """key, vector of unit length. Texts without a token get zeros."""
    gathered = _cells(documents, key, text, dim).groupBy(key).agg(
        F.collect_list(F.struct("idx", "weight")).alias("_parts")
    )
    schema = T.StructType(
        [
            T.StructField(key, documents.schema[key].dataType),
            T.StructField("vector", T.ArrayType(T.DoubleType())),
        ]
    )

    def scaled(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        step = max(1, CELLS_AT_ONCE // dim)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                parts = batch.column(1)
                lists = parts.flatten()
                idx, weight = pc.struct_field(lists, 0), pc.struct_field(lists, 1)
                rows = np.repeat(
                    np.repeat(np.arange(batch.num_rows), pc.list_value_length(parts).to_numpy()),
                    pc.list_value_length(idx).to_numpy(),
                )
                sums = np.bincount(
                    rows * dim + idx.flatten().to_numpy(), weight.flatten().to_numpy(), batch.num_rows * dim
                ).reshape(batch.num_rows, dim)
                length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
                # A text without a token has no length to divide by.
                vectors = np.divide(sums, length, out=np.zeros_like(sums), where=length > 0)
                ends = np.arange(batch.num_rows + 1, dtype=np.int32) * dim
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(vectors.ravel()))],
                    names=[key, "vector"],
                )

    return gathered.mapInArrow(scaled, schema)


def document_vectors(
    documents: DataFrame,
    key: str,
    text: str,
    model_vectors: DataFrame | None = None,
    dim: int = EMBEDDING_DIM,
) -> DataFrame:
    """Vectors a model supplied, else hashed ones; ``provider`` tells which.

    ``model_vectors`` holds (key, vector), at most one row per key. Documents
    it covers are not hashed.
    """
    if model_vectors is None:
        return hash_vectors(documents, key, text, dim).withColumn("provider", F.lit("hash"))
    supplied = model_vectors.filter(F.col("vector").isNotNull()).select(
        key, F.col("vector").cast("array<double>").alias("vector")
    )
    wanted = documents.select(key)
    modelled = supplied.join(wanted, key, "left_semi").withColumn("provider", F.lit("model"))
    rest = documents.join(supplied.select(key), key, "left_anti")
    hashed = hash_vectors(rest, key, text, dim).withColumn("provider", F.lit("hash"))
    return modelled.unionByName(hashed)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, v: total + v * v))
