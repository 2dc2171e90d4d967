"""Exact nearest documents per question, and answers built from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tripflow.session import fresh_dir
from tripflow.settings import DEFAULT_TOP_K, EMBEDDING_DIM

# A block of questions travels to every executor; it holds at most this many bytes of vectors.
BLOCK_BYTES = 64 * 1024 * 1024
MAX_TOP_K = 20
QUESTIONS_AT_ONCE = 256


def _vector_type(key: str, frame: DataFrame) -> T.DataType:
    return frame.schema[key].dataType


def _nearest_in_block(
    documents: DataFrame, ids: list, matrix: np.ndarray, question: str, doc: str, k: int,
    question_type: T.DataType,
) -> DataFrame:
    """Each task keeps its own k best per question of the block, and the k best of all follow."""
    spark = documents.sparkSession
    dim = matrix.shape[1]
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)
    block = spark.sparkContext.broadcast(unit)
    schema = T.StructType(
        [
            T.StructField("_q", T.IntegerType()),
            T.StructField(doc, _vector_type(doc, documents)),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def best_of_task(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        unit = block.value
        # Distances in millionths and document ids of the best so far, a row per question.
        best, best_ids = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            fits = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dim), False)
            if not pc.all(fits).as_py():
                unfit = batch.column(0).filter(pc.invert(fits))
                raise ValueError(f"{len(unfit)} documents without a vector of {dim} places, such as {unfit[0]}")
            ids = np.asarray(batch.column(0).to_pylist())
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            vectors = flat.reshape(batch.num_rows, dim)
            size = np.linalg.norm(vectors, axis=1, keepdims=True)
            vectors = np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 0)
            known = ids if best_ids is None else np.concatenate([ids, best_ids.ravel()])
            names = np.unique(known)
            places = np.searchsorted(names, ids)
            kept, kept_ids = [], []
            # A few questions at a time bound the matrix of distances.
            for start in range(0, len(unit), QUESTIONS_AT_ONCE):
                rows = slice(start, start + QUESTIONS_AT_ONCE)
                far = np.rint((1.0 - unit[rows] @ vectors.T) * 1e6).astype(np.int64)
                # One number that sorts by distance and then by id.
                order = far * len(names) + places
                if best is not None:
                    old = best[rows] * len(names) + np.searchsorted(names, best_ids[rows])
                    order = np.hstack([old, order])
                if order.shape[1] > k:
                    order = np.partition(order, k - 1, axis=1)[:, :k]
                kept.append(order // len(names))
                kept_ids.append(names[order % len(names)])
            best, best_ids = np.vstack(kept), np.vstack(kept_ids)
        if best is None:
            return
        count = best.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(unit), dtype=np.int32), count)),
                pa.array(best_ids.ravel().tolist(), type=doc_type),
                pa.array(best.ravel() / 1e6),
            ],
            names=["_q", doc, "distance"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    doc_type = to_arrow_type(_vector_type(doc, documents))
    scored = documents.select(doc, "vector").mapInArrow(best_of_task, schema)
    names = spark.createDataFrame(
        list(enumerate(ids)),
        T.StructType(
            [T.StructField("_q", T.IntegerType()), T.StructField(question, question_type)]
        ),
    )
    # Labels of one block: as many rows as the block has questions.
    return scored.join(F.broadcast(names), "_q").select(question, doc, "distance")


def _ranked(scored: DataFrame, question: str, doc: str, k: int) -> DataFrame:
    order = Window.partitionBy(question).orderBy("distance", doc)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(
    documents: DataFrame,
    questions: DataFrame,
    doc: str,
    question: str,
    k: int = DEFAULT_TOP_K,
    dim: int = EMBEDDING_DIM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The k documents with the smallest cosine distance per question.

    Both sides hold an id and a ``vector`` of ``dim`` places; any other vector is an error. Distances are
    rounded to six places and ties go to the smaller document id. Documents never move: the questions
    visit them, in blocks of bounded size, worked off one after the other; each leaves its candidates in
    the shared folder before the next is read.
    """
    if not 1 <= k <= MAX_TOP_K:
        raise ValueError(f"k must lie between 1 and {MAX_TOP_K}")
    spark = documents.sparkSession
    kind = _vector_type(question, questions)
    result_schema = T.StructType(
        [
            T.StructField(question, kind),
            T.StructField(doc, _vector_type(doc, documents)),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    asked = questions.select(question, "vector").distinct()
    fits = F.coalesce(F.size("vector") == dim, F.lit(False))
    count, unfit = asked.agg(F.count(F.lit(1)), F.count_if(~fits)).first()
    if unfit:
        raise ValueError(f"{unfit} questions without a vector of {dim} places")
    if not count:
        return _ranked(spark.createDataFrame([], result_schema), question, doc, k)
    fitting = max(1, block_bytes // (8 * dim))
    # Hashing spreads questions unevenly, so several blocks are cut twice as fine as the bound asks.
    blocks = 1 if count <= fitting else -(-2 * count // fitting)
    if blocks > 1:
        # Vectors are made once, not once per block.
        made = fresh_dir(spark, "vectors")
        vectors = documents.select(doc, "vector")
        vectors.write.parquet(made)
        documents = spark.read.schema(vectors.schema).parquet(made)
    folder = fresh_dir(spark, "nearest")
    for number in range(blocks):
        share = asked.filter(F.pmod(F.xxhash64(question, "vector"), F.lit(blocks)) == number)
        ids, matrix = _collect_block(share, question)
        if not ids:
            continue
        scored = _nearest_in_block(documents, ids, matrix, question, doc, k, kind)
        _ranked(scored, question, doc, k).drop("rank").write.mode("append").parquet(folder)
    return _ranked(spark.read.schema(result_schema).parquet(folder), question, doc, k)


def _collect_block(share: DataFrame, question: str) -> tuple[list, np.ndarray]:
    rows = share.select(question, "vector").collect()
    return [r[0] for r in rows], np.asarray([r[1] for r in rows], dtype=np.float64)


def only_scope(documents: DataFrame, city_id: str | None = None, source_type: str | None = None):
    """Metadata filter ahead of a search; values that are not given do not filter."""
    rows = documents
    if city_id:
        rows = rows.filter(F.col("city_id") == city_id)
    if source_type:
        rows = rows.filter(F.col("source_type") == source_type)
    return rows


def with_properties(hits: DataFrame, documents: DataFrame, doc: str) -> DataFrame:
    """Attach text and metadata to the hits. Their size in bytes is known once they are ranked, and
    decides at run time whether they go to the documents or both sides are shuffled."""
    return documents.join(hits, doc)


# Context and answers ---------------------------------------------------------

INSTRUCTIONS = (
    "Answer the question from the numbered context only. If the context does not suffice, say so."
)
CLOSING = "Reply with short bullet points and cite the context by number, such as [1]."
NO_CONTEXT = "No context found."
# Wording of an answer made without a language model.
NO_ANSWER = "Insufficient context to answer this question."
EXTRACTIVE_HEADER = "Extractive fallback answer (LLM unavailable):"


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("None"))


def prompts(
    questions: DataFrame,
    hits: DataFrame,
    key: str = "question_id",
    instructions: str = INSTRUCTIONS,
    closing: str = CLOSING,
) -> DataFrame:
    """Question and its numbered context blocks as one prompt; at most k blocks each."""
    block = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] source="), _text("source_id"),
        F.lit(" type="), _text("source_type"), F.lit(" city="), _text("city_id"),
        F.lit("\ntext="), _text("text"),
    )
    gathered = hits.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("rank", block.alias("block")))).alias("_blocks")
    )
    context = F.array_join(F.transform("_blocks", lambda b: b["block"]), "\n\n")
    return questions.join(gathered, key, "left").select(
        key,
        F.concat(
            F.lit(f"{instructions}\n\nQuestion:\n"), F.col("question"), F.lit("\n\nContext:\n"),
            F.coalesce(context, F.lit(NO_CONTEXT)), F.lit(f"\n\n{closing}"),
        ).alias("prompt"),
    )


def answers(questions: DataFrame, hits: DataFrame, key: str = "question_id") -> DataFrame:
    """Answer records from the nearest hit, with all hits listed as sources."""
    source = F.struct(
        "rank",
        F.col("doc_id").alias("docId"),
        F.col("source_id").alias("sourceId"),
        F.col("source_type").alias("sourceType"),
        F.col("city_id").alias("cityId"),
        "distance",
    )
    top = F.struct(
        _text("source_id").alias("source"), _text("source_type").alias("type"),
        _text("text").alias("text"),
    )
    gathered = hits.groupBy(key).agg(
        F.array_sort(F.collect_list(source)).alias("_sources"),
        F.min_by(top, F.col("rank")).alias("_top"),
        F.count(F.lit(1)).alias("_hits"),
    )
    extract = F.concat(
        F.lit(f"{EXTRACTIVE_HEADER}\n- Most relevant source: "), F.col("_top.source"), F.lit(" ["),
        F.col("_top.type"), F.lit("]\n- Evidence: "), F.col("_top.text"),
    )
    listed = F.transform("_sources", lambda s: s.dropFields("rank"))
    return questions.join(gathered, key, "left").select(
        key,
        "question",
        F.coalesce(extract, F.lit(NO_ANSWER)).alias("answer"),
        F.lit(True).alias("used_fallback"),
        F.coalesce("_hits", F.lit(0)).cast("bigint").alias("retrieved_count"),
        F.coalesce(F.to_json(listed), F.lit("[]")).alias("sources"),
    )
