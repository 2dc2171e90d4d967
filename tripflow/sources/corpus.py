"""Document corpora for indexing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripflow.functions import keys

CORPUS_COLUMNS = ["id", "source_id", "target_table", "source_type", "city_id", "doc_id", "text"]


def with_document_ids(corpus: DataFrame) -> DataFrame:
    """Drop empty texts and give each document its stable id."""
    filled = corpus.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    for name in ("target_table", "source_type", "city_id", "doc_id"):
        filled = filled.withColumn(name, F.coalesce(F.col(name), F.lit("unknown")))
    return filled.withColumn(
        "id", keys.name_uuid(F.concat_ws("::", "source_id", "doc_id"))
    ).select(*CORPUS_COLUMNS)
