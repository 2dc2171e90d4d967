"""A corpus pipeline: documents through five stages, each a table that the next one reads.

Every stage takes (spark, docs, sf_dir) and keeps the columns of documents, except for the last,
which returns the mix: a row for each reading of a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm import decontaminate, mixing, ngram_join, pii, quality_rules
from tripflow.llm.tables import stored, table
from tripflow.llm.words import row_key, space_words

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep. Empty and null texts go; repeated rows share their fate."""
    return quality_rules.judge(docs).where("quality.kept").select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with ``row_key``, which tells rows apart whatever their id: equal only for equal id and text."""
    return docs.select(*COLUMNS, row_key("doc_id", "text").alias("row_key"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id that is not null. Rows
    that share an id or have none are rows of their own; rows without words are groups of their own."""
    keyed = _keyed(docs)
    classes = ngram_join.ngram_classes(keyed, id_column="row_key").where("n_shingles > 0")
    classes = classes.groupBy("row_key").agg(F.any_value("component_id").alias("class"))
    ids = keyed.groupBy("row_key").agg(F.any_value("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    members = stored(ids.join(classes, "row_key"), "near-duplicates")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("first")
    firsts = members.groupBy("class").agg(first).select("first.row_key")
    gone = stored(members.join(firsts, "row_key", "left_anti").select("row_key"), "near-duplicates-gone")
    kept = keyed.join(gone, "row_key", "left_anti")
    # Copies of one text under one id are left over; a window would gather them, an aggregate doesn't.
    repeated = stored(members.where("copies > 1").join(gone, "row_key", "left_anti").select("row_key"), "repeated-rows")
    if repeated.isEmpty():
        return kept.select(*COLUMNS)
    single = kept.join(repeated, "row_key", "left_anti").select(*COLUMNS)
    one = kept.join(repeated, "row_key", "left_semi").groupBy("row_key").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return single.union(one.select("row.*").select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no window of a benchmark item, whatever their id."""
    keyed = _keyed(docs)
    found = decontaminate.contamination(keyed, table(spark, sf_dir, "benchmark"), id_column="row_key")
    bad = found.where("contaminated").select("row_key").distinct()
    return keyed.join(bad, "row_key", "left_anti").select(*COLUMNS)


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [pii.redact(t, s) for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
        columns = {n: batch.column(n) for n in COLUMNS} | {"text": pa.array(texts, pa.string())}
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    found = pii.find_pii(docs).where(F.size("spans") > 0).select("row_key", "spans").dropDuplicates(["row_key"])
    joined = _keyed(docs).join(found, "row_key", "left").select(*COLUMNS, "spans")
    schema = ", ".join(f"{n} {t}" for n, t in docs.select(*COLUMNS).dtypes)
    redacted = joined.mapInArrow(_redacted, schema)
    return redacted.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time it reads a document, with size, source_size, target, the words
    ``taken`` by this ``reading`` (0, 1, 2) and the document's first_slot. Documents that no slot takes
    are left out; a reading that ends with its source's last slot holds the words up to there, joined by
    one space."""
    # Told apart by all columns, so that rows of one key are equal and any of them will do.
    named = docs.select(*COLUMNS, F.to_json(F.struct(*(c for c in COLUMNS if c != "text"))).alias("mix_id"))
    taken = mixing.mix(named, id_column="mix_id")[0].where("taken > 0")
    last = F.ceil(F.col("taken") / F.col("size")).cast("int") - 1
    readings = taken.select("row_key", "size", "source_size", "target", "taken", "first_slot", F.explode(F.sequence(F.lit(0), last)).alias("reading"))
    words = F.least("size", F.col("taken") - F.col("reading") * F.col("size")).alias("taken")
    readings = readings.select("row_key", "size", "source_size", "target", words, "reading", "first_slot")
    rows = named.withColumn("row_key", row_key("mix_id", "text")).drop("mix_id").dropDuplicates(["row_key"])
    mixed = rows.join(readings, "row_key")
    first = F.array_join(F.slice(space_words(F.col("text")), F.lit(1), F.col("taken").cast("int")), " ")
    mixed = mixed.withColumn("text", F.when(F.col("taken") < F.col("size"), first).otherwise(F.col("text")))
    mixed = mixed.withColumn("n_chars", F.length("text").cast("long"))
    return mixed.select(*COLUMNS, "size", "source_size", "target", "taken", "reading", "first_slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", apply_quality_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("mixing sources", mix_sources),
]

# Personal data is found by patterns that are learned in rounds, which SQL doesn't express; the
# stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage-{i + 1}")
    return docs
