"""One query per operator over its whole table, and the SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import (
    chat, decontaminate, html_text, minhash, mixing, ngram_join, pii, quality_rules, runs, secret_scan, substring_dedup, vector_codes, warc,
)
from tripflow.llm.tables import table
from tripflow.llm.words import space_words


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", *(F.col(f"quality.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        _sha256(F.array_join("item_ids", ",")).alias("items_sha256"), "contaminated",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(_number_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS),
        _sha256(_listed(F.col("base"))).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", *(_number_of(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        _sha256(_listed(base)).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", _sha256(F.col("kept_text")).alias("kept_sha256"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    made = chat.format_chats(turns.union(extra).withColumn("parts", chat.text_parts(F.col("text"))))
    lines = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n")))
    loss = chat.read_loss(F.col("formatted"), F.col("loss"))
    read = made.select("conv_id", lines.alias("lines"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id", F.size("lines").cast("long").alias("n_turns"), _sha256(F.array_join("lines", "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), _sha256(F.col("loss")).alias("loss_sha256"), "formatted_chars",
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_pieces")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.codebooks_sha256(codebooks)).alias("codebooks_sha256"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", runs.repeated_tail(F.col("doc_id"), F.col("text"), space_words(F.col("text"))))
    found = runs.periodic_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("top", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        _sha256(F.array_join(lines, "")).alias("runs_sha256"), _sha256(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES = {
    q.__name__: q
    for q in (
        op1_ngram_join, op2_quality_rules, op3_decontaminate, op4_warc, op5_pii, op6_secret_scan, op7_substring_dedup,
        op8_chat_format, op9_html_text, op10_mixing, op11_vector_codes, op12_minhash, op13_periodic_runs,
    )
}
