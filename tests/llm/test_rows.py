"""Rows that repeat an id or have none, through the stages of the pipeline."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests_llm_brute import text_of

SF = "/root/testdata/sf0.001"


def test_stages_decide_row_by_row(spark):
    """One id on different texts, null ids on near copies, a contaminated row under a shared id and under none."""
    near = text_of(21, 100)
    copy = near.rsplit(" ", 1)[0] + " changed"
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first()["text"]
    leaked = text_of(22, 40) + " " + item + " " + text_of(23, 40)
    other = [text_of(s, 80) for s in range(30, 35)]
    rows = [(1, near), (7, copy), (7, other[0]), (7, other[1]), (None, copy), (None, other[2]), (None, other[3]), (7, leaked), (None, leaked), (8, other[4]), (8, other[4])]
    # Near copies that have no id at all leave one.
    lone = text_of(40, 100)
    rows += [(None, lone), (None, lone.rsplit(" ", 1)[0] + " x1"), (None, lone.rsplit(" ", 1)[0] + " x2")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    single = corpus_pipeline.drop_near_duplicates(spark, docs, SF).cache()
    got = Counter((r["doc_id"], r["text"]) for r in single.collect())
    lones = [k for k in got if k[1].startswith(lone[:50])]
    assert len(lones) == 1 and got.pop(lones[0]) == 1
    assert got == Counter([(1, near), (7, other[0]), (7, other[1]), (None, other[2]), (None, other[3]), (7, leaked), (8, other[4])])
    # Near copies of a leaked passage are one class, so the null id is tried on its own.
    found = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert Counter((r["doc_id"], r["text"]) for r in found.collect()) == Counter((i, t) for i, t in rows if t != leaked)
