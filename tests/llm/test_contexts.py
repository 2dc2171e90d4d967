"""Patterns of personal data: which are learned, and how far rounds reach."""

from __future__ import annotations

from tripflow.llm import pii


def revealed(spark, texts):
    found = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["spans"] if s not in r["base"]] for r in found if len(r["spans"]) > len(r["base"])}


def test_rounds_go_on_until_nothing_is_added(spark):
    """Four cues in a row: each stands before what the one before reveals, and before a few more."""
    sets = [[f"u{i}@mail.example.com" for i in range(320)], *([f"i{k}x{i}" for i in range(n)] for k, n in enumerate((80, 20, 5, 1)))]
    texts = [f"see cue{k} {value}" for k in range(4) for value in (*sets[k], *sets[k + 1])]
    got = revealed(spark, texts)
    assert {x for found in got.values() for x in found} == {x for s in sets[1:] for x in s}


def test_cues_on_every_side(spark):
    texts = [f"w{chr(97 + i)} tel {i}0@mail.example.com" for i in range(6)]
    texts.append("here tel a/7")
    texts += [f"q{i}@mail.example.com wrote this {chr(97 + i)}" for i in range(6)]
    texts.append("ann[at]home wrote this again")
    far = "please contact" + " " * 200
    texts += [f"{far}z{i}@mail.example.com" for i in range(6)]
    texts.append(far + "bob[dot]x")
    got = revealed(spark, texts)
    assert got == {6: ["a/7"], 13: ["ann[at]home"], 20: ["bob[dot]x"]}
