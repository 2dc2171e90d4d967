"""Product codes, MinHash classes and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_brute import DOCS, brute_classes, odd_documents, text_of

from tripflow.llm import minhash, runs, vector_codes
from tripflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, code string, id long, vector string"


def brute_codes(rows, parts, entries, rounds):
    """rows: (id, vector, label) without those that can't be coded."""
    whole = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows]
    width = len(whole[0][1]) // parts
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in first] for p in range(parts)]

    def near(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        moved = []
        for p in range(parts):
            held = [[] for _ in books[p]]
            for _, v, _ in whole:
                part = v[p * width : (p + 1) * width]
                held[near(p, part)[1]].append(part)
            moved.append([[sum(c) // len(h) for c in zip(*h)] if h else old for h, old in zip(held, books[p])])
        books = moved
    out = []
    for i, v, label in whole:
        found = [near(p, v[p * width : (p + 1) * width]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, books


def with_label_errors(coded):
    totals = {}
    for _, label, _, error in coded:
        if error is not None:
            totals[label] = totals.get(label, 0) + error
    return Counter((*r, totals.get(r[1])) for r in coded)


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_of_odd_vectors(spark, seed):
    """Nulls, infinities, ties, repeated ids, other lengths and components out of range."""
    rng = random.Random(seed)
    vectors = [[np.float32(rng.choice([rng.gauss(0, 0.2), rng.gauss(3, 1), 0.25])).item() for _ in range(12)] for _ in range(60)]
    good = [(i if i % 7 else None, v, i % 3 or None) for i, v in enumerate(vectors)] + [(5, vectors[5], 1), (5, vectors[6], 1), (70, vectors[5], 9)]
    gone = [(1, None, 1), (2, [None, *vectors[0][1:]], 1), (3, [math.nan, *vectors[0][1:]], 2), (4, [math.inf, *vectors[0][1:]], 2)]
    uncoded = [(80, vectors[0][:8], 4), (81, [], 4), (82, [9000.0, *vectors[0][1:]], None)]
    rows = [(*r, "clash", 1, "clash") for r in good + gone + uncoded]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    found, books = vector_codes.compress_vectors(frame, parts=4, entries=5, rounds=3)
    coded, expected = brute_codes(good, 4, 5, 3)
    assert [b.tolist() for b in books] == expected
    assert Counter(map(tuple, found.collect())) == with_label_errors(coded + [(i, label, None, None) for i, _, label in uncoded])


def test_codes_of_few_or_no_vectors(spark):
    frame = spark.createDataFrame([(1, [0.5] * 8, None, "", 1, ""), (2, [0.5] * 8, None, "", 1, "")], VECTORS)
    found, books = vector_codes.compress_vectors(frame)
    assert [tuple(r) for r in found.orderBy("vec_id").collect()] == [(1, None, "00" * 8, 0, 0), (2, None, "00" * 8, 0, 0)]
    assert all(len(b) == 2 for b in books)
    for rows in ([], [(1, None, 1, "", 1, "")], [(1, [1.0], 1, "", 1, "")]):
        found, books = vector_codes.compress_vectors(spark.createDataFrame(rows, VECTORS))
        assert books == [] and [r["code"] for r in found.collect()] == [None] * (len(rows) and rows[0][1] is not None)


@pytest.mark.parametrize("grid", [1, 3, 16])
def test_cells_lose_no_nearest_entry(grid):
    rng = np.random.default_rng(grid)
    book = rng.integers(-300, 300, (16, 4))
    book[7] = book[3]
    parts = np.concatenate((rng.integers(-900, 900, (4000, 4)), book))
    cells = vector_codes.GridCells(book, grid)
    for _ in range(2):
        code, error = cells.nearest(parts)
        distance = ((parts[:, None, :] - book) ** 2).sum(axis=2)
        assert (code == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
    assert grid == 1 or np.mean([c.mean() for c in cells.known.values()]) < 0.9


def brute_near(rows):
    return Counter((i, n, c, i == c) for i, n, c in brute_classes(rows, size=2).elements())


def near_rows(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, None, None, None, "clash", 1, "clash") for i, t in rows], DOCS)
    return Counter(map(tuple, minhash.near_duplicates(frame.repartition(3), **options).collect()))


def test_minhash_of_odd_documents(spark):
    rows = [(i, t) for i, t, *_ in odd_documents()]
    assert near_rows(spark, rows) == brute_near(rows)
    assert not near_rows(spark, [])


def chain_of_copies():
    """Groups of near copies, a chain of links, and many texts around one passage that aren't linked."""
    rng = random.Random(11)
    base = text_of(50, 130, 5000).split()
    rows, now = [], list(base)
    for i in range(30):
        now = list(now)
        now[rng.randrange(len(now))] = f"c{i}"
        rows.append((i, " ".join(now)))
    passage = text_of(51, 100, 5000)
    rows += [(100 + i, passage + " " + text_of(1000 + i, 20 + i % 9, 9000)) for i in range(40)]
    for i in range(30):
        words = list(base)
        for _ in range(rng.randrange(1, 16)):
            words[rng.randrange(len(words))] = f"d{rng.randrange(10**6)}"
        rows.append((200 + i, " ".join(words)))
    return [(i, t) for i, t in rows for _ in range(1 + (i % 10 == 0))]


@pytest.mark.parametrize("paired", [0, 8, 1000])
def test_minhash_by_buckets_and_by_rare_shingles(spark, paired):
    """The result doesn't depend on how large buckets are taken apart."""
    rows = chain_of_copies()
    assert near_rows(spark, rows, paired=paired) == brute_near(rows)


def test_posterior_bound_falls_below_the_chosen_probability():
    steps = minhash.least_matches(384, 32, (80, 100), 1e-9)
    assert [n for n, _ in steps] == list(range(32, 385, 32))
    for n, m in steps:
        # Probability of the similarity given the matches, by numbers.
        t = (np.arange(20000) + 0.5) / 20000
        density = np.exp((m - 1) * np.log(t) + (n - m + 1) * np.log1p(-t)) if m else None
        assert density is None or density[t >= 0.8].sum() / density.sum() < 1.02e-9
    # A linked pair meets it nearly always.
    n, m = steps[-1]
    assert sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(m)) < 2e-9


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(4)
    common, own = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (800, 200))
    both = minhash.signatures(np.concatenate((common, own[:100], common, own[100:])), np.array([0, 900, 1800]))
    assert abs((both[0] == both[1]).mean() - 0.8) < 0.07


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, min_length=6, min_exponent=4):
    out = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(min_length, min_exponent * q) and not any(s <= start and start + length <= s + n and q % p == 0 for s, n, p in out):
                out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    rng = random.Random(3)
    for _ in range(400):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            words = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(0, 45))]
            if words and rng.random() < 0.5:
                a, p = rng.randrange(len(words)), rng.randrange(1, 6)
                words = [words[i] if i < a else words[min(a + (i - a) % p, len(words) - 1)] for i in range(len(words))]
            texts.append(words)
        first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        flat = np.array([w for t in texts for w in t], np.uint64)
        found = list(zip(*(x.tolist() for x in runs.maximal_runs(flat, first)), strict=True))
        assert found == [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t, 2, 2)]


def run_documents():
    tail = " ".join(["ab é"] * 9)
    return [(i, t) for i, t, *_ in odd_documents()] + [
        (30, "la " * 30000), (31, f"start {tail}"), (32, f"{tail} x {tail} x {tail} x {tail} x"), (33, "a\tb\na\x0bb\ra b a b"), (34, "a a a a a"),
        (35, "a a a a a a b c b c b c b c"), (36, text_of(9, 3000, 2)),
    ]


def test_runs_of_odd_documents(spark):
    rows = run_documents()
    frame = spark.createDataFrame([(i, t, None, None, None, "clash", 1, "clash") for i, t in rows], DOCS)
    found = runs.periodic_runs(frame.repartition(3)).collect()
    expected = []
    for i, t in rows:
        words = WORD.findall(t or "")
        listed = brute_runs(words) if len(words) < 5000 else [(0, len(words), 1)] if len(set(words)) == 1 else []
        if len(words) >= 5000 and len(set(words)) > 1:
            assert i == 10
        expected.append((i, len(words), tuple(listed), collapsed(words, listed)))
    assert Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in found) == Counter(expected)
    assert runs.periodic_runs(frame.limit(0)).collect() == []


def test_tails_are_made_by_the_digits_of_the_id(spark):
    rows = [(i, t) for i, t in enumerate([None, "", " ", "one", text_of(1, 40), text_of(2, 7)] * 40)] + [(None, "a b c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = frame.select("doc_id", "text", runs.repeated_tail(F.col("doc_id"), F.col("text"), F.split("text", " ")).alias("tailed")).collect()
    changed = 0
    for r in found:
        words = WORD.findall(r["text"] or "")
        h = zlib.crc32(str(r["doc_id"]).encode()) if r["doc_id"] is not None else 1
        if h % 10 or not words:
            assert r["tailed"] == r["text"]
            continue
        g, n = h // 10, len(words)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        expected = " ".join(words[i if i < a else a + (i - a) % p] for i in range(n))
        assert r["tailed"] == expected
        changed += expected != " ".join(words)
    assert changed > 5


def test_run_digests_of_the_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    some = 0
    for r in QUERIES["op13_periodic_runs"](spark, SF).collect():
        words = WORD.findall(texts[r["doc_id"]] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        found = brute_runs(words)
        top = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert r["n_runs"] == len(found)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
        some += bool(found)
    assert some
