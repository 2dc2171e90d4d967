"""The training-data operators against brute force, on small tables with every odd case."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripflow.llm import chat, components, decontaminate, html_text, mixing, ngram_join, pii, quality_rules, secret_scan, sketch, substring_dedup, warc
from tripflow.llm.words import Texts

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BITS = 16
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row_key string, n int, spans string"


def lower(text):
    return (text or "").translate(ASCII_LOWER)


def text_of(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}é" for _ in range(n))


def odd_documents():
    """Nulls in every column, empty and long texts, ties, repeated rows, near and exact copies."""
    base = text_of(1, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    rows = [
        (1, base), (2, base.upper().replace("É", "é")), (3, near), (3, near), (None, base), (None, None),
        (4, None), (5, ""), (6, " \t\n\x0b\x0c\r "), (7, "one two three"), (8, "One  two\nthree"), (9, "word"),
        (10, text_of(2, 5000, 3000)), (11, "x" * 30000), (12, text_of(3, 50) + " " + " ".join(words[:45])),
        (13, "the the the the the the the the the the the the"), (14, "a\nb\na\nb\n\n\n a\na"), (15, "ÀÉ İıK ſ straße " * 4),
        (16, " nbsp  joins words   here"), (17, near), (17, "another text under the same id, of eleven words or so"),
    ]
    return [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None, "clash", k, "clash") for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_documents(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_word_hashes_tell_words_apart():
    texts = ["a b  c", "", None, "a b c a b c d\n", "ab c", "A b c"]
    found = Texts(pa.array(texts), lower=True)
    words = [SPACE_WORD.findall(lower(t)) for t in texts]
    assert np.diff(found.first).tolist() == [len(w) for w in words]
    start, text, length = found.windows(2, whole_if_shorter=True)
    hashes = found.hashes(start, length)
    expected = [tuple(w[i : i + 2]) for w in words for i in range(max(len(w) - 1, min(len(w), 1)))]
    assert len(set(zip(expected, hashes.tolist(), strict=True))) == len(set(expected)) == len(set(hashes.tolist()))


def test_sketch_loses_no_repeat(spark):
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 3000, 2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(4)]
    made = []
    for part in parts:
        own = sketch.TaskSketch(BITS)
        assert not list(own.add(part))
        made += own.flush().to_pylist()
    pieces = sketch.merge(spark.createDataFrame([tuple(r.values()) for r in made], sketch.SKETCH_SCHEMA), BITS)

    class Shared:
        value = pieces

    bits = sketch.merged_bits(Shared, BITS)
    counts = Counter(np.concatenate(parts).tolist())
    for part in parts:
        flags = sketch.repeated(part, bits, BITS)
        assert all(f for h, f in zip(part.tolist(), flags, strict=True) if counts[h] > 1)
    single = np.array([h for h, n in counts.items() if n == 1], np.uint64)
    assert sketch.repeated(single, bits, BITS).mean() < 0.1


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 9), (10, 11), (7, 7), (None, 3), (11, 10)] + [(100, 200 + i) for i in range(50)] + [(i, i + 1) for i in range(300, 340)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {n: found[n] for n in (3, 4, 5, 9)} == dict.fromkeys((3, 4, 5, 9), 3)
    assert found[10] == found[11] == 10 and found[240] == 100 and found[340] == 300
    assert 7 not in found
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_classes(rows, size=5):
    sets = []
    for i, t in rows:
        w = SPACE_WORD.findall(lower(t))
        sets.append({tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return Counter((i, len(s), least.get(g)) for (i, _), s, g in zip(rows, sets, group, strict=True))


def test_ngram_join(docs, nothing):
    rows = [(r[0], r[1]) for r in odd_documents()]
    assert Counter(tuple(r) for r in ngram_join.ngram_classes(docs, bits=BITS).collect()) == brute_classes(rows)
    assert ngram_join.ngram_classes(nothing, bits=BITS).collect() == []


@pytest.mark.parametrize(("tile_rows", "blocks", "central"), [(256, 4, 2), (3, 7, 0)])
def test_ngram_join_of_a_large_group_and_chains(spark, monkeypatch, tile_rows, blocks, central):
    """Near copies of one text, each changed elsewhere; copies of copies; sizes at the bound. Also
    where columns are cut into many tiles, and all links come from the block of leading columns."""
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(ngram_join, "COLUMN_BLOCKS", blocks)
    monkeypatch.setattr(ngram_join, "CENTRAL_ROUNDS", central)
    rng = random.Random(3)
    base = text_of(9, 150, 10_000).split()
    rows, now = [], base
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(150)] = f"new{rng.random()}"
        rows.append((i + 100, " ".join(copy)))
    for i in range(15):
        now = list(now)
        now[rng.randrange(150)] = f"step{i}"
        rows.append((i, " ".join(now)))
    for i in range(30):
        rows.append((500 + i, " ".join(base[: 100 + 2 * i])))
    found = ngram_join.ngram_classes(spark.createDataFrame(rows, "doc_id long, text string"), bits=BITS)
    assert Counter(tuple(r) for r in found.collect()) == brute_classes(rows)


def test_quality_rules(docs, nothing):
    found = quality_rules.judge(docs).select("doc_id", "text", "quality.*").collect()
    assert len(found) == len(odd_documents())
    for r in found:
        text = r["text"] or ""
        words = SPACE_WORD.findall(text)
        lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        many = Counter(windows)
        covered = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(5)}
        assert r["n_words"] == len(words)
        assert r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert r["kept"] == (not r["base_failed"] and not r["broken"])
    assert quality_rules.judge(nothing).collect() == []


def test_quality_rules_run_without_python(docs):
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("InMemoryTableScan")[0]


def test_rule_table_is_data(spark):
    rows = spark.createDataFrame([(1, "A B C " * 1 + "plain words stand here in a row of ten words"), (2, "# " * 3 + "some words and then ten more of them stand here now")], "doc_id long, text string")
    rules = (quality_rules.Rule("marks", "symbols_per_word", None, 0.1),)
    assert {r["doc_id"]: r["quality"]["broken"] for r in quality_rules.judge(rows, rules=rules).collect()} == {1: [], 2: ["marks"]}


def brute_contamination(rows, items):
    windows = {}
    for item, text in items:
        w = ITEM_WORD.findall(lower(text))
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = []
    for i, text in rows:
        w = ITEM_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in range(1, 11):
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in own if x is not None}
        out.append((i, len(w), len(hit), tuple(sorted(found)), bool(hit)))
    return Counter(out)


def test_decontamination(spark, docs, nothing):
    words = text_of(1, 120).split()
    items = [
        (1, " ".join(words[10:40])), (10, " ".join(words[60:70])), (9, " ".join(words[20:29]) + " elsewhere and on and on and on"),
        (2, "Three"), (3, None), (4, ""), (None, "the the"), (5, "K ſ"), (6, "nowhere to be found at all in any of the texts"), (1, "one, two!"), (2, "Three"),
    ]
    items_df = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, token string")
    rows = [(r[0], r[1]) for r in odd_documents()]
    found = decontaminate.contamination(docs, items_df)
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"]) for r in found.collect())
    assert got == brute_contamination(rows, items)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert decontaminate.contamination(nothing, items_df).collect() == []
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, items_df.limit(0)).collect())


def test_archives_round_trip(spark, tmp_path):
    html = ["<p>a</p>", "", None, "<p>a</p>", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", "é" * 5000, "<p>a</p>", None]
    rows = [(i, f"http://www.Example{i % 2}.org:80/p?q={i}#f" if i % 3 else None, h, "clash") for i, h in enumerate(html)]
    rows += [(3, "http://b.org/", "<p>a</p>", "clash"), (None, "http://b.org/\r\nX: y", "<p>a</p>", "clash"), (99, "http://c.org", "z", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    index = warc.archive(pages, str(tmp_path / "w"), records_per_file=2)
    got = index.collect()
    keys = [(r["url_key"], r["timestamp"], -1 if r["page_id"] is None else r["page_id"]) for r in got]
    assert keys == sorted(keys)
    largest = {}
    for i, _, h, _ in rows:
        if i is not None:
            largest[h or ""] = max(i, largest.get(h or "", i))
    expected = Counter()
    for i, _, h, _ in rows:
        payload = (h or "").encode()
        revisit = i is not None and i < largest[h or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected[(i, len(payload), digest, "revisit" if revisit else "response", largest[h or ""] if revisit else None)] += 1
    assert Counter(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got) == expected
    # Records lie where the index says.
    for r in got:
        content = zlib.decompress((tmp_path / "w" / r["file"]).read_bytes(), 47)
        assert content[r["offset"] : r["offset"] + r["length"]].startswith(b"WARC/1.1\r\n")
    assert warc.archive(pages.limit(0), str(tmp_path / "none")).collect() == []


def test_loser_tree_merges_any_runs():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(((f"k{rng.randrange(5)}", "t", rng.randrange(9), 0, 0, 0, 0, 0, f"f{i}", j) for j in range(rng.randrange(6))), key=warc._key) for i in range(k)]
        merged = list(warc.merge_runs(runs))
        assert merged == sorted((x for r in runs for x in r), key=warc._key)


def test_url_keys():
    assert warc.url_key("https://www.Sub.Example.com:8080/A?b=C#d") == "com,example,sub)/a?b=c"
    assert warc.url_key("http://user@x.org") == "org,x)/"
    assert warc.url_key(None) == ""


PII_BRUTE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(text):
    out = []
    for no, (kind, expression) in enumerate(PII_BRUTE.items()):
        for m in re.finditer(expression, text, re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": lambda m, d: True,
                "ip": lambda m, d: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")),
                "card": lambda m, d: 14 <= len(d) <= 19 and pii.luhn(d),
                "phone": lambda m, d: 10 <= len(d) <= 15,
            }[kind]
            if fine(m, digits):
                out.append((m.start(), no, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_seeds_match_the_expressions():
    rng = random.Random(11)
    pieces = ["a@b", ".c", "@", "1.2.3.4", "256.1.1.1", "4539 1488 0343 6467", "4539148803436467", "+1 (743) 555-3824", "+", "9", "999", ".", "-", " ", "é", "x_y", "%", "(", ")", "0000255.1.1.01"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
        assert pii.seeds(text) == brute_pii(text), text
    assert pii.seeds("a" * 200_000 + "@" + "9" * 200_000 + "." + "9" * 200_000) == [("email", 0, 600_002)]


def test_pii_finds_by_context(spark, docs, nothing):
    """Seeds behind one context teach it; an identifier of no fixed shape behind it is found."""
    rows = [(i, f"Some words, reach me at user{i}@mail.example.com today") for i in range(12)]
    rows += [(50, "Please reach me at user50[at]mail7 soon"), (51, "nothing here at all 123456789 or so"), (52, None), (53, ""), (None, "reach me at x9@y.org"), (50, "Please reach me at user50[at]mail7 soon")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_id = {r["doc_id"]: r for r in found}
    text = rows[12][1]
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in by_id[50]["spans"]] == [("email", "user50[at]mail7")]
    assert by_id[50]["base"] == [] and by_id[51]["spans"] == [] and by_id[52]["spans"] == []
    assert len(found) == len(rows)
    assert pii.redact(text, [s.asDict() for s in by_id[50]["spans"]]) == "Please reach me at [EMAIL] soon"
    whole = pii.find_pii(docs).collect()
    assert len(whole) == len(odd_documents())
    assert all(r["base"] == r["spans"] for r in whole)
    assert pii.find_pii(nothing).collect() == []


def test_redact_overlaps():
    assert pii.redact("abcdef", [{"kind": "ip", "start": 1, "end": 3}, {"kind": "card", "start": 2, "end": 5}]) == "a[IP]f"
    assert pii.redact(None, []) is None


SECRET_BRUTE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
}


def test_secrets_match_the_expressions():
    rng = random.Random(7)
    pieces = ["token", "Secret", "PASSWORD", "api_key", "apikey", "passwd", "=", ":", '"', "'", " ", "abc12345", "x", "AKIA", "AKIAABCDEFGHIJKLM", "0123456789abcdef" * 2, "ab", "İ", "K", "ſ", "\n", "=="]
    scanner = secret_scan.Scanner()
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        expected = sorted((m.start(), no, kind, m.end()) for no, (kind, (e, ok)) in enumerate(SECRET_BRUTE.items()) for m in re.finditer(e, text, re.ASCII) if ok(m))
        assert [(s, secret_scan.KINDS.index(k), k, e) for k, s, e in scanner.scan(text) if k != "checked"] == expected, text


def test_secret_checksums(docs, nothing):
    body = "A1" * 15
    good = f"ghp_{body}{secret_scan.base62(zlib.crc32(body.encode()), 6)}"
    scanner = secret_scan.Scanner()
    assert ("checked", 4, 4 + len(good)) in scanner.scan(f"use {good}.")
    assert not [x for x in scanner.scan(f"use {good[:-1]}~ {good[:-2]}00") if x[0] == "checked"]
    assert len(secret_scan.find_secrets(docs).collect()) == len(odd_documents())
    assert secret_scan.find_secrets(nothing).collect() == []


def test_substring_dedup(spark, docs, nothing):
    rows = [(r[0], r[1]) for r in odd_documents()] + [(90, "r " * 80), (91, text_of(5, 34)), (92, text_of(5, 34)), (93, text_of(6, 35)), (94, "  " + text_of(6, 35).replace(" ", "\n") + " tail")]
    words = [SPACE_WORD.findall(t or "") for _, t in rows]
    many = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    expected = Counter()
    for (i, _), w in zip(rows, words, strict=True):
        gone = {k + j for k in range(len(w) - 34) if many[tuple(w[k : k + 35])] > 1 for j in range(35)}
        expected[(i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(tuple(r) for r in substring_dedup.remove_repeats(table, bits=BITS).collect()) == expected
    # A sketch far too narrow lets everything through and changes nothing.
    assert Counter(tuple(r) for r in substring_dedup.remove_repeats(table, bits=10).collect()) == expected
    assert substring_dedup.remove_repeats(nothing, bits=BITS).collect() == []


def test_substring_dedup_with_shared_keys(spark, monkeypatch):
    """Texts of different lengths whose first keys are equal don't get each other's runs."""
    rows = [(i, text_of(i, 20 + 9 * i)) for i in range(8)] + [(8, text_of(7, 83)), (8, text_of(7, 83)), (None, text_of(3, 60)), (9, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = Counter(tuple(r) for r in substring_dedup.remove_repeats(table, bits=BITS).collect())
    assert sum(r[2] * n for r, n in expected.items()) > 0
    monkeypatch.setattr(substring_dedup, "_key", lambda: F.xxhash64("row_id", "text") % 3)
    assert Counter(tuple(r) for r in substring_dedup.remove_repeats(table, bits=BITS).collect()) == expected


NASTY = ["", None, "<|end|>\n", "<|turn:user|>\n", "%3C|", "%253C|", "%", "<", "|>", r"\### Assistant: </turn> ok", "<<|", "a\nb", "%7C", "<|image:0|>"]


def test_chat_round_trip(spark):
    rows = [(c, t, role, NASTY[(c + t) % len(NASTY)], "clash") for c in range(14) for t, role in enumerate(["user", "assistant", None, "a|>\nb", "assistant"])]
    rows += [(20, None, "user", "first", "x"), (20, 1, "assistant", "tie b", "x"), (20, 1, "assistant", "tie a", "x"), (20, 1, "assistant", "tie a", "x"), (None, 0, "assistant", "lost", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string").repartition(4)
    made = chat.format_chats(table.withColumn("parts", chat.text_parts(F.col("text"))))
    read = made.select("conv_id", "n_turns", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss"))
    expected = {}
    for c, t, role, text, _ in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        expected.setdefault(c, []).append((role or "", text or ""))
    got = {r["conv_id"]: r for r in read.collect()}
    assert {c: [tuple(t) for t in r["turns"]] for c, r in got.items()} == expected
    assert {c: r["loss"] for c, r in got.items()} == {c: "".join(t for r, t in turns if r == "assistant") for c, turns in expected.items()}
    assert all(r["n_turns"] == len(expected[c]) for c, r in got.items())
    assert chat.format_chats(table.limit(0).withColumn("parts", chat.text_parts(F.col("text")))).collect() == []
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chat_parts(spark):
    def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
        return (kind, text, ref, width, height, seconds, pages)

    rows = [
        (1, 0, "user", [part("text", "look <|"), part("image", ref="a.png", width=57, height=28), part("audio", ref="b.wav", seconds=2.0)]),
        (1, 1, "assistant", [part("text", "seen")]),
        (1, 2, "user", [part("document", ref="c.pdf", pages=2), part(None, "plain"), part("image")]),
        (1, 3, "user", None),
    ]
    made = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")).first()
    turns = [x.split("|>\n", 1)[1] for x in made["formatted"].split("<|end|>\n")[:-1]]
    assert turns == ["look %3C|<|image:0|><|audio:1|>", "seen", "<|document:2|>plain<|image:3|>", ""]
    assert [tuple(a) for a in made["attachments"]] == [(0, "image", "a.png", 3), (1, "audio", "b.wav", 50), (2, "document", "c.pdf", 2048), (3, "image", None, 0)]
    assert [made["formatted"][x["start"] : x["start"] + x["length"]] for x in made["loss"]] == ["seen"]
    with pytest.raises(ValueError):
        chat.format_chats(spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{chat.PART}>"), template=chat.Template(end="</end>"))


PAGES = {
    "<html><head><title>t</title></head><body><nav><a href=x>m</a></nav><article><h1>Head  line</h1><p><b>One &amp; two<br><p>Three\n four</article><footer>f</footer>": "Head line One & two Three four",
    "<body><div class='sidebar'><p>side side side</p></div><div id=content><p>A long text of the page that goes on.</p><p>And more of the same text here.</p></div><div class=\"comments\"><p>reader says</p></div>": "A long text of the page that goes on. And more of the same text here.",
    "<article><p>in<b>li</b>ne &#233;&nbsp;x</p><script>var a = '</p><p>no';</script><style>p{}</style><!-- c <p>no</p> --><form><p>form</p></form><p>end</p></article>": "inline é x end",
    "": "",
    "<body><div></div></body>": "",
    "just text": "just text",
    "<article><aside><p>ad</p></aside><ul><li>a<li>b</ul></article>": "a b",
    "<p>open <unclosed \"quote": "open <unclosed \"quote",
    "<main><p>x</p><p>y z</p></main><div class='cookie-notice'>We use cookies</div>": "x y z",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html_text.main_text(page) == PAGES[page]


def test_main_text_of_hostile_pages():
    assert html_text.main_text("<div>" * 20_000 + "deep") == "deep"
    assert html_text.main_text("<p>" + "<" * 50_000) is not None
    assert html_text.main_text("<article>" + "<p>a b</p>" * 20_000 + "</article>") == " ".join(["a b"] * 20_000)


def test_extract_odd_rows(spark):
    rows = [(1, None, None, "x"), (None, "u", "<article><p>a</p></article>", "x"), (2, "u", "", "x"), (2, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert Counter(tuple(r) for r in html_text.extract(pages).collect()) == Counter([(1, None, ""), (None, "u", "a"), (2, "u", ""), (2, "u", "")])
    assert html_text.extract(pages.limit(0)).collect() == []


def brute_targets(sizes):
    """Share by weight, cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if shares[s] > 3 * sizes[s]]
        if not over:
            return fixed | shares
        fixed |= {s: 3 * sizes[s] for s in over}


def assert_taken_by_slots(rows, got, targets, block, step):
    """Every row's words, first slot and pieces from the slots, drawn one after the other."""
    order = sorted(targets, key=lambda s: (s is None, s or ""))
    streams = {s: [] for s in order}
    for i, text, source in rows:
        digest = hashlib.md5(text.encode()).hexdigest() if text is not None else ""
        key = hashlib.md5(f"{'' if i is None else i}/{digest}".encode()).hexdigest()
        streams[source].append((hashlib.md5(f"mix/{key}".encode()).hexdigest(), i, len(SPACE_WORD.findall(text or ""))))
    total, whole = sum(n for s in order for *_, n in streams[s]), sum(targets.values())
    highs = np.floor(np.cumsum([targets[s] for s in order]) / whole * 2**32).astype(np.int64)
    slots = {s: [] for s in order}
    for k in range(-(-total // block)):
        slots[order[int(np.searchsorted(highs, k * step % 2**32, side="right"))]].append(k)
    expected = Counter()
    for s in order:
        size = sum(n for *_, n in streams[s])
        words, start = min(len(slots[s]) * block, 3 * size), 0
        for _, i, n in sorted(streams[s], key=lambda r: r[0]):
            spans = [(start + e * size, min(start + e * size + n, words)) for e in range(3) if n and start + e * size < words]
            ranks = [r for a, b in spans for r in range(a // block, (b - 1) // block + 1)]
            expected[i, s, n, sum(b - a for a, b in spans), min((slots[s][r] for r in ranks), default=None), len(ranks)] += 1
            start += n
    assert Counter((r["doc_id"], r["source"], r["size"], r["taken"], r["first_slot"], r["n_pieces"]) for r in got) == expected


def test_mixing_where_one_id_holds_a_third(spark):
    """Neither an id nor its texts meet in one bucket; equal rows travel as one."""
    rows = [(7 if i % 3 == 0 else i, f"text number {i}" if i % 6 else "again and again", "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(1200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(table, slots=512)[0].collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    assert_taken_by_slots(rows, got, brute_targets(sizes), -(-sum(sizes.values()) // 512), mixing._STEP)
    keys = {r["row_key"][:4] for r in got if r["doc_id"] == 7}
    assert len(keys) > 150


def test_mixing(spark, docs, nothing):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(40)), ("a", "b", "c", "d", None)[min(rng.randrange(9), 4)]) for i in range(400)]
    rows += [(None, "x y", "b"), (3, "same id", "a"), (3, "same id", "a"), (500, None, "z"), (501, "", "z"), (502, "w " * 3000, "d")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int").repartition(5)
    result, pieces = mixing.mix(table, slots=4096)
    got = result.collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(SPACE_WORD.findall(text or ""))
    expected = brute_targets(sizes)
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    # Within a few blocks of three words.
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 18
    assert_taken_by_slots(rows, got, expected, -(-sum(sizes.values()) // 4096), mixing._STEP)
    other, _ = mixing.mix(table, slots=4096, step=1)
    other = other.collect()
    assert_taken_by_slots(rows, other, expected, -(-sum(sizes.values()) // 4096), 1)
    assert Counter(r["taken"] for r in other) != Counter(r["taken"] for r in got)
    again, _ = mixing.mix(table.repartition(2), slots=4096)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))
    # Every prefix of the mix holds the sources close to their shares.
    source_of = {r["row_key"]: r["source"] for r in got}
    assert sum(p["words"] for p in pieces.collect()) == sum(r["taken"] for r in got)
    blocks = Counter()
    total, off = 0, 0.0
    for slot in sorted(pieces.collect(), key=lambda p: p["slot"]):
        blocks[source_of[slot["row_key"]]] += slot["words"]
        total += slot["words"]
        off = max(off, *(abs(blocks[s] - expected[s] * total / sum(expected.values())) for s in expected))
    assert off < 0.02 * sum(expected.values())
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert len(mixing.mix(docs, slots=64)[0].collect()) == len(odd_documents())
    assert mixing.mix(nothing)[0].collect() == []
