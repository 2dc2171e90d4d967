"""Personal data by fixed shapes, and by contexts learned from them (bootstrapping).

Spans of four fixed shapes are the seeds. What stands around a seed gives lexical patterns: the word
to its left, the two words to its left, the word to its right. Patterns and the identifiers they
surround make a bipartite graph, built and scored by Spark in rounds: a pattern is trusted for a kind
by the share of its distinct identifiers that are known to be of it, an identifier by the best trusted
pattern around it; identifiers accepted in a round count as known in the next. Rounds end when none
adds an identifier, and so no pattern either. Identifiers of no fixed shape that stand in a pattern
trusted at the end are new spans.

Patterns are aggregates, so a context or an identifier that a third of all texts hold is one row.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.tables import stored
from tripflow.llm.words import groups, row_key

KINDS = ("email", "ip", "card", "phone")
# A pattern is trusted with so many distinct known identifiers and such a share of known ones.
MIN_SEEDS, MIN_TRUST = 5, 0.8

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]+")
_DIGIT = re.compile("[0-9]")
_OUTER = "\"'()[]{}<>,;:!?.*#$%&|"
# What plain words of letters may hold inside; any other token could be an identifier.
_JOINS = str.maketrans("", "", "-'\u2019")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses. A local part holds no @, so each @ decides one match."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, match.end()))
            free = match.end()
        else:
            # What this run could not start, nothing right of it can before the @.
            free = at + 1
        at = text.find("@", free)
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def seeds(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed shapes, by start, then kind."""
    found = [("email", *x) for x in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _digits(m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _bare(word: str) -> str:
    return word.strip(_OUTER).lower()


def _patterns(text: str, words: list[tuple[int, int]], start: int, end: int) -> list[str]:
    """Patterns around a place: one and two words to the left, one to the right, without outer
    punctuation. Words of nothing else are passed over; ``words`` are the places of all words."""
    out: list[str] = []
    left: list[str] = []
    at = bisect_left(words, (start, 0)) - 1
    while at >= 0 and len(left) < 2:
        if word := _bare(text[words[at][0] : min(words[at][1], start)]):
            left.insert(0, word)
            out.append(f"{len(left)} {' '.join(left)}")
        at -= 1
    at = max(bisect_left(words, (end, 0)) - 1, 0)
    while at < len(words):
        if word := _bare(text[max(words[at][0], end) : words[at][1]]):
            out.append(f"> {word}")
            break
        at += 1
    return out


def _could_be_identifier(token: str) -> bool:
    return bool(token) and not (token.isalpha() or token.translate(_JOINS).isalpha())


def mentions(text: str, known: list[tuple[str, int, int]]) -> Iterator[tuple[str | None, int, int, list[str], str]]:
    """(kind, start, end, patterns, value) of seeds and of other tokens that could be identifiers:
    all that aren't plain words."""
    words = [m.span() for m in _WORD.finditer(text)]
    for kind, start, end in known:
        if patterns := _patterns(text, words, start, end):
            yield kind, start, end, patterns, text[start:end].lower()
    spans = sorted((s, e) for _, s, e in known)
    taken, at = 0, 0
    for start, end in words:
        while at < len(spans) and spans[at][0] < end:
            taken = max(taken, spans[at][1])
            at += 1
        if start < taken or (token := text[start:end]).isalpha():
            continue
        inner = token.strip(_OUTER)
        if _could_be_identifier(inner):
            start += token.index(inner)
            if patterns := _patterns(text, words, start, start + len(inner)):
                yield None, start, start + len(inner), patterns, inner.lower()


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches):
        rows = [seeds(t) if t else [] for t in batch.column("text").to_pylist()]
        spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in rows], pa.list_(_SPAN))
        yield pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("row_key"), spans], names=["row_id", "row_key", "base"])


def _mention_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups(batches):
        out: list[tuple] = []
        for key, text in zip(batch.column("row_key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if text:
                out += [(key, *x) for x in mentions(text, seeds(text))]
        columns = list(zip(*out, strict=True)) or [()] * 6
        types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["row_key", "kind", "start", "end", "patterns", "value"]
        )


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_SPANS = "array<struct<kind:string,start:int,end:int>>"


def trusted_patterns(edges: DataFrame, rounds: int | None, min_seeds: int, min_trust: float) -> DataFrame:
    """(context, kind, trust) of the patterns trusted once no round adds an identifier, or after
    ``rounds`` if given.

    ``edges`` has (context, value, kind), distinct, kind null for identifiers that are not seeds.
    Known identifiers only become more, and with them trusted patterns, so the rounds end.
    """
    known = edges.where("kind is not null").select("value", "kind").distinct()
    plain = edges.select("context", "value").distinct()
    totals = plain.groupBy("context").agg(F.count("*").alias("total"))
    turn = 0
    while True:
        turn += 1
        sure = plain.join(known, "value").groupBy("context", "kind").agg(F.count("*").alias("sure"))
        scored = sure.where(F.col("sure") >= min_seeds).join(totals, "context")
        trusted = stored(scored.withColumn("trust", F.col("sure") / F.col("total")).where(F.col("trust") >= min_trust).select("context", "kind", "trust"), "pii-patterns")
        if turn == rounds or trusted.isEmpty():
            return trusted
        # The best pattern around an identifier decides its kind.
        new = plain.join(trusted, "context").groupBy("value").agg(F.max(F.struct("trust", "kind")).alias("best"))
        new = stored(new.select("value", F.col("best.kind").alias("kind")).join(known.select("value").distinct(), "value", "left_anti"), "pii-new")
        if new.isEmpty():
            return trusted
        known = stored(known.union(new), "pii-known")


def find_pii(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int | None = None,
    min_seeds: int = MIN_SEEDS,
    min_trust: float = MIN_TRUST,
) -> DataFrame:
    """(doc_id, row_key, base, spans) for each row: seeds, and seeds with what patterns reveal.

    Spans are structs (kind, start, end) in characters, end exclusive, by start, then kind. Seeds are
    the leftmost non-overlapping matches of each kind that pass its check. Null and empty texts have
    none. Rows that repeat an id are rows of their own; an identifier that many rows repeat counts
    once for each of its patterns. An empty table gives an empty result. Columns besides id and text are not
    read. ``row_key`` is 128 bits of id and text.
    """
    rows = docs.select(
        F.col(id_column).alias("row_id"), row_key(id_column, text_column).alias("row_key"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    id_type = dict(rows.dtypes)["row_id"]
    places = rows.mapInArrow(_mention_rows, "row_key string, kind string, start int, end int, patterns array<string>, value string")
    places = stored(places, "pii-mentions")
    edges = stored(places.select(F.explode("patterns").alias("context"), "value", "kind").distinct(), "pii-edges")
    patterns = trusted_patterns(edges, rounds, min_seeds, min_trust)
    # Of all trusted patterns around a place the best names it.
    around = places.where("kind is null").select("row_key", "start", "end", F.explode("patterns").alias("context"))
    best = around.join(patterns, "context").groupBy("row_key", "start", "end").agg(F.max(F.struct("trust", "kind")).alias("best"))
    new = best.select("row_key", F.struct(F.col("best.kind").alias("kind"), "start", "end").alias("span"))
    new = new.groupBy("row_key").agg(F.collect_set("span").alias("revealed"))
    base = rows.mapInArrow(_seed_rows, f"row_id {id_type}, row_key string, base {_SPANS}")
    rank = {k: i for i, k in enumerate(KINDS)}
    number = F.create_map(*(F.lit(x) for kv in rank.items() for x in kv))
    both = F.array_sort(
        F.transform(F.concat("base", "revealed"), lambda s: F.struct(s["start"].alias("start"), number[s["kind"]].alias("no"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    spans = F.transform(both, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return base.join(new, "row_key", "left").select(
        F.col("row_id").alias(id_column), "row_key", "base",
        F.when(F.col("revealed").isNull(), F.col("base")).otherwise(spans).alias("spans"),
    )


def redact(text: str | None, spans: list[dict]) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first
    names the whole."""
    if text is None or not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]["kind"], spans[i]["start"], spans[i]["end"]
        i += 1
        while i < len(spans) and spans[i]["start"] < end:
            end = max(end, spans[i]["end"])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])
