"""Secrets in texts: keywords by an Aho-Corasick automaton, expressions only where one was hit.

One pass of the automaton over the lower-cased text finds all keywords of all rules at once. Each
rule's expression is tried only at its keyword's place, anchored there, so a text without keywords
costs one pass. Tokens that carry a checksum are validated by it. Long runs of hexadecimal digits
have no keyword; they are found by one linear expression.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import LOWER, UPPER, groups

KINDS = ("assign", "access", "hex", "checked")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

# The 62 digits, and prefixes of access tokens that end in a checksum.
_DIGITS62 = "0123456789" + UPPER + LOWER
_CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
_CHECKED = re.compile(r"(?:gh[pousr]_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")


@dataclass(frozen=True)
class Rule:
    """Keywords in lower case, the expression tried where they begin, and the test of a match."""

    kind: str
    keywords: tuple[str, ...]
    expression: re.Pattern
    accept: object


def base62(number: int, width: int) -> str:
    out = ""
    for _ in range(width):
        number, rest = divmod(number, 62)
        out = _DIGITS62[rest] + out
    return out


def checksum_holds(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the thirty before them."""
    return base62(zlib.crc32(match[1].encode()), 6) == match[2]


RULES = (
    Rule("assign", ("password", "passwd", "secret", "token", "api_key", "apikey"), _ASSIGN, lambda m: len(m[1]) >= MIN_VALUE),
    Rule("access", ("akia",), _ACCESS, lambda m: len(m[0]) >= MIN_ACCESS),
    Rule("checked", _CHECKED_PREFIXES, _CHECKED, checksum_holds),
)

_TO_LOWER = str.maketrans(UPPER, LOWER)


class Scanner:
    """The automaton of all rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.automaton = ahocorasick.Automaton()
        for no, rule in enumerate(rules):
            for word in rule.keywords:
                self.automaton.add_word(word, (no, len(word)))
        self.automaton.make_automaton()

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) of each rule's leftmost non-overlapping matches, by start, then kind.

        A match that fails its test is used up all the same.
        """
        lower = text.lower()
        if len(lower) != len(text):
            # A letter whose lower case is longer would shift all places.
            lower = text.translate(_TO_LOWER)
        found, free = [], [0] * len(self.rules)
        # Keywords of one rule that end in order may begin out of order only if nested; these aren't.
        for end, (no, length) in self.automaton.iter(lower):
            start = end - length + 1
            if start < free[no]:
                continue
            match = self.rules[no].expression.match(text, start)
            if match:
                free[no] = match.end()
                if self.rules[no].accept(match):
                    found.append((self.rules[no].kind, start, match.end()))
        found += [("hex", *m.span()) for m in _HEX.finditer(text)]
        return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    for batch in groups(batches):
        found = [scanner.scan(t) if t else [] for t in batch.column("text").to_pylist()]
        spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in found], pa.list_(_SPAN))
        yield pa.RecordBatch.from_arrays([batch.column("row_id"), spans], names=["row_id", "spans"])


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans) for each row: structs (kind, start, end) in characters, end exclusive.

    Kinds: ``assign`` (a named value of 8 characters or more), ``access`` (key ids of 16 or more),
    ``hex`` (32 digits or more), ``checked`` (tokens whose checksum holds). Null and empty texts have
    none. Repeated rows are scanned alike, null ids stay null, an empty table gives an empty result.
    Columns besides id and text are not read. Each row is scanned where it is read.
    """
    rows = docs.select(F.col(id_column).alias("row_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    id_type = dict(rows.dtypes)["row_id"]
    found = rows.mapInArrow(_rows, f"row_id {id_type}, spans array<struct<kind:string,start:int,end:int>>")
    return found.withColumnRenamed("row_id", id_column)
