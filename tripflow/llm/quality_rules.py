"""Quality rules: a table of thresholds, compiled into one projection of built-in functions.

The table is data: name, measure, lowest and highest allowed value. ``compile_rules`` turns it into
columns; nothing but Spark expressions is evaluated, in the task that reads the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import let, space_words

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent words of the languages of the corpus.
STOP_WORDS = (
    *"the of and to in is that for it as with was on are by this be at from or an".split(),
    *"der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    *"de la le et les des en un du une que est pour qui dans par sur au pas avec".split(),
    *"el y los las por con del se para es lo su al no".split(),
)


@dataclass(frozen=True)
class Rule:
    """A measure must lie between both bounds; None leaves a side open.

    Texts of fewer than ``min_words`` words are too short for the rule to mean anything.
    """

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    min_words: int = 0


# Production thresholds. Ratios are fractions.
RULES = (
    Rule("mean_word_length", "mean_word_length", 1.5, 15.0),
    Rule("symbols", "symbols_per_word", None, 0.3),
    Rule("capitals", "capital_share", None, 0.6),
    Rule("stop_words", "stop_word_share", 0.02, None, min_words=50),
    Rule("repeated_lines", "dup_line_share", None, 0.5),
)


def _lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _repeat_words(words: Column, window: int) -> Column:
    """Words in windows that occur twice or more, the first occurrence included.

    Windows are hashed to 64 bits. Most texts repeat none. In others the hashes are sorted with their
    places; equal neighbours are repeats. Taken in order, each place adds as many words as it does
    not share with the next.
    """
    none = F.lit(0).cast("long")

    def count(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        hashed = F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(window))))

        def repeats(s: Column) -> Column:
            def is_same(x: Column, i: Column) -> Column:
                return ((i > 0) & (x["h"] == F.get(s, i - 1)["h"])) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))

            return F.sort_array(F.transform(F.filter(s, is_same), lambda x: x["at"]))

        def covered(p: Column) -> Column:
            added = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(window)), F.lit(window)))
            return F.aggregate(added, none, lambda a, x: a + x)

        def distinct_or_sorted(h: Column) -> Column:
            placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(let(let(placed, repeats), covered))

        return F.when(F.size(w) < window, none).otherwise(let(hashed, distinct_or_sorted))

    return count(words)


def _forms(words: tuple[str, ...]) -> list[str]:
    return sorted({form for w in words for form in (w, w.capitalize(), w.upper())})


def measures(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Struct of counts over a text; a null text counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    forms = _forms(stop_words)
    of_words = let(
        space_words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.filter(w, lambda x: x.isin(*forms))).cast("long").alias("n_stop_words"),
            _repeat_words(w, REPEAT_WINDOW).alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        _lines(text),
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")
        ),
    )
    return F.struct(
        of_words.alias("words"),
        of_lines.alias("lines"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )


def _share(a: Column, b: Column) -> Column:
    """A ratio; of nothing it is zero."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def ratios(m: Column) -> dict[str, Column]:
    """The measures that rules can name, over a struct of counts."""
    return {
        "mean_word_length": _share(m["words"]["word_chars"], m["words"]["n_words"]),
        "symbols_per_word": _share(m["n_symbols"], m["words"]["n_words"]),
        "capital_share": _share(m["n_capitals"], m["words"]["word_chars"]),
        "stop_word_share": _share(m["words"]["n_stop_words"], m["words"]["n_words"]),
        "dup_line_share": _share(m["lines"]["n_dup_lines"], m["lines"]["n_lines"]),
    }


def compile_rules(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a struct of counts breaks."""
    known = ratios(m)
    broken = []
    for rule in rules:
        value = known[rule.measure]
        bad = F.lit(False)
        if rule.least is not None:
            bad = bad | (value < rule.least)
        if rule.most is not None:
            bad = bad | (value > rule.most)
        if rule.min_words:
            bad = bad & (m["words"]["n_words"] >= rule.min_words)
        broken.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(F.lit(None).cast("string"), *broken))


def judge(docs: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``docs`` with one more, ``quality``: a struct of counts and verdict.

    ``base_failed`` holds for fewer than 10 words or more than 20 % of words in repeated 5-word
    windows; ``broken`` names the rules of the table that the text breaks; ``kept`` is true where
    neither applies. A null or empty text has no words and fails. Repeated rows are judged alike, an
    empty table stays empty. A column of ``docs`` named ``quality`` is replaced.
    """

    def verdict(m: Column) -> Column:
        w = m["words"]
        failed = (w["n_words"] < MIN_WORDS) | (100 * w["n_repeat_words"] > MAX_REPEAT_PERCENT * w["n_words"])
        counts = [w[c].alias(c) for c in ("n_words", "word_chars", "n_stop_words", "n_repeat_words")]
        counts += [m["lines"][c].alias(c) for c in ("n_lines", "n_dup_lines")]
        counts += [m[c].alias(c) for c in ("n_symbols", "n_capitals")]
        return let(
            F.struct(*counts, failed.alias("base_failed"), compile_rules(m, rules).alias("broken")),
            lambda q: F.struct(
                *(q[c].alias(c) for c in ("n_words", "word_chars", "n_stop_words", "n_repeat_words", "n_lines", "n_dup_lines", "n_symbols", "n_capitals", "base_failed", "broken")),
                (~q["base_failed"] & (F.size(q["broken"]) == 0)).alias("kept"),
            ),
        )

    return docs.withColumn("quality", let(measures(F.col(text_column)), verdict))
