"""Benchmark decontamination: a prefix-filtered set join, verified over item-sized windows.

A document holds a window of a benchmark item if it holds all its words in order. So a window needs
one token only to be found: with all of its n tokens required, the necessary prefix of the tokens in
order of rarity has n - n + 1 = 1. The rarest word of each window, by its count in the corpus, is
joined with the words of the documents; the place of the word bounds where the window would have to
begin and end; what is left is compared word by word.

Built-in functions only. Documents are read in place: their words meet the tokens of the benchmark
within the task that reads them, if the benchmark is small enough to send (its size is counted
first), else through a shuffle of the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.tables import stored
from tripflow.llm.words import lower_ascii, row_key

WINDOW = 10
# Rows of benchmark tokens or windows, each under 1 kB, that are sent to every executor.
SENT_ROWS = 200_000
# ASCII characters that are no letters or digits part words; case doesn't matter here.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """Words of a text as written; null has none."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _BETWEEN), "")


def item_windows(items: DataFrame, item_column: str, text_column: str, window: int) -> DataFrame:
    """(item, size, window, words) of every window, lower-cased; short items are one window."""
    words = items.select(
        F.col(item_column).cast("string").alias("item"), item_words(lower_ascii(F.col(text_column).cast("string"))).alias("all")
    ).where(F.size("all") > 0)
    size = F.least(F.size("all"), F.lit(window))
    starts = words.withColumn("size", size).select("item", "size", "all", F.explode(F.sequence(F.lit(1), F.size("all") - F.col("size") + 1)).alias("at"))
    return starts.select("item", "size", F.slice("all", F.col("at"), F.col("size")).alias("words")).withColumn("window", F.array_join("words", " "))


def _sent(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= SENT_ROWS else frame


def find_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(row_key, start, size, window) of every place in ``docs`` (row_key, text) that holds a window."""
    words = docs.select("row_key", item_words(F.col("text")).alias("own"))
    # Full lower case finds all that ASCII lower case finds; the comparison at the end is exact.
    tokens = windows.select(F.explode("words").alias("word")).select(F.lower("word").alias("token")).distinct()
    seen = words.select(F.explode("own").alias("word")).select(F.lower("word").alias("token"))
    counts = stored(seen.join(_sent(tokens), "token").groupBy("token").agg(F.count("*").alias("df")), "token-counts")
    placed = (
        windows.select("window", "size", F.posexplode("words").alias("offset", "word"))
        .withColumn("token", F.lower("word"))
        .join(counts, "token", "left")
    )
    # A window with a word that no document has can't occur.
    rarest = placed.groupBy("window", "size").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token", "offset")).alias("least")
    )
    prefix = stored(
        rarest.where("least.df > 0").select("window", "size", F.col("least.token").alias("token"), F.col("least.offset").alias("offset")),
        "window-prefixes",
    )
    at = words.select("row_key", "own", F.posexplode("own").alias("at", "word")).withColumn("token", F.lower("word"))
    start = F.col("at") - F.col("offset")
    near = at.join(_sent(prefix), "token").where((start >= 0) & (start + F.col("size") <= F.size("own")))
    exact = lower_ascii(F.array_join(F.slice("own", start + 1, F.col("size")), " ")) == F.col("window")
    return near.where(exact).select("row_key", start.alias("start"), "size", "window")


def _covered(found: DataFrame) -> DataFrame:
    """(row_key, n_hit): words under the union of the places."""
    order = Window.partitionBy("row_key").orderBy("start", "size")
    ends = F.max(F.col("start") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("size")
    new = F.greatest(end - F.greatest("start", F.coalesce(ends, F.col("start"))), F.lit(0))
    spans = found.select("row_key", "start", "size").distinct()
    return spans.withColumn("new", new).groupBy("row_key").agg(F.sum("new").cast("long").alias("n_hit"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    window: int = WINDOW,
) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, contaminated) for each row of ``docs``.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z
    lower-cased. ``n_hit`` counts the words inside any occurrence of a window of ``window`` item
    words, or of a whole item that is shorter; ``item_ids`` lists, sorted as strings, the items with
    such windows. Null and empty texts have no words, and items without words no windows. Rows that
    repeat an id are rows of their own; items that repeat an id are one item. Null item ids don't
    appear in the list. Empty tables give no hits, or no rows. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_column).alias("row_id"), F.col(text_column).cast("string").alias("text"),
        row_key(id_column, text_column).alias("row_key"),
    )
    owned = stored(item_windows(items, item_column, "text" if "text" in items.columns else text_column, window), "item-windows")
    windows = owned.select("window", "size", "words").dropDuplicates(["window"])
    found = stored(find_windows(rows.select("row_key", "text"), windows).distinct(), "found-windows")
    owners = owned.select("window", "item").where("item is not null").distinct()
    named = found.select("row_key", "window").distinct().join(owners, "window")
    named = named.select("row_key", "item").distinct().groupBy("row_key").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    hits = _covered(found).join(named, "row_key", "left")
    counted = rows.select("row_id", "row_key", F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    return counted.join(hits, "row_key", "left").select(
        F.col("row_id").alias(id_column),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
