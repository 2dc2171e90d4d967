"""N-gram Jaccard join: the product of the sparse document by n-gram incidence matrix with its
transpose, computed in blocks, overlap counts added up and pairs below their bound discarded.

A row of the matrix is the set of a document's shingles, as 64-bit hashes. Sets of sizes a and b link
from an overlap of ``t / (1 + t) * (a + b)`` on, so a pair is discarded as soon as its count and what
both rows still have in columns not multiplied yet stay below that. Columns with one entry count for
nothing. A merged sketch of all hashes tells which can have several; a row with fewer than ``t * a``
entries there links with nothing and leaves the matrix, as do rows equal to another. The others are
multiplied in blocks of columns:

1. the leading columns of each row, in order of rarity. Two rows that share none of them can't reach
   the bound, so this block yields all pairs there are. A column with many entries is cut into tiles of
   rows, and each pair of tiles is multiplied apart. A task writes a partial count for each column and
   pair; they are summed by pair.
2. all columns, cut into blocks by their hash. For the pairs that are left, one block after the other
   is multiplied and added to the count, leaving out what the first block has counted.

A column with many entries would give all pairs of them. So it is first multiplied with its most
central row alone (the one with the fewest rare columns), and rows linked by that are put into one
component. Only pairs across components are counted after that; within one, more links can't change
the result. Nothing is left out: a column is finished when its rows are one component, and all other
pairs of it are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm import sketch
from tripflow.llm.components import components
from tripflow.llm.tables import stored
from tripflow.llm.words import Texts, groups, mix

SHINGLE = 5
# Similarity as a fraction of whole numbers, so that bounds are exact.
SIMILARITY = (80, 100)
# Joins with one central row per column before all pairs of a column are taken.
CENTRAL_ROUNDS = 2
# Blocks of columns, by hash. A pair of which a ninth or more of either row is missing goes.
COLUMN_BLOCKS = 4
# Rows of a column in a tile, on average.
TILE_ROWS = 256

_ROWS = "n long, c1 long, c2 long, grams array<long>"


def _sets(batch: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a group of texts: text and hash of each, ascending."""
    texts = Texts(batch.column("text"), lower=True)
    start, text, length = texts.windows(shingle, whole_if_shorter=True)
    hashes = texts.hashes(start, length)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def _sketcher(shingle: int, bits: int):
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sketch.TaskSketch(bits)
        for batch in groups(batches):
            yield from own.add(_sets(batch, shingle)[1])
        yield own.flush()

    return sketched


def _rows(shingle: int, bits: int, similarity: tuple[int, int], shared):
    """Rows of the matrix. ``grams`` holds the columns that may have several entries, or null where
    there are too few of them for any link."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = sketch.merged_bits(shared, bits)
        for batch in groups(batches):
            text, hashes = _sets(batch, shingle)
            rows = batch.num_rows
            n = np.bincount(text, minlength=rows)
            first = np.concatenate(([0], np.cumsum(n)))
            # A set's class: two sums over its hashes.
            sums = []
            for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64)))
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            many = sketch.repeated(hashes, merged, bits)
            left = np.bincount(text[many], minlength=rows)
            fit = (similarity[1] * left >= similarity[0] * n) & (n > 0)
            keep = many & fit[text]
            offsets = np.concatenate(([0], np.cumsum(np.where(fit, left, 0)))).astype(np.int32)
            grams = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(hashes[keep].view(np.int64)), mask=pa.array(~fit)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array(n.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), grams],
                names=["row_id", "n", "c1", "c2", "grams"],
            )

    return made


def _bound(a: Column | str, b: Column | str, overlap: Column | str, similarity: tuple[int, int]) -> Column:
    """Whether an overlap of sets of these sizes reaches the similarity."""
    a, b, overlap = (F.col(x) if isinstance(x, str) else x for x in (a, b, overlap))
    return (similarity[0] + similarity[1]) * overlap >= similarity[0] * (a + b)


def _matrix(rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """One row per set: (r, n, u, lead, short, heads, g0, p0, q0, g1, ...).

    u: entries in columns of one entry. heads: (df, gram) of the ``lead`` leading columns, in order of
    rarity. Among the first ``short`` of them a match must be if the other set is no smaller. gK: the
    row's columns in block K, in order of rarity, the first pK and qK of them among ``short`` and ``lead``.
    """
    low, high = similarity
    distinct = (
        rows.where("grams is not null")
        .groupBy("c1", "c2")
        .agg(F.any_value("n").alias("n"), F.any_value("grams").alias("grams"))
    )
    distinct = stored(distinct.select(F.col("c1").alias("r"), "n", "grams"), "ngram-sets")
    entries = distinct.select("r", "n", F.explode("grams").alias("gram"))
    frequent = entries.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    ordered = (
        entries.join(frequent, "gram")
        .groupBy("r")
        .agg(F.any_value("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("columns"))
        .where(high * F.size("columns") >= low * F.col("n"))
        .withColumn("u", F.col("n") - F.size("columns"))
    )
    lead = F.col("n") - F.ceil(low * F.col("n") / high) + 1 - F.col("u")
    short = F.col("n") - F.ceil(2 * low * F.col("n") / (low + high)) + 1 - F.col("u")
    ordered = ordered.select(
        "r", "n", "u", F.greatest(lead, F.lit(0)).cast("int").alias("lead"), F.greatest(short, F.lit(0)).cast("int").alias("short"),
        F.col("columns.gram").alias("grams"), "columns",
    )
    ordered = ordered.withColumn("heads", F.slice("columns", F.lit(1), F.col("lead"))).drop("columns")
    for k in range(COLUMN_BLOCKS):
        ordered = (
            ordered.withColumn(f"g{k}", _in_block(F.col("grams"), k))
            .withColumn(f"p{k}", F.size(_in_block(F.slice("grams", F.lit(1), F.col("short")), k)))
            .withColumn(f"q{k}", F.size(_in_block(F.slice("grams", F.lit(1), F.col("lead")), k)))
        )
    return stored(ordered.drop("grams"), "ngram-matrix")


def _in_block(grams: Column, block: int) -> Column:
    return F.filter(grams, lambda g: F.pmod(g, F.lit(COLUMN_BLOCKS)) == block)


def _leading(matrix: DataFrame) -> DataFrame:
    """Entries in the leading columns: (gram, tiles, tile, r, n, u, at, lead, short, lastlead, lastshort).

    ``at`` is the place of the column among those of the row, counted from 0 in order of rarity; the
    last leading and the last short column are given as (df, gram). A column's rows lie in ``tiles`` tiles.
    """
    last = {name: F.when(F.col(name) > 0, F.get("heads", F.col(name) - 1)).alias(f"last{name}") for name in ("lead", "short")}
    entries = matrix.where("lead > 0").select(
        "r", "n", "u", "lead", "short", *last.values(), F.posexplode("heads").alias("at", "head")
    )
    tiles = F.floor(F.col("head.df") / TILE_ROWS) + 1
    return entries.select(
        F.col("head.gram").alias("gram"), tiles.alias("tiles"), F.pmod(F.xxhash64(F.lit("tile"), "r"), tiles).alias("tile"),
        "r", "n", "u", "at", "lead", "short", "lastlead", "lastshort",
    )


def _in_all_tiles(frame: DataFrame, name: str = "tile") -> DataFrame:
    """A row for each tile of its column."""
    return frame.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))


def _multiplied(matrix: DataFrame, pairs: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of rows whose full count reaches the bound, block after block.

    ``pairs``: (a, b, na, nb, seen, cut, lefta, leftb). ``seen`` is what is counted already: nothing
    (cut 0), or all columns up to the last short one of a (1), or up to the last leading one of b (2).
    ``lefta`` and ``leftb`` bound what the rows still have.
    """
    for k in range(COLUMN_BLOCKS):
        sides = {
            "a": F.when(F.col("cut") == 1, F.col("pa")).otherwise(0),
            "b": F.when(F.col("cut") == 2, F.col("qb")).otherwise(0),
        }
        # The side that the last block ended with comes first: pairs are dealt out by it already.
        for side in ("ab", "ba")[k % 2]:
            block = matrix.select(F.col("r").alias(side), *(F.col(f"{x}{k}").alias(f"{x}{side}") for x in "gpq"))
            pairs = pairs.join(block, side)
        for side, skip in sides.items():
            whole = F.col(f"g{side}")
            pairs = pairs.withColumn(f"g{side}", F.when(skip > 0, F.slice(whole, skip + 1, F.size(whole))).otherwise(whole))
        pairs = pairs.select(
            "a", "b", "na", "nb", (F.col("seen") + F.size(F.array_intersect("ga", "gb"))).alias("seen"), "cut",
            (F.col("lefta") - F.size("ga")).alias("lefta"), (F.col("leftb") - F.size("gb")).alias("leftb"),
        ).where(_bound("na", "nb", F.col("seen") + F.least("lefta", "leftb"), similarity))
    return pairs.select("a", "b")


def _near(similarity: tuple[int, int]) -> Column:
    """Sizes, and places of a shared column, that allow a link: rows can share no more than what both
    have before the column, and what both have from there on."""
    after = F.least(*(F.col(f"n{s}") - F.col(f"u{s}") - F.col(f"at{s}") for s in "ab"))
    sizes = similarity[0] * F.greatest("na", "nb") <= similarity[1] * F.least("na", "nb")
    return sizes & _bound("na", "nb", F.least("ata", "atb") + after, similarity)


def _named(entries: DataFrame, side: str, *keys: str) -> DataFrame:
    return entries.select(*(F.col(c) if c in keys else F.col(c).alias(f"{c}{side}") for c in entries.columns))


def _left(side: str) -> Column:
    return (F.col(f"n{side}") - F.col(f"u{side}")).alias(f"left{side}")


def _central_pairs(entries: DataFrame, similarity: tuple[int, int], turn: int) -> DataFrame:
    """Rows of a column with one row of it, if they are in different components: first the most
    central one, later another each turn."""
    slim = entries.select("gram", "tiles", "tile", "r", "n", "u", "at", "c")
    rank = F.col("u") if turn == 0 else F.xxhash64("r", F.lit(turn))
    central = slim.groupBy("gram", "tiles").agg(F.min(F.struct(rank.alias("rank"), "r", "n", "u", "at", "c")).alias("m"))
    central = _in_all_tiles(central.select("gram", "tiles", *(F.col(f"m.{x}").alias(f"{x}a") for x in ("r", "n", "u", "at", "c"))))
    met = _named(slim.drop("tiles"), "b", "gram", "tile").join(central.drop("tiles"), ["gram", "tile"])
    met = met.where(_near(similarity) & (F.col("ca") != F.col("cb")))
    one = F.lit(0)
    return met.select(
        F.col("ra").alias("a"), F.col("rb").alias("b"), "na", "nb", one.alias("seen"), one.alias("cut"), _left("a"), _left("b")
    ).distinct()


def _leading_pairs(entries: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The block of leading columns: tiles of rows multiplied with tiles of rows, counts summed by pair
    of rows in different components, without pairs that can't reach the bound.

    Counted are the short columns of the smaller row that lead in the larger one. That covers all
    that both share up to the last short column of the one or the last leading one of the other,
    whichever is rarer. A partial count that places already rule out is not written: a pair that links
    has none.
    """
    one = _named(_in_all_tiles(entries.where("at < short").drop("lastlead", "lead"), "other"), "a", "gram", "tile", "other")
    two = _in_all_tiles(entries.drop("lastshort", "short").withColumnRenamed("tile", "other"))
    two = _named(two, "b", "gram", "tile", "other")
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ra") < F.col("rb")))
    met = one.join(two, ["gram", "tile", "other"]).where(smaller & (F.col("ca") != F.col("cb")) & _near(similarity))
    cut = F.when(F.col("lastshorta") <= F.col("lastleadb"), 1).otherwise(2)
    counted = met.groupBy(F.col("ra").alias("a"), F.col("rb").alias("b")).agg(
        F.count("*").cast("int").alias("seen"),
        *(F.any_value(x).alias(x) for x in ("na", "nb")),
        F.any_value(cut).alias("cut"),
        F.any_value(F.col("na") - F.col("ua") - F.when(cut == 1, F.col("shorta")).otherwise(0)).alias("lefta"),
        F.any_value(F.col("nb") - F.col("ub") - F.when(cut == 2, F.col("leadb")).otherwise(0)).alias("leftb"),
    )
    possible = _bound("na", "nb", F.col("seen") + F.least("lefta", "leftb"), similarity)
    return counted.where(possible).select("a", "b", "na", "nb", "seen", "cut", "lefta", "leftb")


def _unfinished(entries: DataFrame) -> DataFrame:
    """Entries of columns whose rows are not one component yet."""
    open_ = entries.groupBy("gram", "tiles").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y")
    return entries.join(_in_all_tiles(open_.select("gram", "tiles")).drop("tiles"), ["gram", "tile"], "left_semi")


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    return entries.drop("c").join(labels, "r", "left").withColumn("c", F.coalesce("c", "r"))


def ngram_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: tuple[int, int] = SIMILARITY,
    bits: int = sketch.DEFAULT_BITS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: its class under links of similar sets.

    Words are runs of other characters than ASCII spaces, A-Z lower-cased. A set holds the distinct
    shingles of ``shingle`` words, or the whole sequence if there are fewer; without words (null or
    empty text) it is empty and linked with nothing, and the row is its own class. Rows that repeat
    an id are rows of their own, in one class if their sets are alike or through links. A class is
    named by its smallest id that is not null, by null if it has none. An empty table gives an empty
    result. Columns besides id and text are not read. Ids are long, or strings.
    """
    spark = docs.sparkSession
    id_type = "string" if dict(docs.dtypes)[id_column] == "string" else "long"
    rows = docs.select(
        F.col(id_column).cast(id_type).alias("row_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    merged = sketch.merge(rows.select("text").mapInArrow(_sketcher(shingle, bits), sketch.SKETCH_SCHEMA), bits)
    shared = spark.sparkContext.broadcast(merged)
    del merged
    rows = stored(rows.mapInArrow(_rows(shingle, bits, similarity, shared), f"row_id {id_type}, {_ROWS}"), "ngram-rows")
    shared.unpersist()
    matrix = _matrix(rows, similarity)
    entries = stored(_leading(matrix), "ngram-leading").withColumn("c", F.col("r"))
    labels = None
    for turn in range(CENTRAL_ROUNDS + 1):
        pairs = _central_pairs(entries, similarity, turn) if turn < CENTRAL_ROUNDS else _leading_pairs(entries, similarity)
        found = stored(_multiplied(matrix, pairs, similarity), "ngram-links")
        if labels is None or not found.isEmpty():
            # Components so far stand for the links they came from.
            links = found if labels is None else found.union(labels.where("r <> c"))
            labels = stored(components(links).select(F.col("node").alias("r"), F.col("component").alias("c")), "ngram-labels")
            entries = stored(_unfinished(_labelled(entries, labels)), "ngram-open")
    # Equal sets are one class: named through their sums, then through the links of their row.
    sets = rows.where("n > 0").groupBy("c1", "c2").agg(F.min("row_id").alias("least")).withColumn("r", F.col("c1"))
    named = sets.join(labels, "r", "left").withColumn("c", F.coalesce("c", "r"))
    tops = named.groupBy("c").agg(F.min("least").alias("component_id"))
    classes = named.join(tops, "c").select("c1", "c2", "component_id", F.lit(True).alias("has"))
    empty = F.col("n") == 0
    joined = rows.drop("grams").join(classes, ["c1", "c2"], "left")
    return joined.select(
        F.col("row_id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("row_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
