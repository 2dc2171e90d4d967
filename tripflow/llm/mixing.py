"""Mixing sources to target weights along a low-discrepancy schedule.

The mix is a row of slots, each filled with one block of equally many words. Slot k stands at the
fractional part of k times the golden ratio, an integer sequence here, and belongs to the source
whose share of the cumulative targets covers that point; so every stretch of the mix holds the
sources close to their shares. The slots of a source are ranked, and the slot of rank r takes block
r of the source's stream: its documents in an order shuffled by a hash, one after another, as often
as needed, at most three times. What a source gives is what its slots ask for: its target but for the
few slots by which the sequence strays from the shares, and never more than three readings.

The corpus is cut into a million blocks at most, which grow with it. Places of documents in a stream
come from sums over hash buckets, then within a bucket, so no task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.tables import stored
from tripflow.llm.words import row_key

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
# Blocks the corpus is cut into at most.
SLOTS = 1 << 20
# 2**32 over the golden ratio: multiples modulo 2**32 are the points.
_STEP, _TURN = 2654435769, 1 << 32
_CELLS = 4096
_CHUNK = 4096
_SENT_ROWS = 100_000
_SPACE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(_SPACE)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, no, source_size, target) from rows of (source, size).

    Weights repeat over the sources in code point order, null last. The targets share the sum of all
    sizes by weight; one stops at ``repeats`` times the size of its source and what is over is shared
    again. So a target is the smaller of its cap and its weight times one level, and the level
    follows from the sources in order of cap by weight: those before the first that isn't capped.
    """
    sizes = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    ranked = sizes.withColumn("no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.get(F.array(*(F.lit(w) for w in weights)), F.col("no") % len(weights))
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", repeats * F.col("source_size"))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("no").asc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        ranked.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(order), F.lit(0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0)))
        .withColumn("free", F.col("left") * F.col("weight") <= F.col("cap") * F.col("open"))
    )
    level = F.min(F.when(F.col("free"), F.struct((F.col("cap") / F.col("weight")).alias("o"), "no", "left", "open"))).over(everything)
    found = levels.withColumn("level", level)
    # A source stays uncapped from the first that is.
    shared = (F.col("level.left") * F.col("weight")).cast("double") / F.col("level.open")
    capped = F.col("level").isNull() | (F.struct((F.col("cap") / F.col("weight")).alias("o"), "no") < F.struct(F.col("level.o").alias("o"), F.col("level.no").alias("no")))
    return found.select("source", "no", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(shared).alias("target"))


def schedule(plan: DataFrame, slots: int, step: int = _STEP) -> DataFrame:
    """(slot, no, rank): which source each slot belongs to and how many slots of it came before.

    ``plan`` has (no, target); slot k stands at ``k * step`` modulo 2**32.
    """
    spark = plan.sparkSession
    total = F.sum("target").over(Window.partitionBy())
    upto = F.sum("target").over(Window.orderBy("no"))
    arcs = plan.select(
        "no",
        F.when(total > 0, F.floor((upto - F.col("target")) / total * _TURN)).otherwise(F.lit(0)).cast("long").alias("low"),
        F.when(total > 0, F.floor(upto / total * _TURN)).otherwise(F.lit(0)).cast("long").alias("high"),
    )
    # Neighbouring arcs share their bound exactly.
    arcs = arcs.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("no")), F.lit(0).cast("long"))).where("low < high")
    width = _TURN // _CELLS
    cells = arcs.select("no", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"))
    points = spark.range(slots).select(F.col("id").alias("slot"), F.expr(f"id * {step}L % {_TURN}L").alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") / width))
    owned = points.join(cells, "cell").where("low <= point and point < high").select("slot", "no", F.floor(F.col("slot") / _CHUNK).alias("chunk"))
    owned = stored(owned, "slots")
    before = Window.partitionBy("no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = owned.groupBy("no", "chunk").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranked = owned.join(chunks, ["no", "chunk"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("no", "chunk").orderBy("slot")) - 1)
    return ranked.select("slot", "no", "rank")


def _streamed(sized: DataFrame) -> DataFrame:
    """Adds ``start``: words of the source's stream before the row, or before the first of its copies."""
    keyed = sized.withColumn("order", F.md5(F.concat(F.lit("mix/"), F.col("row_key"))))
    keyed = keyed.withColumn("head", F.substring("order", 1, 2)).withColumn("bucket", F.substring("order", 1, 4))
    words = F.col("size") * F.col("copies")
    # A source's sums are taken over 256 heads, a head's over 256 buckets.
    before = Window.partitionBy("no").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    heads = keyed.groupBy("no", "head").agg(F.sum(words).alias("n")).select("no", "head", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("h"))
    before = Window.partitionBy("no", "head").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = keyed.groupBy("no", "head", "bucket").agg(F.sum(words).alias("n")).select("no", "head", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("b"))
    within = Window.partitionBy("no", "bucket").orderBy("order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keyed.join(buckets, ["no", "head", "bucket"]).join(heads, ["no", "head"])
    return placed.withColumn("start", F.col("h") + F.col("b") + F.sum(words).over(within) - words).drop("order", "head", "bucket", "h", "b")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = MAX_REPEATS,
    slots: int = SLOTS,
    step: int = _STEP,
) -> tuple[DataFrame, DataFrame]:
    """The documents with what the mix takes of each, and the pieces the mix is made of.

    First (row_key, doc_id, source, size, source_size, target, taken, first_slot, n_pieces) for each
    row: a size counts words, runs of other characters than ASCII spaces, over texts of any length;
    null and empty texts have none and are taken zero times. ``taken`` adds up the row's words in all
    slots, ``first_slot`` is the first of them, null if there is none. Then (slot, row_key, epoch, skip,
    words): the words of a document in a slot, which reads the slot's pieces by epoch and stream. Null
    sources are one source, the last. Rows that repeat an id stand side by side, told apart by their
    text; fully equal rows lie one after another in the stream, and each gets one of the results. Columns
    of other names aren't read. An empty table gives empty results. ``row_key`` hashes id and text, so
    the texts can be joined. Reruns agree. Sources are ranked in one task, a row each.
    """
    rows = docs.select(
        F.col(id_column).alias("row_id"), F.col(source_column).alias("source"), row_key(id_column, text_column).alias("row_key"), word_count(F.col(text_column)).alias("size")
    )
    # Equal rows travel as one.
    sized = stored(rows.groupBy("row_id", "source", "row_key", "size").agg(F.count("*").alias("copies")), "mix-sizes")
    plan = targets(sized.select("source", (F.col("size") * F.col("copies")).alias("size")), weights, repeats)
    total = plan.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    block = max(-(-total // slots), 1)
    timetable = stored(schedule(plan.select("no", "target"), -(-total // block), step), "mix-slots")
    given = timetable.groupBy("no").agg(F.count("*").alias("given"))
    asked = F.least(F.coalesce("given", F.lit(0)) * block, repeats * F.col("source_size"))
    plan = stored(plan.join(given, "no", "left").withColumn("words", asked).drop("given"), "mix-plan")
    known = F.broadcast(plan) if plan.count() <= _SENT_ROWS else plan
    placed = _streamed(sized.join(known, sized["source"].eqNullSafe(plan["source"])).drop(plan["source"]))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    placed = placed.select("*", copies.alias("copy")).withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    placed = stored(placed.drop("copies", "copy"), "mix-places")
    # Every reading of a document that begins before the end of its source's last slot, and the blocks it lies in.
    readings = placed.where("size > 0").select("*", F.explode(F.array(*(F.lit(e) for e in range(repeats)))).alias("epoch"))
    readings = readings.withColumn("from", F.col("start") + F.col("epoch") * F.col("source_size"))
    readings = readings.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("words"))).where("from < to")
    pieces = readings.select(
        "row_key", "no", "start", "epoch", "from", "to",
        F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))).alias("rank"),
    )
    begin, end = F.greatest("from", F.col("rank") * block), F.least("to", (F.col("rank") + 1) * block)
    used = pieces.join(timetable, ["no", "rank"]).select(
        "slot", "row_key", "no", "start", "epoch", (begin - F.col("from")).alias("skip"), (end - begin).alias("words")
    )
    # Rows with words have places of their own in the stream, equal rows too.
    sums = used.groupBy("no", "start").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_pieces"))
    # Rows without words may stand at the same place.
    joined = placed.withColumn("at", F.when(F.col("size") > 0, F.col("start"))).join(sums.withColumnRenamed("start", "at"), ["no", "at"], "left")
    result = joined.select(
        "row_key", F.col("row_id").alias(id_column), F.col("source").alias(source_column), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", F.coalesce("n_pieces", F.lit(0)).cast("long").alias("n_pieces"),
    )
    return result, used.drop("no", "start")
