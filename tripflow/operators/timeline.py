"""Ordered scans over long histories of single keys.

A window over one key's whole history would put a busy key into one task. Here
the rows are dealt out by ranges of (key, time), so a busy key spreads over as
many pieces as its share of the rows asks for. Windows run inside each piece
and then over one summary row per key and piece: a prefix scan over the pieces.
The largest group is a piece, or the number of pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripflow.session import fresh_dir


def in_pieces(frame: DataFrame, *order: str) -> DataFrame:
    """The rows with ``_piece``: the number of the range of ``order`` they lie in, rising with it.

    Written to the shared folder, because bounds of ranges come from samples: a second
    evaluation could draw others. Rows equal in ``order`` share a piece.
    """
    placed = frame.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id())
    path = fresh_dir(frame.sparkSession, "timeline")
    placed.write.parquet(path)
    return frame.sparkSession.read.schema(placed.schema).parquet(path)


def value_periods(frame: DataFrame, key: str, value: str, time: str, tie: str) -> DataFrame:
    """Runs of an unchanged value per key: key, value, valid_from, valid_to."""
    rows = frame.select(key, value, F.col(time).alias("_t"), F.col(tie).alias("_tie"))
    cut = in_pieces(rows, key, "_t", "_tie")
    inside = Window.partitionBy(key, "_piece").orderBy("_t", "_tie")
    # Inside a piece only rows that differ from the one before matter.
    changes = cut.withColumn("_row", F.row_number().over(inside)).withColumn(
        "_before", F.lag(value).over(inside)
    ).filter((F.col("_row") == 1) | ~F.col(value).eqNullSafe(F.col("_before")))

    # Summary: the value each piece ends with, seen from the next piece.
    last_value = F.max_by(value, F.struct("_t", "_tie"))
    pieces = changes.groupBy(key, "_piece").agg(last_value.alias("_last"))
    order = Window.partitionBy(key).orderBy("_piece")
    pieces = pieces.select(
        key, "_piece",
        F.lag("_last").over(order).alias("_carried"),
        F.row_number().over(order).alias("_nth"),
    )
    starts = changes.join(pieces, [key, "_piece"]).filter(
        (F.col("_row") > 1)
        | (F.col("_nth") == 1)
        | ~F.col(value).eqNullSafe(F.col("_carried"))
    )

    # End of a run: the next start in the piece, else the first start of a later piece.
    # Starts at one instant follow their tie column, so a run may have no length.
    within = Window.partitionBy(key, "_piece").orderBy("_t", "_tie")
    starts = starts.withColumn("_next", F.lead("_t").over(within))
    heads = starts.groupBy(key, "_piece").agg(F.min("_t").alias("_head"))
    heads = heads.select(key, "_piece", F.lead("_head").over(order).alias("_later"))
    return starts.join(heads, [key, "_piece"]).select(
        key, value,
        F.col("_t").alias("valid_from"),
        F.coalesce("_next", "_later").alias("valid_to"),
    )


def running_before(frame: DataFrame, key: str, time: str, amounts: dict[str, str]) -> DataFrame:
    """Adds, for each amount, its sum over the key's strictly earlier rows.

    ``amounts`` maps a result name to a numeric column. Rows at the same time
    do not count one another; a piece holds all rows of a key at one time.
    """
    cut = in_pieces(frame, key, time).withColumn("_us", F.unix_micros(time))
    totals = cut.groupBy(key, "_piece").agg(
        *[F.sum(column).alias(f"_sum_{name}") for name, column in amounts.items()]
    )
    earlier_pieces = (
        Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        key, "_piece",
        *[F.sum(f"_sum_{name}").over(earlier_pieces).alias(f"_carry_{name}") for name in amounts],
    )
    earlier_rows = (
        Window.partitionBy(key, "_piece").orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    )
    inside = cut.select(
        "*", *[F.sum(column).over(earlier_rows).alias(f"_in_{n}") for n, column in amounts.items()]
    )
    joined = inside.join(carried, [key, "_piece"])
    result = [
        (F.coalesce(F.col(f"_carry_{n}"), F.lit(0)) + F.coalesce(F.col(f"_in_{n}"), F.lit(0))).alias(n)
        for n in amounts
    ]
    return joined.select(*frame.columns, *result)
