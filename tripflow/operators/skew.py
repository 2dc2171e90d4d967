"""Joins and keys that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unmatched_spread(key: Column, row_id: Column) -> Column:
    """Join key whose NULLs are spread: each gets a value of its own that nothing matches."""
    return F.coalesce(key, F.concat(F.lit("\u0000"), row_id))


def hot_keys(frame: DataFrame, key: str, share: float) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: by arithmetic fewer than 1 / share."""
    counts = frame.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total")).scalar()
    return counts.filter(F.col("_n") > total * F.lit(share)).select(key)


def grid_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_id: list[str],
    right_id: list[str],
    salts: int = 16,
    share: float = 0.001,
) -> DataFrame:
    """Left join that spreads keys with many rows, on either side, over a grid of tasks.

    A row of a key that is hot on its own side goes to one of ``salts`` lines of
    the grid, and to every column the other side is spread over. Rows of other
    keys are neither copied nor spread. The id columns decide the line; they are
    data, so that a task that runs again places its rows as before.
    """

    def line(hot: str, id_columns: list[str]) -> Column:
        place = F.pmod(F.xxhash64(*id_columns), F.lit(salts)).cast("int")
        return F.when(F.col(hot), place).otherwise(0)

    def every(hot: str) -> Column:
        lines = F.sequence(F.lit(0), F.lit(salts - 1))
        return F.explode(F.when(F.col(hot), lines).otherwise(F.array(F.lit(0))))

    # Both lists have fewer than 1 / share rows.
    hot_left = hot_keys(left, key, share).select(F.col(key).alias("_k"), F.lit(True).alias("_hot_l"))
    hot_right = hot_keys(right, key, share).select(F.col(key).alias("_k"), F.lit(True).alias("_hot_r"))

    def marked(frame: DataFrame) -> DataFrame:
        return frame.join(F.broadcast(hot_left), "_k", "left").join(
            F.broadcast(hot_right), "_k", "left"
        )

    spread_key = unmatched_spread(F.col(key), F.xxhash64(*left_id).cast("string"))
    lefts = marked(left.withColumn("_k", spread_key)).select(
        *left.columns, "_k", "_hot_r", line("_hot_l", left_id).alias("_i"), every("_hot_r").alias("_j")
    )
    known = right.filter(F.col(key).isNotNull()).withColumnRenamed(key, "_k")
    rights = marked(known).select(
        *known.columns, line("_hot_r", right_id).alias("_j"), every("_hot_l").alias("_i"),
        F.lit(True).alias("_met"),
    )
    joined = lefts.join(rights, ["_k", "_i", "_j"], "left")
    # A key hot on the right has partners, if not in every column.
    whole = joined.filter(F.col("_met") | F.col("_hot_r").isNull())
    return whole.drop("_k", "_i", "_j", "_hot_r", "_met")


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than the cluster has cores, dealt out over all cores.

    Meant for costly work per row on few files. A large table has more splits
    than cores and passes through without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
