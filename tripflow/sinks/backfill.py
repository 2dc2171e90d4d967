"""History older than the stream's watermark, laid beside the streamed silver events and hours."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripflow import schemas
from tripflow.operators.conform import conform
from tripflow.operators.dedup import keep_last
from tripflow.operators.validity import valid_rows
from tripflow.plans.gold import city_hourly
from tripflow.session import fresh_dir
from tripflow.settings import WATERMARK
from tripflow.sources.lake import BACKFILLED, BACKFILLED_HOURS, read_backfilled, read_layer, read_silver

PARTITIONS = ["event_date", "city_id"]


def history_days(history: DataFrame) -> list[date]:
    """Days of the usable events, as literals that prune a scan."""
    days = valid_rows(history).where("event_date is not null").select("event_date").distinct()
    return sorted(row["event_date"] for row in days.collect())


def backfill_silver(spark: SparkSession, history: DataFrame, silver_root: str) -> int:
    """Append the usable events that silver does not hold yet; returns how many.

    Readers of a streamed folder see only files that its commit log names, so the events go to a
    folder of their own, which ``read_silver`` adds. Only the days the history covers are read back
    for comparison. Of several copies the one ingested last stays.

    The usable rows are staged once, numbered. Which of them to take is decided on their keys alone, so
    that whole rows are neither sorted by id nor moved for a history that silver holds already.
    """
    usable = conform(valid_rows(history), schemas.SILVER)
    numbered = usable.withColumn("_copy", F.xxhash64(*usable.columns)).withColumn(
        "_row", F.monotonically_increasing_id()
    )
    staged_path, taken_path = fresh_dir(spark, "backfill"), fresh_dir(spark, "backfill-rows")
    numbered.write.parquet(staged_path)
    staged = spark.read.schema(numbered.schema).parquet(staged_path)
    covered = F.col("event_date").isin(history_days(staged))
    known = read_silver(spark, silver_root).where(covered).select("event_id")
    keys = staged.select("event_id", "ingestion_time", "_copy", "_row")
    latest = keep_last(keys, ["event_id"], ["ingestion_time", "_copy", "_row"])
    latest.join(known, "event_id", "left_anti").select("_row").write.parquet(taken_path)
    taken = spark.read.schema("_row bigint").parquet(taken_path)
    count = taken.count()
    if count:
        # Without a row to leave out there is nothing to join.
        chosen = staged if count == staged.count() else staged.join(taken, "_row", "left_semi")
        fresh = chosen.drop("_copy", "_row")
        fresh.hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(
            f"{silver_root}/{BACKFILLED}"
        )
    return count


def backfill_gold(
    spark: SparkSession, days: list[date], silver_root: str, gold_root: str, watermark: str = WATERMARK
) -> None:
    """Write those city-hours of the days again that hold events filled in later.

    Streamed hours stay as they are; ``read_gold`` lays these over them. What a day gets follows from
    silver alone, so a run that is repeated, or completes one that died, writes the same rows. Hours
    that the stream has yet to close are left to it, and need another run afterwards.
    """
    covered = F.col("event_date").isin(days)
    filled = read_backfilled(spark, silver_root)
    if filled is None or not days:
        return
    streamed = read_layer(spark, f"{silver_root}/canonical_events", schemas.SILVER)
    newest = streamed.agg(F.max("event_date")).first()[0]
    closed = streamed.where(F.col("event_date") == F.lit(newest)).agg(
        F.date_trunc("millisecond", F.max("event_time")) - F.expr(f"interval {watermark}")
    ).first()[0]
    hour = F.window("event_time", "1 hour")
    touched = filled.where(covered).select(hour["start"].alias("window_start"), "city_id").distinct()
    hours = city_hourly(read_silver(spark, silver_root).where(covered))
    again = hours.join(touched, ["window_start", "city_id"], "left_semi")
    if closed is not None:
        again = again.where(F.col("window_end") <= F.lit(closed))
    (
        again.select(*schemas.GOLD_HOURLY.names)
        .hint("rebalance", *PARTITIONS)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*PARTITIONS)
        .parquet(f"{gold_root}/{BACKFILLED_HOURS}")
    )
