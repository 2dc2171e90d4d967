"""Silver to gold: city metrics per hour, emitted once an hour is closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripflow.plans.gold import city_hourly
from tripflow.settings import WATERMARK
from tripflow.sources.lake import stream_silver
from tripflow.streaming.run import append_parquet, gathered

PARTITIONS = ["event_date", "city_id"]


def hourly_metrics(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    return city_hourly(events.withWatermark("event_time", watermark))


def start(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    checkpoint_root: str,
    bounded: bool = False,
    max_files: int | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    silver = stream_silver(spark, f"{silver_root}/canonical_events", max_files)
    return append_parquet(
        gathered(hourly_metrics(silver), PARTITIONS, 1, "window_start"),
        name="gold_city_hourly_metrics",
        path=f"{gold_root}/city_hourly_metrics",
        checkpoint=f"{checkpoint_root}/city_hourly_metrics",
        partition_by=PARTITIONS,
        bounded=bounded,
        state_partitions=state_partitions,
    )
