"""Bronze to silver: usable events once each, the others to quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.operators.validity import quarantined_rows, valid_rows
from tripflow.plans.silver import to_canonical, with_keys
from tripflow.settings import WATERMARK
from tripflow.sources.lake import stream_bronze
from tripflow.streaming.run import append_parquet, gathered

PARTITIONS = ["event_date", "city_id"]
# Tasks that write a micro-batch, per state partition.
WRITERS = 4

LANE = "_lane"


def message_lane(lanes: int) -> Column:
    """One of ``lanes`` numbers by the place of a message in its topic, which copies of an event don't share."""
    return F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(lanes))


def usable_events(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Filter first, so that an unusable copy cannot displace a usable one; then keep one
    copy per event id. The state of an id ends once the watermark has passed it.

    Where rows have a lane, copies are dropped per id and lane first: the copies of an id that
    fills a stream are spread over as many tasks as there are lanes, and one per lane meets in
    the task of the id.
    """
    rows = valid_rows(events).withWatermark("event_time", watermark)
    if LANE in events.columns:
        rows = rows.dropDuplicatesWithinWatermark(["event_id", LANE]).drop(LANE)
    return rows.dropDuplicatesWithinWatermark(["event_id"])


def start(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    checkpoint_root: str,
    bounded: bool = False,
    watermark: str = WATERMARK,
    max_files: int | None = None,
    files_per_partition: int | None = None,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """``files_per_partition`` bounds the files a micro-batch adds to a day and city; without it a
    busy one spreads over all tasks."""
    bronze = stream_bronze(spark, bronze_root, max_files)
    width = state_partitions or spark.sparkContext.defaultParallelism
    keyed = with_keys(bronze)
    lanes = files_per_partition or width
    moved = ["topic", "bronze_entity", "ingestion_time", "value", "event_id", "event_time", "event_date", "city_id"]
    usable = usable_events(keyed.select(*moved, message_lane(width).alias(LANE)), watermark)
    return [
        append_parquet(
            to_canonical(gathered(usable, PARTITIONS, lanes, "event_id", WRITERS * width)),
            name="silver_canonical_events",
            path=f"{silver_root}/canonical_events",
            checkpoint=f"{checkpoint_root}/canonical_events",
            partition_by=PARTITIONS,
            bounded=bounded,
            state_partitions=state_partitions,
        ),
        append_parquet(
            to_canonical(quarantined_rows(keyed)),
            name="silver_quarantine_events",
            path=f"{silver_root}/quarantine_events",
            checkpoint=f"{checkpoint_root}/quarantine_events",
            bounded=bounded,
        ),
    ]
