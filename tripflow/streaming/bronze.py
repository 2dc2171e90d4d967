"""Topics to bronze: raw messages, partitioned by ingest date, one query per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripflow.plans.silver import to_bronze
from tripflow.settings import TOPICS
from tripflow.sources.topics import stream_topic
from tripflow.streaming.run import append_parquet


def start_topic(
    messages: DataFrame, entity: str, bronze_root: str, checkpoint_root: str, bounded: bool
) -> StreamingQuery:
    return append_parquet(
        to_bronze(messages, entity),
        name=f"bronze_{entity}",
        path=f"{bronze_root}/{entity}",
        checkpoint=f"{checkpoint_root}/{entity}",
        partition_by=["ingest_date"],
        bounded=bounded,
        open_files=2,
    )


def start_all(
    spark: SparkSession,
    bronze_root: str,
    checkpoint_root: str,
    bounded: bool = False,
    topics: list[dict] = TOPICS,
    kafka: dict | None = None,
    files: str | None = None,
    max_files: int | None = None,
) -> list[StreamingQuery]:
    return [
        start_topic(
            stream_topic(spark, topic["name"], kafka, files, max_files),
            topic["bronze_entity"], bronze_root, checkpoint_root, bounded,
        )
        for topic in topics
    ]
