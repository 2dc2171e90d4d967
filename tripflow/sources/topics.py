"""Event topics, as streams and as bounded batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripflow import schemas
from tripflow.session import temporarily
from tripflow.settings import TOPICS

DEFAULT_KAFKA = {
    "bootstrap_servers": "kafka:9092",
    "starting_offsets": "earliest",
    "fail_on_data_loss": False,
}


def _kafka_options(topic: str, kafka: dict) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": kafka["bootstrap_servers"],
        "subscribe": topic,
        "startingOffsets": kafka.get("starting_offsets", "latest"),
        "failOnDataLoss": str(kafka.get("fail_on_data_loss", False)).lower(),
    }


def _topic_folder(files: str, topic: str) -> str:
    return f"{files.rstrip('/')}/topic={topic}"


def land_messages(messages: DataFrame, files: str) -> None:
    """Messages as files, a folder per topic, for places without a broker. A task writes its topics
    side by side, without sorting the messages."""
    with temporarily(messages.sparkSession, spark__sql__maxConcurrentOutputFileWriters=len(TOPICS)):
        messages.write.mode("overwrite").partitionBy("topic").parquet(files)


def stream_topic(
    spark: SparkSession,
    topic: str,
    kafka: dict | None = None,
    files: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Messages of one topic, from Kafka or from files holding the same envelope."""
    if files is None:
        reader = spark.readStream.format("kafka")
        return reader.options(**_kafka_options(topic, kafka or DEFAULT_KAFKA)).load()
    reader = spark.readStream.schema(schemas.FILE_ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(_topic_folder(files, topic)).withColumn("topic", F.lit(topic))


def read_topic(
    spark: SparkSession,
    topic: str,
    kafka: dict | None = None,
    files: str | None = None,
) -> DataFrame:
    """Everything the topic holds now."""
    if files is None:
        options = _kafka_options(topic, kafka or DEFAULT_KAFKA)
        options.update({"startingOffsets": "earliest", "endingOffsets": "latest"})
        batch = spark.read.format("kafka").options(**options).load()
    else:
        batch = spark.read.schema(schemas.FILE_ENVELOPE).parquet(_topic_folder(files, topic))
        batch = batch.withColumn("topic", F.lit(topic))
    return batch
