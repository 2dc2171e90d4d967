"""Tables derived from the test events, written once per application and read by many queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripflow import schemas
from tripflow.operators.conform import to_staging
from tripflow.operators.skew import spread
from tripflow.session import configure, fresh_dir
from tripflow.settings import TOPICS
from tripflow.sinks.backfill import backfill_gold, backfill_silver, history_days
from tripflow.sources import lake
from tripflow.sources.tables import EVENT_TOPICS, canonical_events, event_messages, table
from tripflow.sources.topics import land_messages, read_topic
from tripflow.streaming import bronze, gold, silver
from tripflow.streaming.run import await_all

PARTITIONS = ["event_date", "city_id"]
_written: dict[tuple, str] = {}


def _fingerprint(spark: SparkSession, path: str) -> tuple:
    """Files, bytes and last change of a table, from its listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first()
    return tuple(row)


def write_silver(staging: DataFrame, path: str) -> None:
    """Days by cities. Rebalancing gives each partition files of even size and splits
    a partition that holds much of the data over several tasks."""
    (
        staging.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STAGING).parquet(path)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_events(table(configure(spark), sf_dir, "events"))


def lazy_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable events, last copy each, as a plan over the source table."""
    return to_staging(raw_events(spark, sf_dir), ["ingestion_time", "source_offset"])


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of a derived table, built on first use and again if the events change."""
    configure(spark)
    source = f"{sf_dir.rstrip('/')}/events.parquet"
    key = (spark.sparkContext.applicationId, name, source, *_fingerprint(spark, source))
    if key not in _written:
        path = fresh_dir(spark, name)
        build(path)
        _written[key] = path
    return _written[key]


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table in the shared folder. Deduplicating moves every event, so it is
    done once, and the many models after it read day and city partitions instead."""
    path = _once(
        spark, sf_dir, "silver", lambda out: write_silver(lazy_staging(spark, sf_dir), out)
    )
    return read_silver(spark, path)


def landed_topics(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the events as topic messages."""
    events = spread(table(configure(spark), sf_dir, "events"))
    return _once(
        spark, sf_dir, "topics", lambda out: land_messages(event_messages(events), out)
    )


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = landed_topics(spark, sf_dir)
    result = None
    for topic in EVENT_TOPICS:
        one = read_topic(spark, topic, files=files)
        result = one if result is None else result.unionByName(one)
    return result


def stream_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three streaming jobs, each run until it has worked off what has arrived."""
    root = _streams_root(spark, sf_dir)
    return {
        "bronze": spark.read.schema(schemas.BRONZE)
        .option("recursiveFileLookup", "true")
        .parquet(f"{root}/bronze"),
        "silver": spark.read.schema(schemas.SILVER).parquet(f"{root}/silver/canonical_events"),
        "quarantine": spark.read.schema(schemas.SILVER).parquet(f"{root}/silver/quarantine_events"),
        "gold": spark.read.schema(schemas.GOLD_HOURLY).parquet(f"{root}/gold/city_hourly_metrics"),
    }


def _streams_root(spark: SparkSession, sf_dir: str) -> str:
    files = landed_topics(spark, sf_dir)
    return _once(spark, sf_dir, "stream", lambda out: _run_streams(spark, files, out))


def backfilled_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver and gold after the streams, with every usable event once more a day earlier as history.
    The history is loaded twice, of which the second time adds nothing."""
    root = _streams_root(spark, sf_dir)

    def load(_: str) -> None:
        silver_root = f"{root}/silver"
        events = lake.read_layer(spark, f"{silver_root}/canonical_events", schemas.SILVER)
        earlier = F.col("event_time") - F.expr("interval 1 day")
        history = events.withColumn("event_id", F.concat(F.lit("day-before-"), "event_id")).withColumn("event_time", earlier)
        history = history.withColumn("event_date", F.to_date("event_time"))
        for _ in range(2):
            backfill_silver(spark, history, silver_root)
        backfill_gold(spark, history_days(history), silver_root, f"{root}/gold")

    _once(spark, sf_dir, "backfilled", load)
    return {"silver": lake.read_silver(spark, f"{root}/silver"), "gold": lake.read_gold(spark, f"{root}/gold")}


def _run_streams(spark: SparkSession, files: str, root: str) -> None:
    topics = [t for t in TOPICS if t["name"] in EVENT_TOPICS]
    marks = f"{root}/checkpoints"
    await_all(
        bronze.start_all(
            spark, f"{root}/bronze", f"{marks}/bronze", bounded=True, topics=topics, files=files
        )
    )
    await_all(silver.start(spark, f"{root}/bronze", f"{root}/silver", f"{marks}/silver", bounded=True))
    await_all([gold.start(spark, f"{root}/silver", f"{root}/gold", f"{marks}/gold", bounded=True)])
