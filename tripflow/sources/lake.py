"""Scans of the lake layers, always with a declared schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripflow import schemas

# A streamed folder shows its readers only what its own commit log names, so history that a batch
# job adds needs a folder of its own.
BACKFILLED = "backfilled_events"
BACKFILLED_HOURS = "backfilled_city_hourly_metrics"


def stream_bronze(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """All entities below the root; the ingest-date folders are not columns here."""
    reader = spark.readStream.schema(schemas.BRONZE).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root)


def stream_silver(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.SILVER)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(root)


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Batch scan of a whole layer."""
    return spark.read.schema(schema).parquet(path)


def _if_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    try:
        return read_layer(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_backfilled(spark: SparkSession, silver_root: str) -> DataFrame | None:
    """Events that were filled in later, if there are any."""
    return _if_written(spark, f"{silver_root}/{BACKFILLED}", schemas.SILVER)


def read_silver(spark: SparkSession, silver_root: str) -> DataFrame:
    """Canonical events of the stream and those filled in later, which lie beside them."""
    streamed = read_layer(spark, f"{silver_root}/canonical_events", schemas.SILVER)
    filled = read_backfilled(spark, silver_root)
    return streamed if filled is None else streamed.unionByName(filled)


def read_gold(spark: SparkSession, gold_root: str) -> DataFrame:
    """City-hours of the stream; those that history was filled into come from the batch that wrote them again."""
    streamed = read_layer(spark, f"{gold_root}/city_hourly_metrics", schemas.GOLD_HOURLY)
    again = _if_written(spark, f"{gold_root}/{BACKFILLED_HOURS}", schemas.GOLD_HOURLY)
    if again is None:
        return streamed
    hours = ["event_date", "city_id", "window_start"]
    return streamed.join(again.select(*hours), hours, "left_anti").unionByName(again)


def read_source_file(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Open-data file: Parquet by suffix, otherwise CSV with a header, read as text."""
    if path.lower().rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", "true").option("inferSchema", "false")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_query(spark: SparkSession, sql: str, relations: dict[str, DataFrame]) -> DataFrame:
    """SQL over relations by name, written ``{name}``; names hold for this query alone."""
    return spark.sql(sql, **relations)
