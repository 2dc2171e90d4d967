"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.session import fresh_dir


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written out and read again: computed once, kept through the loss of executors."""
    path = fresh_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
