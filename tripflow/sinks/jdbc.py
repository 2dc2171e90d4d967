"""Truncate-and-load into a relational table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PAGE_ROWS = 500


def truncate_and_load(
    frame: DataFrame, url: str, table: str, connections: int, properties: dict[str, str] | None = None
) -> None:
    """Keeps the table's definition; ``connections`` bounds the sessions the database sees."""
    (
        frame.coalesce(connections)
        .write.format("jdbc")
        .options(url=url, dbtable=table, truncate="true", batchsize=PAGE_ROWS, **(properties or {}))
        .mode("overwrite")
        .save()
    )


def read_table(
    spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load()
