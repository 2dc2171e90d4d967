"""Inventory of relations as a frame, as CSV and as Markdown."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F


def row_counts(
    spark: SparkSession, relations: dict[str, DataFrame | None], schema: str = "lake", kind: str = "BASE TABLE"
) -> DataFrame:
    """One row per relation with its count; NULL for one that cannot be read."""
    result = None
    for name, frame in relations.items():
        if frame is None:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        else:
            counted = frame.agg(F.count(F.lit(1)).alias("row_count"))
        one = counted.select(
            F.lit(schema).alias("schema"), F.lit(name).alias("relation"),
            F.lit(kind).alias("type"), "row_count",
        )
        result = one if result is None else result.unionByName(one)
    return result


def folder_size(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of all files below a path, from the listing; no file is opened."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("length")
    )
    return listing.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))


def inventory(
    spark: SparkSession,
    relations: dict[str, DataFrame | None],
    paths: dict[str, str],
    schema: str = "lake",
    kind: str = "BASE TABLE",
) -> DataFrame:
    """Counts and sizes; a relation without files has no size."""
    sizes = None
    for name, path in paths.items():
        one = folder_size(spark, path).select(F.lit(name).alias("relation"), "size_bytes")
        sizes = one if sizes is None else sizes.unionByName(one)
    counts = row_counts(spark, relations, schema, kind)
    if sizes is None:
        return counts.withColumn("size_bytes", F.lit(None).cast("bigint"))
    return counts.join(sizes, "relation", "left").select(
        "schema", "relation", "type", "row_count", "size_bytes"
    )


def readable(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The relation, or None if Spark cannot open it: files gone, no schema to be found, a marker
    without its folder."""
    try:
        return read()
    except (PySparkException, Py4JJavaError, FileNotFoundError):
        return None


def catalog_relations(spark: SparkSession, include_views: bool = False) -> dict[str, DataFrame | None]:
    """Tables of the current database; one that cannot be read is None and counts as NULL."""
    found = {}
    for entry in spark.catalog.listTables():
        if entry.tableType in ("VIEW", "TEMPORARY") and not include_views:
            continue
        found[entry.name] = readable(lambda name=entry.name: spark.table(name))
    return found


def totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("relations"), F.sum("row_count").alias("total_rows")
    )


def write_csv(report: DataFrame, path: str) -> None:
    report.orderBy("schema", "relation").write.mode("overwrite").option("header", "true").csv(path)


def write_markdown(report: DataFrame, path: str, title: str = "Table Inventory") -> None:
    """One line per relation of a catalogue."""
    total = totals(report).first()
    lines = [
        f"# {title}",
        "",
        f"Generated at: {datetime.now(timezone.utc).isoformat()}",
        f"Relations scanned: {total['relations']}",
        f"Total rows (summed): {total['total_rows'] or 0}",
        "",
        "| Schema | Relation | Type | Row Count | Size (bytes) |",
        "|---|---|---|---:|---:|",
    ]
    for row in report.orderBy("schema", "relation").toLocalIterator():
        cells = ["n/a" if v is None else str(v) for v in row]
        lines.append("| " + " | ".join(cells) + " |")
    Path(path).write_text("\n".join(lines) + "\n", encoding="utf-8")
