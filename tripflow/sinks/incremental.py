"""Fact tables partitioned by event date and merged in place."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripflow import schemas
from tripflow.operators.upsert import EPOCH, high_water
from tripflow.plans.facts import FACTS
from tripflow.sinks.snapshots import SnapshotTable, folder_exists

DAY = "created_date"
KEY_HASH = "key_hash"
_KEYS = f"{KEY_HASH} bigint, {DAY} date"


class IncrementalFact:
    """A fact on disk. A load takes events past the high-water mark, replaces rows of equal key
    and rewrites only the date partitions that hold such rows.

    A later load first writes the new content of those partitions beside the table and notes
    it as pending. Only then does it overwrite them, and last it stores the mark. A load that
    dies in between leaves either nothing or a pending change, which the next load applies
    before it starts; applying it twice changes nothing.

    Which days a load touches is read from a table of key hashes kept beside the fact, in
    the same days: eight bytes a row, sorted. Days of the fact that hold none of the batch's
    keys are neither read nor written. Two keys of one hash cost the reading of a day, no more.
    """

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark = spark
        self.fact = FACTS[name]
        base = f"{root.rstrip('/')}/{name}"
        self.path = f"{base}/data"
        self.changes = f"{base}/changes"
        self.keys_path = f"{base}/keys"
        self.mark = SnapshotTable(spark, f"{base}/mark")
        self.pending = SnapshotTable(spark, f"{base}/pending")

    def read(self) -> DataFrame:
        """In today's columns: older files that lack one hold NULL there."""
        columns = self.fact.build(self.spark.createDataFrame([], schemas.STAGING))
        schema = columns.withColumn(DAY, F.to_date("created_at")).schema
        return self.spark.read.schema(schema).parquet(self.path)

    def keys(self) -> DataFrame:
        """(key_hash, day) of all rows."""
        if not folder_exists(self.spark, self.keys_path):
            self._write_keys(self.read(), "static")
        return self.spark.read.schema(_KEYS).parquet(self.keys_path)

    def days_with(self, batch: DataFrame) -> DataFrame:
        """Days that hold a row of a key in the batch."""
        wanted = batch.select(F.xxhash64(self.fact.key).alias(KEY_HASH)).distinct()
        return self.keys().join(wanted, KEY_HASH, "left_semi").select(DAY).distinct()

    def loaded(self) -> bool:
        return self.mark.exists()

    def high_water(self) -> datetime:
        return self.mark.read().first()["high_water"] if self.loaded() else EPOCH

    def load(self, staging: DataFrame, lookback: timedelta = timedelta(0)) -> datetime:
        if not self.loaded():
            self._write(self.fact.build(staging).withColumn(DAY, F.to_date("created_at")), "static")
            self._write_keys(self.read(), "static")
            return self._advance(high_water(self.read()), "first")
        self.apply_pending()
        batch = self.fact.build(staging, newer_than=self.high_water() - lookback)
        batch = batch.withColumn(DAY, F.to_date("created_at"))
        change = f"{self.changes}/{uuid.uuid4().hex}"
        # Written once: it is read for its keys, its days and its rows.
        batch.write.parquet(f"{change}/batch")
        batch = self.spark.read.schema(batch.schema).parquet(f"{change}/batch")
        if batch.isEmpty():
            self._drop(change)
            return self.high_water()
        # One line per calendar day.
        touched = {r[0] for r in self.days_with(batch).union(batch.select(DAY)).distinct().collect()}
        kept = self.unreplaced(batch, touched)
        kept.select(*batch.columns).unionByName(batch).write.parquet(f"{change}/days")
        left = {r[0] for r in self.spark.read.schema(batch.schema).parquet(f"{change}/days").select(DAY).distinct().collect()}
        emptied = sorted(touched - left)
        self.pending.replace(
            self.spark.createDataFrame(
                [(change, max(self.high_water(), high_water(batch)), emptied)],
                "change string, high_water timestamp, emptied array<date>",
            )
        )
        self.apply_pending()
        return self.high_water()

    def unreplaced(self, batch: DataFrame, days: set) -> DataFrame:
        """Rows of these days whose key the batch lacks."""
        existing = self.read().filter(F.col(DAY).isin(sorted(days)))
        return existing.join(batch.select(self.fact.key).distinct(), self.fact.key, "left_anti")

    def apply_pending(self) -> None:
        """Carry out the noted change unless the mark shows that it is done."""
        if not self.pending.exists():
            return
        note = self.pending.read().first()
        if self.mark.read().first()["change"] == note["change"]:
            return
        days = self.spark.read.parquet(f"{note['change']}/days")
        self._write(days, "dynamic")
        self._write_keys(days, "dynamic")
        for day in note["emptied"]:
            self._drop_day(day)
        self._advance(note["high_water"], note["change"])
        # Nothing reads a change that the mark names.
        self._drop(note["change"])

    def _write(self, rows: DataFrame, mode: str) -> None:
        (
            rows.hint("rebalance", DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy(DAY)
            .parquet(self.path)
        )

    def _write_keys(self, rows: DataFrame, mode: str) -> None:
        keys = rows.select(F.xxhash64(self.fact.key).alias(KEY_HASH), DAY)
        (
            keys.hint("rebalance", DAY)
            .sortWithinPartitions(DAY, KEY_HASH)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy(DAY)
            .parquet(self.keys_path)
        )

    def _drop_day(self, day) -> None:
        """A day without rows is not in the write, so its folders have to go by themselves."""
        self._drop(f"{self.path}/{DAY}={day}")
        self._drop(f"{self.keys_path}/{DAY}={day}")

    def _drop(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        path.getFileSystem(conf).delete(path, True)

    def _advance(self, value: datetime, change: str) -> datetime:
        self.mark.replace(
            self.spark.createDataFrame([(value, change)], "high_water timestamp, change string")
        )
        return value
