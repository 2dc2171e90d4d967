"""Keyed tables cut into buckets by a hash of the key; a load rewrites the buckets its keys fall into."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from tripflow.operators.upsert import insert_if_absent, merge_fields, replace_by_key
from tripflow.sinks.snapshots import SnapshotTable

BUCKET = "_bucket"
# Folders of a table, for life. A load of many more keys than that touches all of them.
DEFAULT_BUCKETS = 64


class BucketedTable:
    """A table on disk, partitioned by bucket.

    A load first writes the new content of the touched buckets beside the table and notes it as
    pending. Only then does it overwrite them, and last it stores the mark. A load that dies in
    between leaves either nothing or a pending change, which the next load applies before it
    starts; applying it twice changes nothing. A merge never removes a key, so no bucket empties.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str], buckets: int = DEFAULT_BUCKETS):
        self.spark, self.key, self._buckets = spark, key, buckets
        self.root = root.rstrip("/")
        self.path = f"{self.root}/data"
        self.mark = SnapshotTable(spark, f"{self.root}/mark")
        self.pending = SnapshotTable(spark, f"{self.root}/pending")

    def exists(self) -> bool:
        return self.mark.exists()

    def read(self) -> DataFrame:
        """In the columns of the last load: older files that lack one hold NULL there."""
        return self._rows().drop(BUCKET)

    def upsert(self, incoming: DataFrame) -> None:
        self.load(incoming, replace_by_key)

    def set_fields(self, incoming: DataFrame) -> None:
        self.load(incoming, merge_fields)

    def insert_absent(self, incoming: DataFrame) -> None:
        self.load(incoming, insert_if_absent)

    def load(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame]) -> None:
        """``merge(existing, incoming, key)`` over the buckets of the incoming keys."""
        self.apply_pending()
        change = f"{self.root}/changes/{uuid.uuid4().hex}"
        buckets = self.mark.read().first()["buckets"] if self.exists() else self._buckets
        # Written once: it is read for its buckets and its rows.
        placed = incoming.withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int"))
        placed.write.parquet(f"{change}/batch")
        batch = self.spark.read.schema(placed.schema).parquet(f"{change}/batch")
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
        merged = batch
        if self.exists():
            merged = merge(self.held(touched), batch, self.key)
        merged.write.parquet(f"{change}/rows")
        columns = StructType([f for f in merged.schema.fields if f.name != BUCKET]).json()
        self.pending.replace(
            self.spark.createDataFrame([(change, buckets, columns)], "change string, buckets int, columns string")
        )
        self.apply_pending()

    def held(self, buckets: list[int]) -> DataFrame:
        return self._rows().filter(F.col(BUCKET).isin(buckets))

    def apply_pending(self) -> None:
        """Carry out the noted change unless the mark shows that it is done."""
        if not self.pending.exists():
            return
        note = self.pending.read().first()
        if self.exists() and self.mark.read().first()["change"] == note["change"]:
            return
        rows = self.spark.read.schema(self._schema(note["columns"])).parquet(f"{note['change']}/rows")
        (
            rows.hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )
        self.mark.replace(self.spark.createDataFrame([note], "change string, buckets int, columns string"))
        # Nothing reads a change that the mark names.
        path = self.spark._jvm.org.apache.hadoop.fs.Path(note["change"])
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def _schema(self, columns: str) -> StructType:
        return StructType.fromJson(json.loads(columns)).add(BUCKET, IntegerType())

    def _rows(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"{self.root} has no content")
        return self.spark.read.schema(self._schema(self.mark.read().first()["columns"])).parquet(self.path)
