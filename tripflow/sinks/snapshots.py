"""Tables that are replaced as a whole: each write is a new folder, one marker names the current."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripflow.operators.upsert import append_keep_last, insert_if_absent, merge_fields, replace_by_key


def folder_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


class SnapshotTable:
    """Parquet folder per version. Readers of the old version are not disturbed by a write.

    The marker is a one-line text table whose newest entry names the version,
    so a job that dies before the marker leaves the old version in force.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType | None = None):
        """``schema`` fixes the types of partition columns, which reading would guess."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def version(self) -> str | None:
        marker = self._path(f"{self.root}/CURRENT")
        if not self._fs.exists(marker):
            return None
        stream = self._fs.open(marker)
        try:
            return stream.readLine()
        finally:
            stream.close()

    @property
    def path(self) -> str:
        """Folder of the current version."""
        return f"{self.root}/{self.version()}"

    def exists(self) -> bool:
        return self.version() is not None

    def read(self) -> DataFrame:
        version = self.version()
        if version is None:
            raise FileNotFoundError(f"{self.root} has no current version")
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(f"{self.root}/{version}")

    def replace(self, frame: DataFrame, partition_by: list[str] | None = None) -> None:
        version = f"v-{uuid.uuid4().hex}"
        writer = frame.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/{version}")
        self._point_to(version)

    def _point_to(self, version: str) -> None:
        """Write the marker beside the old one, then rename over it."""
        pending = self._path(f"{self.root}/_CURRENT.{version}")
        stream = self._fs.create(pending, True)
        try:
            stream.writeBytes(f"{version}\n")
        finally:
            stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri())
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        array = self.spark._sc._gateway.new_array(options, 1)
        array[0] = options.OVERWRITE
        context.rename(
            self._fs.makeQualified(pending),
            self._fs.makeQualified(self._path(f"{self.root}/CURRENT")),
            array,
        )

    def upsert(self, incoming: DataFrame, key: list[str]) -> None:
        self.replace(replace_by_key(self.read(), incoming, key) if self.exists() else incoming)

    def set_fields(self, incoming: DataFrame, key: list[str]) -> None:
        self.replace(merge_fields(self.read(), incoming, key) if self.exists() else incoming)

    def append_keep_last(self, incoming: DataFrame, key: list[str]) -> None:
        self.replace(append_keep_last(self.read(), incoming, key) if self.exists() else incoming)

    def insert_absent(self, incoming: DataFrame, key: list[str]) -> None:
        self.replace(insert_if_absent(self.read(), incoming, key) if self.exists() else incoming)
