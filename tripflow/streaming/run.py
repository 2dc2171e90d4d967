"""Starting, awaiting and observing streaming queries."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.session import temporarily


def gathered(
    frame: DataFrame, partition_by: list[str], files: int, by: str, tasks: int | None = None
) -> DataFrame:
    """Rows of a micro-batch laid out so that a partition gets at most ``files`` files, not one
    from every task. ``by`` spreads a partition that holds much of the batch. A task sorts its rows by
    partition, so more ``tasks`` than state partitions keep the sort of a large batch in memory."""
    lane = F.pmod(F.xxhash64(by), F.lit(files))
    if tasks:
        return frame.repartition(tasks, *partition_by, lane)
    return frame.repartition(*partition_by, lane)


def append_parquet(
    frame: DataFrame,
    name: str,
    path: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
    bounded: bool = False,
    state_partitions: int | None = None,
    open_files: int = 0,
) -> StreamingQuery:
    """Append-only Parquet sink; ``bounded`` works off what is there now and stops.

    A task that meets at most ``open_files`` partitions writes them side by side and needn't sort its
    rows. A stream keeps the number of its state partitions for life and has no
    adaptive execution to merge small ones, so it gets one per core unless told.
    """
    writer = (
        frame.writeStream.queryName(name)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bounded:
        writer = writer.trigger(availableNow=True)
    spark = frame.sparkSession
    width = state_partitions or spark.sparkContext.defaultParallelism
    with temporarily(
        spark, spark__sql__shuffle__partitions=width, spark__sql__maxConcurrentOutputFileWriters=open_files
    ):
        return writer.start()


class ProgressLog:
    """Progress reports of streaming queries, a small JSON file per micro-batch.

    A query holds only its newest reports, so they are copied while it runs. A restarted query goes
    on numbering its batches; a batch that ran twice after a failure counts by its last report.
    """

    SCHEMA = (
        "name string, batchId bigint, timestamp string, "
        "stateOperators array<struct<numRowsDroppedByWatermark: bigint>>"
    )

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._seen: dict[str, int] = {}

    def record(self, query: StreamingQuery) -> None:
        """Copy the reports that came since the last call."""
        run = str(query.runId)
        last = self._seen.get(run, -1)
        for report in query.recentProgress:
            # A trigger that found nothing to do reports too, under the number of the next batch.
            if report["batchId"] > last and "addBatch" in report["durationMs"]:
                place = f"{self.root}/name={quote(query.name, safe='')}/{run}-{report['batchId']}.json"
                self._put(place, report.json)
                self._seen[run] = last = report["batchId"]

    def _put(self, place: str, report: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        system = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        stream = system.create(path, True)
        try:
            stream.write(bytearray(" ".join(report.split("\n")).encode()))
        finally:
            stream.close()

    def late_rows(self) -> DataFrame:
        """(name, batches, late_rows): rows the watermark has turned away, over all batches so far."""
        reports = self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", "true").json(self.root)
        last = reports.groupBy("name", "batchId").agg(F.max_by("stateOperators", "timestamp").alias("operators"))
        late = F.aggregate(
            F.coalesce("operators", F.array()), F.lit(0).cast("bigint"),
            lambda total, x: total + F.coalesce(x["numRowsDroppedByWatermark"], F.lit(0)),
        )
        return last.groupBy("name").agg(F.count("*").alias("batches"), F.sum(late).alias("late_rows"))


def await_all(queries: list[StreamingQuery], log: ProgressLog | None = None, seconds: float = 1.0) -> None:
    """Wait for the end of all. With a log, their reports are kept; between two looks a query must not
    run more batches than ``spark.sql.streaming.numRecentProgressUpdates``."""
    if log is None:
        for query in queries:
            query.awaitTermination()
        return
    running = list(queries)
    while running:
        ended = [q for q in running if q.awaitTermination(seconds / len(running))]
        for query in running:
            log.record(query)
        running = [q for q in running if q not in ended]
