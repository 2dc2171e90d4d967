"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs rely on. Shuffle width and memory belong to the cluster and stay out.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Reports that a query holds between two looks of a progress log.
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
    # A commit uploads what changed, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session for a job; ``extra`` keys use ``__`` where Spark uses a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def temporarily(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings for what starts in the block; keys use ``__`` where Spark uses a dot."""
    wanted = {key.replace("__", "."): str(value) for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, private to this application.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder of its own machine.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="tripflow-")
        root = _local_dirs[app]
    return f"{root.rstrip('/')}/tripflow/{app}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
