"""Session settings and the shared work folder.

Everything the library writes (streaming tables, checkpoints, outbox,
staged feed files) goes below the folder the cluster names in
``spark.checkpoint.dir``.  That folder is shared storage on a real
cluster, so a query restarted on another machine finds its checkpoint.
Only a session with a local master (unit tests, a laptop) gets a folder of
its own when the setting is absent.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Settings a session built by ``local_session`` gets.  On a cluster these
# come from the job submission instead; the library only reads them.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Streaming settings for a cluster.  The windowed counts and, above all,
# the watchlist match keep state that grows with the data (the match keeps
# every transaction for ever, as the original does).  RocksDB keeps it off
# the JVM heap and checkpoints only the changes of each micro-batch.  The
# provider, and the number of state partitions (``spark.sql.shuffle.
# partitions`` when a checkpoint is first created), are fixed for the life
# of a checkpoint, so set them before the first run.  Local test sessions
# keep the default in-memory provider: their state is a few MB.
CLUSTER_STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All state stores of an executor share one bounded cache and write buffer.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cardwatch", rocksdb: bool = False) -> SparkSession:
    """A local session for tests and the bench (not used on a cluster).

    ``rocksdb`` switches on the cluster state-store settings.
    """
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    settings = {**LOCAL_DEFAULTS, **(CLUSTER_STREAMING if rocksdb else {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether the session's executors are threads of its driver."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


# The folder of this process's local sessions, once made.
_LOCAL_ROOT: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Falls back to the RDD checkpoint folder.  When neither is set, a session
    with a local master gets one temporary folder per process; any other
    session is an error, as a machine-local folder would lose data.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext on Spark Connect
            root = None
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        if not _LOCAL_ROOT:
            _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="cardwatch-"))
        root = _LOCAL_ROOT[0]
    return root.rstrip("/")


@dataclass(frozen=True)
class RunFolder:
    """A fresh folder for one run: tables and their checkpoints side by side."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def staging(self, name: str) -> str:
        return f"{self.root}/staging/{name}"


def new_run(spark: SparkSession, name: str) -> RunFolder:
    """A new, never used folder below the shared root (one per run)."""
    return RunFolder(f"{shared_root(spark)}/cardwatch/{name}-{uuid.uuid4().hex[:12]}")
