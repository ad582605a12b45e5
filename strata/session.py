"""Spark session defaults and the shared scratch location.

Scratch data (staged feeds, stored layer tables, streaming checkpoints) always lives
under the folder the cluster names in ``spark.checkpoint.dir``: on a cluster that is
shared storage every executor can reach. Only when the session leaves it unset (unit
tests, a laptop) do we pick a local folder ourselves.
"""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that matter at scale. The static (estimate-based) broadcast threshold is
# off: broadcasts happen either through an explicit, counted check
# (strata.operators.joins.sized_broadcast) or through AQE, which decides from the
# real size of a finished shuffle stage.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: State of stream-stream joins: RocksDB, the four stores of a join's partition as column families of one
#: instance, and a commit that uploads a log of what changed, not new snapshots of the files.
JOIN_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": DEFAULT_CONF["spark.sql.streaming.stateStore.providerClass"],
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
#: Without a count of the rows in state, a write looks no old value up.
UNCOUNTED_STATE_CONF = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
#: The logs of join state packed closer.
PACKED_STATE_CONF = {"spark.sql.streaming.stateStore.compression.codec": "zstd"}
#: For jobs that write table after table: the files of a shuffle go when the job that made it ends, not when the
#: driver happens to collect its garbage, and tables are packed closer.
LEAN_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of the block. A streaming query that is started in it keeps them, for it
    works on a copy of the session; a checkpoint keeps the state format that it began with."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def drop_garbage(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what nobody refers to any more: it does so when the driver's garbage
    is collected, which may be long after (micro-batches are not covered by ``LEAN_CONF``)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def build_session(
    app: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the defaults above.

    ``master`` is only applied when given; on a cluster the launcher sets it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            # getCheckpointDir() appends a per-application folder; keep its parent.
            root = current.rsplit("/", 1)[0]
        elif re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            root = tempfile.mkdtemp(prefix="strata-checkpoints-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for one run below the shared checkpoint folder (created through
    Hadoop's file system, so any shared store works)."""
    path = f"{scratch_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
    hadoop_path, fs = hadoop_fs(spark, path)
    fs.mkdirs(hadoop_path)
    return path


def hadoop_fs(spark: SparkSession, path: str):
    """(path object, file system) of ``path`` in the session's Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
