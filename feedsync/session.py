"""Session settings the operators are designed for."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run relies on: adaptive execution (partition coalescing,
# skewed-partition splitting), UTC stamps, Spark UI off (no server).
#
# Broadcasts: the static planner's choice rests on size *estimates* (file sizes
# scaled through filters and aggregates), which can be far below the real
# in-memory size of a table that grows with the feed.  So static broadcasting
# is off, and adaptive execution converts a sort-merge join into a broadcast
# join only when the *measured* size of a finished shuffle stage is under the
# adaptive threshold.  The reconciliation itself broadcasts nothing explicitly.
BASE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even when a later operator relied on the
    # join's partitioning (costs one extra shuffle instead of one hot task)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    master: str | None = None,
    app: str = "feedsync",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for staged tables (``spark.checkpoint.dir``).

    Read from the session.  Only when it is unset (local tests, the bench) a
    fresh scratch folder is created and recorded in the session, so every
    later call agrees.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="feedsync-", dir=os.environ.get("FEEDSYNC_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_root(spark: SparkSession, root: str) -> str:
    """``root``, refused on a cluster if it is a folder of one machine."""
    local = root.startswith(("/", "file:"))
    if local and not spark.sparkContext.master.startswith("local"):
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or ""
        strip = lambda p: re.sub("/+", "/", p.removeprefix("file:"))
        if not shared or not strip(root).startswith(strip(shared)):
            raise ValueError(f"{root} is a folder of one machine; use storage that all executors share")
    return root


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs in here go when it ends, not when the driver happens to
    collect its garbage.  For writes, whose shuffles nothing reads again."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """File-system metadata check (no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run owns, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def make_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` from the file system's metadata (no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def shuffle_partitions_for(
    n_bytes: int,
    cores: int,
    target_bytes: int = 512 << 20,
) -> int:
    """Initial shuffle partition count for an input of ``n_bytes``: about one
    partition per ``target_bytes`` (so a reduce task holds a few hundred MB
    and sorts without spilling much), never fewer than two waves of the
    cluster's cores.  The size of a partition is what bounds a task's memory, so
    the count has no upper limit.  Adaptive execution then coalesces partitions
    that turn out small."""
    return int(max(2 * cores, -(-max(n_bytes, 1) // target_bytes)))


def size_shuffle(spark: SparkSession, n_bytes: int, **kw) -> int:
    """Set ``spark.sql.shuffle.partitions`` for this input unless the session
    was given a value explicitly."""
    if spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = shuffle_partitions_for(n_bytes, spark.sparkContext.defaultParallelism, **kw)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
