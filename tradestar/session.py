"""Session helpers: a tuned local session for tests/bench and the shared
scratch folder that jobs use to cut lineage or stage files."""

from __future__ import annotations

import contextlib
import math
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that matter at any scale. AQE re-plans joins from measured sizes
# (broadcast conversion, skew-join splitting, partition coalescing).
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "tradestar", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark. On a cluster, the cluster's
    own session is used and only ``_BASE_CONF`` style settings apply."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for tables between stages: ``spark.checkpoint.dir`` of
    the session; where that is unset, a folder in the session's own warehouse
    (``spark.sql.warehouse.dir``), which every executor sees as well."""
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and sc is not None:
        folder = sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if sc is not None:
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    return folder


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", "connect")


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Rows of a wide table to a partition, and shuffled bytes that a task reads:
#: what a task sorts, or hashes for a join, then stays in its memory.
ROWS_PER_PARTITION = 500_000
TASK_BYTES = "32m"
#: Up to this size, as measured by AQE, a join's side goes to every executor
#: (Spark's own default), so that a wide table need not be shuffled for it.
BROADCAST_BYTES = "10m"


@contextlib.contextmanager
def sized_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """For the actions in this block, shuffles cut by ``rows`` instead of the
    session's fixed number, which puts ever larger partitions on a task until
    its sorts spill. AQE merges small partitions up to TASK_BYTES, and hashes
    the smaller side of a join whose partitions are all below that, so the
    larger is not sorted. The session's own settings hold again afterwards."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = {"spark.sql.shuffle.partitions": str(max(least, math.ceil(rows / ROWS_PER_PARTITION))),
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
              "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": TASK_BYTES}
    if not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):  # -1: switched off
        values["spark.sql.adaptive.autoBroadcastJoinThreshold"] = BROADCAST_BYTES
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never-reused folder below the checkpoint root."""
    path = "/".join([checkpoint_root(spark).rstrip("/"), "tradestar", *parts, uuid.uuid4().hex])
    _SCRATCH.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file of the store; whether there was one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True))


def drop_scratch(spark: SparkSession) -> int:
    """Delete the folders that this driver has handed out, at the end of an
    application whose results are read; returns their number."""
    count = 0
    while _SCRATCH:
        count += drop_path(spark, _SCRATCH.pop())
    return count


def newest_change(spark: SparkSession, folder: str) -> int:
    """Newest modification time of the tables in ``folder`` (files, or folders
    of files), from the file system's own listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    newest = 0
    for entry in fs.listStatus(path):
        newest = max(newest, entry.getModificationTime())
        if entry.isDirectory():
            newest = max([newest, *(f.getModificationTime() for f in fs.listStatus(entry.getPath()))])
    return newest


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
