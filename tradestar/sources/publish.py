"""Tables published without a gap, by Spark's own catalog.

Each publication writes a version: a table with a folder of its own, schema and
partitions included, that nobody reads yet. Then one catalog call points the
view that readers name at it. A reader sees the old rows or the new ones,
whole; a write that fails leaves the view as it was; a query planned before the
switch goes on reading its version, which stays until ``keep`` newer ones exist.

How a version is partitioned and sorted is kept as properties of the view, so
compaction writes the same layout anew, in fewer files, and publishes it the
same way.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from tradestar.layouts import COMPACTION_TARGET_BYTES
from tradestar.session import drop_path

_PREFIX = "tradestar."


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _properties(spark: SparkSession, name: str) -> dict:
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()
    return {r["key"].removeprefix(_PREFIX): json.loads(r["value"]) for r in rows if r["key"].startswith(_PREFIX)}


def versions(spark: SparkSession, name: str) -> list[str]:
    """The version tables of a published name, oldest first (their names carry
    the time of their publication)."""
    database, _, table = name.rpartition(".")
    found = spark.sql(f"SHOW TABLES{f' IN {_quoted(database)}' if database else ''} LIKE '{table}__v*'").collect()
    return sorted(f"{database}.{r['tableName']}".lstrip(".") for r in found
                  if r["tableName"].startswith(f"{table}__v"))


def publish(df: DataFrame, name: str, root: str, partition_by: list[str] | tuple[str, ...] = (),
            sort_by: list[str] | tuple[str, ...] = (), keep: int = 2,
            buckets: int = 0, bucket_by: list[str] | tuple[str, ...] = ()) -> str:
    """Make the rows of ``df`` the table ``name`` (``database.table``; the
    database must exist), stored below ``root``. ``partition_by`` are its
    folders; ``sort_by`` says how its rows are sorted within files, for
    compaction (the rows are written as ``df`` has them). With ``buckets`` the
    rows are dealt by the hash of ``bucket_by``, one file for each bucket, so
    tables that are joined or grouped by these columns need no shuffle for it;
    choose as many buckets as give files of a task's size. Returns the version."""
    spark = df.sparkSession
    version = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    folder = f"{root.rstrip('/')}/{version.rpartition('.')[2]}"
    writer = df.write.format("parquet").option("path", folder)
    if buckets:
        dealt = df.repartition(buckets, *bucket_by)
        writer = dealt.write.format("parquet").option("path", folder).bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(version)
    except Exception:
        drop_path(spark, folder)  # nobody has read it
        raise
    kept = {"version": version, "root": root, "partition_by": list(partition_by), "sort_by": list(sort_by),
            "buckets": buckets, "bucket_by": list(bucket_by)}
    properties = ", ".join(f"'{_PREFIX}{k}' = '{json.dumps(v)}'" for k, v in kept.items())
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} TBLPROPERTIES ({properties}) "
              f"AS SELECT * FROM {_quoted(version)}")
    for old in versions(spark, name)[:-keep]:
        if old != version:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(old)}")
            drop_path(spark, f"{root.rstrip('/')}/{old.rpartition('.')[2]}")
    return version


def current(spark: SparkSession, name: str) -> str:
    """The version that a published name stands for."""
    return _properties(spark, name)["version"]


def compact(spark: SparkSession, name: str, target_bytes: int = COMPACTION_TARGET_BYTES, keep: int = 2) -> int | None:
    """Publish the same rows in files of about ``target_bytes``, with the same
    folders and order, if there are more files than that takes; returns how many
    partitions wrote them (None: nothing to do)."""
    from tradestar.sources.sinks import files_of, ranged

    kept = _properties(spark, name)
    version = kept["version"]
    n_files, total = files_of(spark, f"{kept['root'].rstrip('/')}/{version.rpartition('.')[2]}")
    n = max(kept["buckets"] or 1, math.ceil(total / target_bytes))
    if n_files <= n:
        return None
    rows = spark.table(version)
    if not kept["buckets"]:
        rows = ranged(rows, n, kept["partition_by"], kept["sort_by"])
    publish(rows, name, kept["root"], kept["partition_by"], kept["sort_by"], keep, kept["buckets"], kept["bucket_by"])
    return n
