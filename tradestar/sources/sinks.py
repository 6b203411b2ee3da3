"""Sinks: append with schema merge, whole-table overwrite (optionally partitioned),
dynamic-partition snapshots and small-file compaction.

Parquet is the format here (no Delta jar); with Delta on the classpath set
``tradestar.table.format=delta`` and the same calls write Delta. Only Delta's
overwrite of a path is atomic: Parquet's deletes the old files first, so a reader
may see nothing and a crash leaves nothing. ``publish`` has no such gap: it
writes versions and switches a name in Spark's catalog.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradestar.functions.names import partition_columns
from tradestar.layouts import COMPACTION_TARGET_BYTES
from tradestar.sources.files import list_files, table_format, table_name


def _fmt(spark: SparkSession) -> str:
    f = table_format(spark)
    return "delta" if f == "delta" else "parquet"


def append_merge_schema(df: DataFrame, path: str, fmt: str | None = None) -> None:
    """Append; new columns widen the table (read side uses ``mergeSchema``)."""
    (df.write.format(fmt or _fmt(df.sparkSession)).mode("append")
     .option("mergeSchema", "true").save(path))


def read_merged(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """A table whose files may differ in width: every column of every file."""
    if (fmt or _fmt(spark)) == "delta":
        return spark.read.format("delta").load(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                    fmt: str | None = None) -> None:
    """Replace the whole table (schema included)."""
    w = (df.write.format(fmt or _fmt(df.sparkSession)).mode("overwrite")
         .option("overwriteSchema", "true").option("partitionOverwriteMode", "static"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite_partitioned(df: DataFrame, path: str, rebalance: bool = True,
                          fmt: str | None = None) -> list[str]:
    """Silver write: partition by the first present year column and month
    column (if any), full overwrite. Returns the partition columns used.

    Without a shuffle every task would write one file per month it holds
    (tasks × months small files). The ``REBALANCE`` hint on the partition
    columns lets AQE cut each month into advisory-sized partitions, splitting
    a hot month and merging small ones, so files come out near the target
    size."""
    cols = partition_columns(df.columns)
    if cols and rebalance:
        df = df.hint("rebalance", *cols)
    overwrite_table(df, path, cols, fmt)
    return cols


def write_snapshot(df: DataFrame, path: str, partition_by: list[str], fmt: str | None = None) -> None:
    """Dynamic partition overwrite: only the partitions present in ``df`` are
    replaced, so a monthly refresh never rewrites history. Rebalanced on the
    partition columns so each month is written as a few well-sized files."""
    (df.hint("rebalance", *partition_by)
     .write.format(fmt or _fmt(df.sparkSession)).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path))


def write_idempotent_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write one micro-batch under ``batch_id=<n>`` with dynamic overwrite: a
    retried batch replaces its own partition instead of appending twice."""
    (df.withColumn("batch_id", F.lit(int(batch_id)))
     .write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").save(path))


def compaction_of(files: DataFrame, target_bytes: int = COMPACTION_TARGET_BYTES) -> DataFrame:
    """For a listing (pasta, arquivo, bytes), per table (first-level folder, or
    file stem for files at the root): file count, bytes, and the file count a
    rewrite at the target size would produce (``ceil(bytes / target)``, at least 1)."""
    return (files.groupBy(table_name().alias("tabela"))
            .agg(F.count(F.lit(1)).alias("n_arquivos"), F.sum("bytes").alias("bytes"))
            .withColumn("n_alvo", F.greatest(F.lit(1),
                                             F.ceil(F.col("bytes") / F.lit(target_bytes)))
                        .cast("int"))
            .withColumn("compactar", F.col("n_arquivos") > F.col("n_alvo")))


def compaction_plan(spark: SparkSession, root: str,
                    target_bytes: int = COMPACTION_TARGET_BYTES) -> DataFrame:
    """``compaction_of`` the Parquet files below ``root``."""
    return compaction_of(list_files(spark, root, glob="*.parquet"), target_bytes)


def ranged(df: DataFrame, n: int, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """``df`` in ``n`` partitions: ranged and sorted by the partition columns and
    ``sort_by``, so files keep narrow value ranges; without either, spread evenly."""
    order = [*partition_by, *sort_by]
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order) if order else df.repartition(n)


def files_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the Parquet files below a folder."""
    found = (list_files(spark, path, glob="*.parquet")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).first())
    return int(found["n"] or 0), int(found["b"] or 0)


def folder_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that a Parquet table keeps in its folders' names (``k=v``)."""
    one = list_files(spark, path, glob="*.parquet").select("path").first()
    below = one["path"].rsplit("/" + path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1] if one else ""
    return [part.split("=", 1)[0] for part in below.split("/")[:-1] if "=" in part]


def compact(spark: SparkSession, src: str, dst: str, total_bytes: int,
            target_bytes: int = COMPACTION_TARGET_BYTES, partition_by: Sequence[str] = (),
            sort_by: Sequence[str] = ()) -> int:
    """Rewrite a Parquet table into about ``target_bytes`` sized files; the
    source is left untouched. Partition folders stay (``partition_by``), and
    rows are ``ranged`` by them and ``sort_by``. Returns the number of tasks."""
    n = max(1, math.ceil(total_bytes / target_bytes))
    # folder names are text: values such as '01' must not come back as numbers
    inferred = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inferred)
    spark.conf.set(inferred, "false")
    try:
        df = spark.read.parquet(src)
    finally:
        spark.conf.set(inferred, before)
    ranged(df, n, partition_by, sort_by).write.mode("overwrite").partitionBy(*partition_by).parquet(dst)
    return n


def optimize_table(spark: SparkSession, path: str, dst: str | None = None,
                   target_bytes: int = COMPACTION_TARGET_BYTES, sort_by: Sequence[str] = ()) -> int | None:
    """Small-file compaction of one table by path. With Delta
    (``tradestar.table.format = delta``) this is ``OPTIMIZE`` on the path, atomic
    and in place. With Parquet the table is rewritten into ``dst`` at the target
    file size when the plan says it pays, with the same partition folders and
    sorted by ``sort_by``; returns the new file count (None when nothing was
    done). A path has no atomic swap: the caller points readers at ``dst``, or
    keeps the table published (``publish.compact``)."""
    if _fmt(spark) == "delta":
        spark.sql(f"OPTIMIZE delta.`{path}`")
        return None
    n_files, total = files_of(spark, path)
    target_n = max(1, math.ceil(total / target_bytes))
    if dst is None or n_files <= target_n:
        return None
    return compact(spark, path, dst, total, target_bytes, folder_columns(spark, path), sort_by)
