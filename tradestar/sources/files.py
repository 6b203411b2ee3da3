"""File sources: delimited-text scans, table reads and file inventories.

Listing uses the ``binaryFile`` source with only ``path``/``length`` selected,
so file contents are never read; the listing is a distributed DataFrame, not a
driver-side loop.
"""

from __future__ import annotations

import logging
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.functions.names import fallback_name
from tradestar.layouts import TRADE_ENTITIES, TRADE_LAYOUTS, source_schema

log = logging.getLogger(__name__)

#: Error conditions that say a path holds no Delta table, or that Spark has no Delta.
NOT_DELTA = ("DATA_SOURCE_NOT_FOUND", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE")

LANDING_OPTIONS = {"sep": ";", "header": "true", "encoding": "ISO-8859-1"}


def project_by_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """One projection renaming source columns to the layout's names.
    Mapped columns absent from the file are skipped with a warning; columns the
    layout does not name are dropped."""
    present = [(src, dst) for src, dst in mapping.items() if src in df.columns]
    for src in mapping:
        if src not in df.columns:
            log.warning("column %s not found; skipped", src)
    if not present:
        return df
    return df.select(*[F.col(f"`{s}`").alias(d) for s, d in present])


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             glob: str | None = None, enforce_schema: bool = False,
             options: dict[str, str] | None = None) -> DataFrame:
    """Batch scan of delimited text. With an explicit schema and
    ``enforceSchema=false`` the header of every file is checked against the
    schema's names, so a file of another layout fails instead of being read by
    position."""
    reader = spark.read.options(**{**LANDING_OPTIONS, **(options or {})})
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", str(enforce_schema).lower())
    return reader.csv(path)


def scan_csv_entity(spark: SparkSession, landing_dir: str, entity: str,
                    glob: str | None = None) -> DataFrame:
    """Scan one trade entity from the landing folder and name it by layout
    (or by the fallback rule when the entity has no layout)."""
    default_glob, layout_key = TRADE_ENTITIES[entity]
    if layout_key is None:
        df = scan_csv(spark, landing_dir, glob=glob or default_glob,
                      options={"inferSchema": "false"})
        return df.toDF(*[fallback_name(c) for c in df.columns])
    df = scan_csv(spark, landing_dir, source_schema(layout_key), glob or default_glob)
    return project_by_mapping(df, TRADE_LAYOUTS[layout_key])


def table_format(spark: SparkSession) -> str:
    """'parquet' (the default), 'delta', or 'auto' (try Delta, fall back to
    Parquet) from ``tradestar.table.format``."""
    return spark.conf.get("tradestar.table.format", "parquet")


def read_table(spark: SparkSession, path: str, fmt: str | None = None,
               recursive: bool = False) -> DataFrame:
    """Read a lake table: Delta when requested or, in 'auto', when the path
    reads as Delta; otherwise Parquet with partition discovery (``k=v``
    folders become columns). ``recursive`` reads every file below ``path``
    whatever the folder names (``recursiveFileLookup``; no partition columns)."""
    fmt = fmt or table_format(spark)
    if fmt == "delta":
        return spark.read.format("delta").load(path)
    if fmt == "auto":
        try:
            return spark.read.format("delta").load(path)
        except AnalysisException as exc:  # anything else is an error of the table
            if exc.getCondition() not in NOT_DELTA:
                raise
    if recursive:
        return spark.read.option("recursiveFileLookup", "true").parquet(path)
    return spark.read.parquet(path)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, folder, arquivo, bytes, modificado) for every file below ``root``;
    content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    root_prefix = root.rstrip("/")
    files = reader.load(root).select("path", "length", "modificationTime")
    rel = F.regexp_replace(F.col("path"), r"^.*?" + re.escape(root_prefix.split(":", 1)[-1]) + "/?",
                           "")
    return files.select(
        "path",
        F.when(F.instr(rel, "/") > 0, F.substring_index(rel, "/", 1)).alias("pasta"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("arquivo"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modificado"),
    )


def table_name() -> Column:
    """The table a listed file belongs to: its folder, or its own stem."""
    return F.coalesce("pasta", F.regexp_replace("arquivo", r"\.[^.]*$", ""))


def inventory_of(files: DataFrame) -> DataFrame:
    """For a listing (pasta, arquivo, bytes): files, KB and an empty flag per
    container (one aggregation)."""
    return (files.groupBy(F.coalesce("pasta", F.lit(".")).alias("container"))
            .agg(F.count(F.lit(1)).alias("n_arquivos"),
                 F.round(F.sum("bytes") / 1024.0, 2).alias("total_kb"),
                 (F.sum("bytes") == 0).alias("vazio")))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """``inventory_of`` all files below ``root``."""
    return inventory_of(list_files(spark, root))


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """Per-file view with size in KB."""
    return list_files(spark, root).select(
        "pasta", "arquivo", "bytes", F.round(F.col("bytes") / 1024.0, 2).alias("kb"))


def presence_of(files: DataFrame, expected: list[str]) -> DataFrame:
    """For a listing, whether each expected folder or table is there ('exists' /
    'pending')."""
    found = files.select(table_name().alias("nome")).distinct()
    want = files.sparkSession.createDataFrame([(e,) for e in expected], "nome string")
    return (want.join(found.withColumn("_f", F.lit(True)), "nome", "left")
            .select("nome", F.when(F.col("_f"), "exists").otherwise("pending").alias("status")))


def expected_folders_status(spark: SparkSession, root: str, expected: list[str]) -> DataFrame:
    """``presence_of`` the expected entries below ``root``."""
    return presence_of(list_files(spark, root), expected)


def list_entities(spark: SparkSession, root: str, known: list[str] | None = None) -> DataFrame:
    """``entities_of`` the files below a layer folder."""
    return entities_of(list_files(spark, root), known)


def entities_of(files: DataFrame, known: list[str] | None = None) -> DataFrame:
    """Entity tables of a listing (first path level), optionally restricted to
    known names, sorted."""
    names = files.select(table_name().alias("entidade")).distinct()
    if known is not None:
        names = names.filter(F.col("entidade").isin(*known))
    return names.orderBy("entidade")


def read_classified(spark: SparkSession, path: str, formato: str,
                    header: bool | None = None, delimitador: str | None = None,
                    encoding: str | None = None, multiline: bool = False) -> DataFrame:
    """Read a file with the instructions produced by ``classify_files``
    (csv with header/delimiter/encoding, parquet, json with multiLine)."""
    if formato == "parquet":
        return spark.read.parquet(path)
    if formato == "json":
        return spark.read.option("multiLine", str(bool(multiline)).lower()).json(path)
    if formato == "csv":
        opts = {"header": str(bool(header)).lower(), "sep": delimitador or ",",
                "encoding": encoding or "UTF-8"}
        return spark.read.options(**opts).csv(path)
    raise ValueError(f"no reader for format {formato!r}")
