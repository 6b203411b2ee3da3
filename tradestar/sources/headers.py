"""Landing files of one glob, each read by its own header.

Files under a glob may name other columns, or name them in another order, than
their neighbours. ``read_heads`` takes the first line of each file on the
executors (by position, not the file), ``routed`` decides which files a layout
can read, and ``scan_by_header`` reads the files of each distinct header by a
scan of their own and joins the scans by name. So the order in which files arrive
decides nothing, and a file that fits no layout is named instead of read wrongly.

A column that a file lacks is null; a column that the layout does not name is
dropped. A file without a header line (one without a byte is none to Spark, and
has no rows to lose), with a name twice (Spark reads names without regard to
case), or with none of the layout's columns does not fit.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.functions.names import fallback_name
from tradestar.operators.gold import union_all_by_name
from tradestar.sources.archives import _opened
from tradestar.sources.files import LANDING_OPTIONS

HEAD_SCHEMA = "path string, cabecalho array<string>"
#: Bytes in which a header line must end.
HEAD_BYTES = 1 << 20
EMPTY, REPEATED, FOREIGN = "sem cabeçalho", "coluna repetida", "nenhuma coluna do layout"


def _head(path: str, encoding: str, sep: str) -> list[str]:
    """Names in a file's first line; none if it is empty or not a line."""
    with _opened(path) as raw:
        line, end, _ = raw.read(HEAD_BYTES).partition(b"\n")
    if not end and len(line) == HEAD_BYTES:
        return []
    text = line.decode(encoding).removeprefix("﻿").rstrip("\r")
    return next(csv.reader(io.StringIO(text), delimiter=sep), []) if text.strip() else []


def read_heads(files: DataFrame, encoding: str = LANDING_OPTIONS["encoding"],
               sep: str = LANDING_OPTIONS["sep"]) -> DataFrame:
    """(path, names in its first line) of the files named by ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column("path")
            heads = [_head(p, encoding, sep) for p in paths.to_pylist()]
            yield pa.RecordBatch.from_arrays([paths, pa.array(heads, pa.list_(pa.string()))],
                                             names=["path", "cabecalho"])

    return files.select("path").mapInArrow(run, HEAD_SCHEMA)


def routed(heads: DataFrame, mapping: dict[str, str] | None) -> DataFrame:
    """``heads`` plus ``problema``: why the layout (``mapping``; None: any names)
    cannot read the file, null if it can."""
    lower = F.transform("cabecalho", F.lower)
    fits = F.lit(True) if mapping is None else F.arrays_overlap("cabecalho", F.array(*map(F.lit, mapping)))
    return heads.withColumn("problema", F.when(F.size("cabecalho") == 0, EMPTY)
                            .when(F.size(F.array_distinct(lower)) < F.size(lower), REPEATED)
                            .when(~fits, FOREIGN))


def _named(df: DataFrame, mapping: dict[str, str] | None) -> DataFrame:
    targets = {c: fallback_name(c) for c in df.columns} if mapping is None else mapping
    return df.select(*[F.col(f"`{c}`").alias(targets[c]) for c in df.columns if c in targets])


def scan_by_header(spark: SparkSession, files: DataFrame, mapping: dict[str, str] | None) -> DataFrame | None:
    """The rows of the ``routed`` files that fit, all columns strings under the
    layout's names (in the layout's order); None if no file fits. The names of
    the files pass through the driver, as in any scan; a stream hands over a
    bounded number at a time (``maxFilesPerTrigger``)."""
    groups = (files.filter("problema is null").groupBy("cabecalho")
              .agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("cabecalho").collect())
    scans = []
    for g in groups:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in g["cabecalho"]])
        scans.append(_named(spark.read.schema(schema).options(**LANDING_OPTIONS).csv(g["paths"]), mapping))
    if not scans:
        return None
    rows = union_all_by_name(scans)
    order = rows.columns if mapping is None else [t for t in mapping.values() if t in rows.columns]
    return rows.select(*[f"`{c}`" for c in order])


def missing_columns(rows: DataFrame, mapping: dict[str, str] | None) -> list[str]:
    """Columns of the layout that none of the files has."""
    return [t for t in (mapping or {}).values() if t not in rows.columns]
