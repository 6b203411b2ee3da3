"""The catalogue of the lake's tables from sketches that are stored and merged.

``column_sketches`` takes a table once and gives one small row for each column
and partition of it: rows, nulls, bounds and a HyperLogLog sketch of its values.
They are stored by table and partition, so a new month costs only its own scan,
and ``catalogue`` merges what is stored: counts and bounds exactly, distinct
values with a relative standard error of ERROR.

Values enter the sketch as 64-bit hashes, so columns of any type have one; nulls
do not. Bounds are text: floating numbers with six decimals, time stamps as
microseconds since 1970, everything else as Spark casts it; columns without an
order (arrays, maps, structs) have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.sources.sinks import write_snapshot

LOG_SLOTS = 12
#: Relative standard error of a HyperLogLog sketch of 2^LOG_SLOTS slots.
ERROR = 1.04 / 2 ** (LOG_SLOTS / 2)
WHOLE = "tudo"
STORED = ("tabela string, particao string, coluna string, tipo string, linhas long, nulos long, "
          "minimo string, maximo string, esboco binary")


def _text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.cast("decimal(38,6)").cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("string")
    return value.cast("string")


def column_sketches(df: DataFrame, table: str, partition: Column | None = None) -> DataFrame:
    """One row for each column of ``df`` and value of ``partition`` (a text such
    as the month; default: the whole table), by one aggregation."""
    rows = df.withColumn("_p", F.lit(WHOLE) if partition is None else F.coalesce(
        partition.cast("string"), F.lit("nulo")))
    n, described = F.count(F.lit(1)).alias("linhas"), []
    for f in df.schema.fields:
        c, ordered = F.col(f"`{f.name}`"), not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        bounds = [_text(by(c), f.dataType) if ordered else F.lit(None).cast("string") for by in (F.min, F.max)]
        described.append(F.struct(
            F.lit(f.name).alias("coluna"), F.lit(f.dataType.simpleString()).alias("tipo"),
            (F.count(F.lit(1)) - F.count(c)).alias("nulos"), bounds[0].alias("minimo"), bounds[1].alias("maximo"),
            F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), LOG_SLOTS).alias("esboco")))
    one = rows.groupBy("_p").agg(n, F.array(*described).alias("c"))
    return one.select(F.lit(table).alias("tabela"), F.col("_p").alias("particao"), "linhas",
                      F.explode("c").alias("c")).select(
        "tabela", "particao", "c.coluna", "c.tipo", "linhas", "c.nulos", "c.minimo", "c.maximo", "c.esboco")


def update(path: str, df: DataFrame, table: str, partition: Column | None = None) -> None:
    """Store the sketches of ``df``; those of partitions that it does not hold
    stay as they are. ``df`` is the whole of each partition that it holds."""
    write_snapshot(column_sketches(df, table, partition), path, ["tabela", "particao"], "parquet")


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """tabela, coluna, tipo, linhas, nulos, minimo, maximo, distintos_aprox of all
    stored sketches."""
    stored = spark.read.schema(STORED).parquet(path)
    number = F.col("tipo").rlike("^(tinyint|smallint|int|bigint|decimal.*|double|float|timestamp.*)$")
    key = lambda c: F.when(F.col(c).isNotNull(), F.struct(
        F.when(number, F.col(c).try_cast("double")), F.when(number, F.col(c).try_cast("decimal(38,6)")), F.col(c)))
    return stored.groupBy("tabela", "coluna", "tipo").agg(
        F.sum("linhas").alias("linhas"), F.sum("nulos").alias("nulos"),
        F.min_by("minimo", key("minimo")).alias("minimo"), F.max_by("maximo", key("maximo")).alias("maximo"),
        F.hll_sketch_estimate(F.hll_union_agg("esboco")).alias("distintos_aprox"))
