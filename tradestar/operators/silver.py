"""Silver layer: cleaning chain of the trusted tables.

Name operations act on the schema and end in one ``toDF``/``select``; value
operations are one projection over all string columns (not one ``withColumn``
per column, which makes analysis quadratic in the column count). The only
shuffle of the chain is the dedup, a hash aggregate with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.functions.names import fallback_name, header_names, rename_positional_names
from tradestar.layouts import FOREIGN_SUFFIXES

NULL_TEXT = "N/A"
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalize_headers(df: DataFrame) -> DataFrame:
    """Accent-free, lower-case, underscore names, each of them once."""
    return df.toDF(*header_names(df.columns))


def rename_fallback(df: DataFrame) -> DataFrame:
    """Rename used when no layout applies: lower case, spaces -> '_'."""
    return df.toDF(*[fallback_name(c) for c in df.columns])


def rename_by_mapping(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by dict; absent keys are ignored, other columns kept."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename the first min(len) columns by position."""
    return df.toDF(*rename_positional_names(df.columns, names))


def drop_foreign_columns(df: DataFrame, suffixes: tuple[str, ...] = FOREIGN_SUFFIXES) -> DataFrame:
    """Drop English/Spanish duplicates (names ending in a language suffix)."""
    return df.drop(*[c for c in df.columns if c.endswith(suffixes)])


def _map_strings(df: DataFrame, fn) -> DataFrame:
    strings = set(string_columns(df))
    return df.select(*[fn(F.col(c)).alias(c) if c in strings else F.col(c) for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    return _map_strings(df, F.trim)


def upper_strings(df: DataFrame) -> DataFrame:
    return _map_strings(df, F.upper)


def trim_upper_strings(df: DataFrame) -> DataFrame:
    """trim then upper in a single projection."""
    return _map_strings(df, lambda c: F.upper(F.trim(c)))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row dedup (hash aggregate on all columns; duplicates collapse
    map-side before the shuffle, so a hot duplicated row costs nothing)."""
    return df.dropDuplicates()


def treat_nulls(df: DataFrame, protect: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """numeric null -> 0, string null -> 'N/A'; date/time/boolean stay null.

    ``protect`` lists columns that must keep their nulls (keys and codes), so
    that later quality gates and defaults still see a missing value.
    """
    keep = set(protect)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in keep:
            out.append(c)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            # like DataFrame.fillna, NaN is filled as well
            out.append(F.when(c.isNull() | F.isnan(c), F.lit(0).cast(f.dataType))
                       .otherwise(c).alias(f.name))
        elif isinstance(f.dataType, _NUMERIC):
            out.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(c, F.lit(NULL_TEXT)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def key_columns(columns: list[str]) -> list[str]:
    """Columns never filled in our silver: codes, states, year and month."""
    return [c for c in columns
            if c.startswith(("codigo_", "uf", "cnpj_", "cnae")) or c in ("ano", "mes")]


def silver_clean(df: DataFrame, mapping: dict[str, str] | None = None,
                 drop_foreign: bool = False, fill_first: bool = False,
                 protect: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """rename (layout) or normalise -> [drop foreign] -> trim -> upper -> dedup
    -> null fill. ``fill_first`` fills before the dedup, so rows that become
    equal after filling collapse too (the chain is then idempotent)."""
    out = rename_by_mapping(df, mapping) if mapping else normalize_headers(df)
    if drop_foreign:
        out = drop_foreign_columns(out)
    out = trim_upper_strings(out)
    if fill_first:
        return dedup_rows(treat_nulls(out, protect))
    return treat_nulls(dedup_rows(out), protect)


def dedup_latest(df: DataFrame, business: list[str], order_by: list[str]) -> DataFrame:
    """Dedup on business columns, keeping the row with the greatest
    ``order_by`` (e.g. newest ``ingestion_timestamp``). Aggregate, not window:
    partial aggregation keeps a hot key from landing whole in one task."""
    rest = [c for c in df.columns if c not in business]
    ordered = [c for c in order_by] + [c for c in rest if c not in order_by]
    return (df.groupBy(*business).agg(F.max(F.struct(*ordered)).alias("_r"))
            .select(*business, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def silver_clean_registry(df: DataFrame, provenance: tuple[str, str] = (
        "ingestion_timestamp", "file_source")) -> DataFrame:
    """Registry chain: normalise -> drop foreign -> trim/upper -> dedup on the
    business columns (provenance excluded, newest load wins) -> null fill of
    the descriptive columns; keys, states and codes keep their nulls."""
    out = drop_foreign_columns(normalize_headers(df))
    out = trim_upper_strings(out)
    business = [c for c in out.columns if c not in provenance]
    out = dedup_latest(out, business, list(provenance))
    return treat_nulls(out, protect=[*provenance, *key_columns(out.columns)])


def typed_columns(df: DataFrame, types: dict[str, str],
                  reject_column: str = "erro_tipagem") -> DataFrame:
    """Strong typing: ``try_cast`` each listed column; ``reject_column`` names
    the columns whose non-null input did not convert (null when clean). Values
    are cast in an inner projection and compared in an outer one, so each is
    converted once."""
    cast = {c: f"__typed_{i}" for i, c in enumerate(types)}
    inner = df.select("*", *[F.col(c).try_cast(t).alias(cast[c]) for c, t in types.items()])
    failed = [F.when(F.col(c).isNotNull() & F.col(cast[c]).isNull(), F.lit(c)) for c in types]
    out = [F.col(cast[c]).alias(c) if c in cast else F.col(c) for c in df.columns]
    return inner.select(*out, F.nullif(F.concat_ws(",", *failed), F.lit("")).alias(reject_column))


def split_rejects(typed: DataFrame, reject_column: str = "erro_tipagem"):
    """(clean rows, rejected rows) of a ``typed_columns`` result."""
    return (typed.filter(F.col(reject_column).isNull()).drop(reject_column),
            typed.filter(F.col(reject_column).isNotNull()))


def schema_problems(actual: T.StructType, expected: T.StructType) -> list[tuple]:
    """(column, problem, expected type, found type) from schemas alone:
    missing / unexpected / wrong type (string input is checked by value)."""
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in expected.fields}
    out = []
    for name, dtype in want.items():
        if name not in have:
            out.append((name, "missing", dtype.simpleString(), None))
        elif have[name] != dtype and not isinstance(have[name], T.StringType):
            out.append((name, "wrong_type", dtype.simpleString(), have[name].simpleString()))
    for name, dtype in have.items():
        if name not in want:
            out.append((name, "unexpected", None, dtype.simpleString()))
    return out


def validate_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Schema and value validation against a layout, as a DataFrame of
    (coluna, problema, esperado, encontrado, n_linhas).

    Schema problems (missing / unexpected / wrong type) come from the schemas;
    value problems count, in one aggregation pass over the data, the rows whose
    non-null text does not convert to the expected type.
    """
    spark = df.sparkSession
    actual = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    problems = schema_problems(df.schema, expected)
    schema_rows = spark.createDataFrame(
        problems, "coluna string, problema string, esperado string, encontrado string"
    ).withColumn("n_linhas", F.lit(None).cast("bigint"))

    checked = [n for n, t in want.items()
               if n in actual and isinstance(actual[n], T.StringType)
               and not isinstance(t, T.StringType)]
    if not checked:
        return schema_rows
    counts = df.agg(*[F.count(F.when(F.col(c).isNotNull()
                                     & F.col(c).try_cast(want[c]).isNull(), 1)).alias(c)
                      for c in checked])
    stack = ", ".join(f"'{c}', '{want[c].simpleString()}', `{c}`" for c in checked)
    values = (counts.selectExpr(f"stack({len(checked)}, {stack}) AS (coluna, esperado, n_linhas)")
              .filter(F.col("n_linhas") > 0)
              .select("coluna", F.lit("invalid_values").alias("problema"), "esperado",
                      F.lit("string").alias("encontrado"), F.col("n_linhas").cast("bigint")))
    return schema_rows.unionByName(values)
