"""Mappings that change over time, joined as of the month of each row.

A mapping row holds from its date until the next date of the same key. A range
condition alone would be a nested loop over both tables, so ranges are dealt to
the years they touch and rows meet them by key and year (an equi join that Spark
may shuffle or broadcast as it finds best); the range itself is only the rest of
the condition. Ranges of one key do not overlap, so a row meets one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_index(sk_data: Column) -> Column:
    """Consecutive number of the month YYYYMM."""
    return (F.floor(sk_data / 100) * 12 + sk_data % 100 - 1).cast("int")


def first_month(day: Column) -> Column:
    """Number of the first month whose first day is not before ``day``."""
    return (F.year(day) * 12 + F.month(day) - 1 + F.when(F.dayofmonth(day) > 1, 1).otherwise(0)).cast("int")


def validity_ranges(mapping: DataFrame, key: str, from_col: str, version_col: str) -> DataFrame:
    """``mapping`` plus ``_from`` and ``_to`` (months, the end excluded; null: still
    valid). Of rows of a key that begin in one month the highest version counts.
    A key's rows are its versions, so the window holds few."""
    rest = [c for c in mapping.columns if c not in (key, version_col)]
    begun = mapping.withColumn("_from", first_month(F.col(from_col)))
    one = begun.groupBy(key, "_from").agg(F.max(F.struct(version_col, *rest)).alias("_m"))
    order = Window.partitionBy(key).orderBy("_from")
    return one.select(key, "_from", F.lead("_from").over(order).alias("_to"),
                      *[F.col(f"_m.{c}").alias(c) for c in mapping.columns if c != key])


def valid_in_month(rows: DataFrame, ranges: DataFrame, key: str, month_col: str, value_cols: list[str],
                   first_year: int, last_year: int) -> DataFrame:
    """``rows`` plus ``value_cols`` of the range of its key that holds in its month
    (YYYYMM; null where none does). ``first_year`` and ``last_year`` bound the
    rows' months: ranges are dealt to no other years."""
    start, end = F.lit(first_year * 12), F.lit(last_year * 12 + 12)
    a, z = F.greatest("_from", start), F.least(F.coalesce("_to", end), end) - 1
    dealt = ranges.filter(a <= z).select(
        key, "_from", "_to", *value_cols,
        F.explode(F.sequence(F.floor(a / 12), F.floor(z / 12))).alias("_year"))
    month = month_index(F.col(f"r.{month_col}"))
    on = ((F.col(f"r.{key}") == F.col(f"m.{key}")) & (F.floor(F.col(f"r.{month_col}") / 100) == F.col("m._year"))
          & (month >= F.col("m._from")) & (F.col("m._to").isNull() | (month < F.col("m._to"))))
    return rows.alias("r").join(dealt.alias("m"), on, "left").select("r.*", *[f"m.{c}" for c in value_cols])
