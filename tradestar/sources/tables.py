"""Catalog registration: stored lake tables as ``<database>.<table>`` so the
documented SQL (``FROM gold.ft_balanco_comercial f JOIN gold.dim_data d``)
runs unchanged through ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradestar.session import scratch_path


def register_tables(spark: SparkSession, tables: dict[str, str], database: str = "gold",
                    fmt: str = "parquet", location: str | None = None) -> list[str]:
    """Create (or re-point) external tables over stored folders; partition
    folders are discovered from the files. The database folder goes to
    ``location`` (default: the shared checkpoint folder), never to the
    process's working directory. Returns the qualified names."""
    if location is None:
        location = scratch_path(spark, "catalog", database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    names = []
    for name, path in tables.items():
        qualified = f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {qualified}")
        spark.sql(f"CREATE TABLE {qualified} USING {fmt} LOCATION '{path}'")
        if any(c.isPartition for c in spark.catalog.listColumns(qualified)):
            # catalogs that manage partitions start with none registered
            spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
        names.append(qualified)
    return names
