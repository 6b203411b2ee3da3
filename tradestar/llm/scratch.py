"""Tables that jobs of this package write between their stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradestar.session import scratch_path

#: Lets a write drop its shuffle files when it has ended: nobody reads them again.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_clean(df: DataFrame, path: str, **options: str) -> DataFrame:
    """``df`` written as Parquet and read back; its shuffle files go when the
    write has ended."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one job, below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back, which cuts its lineage: a lost executor
        costs the tasks at hand, not the whole job."""
        path = self.paths[name] = scratch_path(self.spark, "llm", name)
        return write_clean(df, path)

    def drop(self, *names: str) -> None:
        """Remove tables that no later stage reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)
