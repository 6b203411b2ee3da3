"""tradestar: a Spark-native medallion lakehouse for foreign-trade and
company-registry data.

Every operator is a plain ``DataFrame -> DataFrame`` function. The layers are

* ``sources``   – scans (CSV, ZIP via ``binaryFile``), file inventories, sinks
* ``streaming`` – checkpointed run-to-completion ingestion
* ``operators`` – silver cleaning, gold star schema, marts, quality reports
* ``functions`` – column expressions (keys, dates, masking, name rules)
* ``plans``     – the medallion job and the query registry
"""

__version__ = "0.1.0"
