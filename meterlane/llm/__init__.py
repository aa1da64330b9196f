"""Operators for preparing training data; nothing else in the library imports them."""

from pyspark.sql import SparkSession

from meterlane.session import prepare

# Rows and bytes that go to a Python worker at once: texts can be long, and workers share
# what the executor's heap leaves.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def prepared(spark: SparkSession) -> SparkSession:
    """The library's settings and small batches."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return prepare(spark)
