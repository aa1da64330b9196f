"""Reads and writes over JDBC. The driver of the database must be on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Rows per round trip of a chunked load.
CHUNK_ROWS = 100_000


def read_options(url: str, table: str, column: str | None = None, lower: int | None = None,
                 upper: int | None = None, partitions: int = 1) -> dict[str, str]:
    """Options of a JDBC scan; a numeric column splits it into parallel ranges."""
    options = {"url": url, "dbtable": table}
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs both bounds")
        options |= {"partitionColumn": column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
    return options


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] = {},
               **split) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **split), **properties).load()


def write_options(url: str, table: str, writers: int = 4, chunk: int = CHUNK_ROWS) -> dict[str, str]:
    return {"url": url, "dbtable": table, "numPartitions": str(writers), "batchsize": str(chunk)}


def write_table(df: DataFrame, url: str, table: str, properties: Mapping[str, str] = {},
                writers: int = 4, chunk: int = CHUNK_ROWS) -> None:
    """Create the table from an empty head, then append in chunks."""
    options = write_options(url, table, writers, chunk) | dict(properties)
    df.limit(0).write.format("jdbc").options(**options).mode("overwrite").save()
    df.write.format("jdbc").options(**options).mode("append").save()
