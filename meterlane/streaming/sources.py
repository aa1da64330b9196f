"""Streams from topics and folders, and the message form of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def topic(spark: SparkSession, servers: str, name: str, start: str = "earliest",
          format_name: str = "kafka", **options: str) -> DataFrame:
    """Key/value stream of a topic; needs the connector package on the class path."""
    reader = spark.readStream.format(format_name).options(**{
        "kafka.bootstrap.servers": servers, "subscribe": name, "startingOffsets": start, **options})
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"),
                                F.col("timestamp"))


def folder(spark: SparkSession, path: str, schema: T.StructType | None = None,
           format_name: str = "parquet", since: str | None = None, **options: str) -> DataFrame:
    """Stream over the files of a folder, from the earliest one or from those written after ``since``.

    ``since`` is a fixed time, so that a restarted stream means the same files by it.
    """
    if schema is None:
        schema = spark.read.format(format_name).load(path).schema
    stream = spark.readStream.format(format_name).schema(schema).options(**options).load(path)
    if since is None:
        return stream
    return stream.filter(F.col("_metadata.file_modification_time") > F.lit(since).cast("timestamp"))


def as_messages(df: DataFrame, key: str, columns: Sequence[str], text: str = "json",
                separator: str = ", ") -> DataFrame:
    """Rows as text key and value, the value as JSON or as delimited text."""
    if text == "json":
        value = F.to_json(F.struct(*columns))
    else:
        value = F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))
