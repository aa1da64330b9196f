"""Tables that a stream changes by key: a log of changed rows over a base, in one versioned table.

Each micro-batch adds one folder to the log. The newest row of a key counts, and newest means written in
the latest version of the table: not the highest batch number, which starts again with a new checkpoint.
``fold`` moves the log into the base, where only files that hold a changed key are written anew, so the log
that readers have to rank never holds more than the batches since the last fold. Every step is a version of its
own: readers see all of a batch or nothing, and a batch repeated after a failure adds rows equal to those it added before.

One stream writes to a table at a time; a fold may run beside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from meterlane.operators.cleaning import first_per_key
from meterlane.sinks import versioned

LOG, WRITTEN = "log", "__written"


def prepare(spark: SparkSession, path: str, schema: StructType) -> None:
    """Make the table with its declared columns, so that it can be read before the first row arrives."""
    if versioned.version(spark, path) is None:
        empty = spark.createDataFrame([], StructType(list(schema.fields)).add(WRITTEN, LongType()))
        versioned.replace(empty, path)


def add(batch: DataFrame, path: str) -> None:
    """One micro-batch, as a folder of the log. A fold that comes between is no obstacle."""
    spark = batch.sparkSession
    at = versioned.known(spark, path)
    rows = batch.withColumn(WRITTEN, F.lit(at.number + 1).cast("long"))
    folder = versioned.written(rows, path)
    while True:
        parts = {**at.parts, LOG: {**at.parts.get(LOG, {}), folder: None}}
        try:
            return versioned.point(spark, path, versioned.Version(
                at.number + 1, versioned.wider(at.schema, rows.schema), parts))
        except versioned.Conflict:
            at = versioned.known(spark, path)


def fold(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Move the log into the base; raises ``Conflict``, without a change, if a batch comes between.

    Rows with a null in the key match no row of the base, so each fold adds them; readers still take the newest.
    """
    at = versioned.known(spark, path)
    if at.parts.get(LOG):
        versioned.merge(versioned.frame(spark, path, at, LOG), path, keys, [F.col(WRITTEN).desc()], at)


def log_length(spark: SparkSession, path: str) -> int:
    """Batches since the last fold."""
    return len(versioned.known(spark, path).parts.get(LOG, {}))


def read(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key; null keys are equal to each other."""
    at = versioned.known(spark, path)
    rows = versioned.frame(spark, path, at, versioned.ROWS)
    if at.parts.get(LOG):
        rows = rows.unionByName(versioned.frame(spark, path, at, LOG))
    return first_per_key(rows, keys, [F.col(WRITTEN).desc()]).drop(WRITTEN)
