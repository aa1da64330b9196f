"""Running a stream over the input that is there, into tables under the shared folder.

Every run has a checkpoint; starting again with the same one continues where the
last run stopped.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlane.operators import ordered
from meterlane.session import materialize, new_path
from meterlane.sinks import upserts

RUN, BATCH = "run_id", "batch_id"


# Number of state partitions of new streams; without it, that of the session's shuffles.
STATE_PARTITIONS = "meterlane.streaming.statePartitions"


@contextmanager
def state_partitions(spark: SparkSession):
    """Start a stream with the number of state partitions that ``STATE_PARTITIONS`` asks for.

    The number is fixed for the life of a checkpoint and adaptive execution cannot change
    it, so it is a setting of its own and never follows from the cores of the moment.
    """
    setting, wanted = "spark.sql.shuffle.partitions", spark.conf.get(STATE_PARTITIONS, None)
    before = spark.conf.get(setting)
    spark.conf.set(setting, wanted or before)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _finish(stream: DataFrame, writer, checkpoint: str | None) -> None:
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    with state_partitions(stream.sparkSession):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def append(stream: DataFrame, label: str, path: str | None = None,
           checkpoint: str | None = None) -> DataFrame:
    """Append-mode file sink."""
    spark = stream.sparkSession
    path, checkpoint = path or new_path(spark, label), checkpoint or new_path(spark, f"{label}-state")
    _finish(stream, stream.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint)
    return spark.read.schema(stream.schema).parquet(path)


def complete(stream: DataFrame, label: str, checkpoint: str | None = None) -> DataFrame:
    """The whole result table after the last micro-batch.

    The table lies beside its checkpoint, a folder for each micro-batch, and the newest
    counts: a restart without new input still shows the last result, and no write replaces
    the only copy.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or new_path(spark, f"{label}-state")
    path = f"{checkpoint.rstrip('/')}-table"
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{path}/{BATCH}=-1")
    _finish(stream, stream.writeStream.outputMode("complete").foreachBatch(
        lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")), checkpoint)
    # Read without the partition column, then only the newest folder; numbers are few.
    versions = spark.read.schema(f"{BATCH} long").parquet(path)
    newest = versions.agg(F.max(BATCH)).first()[0]
    return spark.read.schema(stream.schema).parquet(f"{path}/{BATCH}={-1 if newest is None else newest}")


def upsert(stream: DataFrame, label: str, keys: Sequence[str], path: str | None = None,
           checkpoint: str | None = None, mode: str = "update", fold_every: int = 100) -> DataFrame:
    """Upsert sink: each micro-batch adds its changed rows, the newest row per key counts.

    Repeating a batch after a failure changes nothing; see ``sinks.upserts``. Every ``fold_every`` batches
    the log of changes is folded into the base.
    """
    spark = stream.sparkSession
    path, checkpoint = path or new_path(spark, label), checkpoint or new_path(spark, f"{label}-state")
    upserts.prepare(spark, path, stream.schema)

    def write(batch: DataFrame, number: int) -> None:
        upserts.add(batch, path)
        if (number + 1) % fold_every == 0:
            upserts.fold(batch.sparkSession, path, keys)

    _finish(stream, stream.writeStream.outputMode(mode).foreachBatch(write), checkpoint)
    return upserts.read(spark, path, keys)


def _declared(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table of batch folders, readable before the first batch."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{RUN}=0/{BATCH}=-1")
    return spark.read.schema(schema).parquet(path).drop(RUN, BATCH)


def _place(path: str, checkpoint: str, number: int) -> str:
    """Where a batch writes: repeated, it writes to the same place, and another checkpoint to another one."""
    return f"{path}/{RUN}={zlib.crc32(checkpoint.encode())}/{BATCH}={number}"


def branch(stream: DataFrame, label: str, routes: Mapping[str, Column], path: str | None = None,
           checkpoint: str | None = None) -> dict[str, DataFrame]:
    """One pass over the stream, one table per predicate."""
    spark = stream.sparkSession
    path, checkpoint = path or new_path(spark, label), checkpoint or new_path(spark, f"{label}-state")

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for name, condition in routes.items():
            batch.filter(condition).write.mode("overwrite").parquet(_place(f"{path}/{name}", checkpoint, number))
        batch.unpersist()

    for name in routes:
        _declared(spark, f"{path}/{name}", stream.schema)
    _finish(stream, stream.writeStream.foreachBatch(write), checkpoint)
    return {name: _declared(spark, f"{path}/{name}", stream.schema) for name in routes}


def each_batch(stream: DataFrame, label: str, work: Callable[[DataFrame], DataFrame], path: str | None = None,
               checkpoint: str | None = None) -> DataFrame:
    """Apply a batch function to every micro-batch and gather the results in a table."""
    spark = stream.sparkSession
    path, checkpoint = path or new_path(spark, label), checkpoint or new_path(spark, f"{label}-state")
    schema = work(spark.createDataFrame([], stream.schema)).schema
    _declared(spark, path, schema)
    _finish(stream, stream.writeStream.foreachBatch(
        lambda batch, number: work(batch).write.mode("overwrite").parquet(_place(path, checkpoint, number))), checkpoint)
    return _declared(spark, path, schema)


def every_n(stream: DataFrame, label: str, n: int, order: Sequence[str], amount: str, path: str | None = None,
            checkpoint: str | None = None) -> DataFrame:
    """A report of the totals so far after every ``n`` messages: messages, revenue and average amount.

    Messages count in the order of the micro-batches, inside one in that of ``order`` (which should
    end in a unique column). A batch is numbered by sorted slices and reduced to one row per report
    before anything is added up, so no task holds a batch. Messages and amount up to the end of a batch are
    written beside its reports, and the next batch, also after a restart, goes on from there; a
    repeated batch starts from the same place again. Null amounts count as messages and add nothing.
    """
    spark = stream.sparkSession
    path, checkpoint = path or new_path(spark, label), checkpoint or new_path(spark, f"{label}-state")
    reports = spark.createDataFrame([], "messages long, revenue double, avg_amount double").schema
    carried = f"{checkpoint.rstrip('/')}-carried"

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = (0, 0.0) if number == 0 else tuple(session.read.schema("messages long, revenue double")
                                                    .parquet(f"{carried}/{BATCH}={number - 1}").first())
        numbered = ordered.row_number(batch.select(*order, F.col(amount).cast("double").alias("__amount")),
                                      [F.col(c) for c in order], name="__row")
        report = F.ceil((F.col("__row") + before[0]) / n).cast("long")
        blocks = materialize(numbered.groupBy(report.alias("__report")).agg(
            F.count(F.lit(1)).alias("__rows"), F.coalesce(F.sum("__amount"), F.lit(0.0)).alias("__sum")), label)
        rows, amounts = blocks.agg(F.coalesce(F.sum("__rows"), F.lit(0)), F.coalesce(F.sum("__sum"), F.lit(0.0))).first()
        after = (before[0] + rows, before[1] + amounts)
        upto = ordered.running_sum(blocks, [], [F.col("__report")], F.col("__sum"), "__upto")
        messages, revenue = F.col("__report") * n, F.col("__upto") + before[1]
        full = upto.filter(messages <= after[0]).select(
            messages.alias("messages"), revenue.alias("revenue"), (revenue / messages).alias("avg_amount"))
        full.write.mode("overwrite").parquet(_place(path, checkpoint, number))
        session.createDataFrame([after], "messages long, revenue double").coalesce(1).write.mode(
            "overwrite").parquet(f"{carried}/{BATCH}={number}")

    _declared(spark, path, reports)
    _finish(stream, stream.writeStream.foreachBatch(write), checkpoint)
    return _declared(spark, path, reports)


def console(stream: DataFrame, mode: str = "complete", rows: int = 20, every: str = "5 seconds"):
    """Start printing results; the caller stops the returned query."""
    writer = stream.writeStream.outputMode(mode).format("console").option("numRows", rows)
    with state_partitions(stream.sparkSession):
        return writer.trigger(processingTime=every).start()


def memory(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """In-memory result table on the driver: for aggregates of a few rows only."""
    _finish(stream, stream.writeStream.outputMode(mode).format("memory").queryName(name), None)
    return stream.sparkSession.table(name)


def to_topic(stream: DataFrame, format_name: str, options: Mapping[str, str], checkpoint: str,
             mode: str = "append"):
    """Write key/value text to a topic; needs the connector package."""
    return (stream.select("key", "value").writeStream.format(format_name).options(**options)
            .outputMode(mode).option("checkpointLocation", checkpoint).start())
