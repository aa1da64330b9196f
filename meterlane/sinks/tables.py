"""File layout of written tables, and loads that replace whole partitions. Loads by row are in ``versioned``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlane.operators.merging import upsert
from meterlane.session import materialize


def write_files(df: DataFrame, path: str, files: int, **options: str) -> None:
    """Parquet with a chosen number of files."""
    df.repartition(files).write.options(**options).mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """One file, for a report that has been aggregated to few rows.

    The extra shuffle moves the finished rows only; ``coalesce(1)`` would pull the
    aggregation itself into the single writing task.
    """
    df.repartition(1).write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], cluster: Sequence[str] = ()) -> None:
    """Hive-partitioned folders, sorted inside by the cluster columns.

    The rebalance hint groups rows by partition, so a task does not open a file in
    every folder, and lets AQE split a busy partition over several tasks and join
    small ones. Existing partitions that get no rows are left alone.
    """
    (rebalanced(df, *by).sortWithinPartitions(*by, *cluster).write.partitionBy(*by)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def rebalanced(df: DataFrame, *by: str) -> DataFrame:
    """Rows grouped by columns as far as partitions of even size allow."""
    return df.hint("rebalance", *by)


def create_table(df: DataFrame, name: str, path: str) -> None:
    """CREATE TABLE AS SELECT at an explicit folder."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def create_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store a table in sorted buckets, so that joins on the key need no shuffle.

    A bucket is read by one task and is never split: for a table with a hot key, take
    ``create_table`` instead; its joins shuffle and AQE splits the hot key.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A catalog entry over existing Parquet files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def create_if_absent(spark: SparkSession, name: str, columns: str, path: str) -> DataFrame:
    """An empty table with declared columns unless it is already there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")
    return spark.table(name)


def write_external(df: DataFrame, format_name: str, options: dict[str, str],
                   mode: str = "append") -> None:
    """Warehouse, JDBC or any other connector that is on the class path."""
    df.write.format(format_name).options(**options).mode(mode).save()


def merge_partitions(df: DataFrame, path: str, keys: Sequence[str], by: str) -> DataFrame:
    """Upsert that rewrites only the partitions the new rows fall into.

    ``by`` has to be one of the keys, so that no row can move to another partition.
    """
    if by not in keys:
        raise ValueError(f"the partition column {by!r} must be part of the key")
    target = df.sparkSession.read.parquet(path)
    merged = upsert(_partitions_of(target, df, by), df, keys)
    write_partitioned(materialize(merged, "merge-partitions"), path, [by])
    return df.sparkSession.read.parquet(path)


def _partitions_of(target: DataFrame, df: DataFrame, by: str) -> DataFrame:
    """The target's rows in the partitions that ``df`` has rows for.

    The list of partitions becomes a filter on the partition column, so the scan opens no
    other folder. The write puts all of them into folders, so the list is one that Spark's own
    file index holds as well.
    """
    values = [row[0] for row in df.select(by).distinct().collect()]
    named = F.col(by).isin([v for v in values if v is not None])
    return target.filter(named | F.col(by).isNull() if None in values else named)


def replace_days(df: DataFrame, path: str, by: str, first: str, last: str) -> DataFrame:
    """Time-interval load of a table partitioned by day, for the whole days first..last.

    Only the folders of that interval are written. Days that had rows before and
    have none now are emptied one by one; there are at most as many as the interval
    has days.
    """
    spark = df.sparkSession
    inside = F.col(by).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    rows = materialize(df.filter(inside), "replace-days")
    old_days = spark.read.parquet(path).filter(inside).select(by).distinct()
    emptied = old_days.join(rows.select(by).distinct(), by, "left_anti").collect()
    write_partitioned(rows, path, [by])
    for row in emptied:
        rows.limit(0).drop(by).write.mode("overwrite").parquet(f"{path}/{by}={row[by]}")
    return spark.read.parquet(path)


def backfill(df: DataFrame, path: str, by: str, done: DataFrame | None) -> DataFrame:
    """Write the partitions that are not there yet, all in one job.

    ``done`` lists the partitions present; the wanted ones follow from ``df``.
    """
    todo = df if done is None else df.join(done.select(by).distinct(), by, "left_anti")
    write_partitioned(todo, path, [by])
    return df.sparkSession.read.parquet(path)
