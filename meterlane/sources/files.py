"""CSV, JSON and Parquet scans, catalog views, lineage and partition listings."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.session import new_path

# Workers get the functions below with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Text files keep milliseconds only unless writer and reader are told otherwise.
EXACT_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def typed_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
              **options) -> DataFrame:
    """CSV with header and declared schema; ``.csv.gz`` works as well.

    Columns are taken by position unless ``enforceSchema`` is off. A gzip file is
    read by one task, so callers with few large ones should repartition.
    """
    return spark.read.schema(schema).options(header=True, **options).csv(path)


def text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text."""
    return spark.read.option("header", True).csv(path)


def inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(header=True, inferSchema=True).csv(path)


def sampled_schema(spark: SparkSession, path: str, rows: int = 1000) -> T.StructType:
    """Schema inferred from the first rows of a CSV folder.

    The sample is bounded by ``rows``; it goes through one small file because the
    reader infers types from files.
    """
    sample = new_path(spark, "csv-sample")
    text_csv(spark, path).limit(rows).write.option("header", True).csv(sample)
    return inferred_csv(spark, sample).schema


def csv_known_columns(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read by header name: columns the schema does not name are ignored."""
    wide = text_csv(spark, path)
    return wide.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def parquet_by_name(spark: SparkSession, *paths: str) -> DataFrame:
    """Files with differing columns, united by column name."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   **options) -> DataFrame:
    """One JSON document per line; the reader splits large files."""
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema else reader).json(path)


def with_source_file(df: DataFrame, name: str = "filename") -> DataFrame:
    """Name of the file each row came from."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def rows_per_file(df: DataFrame) -> DataFrame:
    """One row per file; files of one name in several folders are several files."""
    return (df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("filename"),
                      F.col("_metadata.file_size").alias("bytes"))
            .groupBy("path", "filename", "bytes").agg(F.count(F.lit(1)).alias("n")).drop("path"))


def footers(df: DataFrame, column: str | None = None) -> DataFrame:
    """One row per Parquet file of a frame from the files' footers alone: ``path``, ``n`` rows, ``bytes``, ``row_groups`` and, for
    a whole-number ``column``, its ``least`` and ``greatest`` value (null where the writer left no statistics or all is null).

    Tasks open the files; the driver holds their names, as it does for every scan. Empty files have a row too.
    """
    names = df.inputFiles()
    spark = df.sparkSession
    listed = spark.createDataFrame([(n,) for n in names], "path string").repartition(
        max(1, min(len(names), 4 * spark.sparkContext.defaultParallelism)))

    def opened(batches):
        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for name in batch["path"]:
                store, place = pafs.FileSystem.from_uri(name)
                size = store.get_file_info(place).size
                with store.open_input_file(place) as file:
                    told = pq.ParquetFile(file).metadata
                ranges = [_range(told.row_group(i), column) for i in range(told.num_row_groups)]
                known = all(r is not None for r in ranges)
                values = [v for r in ranges for v in r or ()]
                rows.append((name, told.num_rows, size, told.num_row_groups,
                             min(values) if known and values else None, max(values) if known and values else None))
            yield pd.DataFrame(rows, columns=["path", "n", "bytes", "row_groups", "least", "greatest"]).astype(
                {"least": "Int64", "greatest": "Int64"})

    return listed.mapInPandas(opened, "path string, n long, bytes long, row_groups int, least long, greatest long")


def _range(group, column: str | None):
    """Least and greatest value of a row group, nothing where all is null, None where that isn't known."""
    for i in range(group.num_columns if column else 0):
        chunk = group.column(i)
        if chunk.path_in_schema == column:
            stats = chunk.statistics
            if stats is not None and stats.has_min_max:
                return stats.min, stats.max
            return () if stats is not None and stats.has_null_count and stats.null_count == chunk.num_values else None
    return None


def partition_stats(df: DataFrame, by: str, column: str | None = None) -> DataFrame:
    """Rows, files and bytes of each partition, and the range of a whole-number column, from the footers alone.

    ``by`` is a folder level ``by=value``; its values come as text, null for the default partition.
    """
    value = F.regexp_extract("path", f"/{by}=([^/]*)/", 1)
    # Folder names are escaped by percent signs, and the path once more; a plus sign stands for itself.
    for _ in range(2):
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    value = F.when(value != "__HIVE_DEFAULT_PARTITION__", value)
    return footers(df, column).groupBy(value.alias(by)).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"))


def schema_listing(df: DataFrame) -> DataFrame:
    """Column names, types, nullability and positions as rows."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, is_nullable boolean")


def object_store_options(spark: SparkSession, settings: dict[str, str]) -> None:
    """File-system settings (connector class, key file, ...) for later reads and writes.

    Paths stay plain URIs; the connector has to be on the class path.
    """
    for key, value in settings.items():
        spark.conf.set(key.removeprefix("spark.hadoop."), value)


def preview(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order).limit(n)
