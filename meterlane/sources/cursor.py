"""Incremental reads that remember how far they came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlane.operators.merging import missing_rows
from meterlane.session import materialize

STATE = "pipeline string, cursor timestamp_ntz, run int"


def remembered(spark: SparkSession, state_path: str, pipeline: str) -> tuple | None:
    """Last cursor value and run number of a pipeline, if it ran before."""
    state = spark.read.schema(STATE).parquet(state_path).filter(F.col("pipeline") == pipeline)
    return state.agg(F.max("cursor"), F.max("run")).first()


def load_since_cursor(source: DataFrame, target_path: str, state_path: str, pipeline: str,
                      cursor: str, keys: Sequence[str], initial: str) -> int:
    """Append the rows at or beyond the remembered cursor and move it; returns rows loaded.

    Rows exactly at the cursor are read again, because more of them may have
    arrived since, and are dropped if the target already has their key.
    """
    spark = source.sparkSession
    spark.createDataFrame([], STATE).write.mode("append").parquet(state_path)
    value, run = remembered(spark, state_path, pipeline)
    bound = F.lit(value if value is not None else initial).cast("timestamp_ntz")
    fresh = source.filter(F.col(cursor) >= bound)
    if value is not None:
        seen = spark.read.parquet(target_path).filter(F.col(cursor) >= bound)
        fresh = missing_rows(seen, fresh, keys)
    fresh = materialize(fresh, "cursor")
    loaded, newest = fresh.agg(F.count(F.lit(1)), F.max(cursor)).first()
    fresh.write.mode("append").parquet(target_path)
    if loaded:
        (spark.createDataFrame([(pipeline, newest, (run or 0) + 1)], STATE)
         .write.mode("append").parquet(state_path))
    return loaded
