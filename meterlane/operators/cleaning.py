"""Staging projections, row filters, de-duplication and step counts."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlane.functions.times import within


def staged(df: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Cast and rename in one projection: ``new name -> (source column, type)``."""
    return df.select(*[F.col(src).try_cast(kind).alias(name)
                       for name, (src, kind) in columns.items()])


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names both tables have, in the order of the left one."""
    return [c for c in left.columns if c in set(right.columns)]


def keep_all(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows that meet every named condition."""
    for condition in conditions.values():
        df = df.filter(condition)
    return df


def step_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows left after each cleaning step and the share dropped by it, in one pass."""
    passed, kept = F.lit(True), [F.count(F.lit(1)).alias("n0")]
    for i, condition in enumerate(conditions.values(), start=1):
        passed = passed & condition
        kept.append(F.count_if(passed).alias(f"n{i}"))
    counts = df.agg(*kept)
    steps = [F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                      F.col(f"n{i - 1}").alias("rows_before"), F.col(f"n{i}").alias("rows_after"))
             for i, name in enumerate(conditions, start=1)]
    dropped = F.col("rows_before") - F.col("rows_after")
    return (counts.select(F.inline(F.array(*steps)))
            .withColumn("dropped_pct", F.try_divide(dropped * 100.0, F.col("rows_before"))))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """Keep the first ``n`` rows of each key.

    The filter on the row number lets Spark keep only ``n`` rows per key in every
    map task before the shuffle, so a hot key stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(window))
            .filter(F.col("__rn") <= n).drop("__rn"))


def sample_in_dev(df: DataFrame, column: str, start: str, end: str, target: str) -> DataFrame:
    """The fixed sample range in a development run, everything otherwise."""
    return df.filter(within(column, start, end)) if target == "dev" else df


def days_back(argument: int | None = None, variable: str = "DAYS_BACK", default: int = 30) -> int:
    """Argument before environment variable before default."""
    if argument is not None:
        return int(argument)
    return int(os.environ.get(variable, default))


def last_days(df: DataFrame, column: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days up to the newest value in the table."""
    newest = df.agg(F.max(column).alias("newest"))
    limit = F.col("newest").cast("date") - F.make_dt_interval(F.lit(days))
    bound = newest.select(limit.cast("timestamp_ntz").alias("bound")).scalar()
    return df.filter(F.col(column) >= bound)


def masked(df: DataFrame, *columns: str) -> DataFrame:
    """Replace the texts of sensitive columns by their SHA-256 digests."""
    return df.withColumns({c: F.sha2(F.col(c).cast("string"), 256) for c in columns})


def deleted_where(df: DataFrame, condition: Column) -> DataFrame:
    """What is left after DELETE: rows whose condition is false or unknown."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
