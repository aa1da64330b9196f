"""Session windows over finished tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlane.functions.numbers import total


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap_seconds: int,
             sums: dict[str, str] | None = None) -> DataFrame:
    """Runs of events per key whose neighbours are at most ``gap_seconds`` apart.

    Events in one cell as wide as the gap always belong together, so the rows are
    first reduced to one per (key, cell), map-side. The window then sees at most
    one row per cell of a key, however many events the key has.
    ``session_end`` is the last event plus the gap.
    """
    gap = gap_seconds * 1_000_000
    at = F.unix_micros(F.col(time).cast("timestamp"))
    sums = sums or {}
    cells = (df.withColumn("__at", at)
             .groupBy(*keys, F.floor(F.col("__at") / gap).alias("__cell"))
             .agg(F.min("__at").alias("__first"), F.max("__at").alias("__last"),
                  F.count(F.lit(1)).alias("__n"),
                  *[total(c).alias(f"__s_{n}") for n, c in sums.items()]))
    in_order = Window.partitionBy(*keys).orderBy("__cell")
    apart = F.col("__first") - F.lag("__last").over(in_order)
    opens = F.when(apart.isNull() | (apart > gap), 1).otherwise(0)
    numbered = (cells.withColumn("__opens", opens)
                .withColumn("__session", F.sum("__opens").over(
                    in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    ended = F.max("__last") + gap
    return (numbered.groupBy(*keys, "__session").agg(
        F.timestamp_micros(F.min("__first")).cast("timestamp_ntz").alias("session_start"),
        F.timestamp_micros(ended).cast("timestamp_ntz").alias("session_end"),
        F.sum("__n").alias("n_events"),
        *[total(f"__s_{n}").alias(n) for n in sums]).drop("__session"))
