"""Joins of a stream with a lookup table and with another stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.streaming.aggregates import watermarked


def with_lookup(stream: DataFrame, lookup: DataFrame, stream_key: str, lookup_key: str,
                how: str = "left") -> DataFrame:
    return stream.join(lookup, F.col(stream_key) == F.col(lookup_key), how)


def interval_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                  within_minutes: int, keep_minutes: int, grace_minutes: int) -> DataFrame:
    """Pairs of one key within ``within_minutes`` of each other, of which those are kept
    whose distance is at most ``keep_minutes`` whole minutes.

    Both times are event times. Time cells as wide as the join window take part in
    the key, so one busy key spreads over many state partitions. Rows may arrive up
    to ``grace_minutes`` late; older state is dropped.
    """
    late = f"{grace_minutes} minutes"
    lefts, rights = watermarked(left, left_time, late), watermarked(right, right_time, late)
    seconds = within_minutes * 60
    cell = F.floor(F.unix_seconds(F.col(right_time)) / seconds)
    lefts = lefts.withColumn("__left_cell", F.floor(F.unix_seconds(F.col(left_time)) / seconds))
    rights = (rights.withColumn("__right_cell", F.explode(F.array(cell - 1, cell, cell + 1)))
              .withColumnRenamed(key, "__right_key"))
    window = F.expr(f"INTERVAL {within_minutes} MINUTES")
    pairs = lefts.join(rights, (F.col(key) == F.col("__right_key"))
                       & (F.col("__left_cell") == F.col("__right_cell"))
                       & (F.col(right_time) >= F.col(left_time) - window)
                       & (F.col(right_time) <= F.col(left_time) + window))
    apart = F.abs(F.unix_micros(F.col(left_time)) - F.unix_micros(F.col(right_time)))
    return (pairs.filter(F.floor(apart / 60_000_000) <= keep_minutes)
            .drop("__left_cell", "__right_cell", "__right_key"))
