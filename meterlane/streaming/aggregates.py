"""Windowed and running aggregates; ``late`` sets a watermark where the input is a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlane.functions.numbers import total
from meterlane.operators import ordered


# A row at or after this time says that the stream has ended: it moves the watermark past all rows and counts nowhere.
END_OF_STREAM = "9999-01-01 00:00:00"


def watermarked(df: DataFrame, time: str, late: str | None) -> DataFrame:
    """Event time as an instant; the watermark only has a meaning on streams.

    Rows at ``END_OF_STREAM`` are left out behind the watermark. The condition is on the event time, so
    the optimizer leaves it there and the watermark sees them.
    """
    timed = df.withColumn(time, F.col(time).cast("timestamp"))
    if not (late and df.isStreaming):
        return timed
    ends = F.col(time) >= F.lit(END_OF_STREAM).cast("timestamp")
    return timed.withWatermark(time, late).filter(~F.coalesce(ends, F.lit(False)))


def end_mark(df: DataFrame, time: str) -> DataFrame:
    """The one row that closes a stream with the columns of ``df``: all null but for its time."""
    end = F.lit(END_OF_STREAM)
    return df.sparkSession.range(1).select(*[
        (end if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema.fields])


def counts_by_key(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def windowed(df: DataFrame, time: str, size: str, keys: Sequence[str] = (), amount: str | None = None,
             slide: str | None = None, late: str | None = None) -> DataFrame:
    """Count, and sum of an amount, per key in tumbling or (with ``slide``) hopping windows."""
    frame = F.window(time, size, slide) if slide else F.window(time, size)
    measures = [F.count(F.lit(1)).alias("n")]
    if amount:
        measures.append(total(amount).alias("amount"))
    grouped = watermarked(df, time, late).groupBy(frame, *keys).agg(*measures)
    return grouped.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                          *keys, *[c for c in grouped.columns if c in ("n", "amount")])


def session_windows(df: DataFrame, time: str, gap: str, keys: Sequence[str],
                    late: str | None = None) -> DataFrame:
    """Count per key and session; a session ends one gap after its last event.

    On a stream with ``late`` and in append mode a session is emitted once it is closed and leaves the state with
    that. The state holds one row per open session, not its events, and the events of a key are merged into
    sessions inside each map task first (a setting of the session), so a hot key costs no more than its sessions.
    """
    grouped = (watermarked(df, time, late)
               .groupBy(F.session_window(time, gap).alias("session"), *keys)
               .agg(F.count(F.lit(1)).alias("n_events")))
    return grouped.select(*keys, F.col("session.start").cast("timestamp_ntz").alias("session_start"),
                          F.col("session.end").cast("timestamp_ntz").alias("session_end"), "n_events")


def processing_time_windows(df: DataFrame, size: str, keys: Sequence[str], slack: str = "1 minute") -> DataFrame:
    """Count per key in windows on the time a row is processed; on a stream a window leaves the state
    once the clock has passed it by ``slack``."""
    stamped = df.withColumn("processed_at", F.current_timestamp())
    return windowed(stamped, "processed_at", size, keys, late=slack)


def busiest_first(windows: DataFrame, n: str = "n") -> DataFrame:
    """The rank of each key in its window, 1 for the highest count; equal counts share a rank."""
    return ordered.ranks(windows, ["window_start", "window_end"], n).drop("dense_rank")


def running_totals(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Trips, revenue and average so far, overall or per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"), total(amount).alias("revenue"),
        F.try_divide(total(amount), F.count(F.lit(1))).alias("avg_amount"))
