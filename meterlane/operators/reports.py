"""Grouped reports. Amounts are summed as they are; all groupings combine map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlane.functions.numbers import half_up, mean, ratio, total
from meterlane.functions.times import truncated


def counts_by(df: DataFrame, *keys: str | Column, name: str = "trips") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top-k report; the order should end in a unique column."""
    return df.orderBy(*order).limit(n)


def monthly_revenue(df: DataFrame, time: str, amount: str, distance: str,
                    keys: Sequence[str] = ()) -> DataFrame:
    """Trips, revenue and rounded averages per month."""
    month = truncated("month", time).alias("month")
    return df.groupBy(month, *keys).agg(
        F.count(F.lit(1)).alias("trips"),
        total(amount).alias("revenue"),
        half_up(mean(amount)).alias("avg_amount"),
        half_up(mean(distance)).alias("avg_distance"))


def monthly_zone_mart(df: DataFrame, zone: Column, time: str, service: str,
                      sums: Mapping[str, str], trip: str, averages: Mapping[str, str]) -> DataFrame:
    """Zone x month x service: named sums, a trip count and named averages."""
    return df.groupBy(zone.alias("zone"), truncated("month", time).alias("revenue_month"),
                      F.col(service).alias("service_type")).agg(
        *[total(column).alias(name) for name, column in sums.items()],
        F.count(trip).alias("total_monthly_trips"),
        *[mean(column).alias(name) for name, column in averages.items()])


def tip_percent(df: DataFrame, keys: Sequence[Column], tip: str, fare: str, amount: str) -> DataFrame:
    percent = ratio(F.col(tip), F.col(fare)) * 100
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"),
        total(amount).alias("revenue"),
        F.round(F.avg(percent), 6).alias("avg_tip_pct"))


def best_day(df: DataFrame, time: str, measure: str, n: int = 1) -> DataFrame:
    """The day with the largest single value."""
    days = df.groupBy(truncated("day", time).alias("day")).agg(F.max(measure).alias("largest"))
    return top(days, [F.col("largest").desc_nulls_last(), F.col("day")], n)


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Rows per category and their percentage of all rows.

    The total comes from a one-row subquery: a window without keys would move all
    categories into one task.
    """
    grouped = counts_by(df, key, name="n")
    everything = df.agg(F.count(F.lit(1))).scalar()
    return grouped.withColumn("share_pct", F.round(F.col("n") * 100.0 / everything, 6))


def sign_composition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Positive, zero, negative and null counts of several columns, in one pass."""
    parts = []
    for c in columns:
        parts.append(F.struct(
            F.lit(c).alias("column_name"), F.count_if(F.col(c) > 0).alias("positive"),
            F.count_if(F.col(c) == 0).alias("zero"), F.count_if(F.col(c) < 0).alias("negative"),
            F.count_if(F.col(c).isNull()).alias("missing")))
    return df.agg(F.array(*parts).alias("all")).select(F.inline("all"))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, extremes and sum of several columns, in one pass."""
    parts = [F.struct(
        F.lit(c).alias("column_name"), F.round(mean(c), 6).alias("mean"),
        F.round(F.stddev_samp(F.col(c).cast("double")), 4).alias("stddev"),
        F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        total(c).alias("sum")) for c in columns]
    return df.agg(F.array(*parts).alias("all")).select(F.inline("all"))


def duration_by_pair(df: DataFrame, start_zone: str, end_zone: str, seconds: str) -> DataFrame:
    """Average, shortest and longest trip time of each ordered zone pair."""
    return df.groupBy(start_zone, end_zone).agg(
        F.count(F.lit(1)).alias("trips"),
        (F.sum(seconds) / F.count(seconds)).alias("avg_seconds"),
        F.min(seconds).alias("min_seconds"), F.max(seconds).alias("max_seconds"))


def month_over_month(monthly: DataFrame, month: str, value: str) -> DataFrame:
    """Change against the previous month; input has one row per month."""
    # One row per calendar month, so the unpartitioned window is small by nature.
    previous = F.lag(value).over(Window.orderBy(month))
    return (monthly.withColumn("previous", previous)
            .withColumn("change_pct",
                        F.round(ratio(F.col(value) - F.col("previous"), F.col("previous")) * 100, 6)))


def quarterly_growth(df: DataFrame, time: str, service: str, amount: str) -> DataFrame:
    """Revenue per service and quarter with the change against the same quarter a year before.

    A quarter without a predecessor exactly one year earlier gets no growth.
    """
    quarters = df.groupBy(F.col(service).alias("service_type"), F.year(time).alias("year"),
                          F.quarter(time).alias("quarter")).agg(total(amount).alias("revenue"))
    # One row per year in each partition.
    window = Window.partitionBy("service_type", "quarter").orderBy("year")
    follows = F.lag("year").over(window) == F.col("year") - 1
    previous = F.when(follows, F.lag("revenue").over(window))
    return (quarters.withColumn("previous", previous)
            .withColumn("yoy_pct",
                        F.round(ratio(F.col("revenue") - F.col("previous"), F.col("previous")) * 100, 6)))
