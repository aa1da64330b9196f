"""Unions of similar but unequal tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stacked(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name of tables with equal columns."""
    return reduce(DataFrame.unionByName, frames)


def stacked_loosely(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def aligned(frames: Mapping[str, DataFrame], constants: Mapping[str, Mapping[str, tuple]],
            tag: str = "service_type") -> DataFrame:
    """UNION ALL of unequal tables with typed constants for missing columns and a tag.

    ``constants[tag value][column]`` is ``(value, type)``.
    """
    ready = []
    for name, frame in frames.items():
        for column, (value, kind) in constants.get(name, {}).items():
            frame = frame.withColumn(column, F.lit(value).cast(kind))
        ready.append(frame.withColumn(tag, F.lit(name)))
    return stacked(*ready)
