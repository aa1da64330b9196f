"""Write strategies as plain expressions: old table and new rows in, new table out.

How the result reaches the disk is decided in ``meterlane.sinks``. The keys of one
side are always reduced to distinct rows before an anti-join, so a key that occurs
very often is sent once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlane.functions.keys import row_hash
from meterlane.operators.cleaning import first_per_key
from meterlane.operators.unions import stacked_loosely


def missing_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have; duplicates in the source stay."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_anti")


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE with nothing but WHEN NOT MATCHED THEN INSERT."""
    return target.unionByName(missing_rows(target, source, keys))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           newest: Sequence[Column] = ()) -> DataFrame:
    """Matched rows are replaced as a whole, new keys are inserted, new columns appended.

    A key that the source has several times counts once: its first row in the order
    ``newest``, or any one of them without an order.
    """
    once = first_per_key(source, keys, newest) if newest else source.dropDuplicates(list(keys))
    return stacked_loosely(missing_rows(source, target, keys), once)


def delete_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete every target row whose key occurs in the source, then insert the source as it is."""
    return missing_rows(source, target, keys).unionByName(source)


def replace_interval(target: DataFrame, rows: DataFrame, time: str, start: Column,
                     end: Column) -> DataFrame:
    """Delete the target's rows in [start, end), then insert the rows of that interval."""
    inside = (F.col(time) >= start) & (F.col(time) < end)
    outside = ~F.coalesce(inside, F.lit(False))
    return target.filter(outside).unionByName(rows.filter(inside))


def newer_than_target(target: DataFrame, source: DataFrame, time: str) -> DataFrame:
    """Source rows beyond the newest time the target has; all rows for an empty target."""
    mark = target.agg(F.max(time)).scalar()
    return source.filter(mark.isNull() | (F.col(time) > mark))


def scd2(history: DataFrame, current: DataFrame, key: str, tracked: Sequence[str],
         at: Column) -> DataFrame:
    """Type-2 history: close versions that changed or vanished, open new ones.

    ``history`` has the key, the tracked columns, ``valid_from`` and ``valid_to``
    (null while a version is open); ``current`` has one row per key. Open versions
    are unique per key as well, so one outer join compares both sides.
    """
    order = [key, *tracked, "valid_from", "valid_to"]
    is_open = F.col("valid_to").isNull()
    old = history.filter(is_open).select(key, F.struct(*order).alias("old"))
    never = F.lit(None).cast(history.schema["valid_to"].dataType)
    version = F.struct(key, *tracked, at.alias("valid_from"), never.alias("valid_to"))
    now = current.select(key, version.alias("now"))
    both = old.join(now, key, "outer")
    # Column by column, so that neither a null nor text that moves between columns is missed.
    same = F.col("old").isNotNull() & F.col("now").isNotNull()
    for column in tracked:
        same = same & F.col(f"old.{column}").eqNullSafe(F.col(f"now.{column}"))
    kept_or_closed = F.when(same, F.col("old")).when(F.col("old").isNotNull(),
                                                     F.col("old").withField("valid_to", at))
    opened = F.when(~same & F.col("now").isNotNull(), F.col("now"))
    versions = both.select(F.inline(F.array_compact(F.array(kept_or_closed, opened))))
    return history.filter(~is_open).select(*order).unionByName(versions)
