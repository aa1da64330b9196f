"""Joins of trips with zones and with each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def with_roles(facts: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
               how: str = "left") -> DataFrame:
    """Join one lookup table several times; ``roles`` maps a prefix to the fact's key.

    The columns of the lookup arrive as ``<prefix>_<column>``.
    """
    small = dim
    for prefix, key in roles.items():
        renamed = small.select(*[F.col(c).alias(f"{prefix}_{c}") for c in dim.columns])
        facts = facts.join(renamed, F.col(key) == F.col(f"{prefix}_{dim_key}"), how)
        facts = facts.drop(f"{prefix}_{dim_key}")
    return facts


def lookup(facts: DataFrame, dim: DataFrame, on: Column, how: str = "left") -> DataFrame:
    return facts.join(dim, on, how)


def not_in_either(facts: DataFrame, dim: DataFrame, dim_key: str, keys: Sequence[str]) -> DataFrame:
    """Rows for which any key is ``NOT IN`` the lookup.

    A null key compares as unknown and does not qualify by itself. If the lookup
    itself holds a null key, nothing qualifies at all, as in SQL. Each key becomes
    one equi-join against the distinct non-null ids.
    """
    ids = dim.select(F.col(dim_key).alias("__id")).distinct()
    state = ids.agg(F.count("*"), F.count("__id")).first()
    if state[0] == 0:  # nothing to be found in: every row qualifies, a null key too
        return facts
    if state[0] > state[1]:
        return facts.limit(0)
    small = ids
    result, wanted = facts, F.lit(False)
    for i, key in enumerate(keys):
        flagged = small.select(F.col("__id").alias(f"__id{i}"), F.lit(True).alias(f"__hit{i}"))
        result = result.join(flagged, F.col(key) == F.col(f"__id{i}"), "left")
        wanted = wanted | (F.col(key).isNotNull() & F.col(f"__hit{i}").isNull())
    helpers = [f"__id{i}" for i in range(len(keys))] + [f"__hit{i}" for i in range(len(keys))]
    return result.filter(wanted).drop(*helpers)


def only_known(facts: DataFrame, dim: DataFrame, dim_key: str, keys: Sequence[str]) -> DataFrame:
    """Rows all of whose keys occur in the lookup."""
    ids = dim.select(F.col(dim_key).alias("__id")).distinct()
    for key in keys:
        facts = facts.join(ids, F.col(key) == F.col("__id"), "left_semi")
    return facts


def outer_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two aggregates that have one row per key each."""
    return left.join(right, list(keys), "outer")


def at_latest(df: DataFrame, time: str) -> DataFrame:
    """Rows at the newest time, found by a one-row subquery instead of a cross join."""
    return df.filter(F.col(time) == df.agg(F.max(time)).scalar())


def since_latest(df: DataFrame, time: str, interval: str) -> DataFrame:
    """Rows not older than the newest time minus ``interval`` (e.g. ``INTERVAL 17 HOURS``)."""
    newest = df.agg((F.max(time) - F.expr(interval)).alias("bound"))
    return df.filter(F.col(time) >= newest.scalar())


def near_in_time(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
                 seconds: int) -> DataFrame:
    """Pairs with equal key whose times differ by at most ``seconds`` (inclusive).

    Time is cut into cells as wide as the limit, and each right row is offered to
    its own and both neighbouring cells. The join is then an equi-join on
    (key, cell), which spreads one busy key over the cells.
    Both inputs need different column names except for ``key``.
    """
    width = seconds * 1_000_000
    left_at = F.unix_micros(F.col(left_time).cast("timestamp"))
    right_at = F.unix_micros(F.col(right_time).cast("timestamp"))
    lefts = left.withColumn("__cell", F.floor(left_at / width)).withColumn("__l", left_at)
    cell = F.floor(right_at / width)
    rights = (right.withColumn("__cell", F.explode(F.array(cell - 1, cell, cell + 1)))
              .withColumn("__r", right_at))
    pairs = lefts.join(rights, [key, "__cell"])
    return pairs.filter(F.abs(F.col("__l") - F.col("__r")) <= width).drop("__cell", "__l", "__r")
