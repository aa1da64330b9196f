"""Window results over groups of any size.

``Window.partitionBy(zone)`` sends every row of a zone to one task, and a window
without keys sends the whole table there. The functions here lay the rows out in
sorted, equally sized slices instead (range partitioning on keys *and* order), so
a key with a third of all rows is spread over a third of the slices. What has to
cross slices is one small row per slice (and key): its row count or its sum.

The layout is written to the shared folder before it is read twice, because row
positions must stay the same when a task is re-run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlane.session import materialize, slice_count

SLICE, IN_SLICE, POSITION = "__slice", "__in_slice", "__position"
# monotonically_increasing_id() keeps the row number of a partition in its low 33 bits.
ROW_BITS = 33
BLOCK_ROWS = 65_536


def positioned(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Number all rows from 0 in the order of keys, then ``order``.

    Adds ``__slice`` and ``__position``. The order should end in a unique column;
    rows that tie on everything get positions in no particular order.
    """
    slices = slice_count(df.sparkSession)
    sort_by = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    numbered = (df.repartitionByRange(slices, *sort_by)
                .sortWithinPartitions(*sort_by)
                .withColumn("__id", F.monotonically_increasing_id())
                .withColumn(SLICE, F.shiftright("__id", ROW_BITS))
                .withColumn(IN_SLICE, F.col("__id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
                .drop("__id"))
    laid_out = materialize(numbered, "slices")
    # One row per slice, so the window below and the broadcast are bounded by `slices`.
    sizes = laid_out.groupBy(SLICE).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(SLICE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (laid_out.join(F.broadcast(starts), SLICE)
            .withColumn(POSITION, F.col("__start") + F.col(IN_SLICE))
            .drop("__start", IN_SLICE))


def row_number(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (),
               name: str = "row_number") -> DataFrame:
    """ROW_NUMBER over the whole table or per key."""
    laid_out = positioned(df, keys, order)
    if not keys:
        return laid_out.withColumn(name, F.col(POSITION) + 1).drop(SLICE, POSITION)
    return (_with_key_start(laid_out, keys)
            .withColumn(name, F.col(POSITION) - F.col("__first") + 1)
            .drop(SLICE, POSITION, "__first"))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                value: Column, name: str = "running_sum") -> DataFrame:
    """SUM over all rows of the key up to and including the current one.

    Integers and decimals add exactly; with doubles the last bits depend on the slices.
    """
    laid_out = positioned(df.withColumn("__value", value), keys, order)
    return _running_sum(laid_out, keys, "__value", name).drop("__value", SLICE, POSITION)


def ranks(df: DataFrame, keys: Sequence[str], value: str, descending: bool = True,
          rank: str = "rank", dense_rank: str = "dense_rank") -> DataFrame:
    """RANK and DENSE_RANK by one value.

    Rows with equal values share both numbers, so only the distinct values are
    laid out; a value held by very many rows costs no more than a rare one.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    laid_out = _with_key_start(positioned(counted, keys, [order]), keys)
    ranked = (_running_sum(laid_out, keys, "__n", "__upto")
              .withColumn(rank, F.col("__upto") - F.col("__n") + 1)
              .withColumn(dense_rank, F.col(POSITION) - F.col("__first") + 1)
              .select(*[F.col(c).alias(f"__k_{c}") for c in (*keys, value)], rank, dense_rank))
    same = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in (*keys, value)]
    return df.join(ranked, same).drop(*[f"__k_{c}" for c in (*keys, value)])


def framed(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
           columns: Mapping[str, "callable"], before: int = 0, after: int = 0) -> DataFrame:
    """Window columns whose frame reaches at most ``before``/``after`` rows.

    Covers LAG, LEAD and moving aggregates. Rows are cut into blocks of a fixed
    length, the frame's at least; the few rows at a block's edge are also copied to its neighbour, so
    each block can be computed alone. ``columns`` maps a name to a function from
    the window (ordered, without frame) to a column.
    """
    rows = max(BLOCK_ROWS, before, after)
    laid_out = positioned(df, keys, order)
    home = F.floor(F.col(POSITION) / rows)
    offset = F.col(POSITION) % rows
    homes = F.array(home,
                    F.when(offset >= rows - before, home + 1),
                    F.when(offset < after, home - 1))
    copies = (laid_out.withColumn("__home", home)
              .withColumn("__block", F.explode(F.array_compact(homes))))
    window = Window.partitionBy(*keys, "__block").orderBy(POSITION)
    computed = copies.select("*", *[make(window).alias(name) for name, make in columns.items()])
    return (computed.filter(F.col("__block") == F.col("__home"))
            .drop("__block", "__home", SLICE, POSITION))


def percentiles(df: DataFrame, keys: Sequence[str], value: str,
                probabilities: Mapping[str, float]) -> DataFrame:
    """Exact continuous percentiles per group (linear interpolation, nulls ignored).

    Equal values are counted before anything else is moved, the values are ranked in slices
    and the two neighbours of each percentile are picked by position: one way for groups of
    any size, with or without keys. A group without values gets nulls.
    """
    if not keys:
        alone = percentiles(df.withColumn("__all", F.lit(0)), ["__all"], value, probabilities)
        return alone.drop("__all")
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    counted = materialize(counted, "value-counts")
    found = _percentiles_by_position(counted.filter(F.col(value).isNotNull()), keys, value, probabilities)
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    groups = counted.select(*keys).distinct()
    return (groups.join(found.withColumnsRenamed({k: f"__r_{k}" for k in keys}), same, "left")
            .select(*keys, *probabilities))


def _percentiles_by_position(counted: DataFrame, keys: Sequence[str], value: str,
                             probabilities: Mapping[str, float]) -> DataFrame:
    cumulated = running_sum(counted, keys, [F.col(value).asc()], F.col("__n"), "__upto")
    totals = counted.groupBy(*keys).agg(F.sum("__n").alias("__total"))
    joined = _join_on(cumulated, totals, keys)
    picks = []
    for name, p in probabilities.items():
        spot = F.lit(float(p)) * (F.col("__total") - 1)
        for side, index in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            hit = (index >= F.col("__upto") - F.col("__n")) & (index < F.col("__upto"))
            picks.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"__{side}_{name}"))
    picked = joined.groupBy(*keys).agg(*picks, F.first("__total").alias("__total"))
    results = []
    for name, p in probabilities.items():
        spot = F.lit(float(p)) * (F.col("__total") - 1)
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        results.append((low + (high - low) * (spot - F.floor(spot))).alias(name))
    return picked.select(*keys, *results)


def _with_key_start(laid_out: DataFrame, keys: Sequence[str]) -> DataFrame:
    starts = laid_out.groupBy(*keys).agg(F.min(POSITION).alias("__first"))
    if not keys:
        return laid_out.withColumn("__first", F.lit(0))
    return _join_on(laid_out, starts, keys)


def _running_sum(laid_out: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    inside = (Window.partitionBy(SLICE, *keys).orderBy(POSITION)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Per key at most one row per slice, so this window is bounded by the slice count.
    sums = laid_out.groupBy(SLICE, *keys).agg(F.sum(value).alias("__slice_sum"))
    earlier = (Window.partitionBy(*keys).orderBy(SLICE)
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = sums.select(SLICE, *keys, F.sum("__slice_sum").over(earlier).alias("__carried"))
    local = laid_out.withColumn("__local", F.sum(value).over(inside))
    joined = _join_on(local, carried, (SLICE, *keys))
    summed = F.col("__local") + F.coalesce(F.col("__carried"), F.lit(0))
    return joined.withColumn(name, summed).drop("__local", "__carried")


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys match each other."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"__r_{k}" for k in keys])
