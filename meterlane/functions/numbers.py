"""Sums and averages of amounts, rounding and safe division."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money(col: Column | str, scale: int = 2) -> Column:
    """Fixed-scale amount."""
    return _c(col).cast(f"decimal(18,{scale})")


def half_up(col: Column, digits: int = 2) -> Column:
    """Round half away from zero through a decimal, returned as double."""
    return F.round(col.cast("decimal(28,8)"), digits).cast("double")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Finished amounts for a report: only results are rounded, never what is added."""
    return df.withColumns({c: half_up(F.col(c), digits) for c in columns})


def total(col: Column | str) -> Column:
    """Sum of an amount as it is declared, as double; null without values.

    Decimals and whole numbers add exactly. Doubles add with all their decimals, and the
    last bits of the result depend on the order of the rows, as with any sum of doubles.
    """
    return F.sum(_c(col)).cast("double")


def mean(col: Column | str) -> Column:
    """The sum divided by the number of non-null values, as double; null without values."""
    return F.try_divide(total(col), F.count(_c(col)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Zero where the denominator is not positive."""
    return F.when(denominator > 0, ratio(numerator, denominator)).otherwise(F.lit(0.0))


def safe_cast(col: Column | str, data_type: str) -> Column:
    """Null instead of an error when the text is not of the wanted type."""
    return _c(col).try_cast(data_type)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
