"""Hash keys and the id codec for dispatch numbers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text that stands for a null part of a surrogate key.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def row_hash(*cols: Column | str) -> Column:
    """md5 over the texts of all columns, nulls as empty text, no separator."""
    return F.md5(F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]))


def surrogate_key(*cols: Column | str, null_part: str = NULL_PART) -> Column:
    """md5 over the texts of all columns joined by ``-`` with a marker for nulls."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_part)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def base_id(col: Column | str) -> Column:
    """Prefix chosen by divisibility plus the number behind the first letter in hex."""
    number = F.substring(_c(col), 2, 20).cast("bigint")
    digits = F.lower(F.hex(number))
    padded = F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    prefix = F.when(number % 7 == 0, "s/").when(number % 3 == 0, "a/").otherwise("e/")
    return F.concat(prefix, padded)


@F.pandas_udf(T.StringType())
def base_id_udf(codes: pd.Series) -> pd.Series:
    """The same id computed in Python on Arrow batches, for comparison."""
    known = codes.dropna()
    numbers = known.str.slice(1).astype("int64")
    prefix = pd.Series("e/", index=known.index)
    prefix[numbers % 3 == 0] = "a/"
    prefix[numbers % 7 == 0] = "s/"
    return (prefix + numbers.map("{:03x}".format)).reindex(codes.index).astype(object).where(codes.notna(), None)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
