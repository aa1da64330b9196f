"""Text expressions and column-name normalising."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def concat_skip_null(*cols: Column) -> Column:
    """Nulls count as empty text."""
    return F.concat_ws("", *cols)


def concat_propagate(*cols: Column) -> Column:
    """One null makes the whole result null."""
    return F.concat(*cols)


def columns_from_text(col: Column, schema: T.StructType, separator: str = ", ") -> list[Column]:
    """Split text by position and cast each token to the type of its field."""
    tokens = F.split(col, re.escape(separator))
    return [F.try_element_at(tokens, F.lit(i + 1)).try_cast(field.dataType).alias(field.name)
            for i, field in enumerate(schema.fields)]


def snake_case(name: str, every_capital: bool = False) -> str:
    """``VendorID`` to ``vendor_id``; ``every_capital`` gives ``vendor_i_d`` instead."""
    if every_capital:
        spaced = re.sub("[A-Z]", lambda m: "_" + m.group(), name)
    else:
        spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return re.sub(r"_+", "_", spaced).lower().lstrip("_")


def with_snake_case(df: DataFrame, every_capital: bool = False) -> DataFrame:
    return df.toDF(*[snake_case(c, every_capital) for c in df.columns])
