"""Nested documents to flat parent and child tables, and JSON text to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.functions.text import snake_case

SEPARATOR = "__"


def flatten(df: DataFrame) -> DataFrame:
    """One column per leaf of every struct, named ``outer__inner``; lists are left out."""
    return df.select(*_leaves(df.schema))


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[Column]:
    found: list[Column] = []
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, here)
        elif not isinstance(field.dataType, T.ArrayType):
            name = SEPARATOR.join(snake_case(p) for p in here)
            found.append(F.col(".".join(f"`{p}`" for p in here)).alias(name))
    return found


def child_table(df: DataFrame, list_column: str, parent_key: Sequence[str]) -> DataFrame:
    """One row per list element with the parent's key and the element's list index."""
    keys = [F.col(k) for k in parent_key]
    rows = df.select(*keys, F.posexplode(list_column).alias("list_idx", "element"))
    if isinstance(rows.schema["element"].dataType, T.StructType):
        inner = [F.col(f"element.{f}").alias(snake_case(f))
                 for f in rows.schema["element"].dataType.names]
        return rows.select(*parent_key, "list_idx", *inner)
    return rows.withColumnRenamed("element", "value")


def json_columns(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """JSON text into one column per field of the declared schema."""
    return df.withColumn("__data", F.from_json(column, schema)).select(
        *[c for c in df.columns if c != column], "__data.*")


def json_fields_or_default(column: str, fields: Sequence[str], default: str = "N/A") -> list[Column]:
    """Keep a list of JSON fields as text; a missing field becomes the default."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    data = F.from_json(column, schema)
    return [F.coalesce(data[f], F.lit(default)).alias(f) for f in fields]


def to_json_text(*cols: str) -> Column:
    return F.to_json(F.struct(*cols))
