"""Message text to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.functions.text import columns_from_text

CORRUPT = "_corrupt_record"


def delimited(messages: DataFrame, schema: T.StructType, separator: str = ", ") -> DataFrame:
    return messages.select(*columns_from_text(F.col("value"), schema, separator))


def json(messages: DataFrame, schema: T.StructType) -> DataFrame:
    return messages.select(F.from_json("value", schema).alias("data")).select("data.*")


def checked_json(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Decoded columns plus the raw text of every message that does not fit the schema."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return messages.select(F.from_json("value", wide, options).alias("data")).select("data.*")


def is_bad(df: DataFrame):
    return F.col(CORRUPT).isNotNull()
