"""Data checks. Each returns one row: check, target, failures, status.

Checks never stop a run by themselves; ``report`` unites them and ``enforce``
raises on failures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _result(counted: DataFrame, check: str, target: str) -> DataFrame:
    failures = F.coalesce(F.col("failures"), F.lit(0)).cast("bigint")
    return counted.select(F.lit(check).alias("check"), F.lit(target).alias("target"),
                          failures.alias("failures"),
                          F.when(failures == 0, "pass").otherwise("fail").alias("status"))


def violations(bad_rows: DataFrame, target: str, check: str = "singular") -> DataFrame:
    """Any query of bad rows; it must be empty."""
    return _result(bad_rows.agg(F.count(F.lit(1)).alias("failures")), check, target)


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null counts of all columns in one pass, one row per column."""
    rows = [F.struct(F.lit("not_null").alias("check"), F.lit(c).alias("target"),
                     F.count_if(F.col(c).isNull()).alias("failures")) for c in columns]
    return (df.agg(F.array(*rows).alias("all")).select(F.inline("all"))
            .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail")))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; nulls are not compared."""
    repeated = (df.filter(F.col(column).isNotNull()).groupBy(column)
                .agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    return violations(repeated, column, "unique")


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return violations(repeated, ",".join(columns), "unique_combination")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list; a null value passes, a null in the list means nothing."""
    listed = [v for v in values if v is not None]
    outside = ~F.col(column).isin(listed) if listed else F.col(column).isNotNull()
    return violations(df.filter(outside), column, "accepted_values")


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent; a null child passes.

    Child keys are counted first, so a frequent key takes part in the join once.
    """
    counts = (child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("__key"))
              .agg(F.count(F.lit(1)).alias("n")))
    known = parent.select(F.col(key).alias("__key")).distinct()
    orphans = counts.join(known, "__key", "left_anti").agg(F.sum("n").alias("failures"))
    return _result(orphans, "relationships", column)


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return violations(df.filter(F.col(column) < 0), column, "non_negative")


def positive(df: DataFrame, column: str) -> DataFrame:
    return violations(df.filter(F.col(column) <= 0), column, "positive")


def has_rows(df: DataFrame, target: str) -> DataFrame:
    """Passes when the table holds any row."""
    empty = df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias("failures"))
    return _result(empty, "row_count", target)


def freshness(df: DataFrame, time: str, now: str, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Age of the newest row against a reference time: pass, warn or error."""
    age = F.timestamp_diff("HOUR", F.max(time), F.lit(now).cast("timestamp_ntz"))
    return (df.agg(age.alias("failures"))
            .select(F.lit("freshness").alias("check"), F.lit(time).alias("target"), "failures",
                    F.when(F.col("failures").isNull() | (F.col("failures") > error_hours), "error")
                    .when(F.col("failures") > warn_hours, "warn").otherwise("pass").alias("status")))


def assertions(df: DataFrame, required: Sequence[str], minima: Mapping[str, float]) -> DataFrame:
    """Non-empty, required columns present, minima kept: all in one aggregate."""
    absent = [c for c in required if c not in df.columns]
    rows = [F.struct(F.lit("not_empty").alias("check"), F.lit("table").alias("target"),
                     F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("failures")),
            F.struct(F.lit("columns_present").alias("check"), F.lit(",".join(required)).alias("target"),
                     F.lit(len(absent)).cast("bigint").alias("failures"))]
    rows += [F.struct(F.lit("minimum").alias("check"), F.lit(c).alias("target"),
                      F.count_if(F.col(c) < least).alias("failures")) for c, least in minima.items()]
    return (df.agg(F.array(*rows).alias("all")).select(F.inline("all"))
            .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail")))


def schema_differences(actual: T.StructType, declared: T.StructType) -> list[str]:
    """What keeps a frame from meeting its contract: missing, extra or mistyped columns."""
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in declared.fields}
    found = [f"missing column {n} {t}" for n, t in want.items() if n not in have]
    found += [f"undeclared column {n}" for n in have if n not in want]
    return found + [f"column {n} is {have[n]}, declared {t}" for n, t in want.items()
                    if n in have and have[n] != t]


def contracted(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The frame itself, or an error before anything is written."""
    if differences := schema_differences(df.schema, declared):
        raise ValueError("contract broken: " + "; ".join(differences))
    return df


def schema_compatible(old: T.StructType, new: T.StructType) -> list[str]:
    """Why rows of the old schema cannot be read with the new one; empty when they can.

    An added field must be nullable, and no field may change its type.
    """
    before = {f.name: f for f in old.fields}
    problems = []
    for field in new.fields:
        known = before.get(field.name)
        if known is None and not field.nullable:
            problems.append(f"new field {field.name} has no default")
        elif known is not None and known.dataType != field.dataType:
            problems.append(f"field {field.name} changed its type")
    return problems


def compare_models(old: DataFrame, new: DataFrame, keys: Sequence[str],
                   columns: Sequence[str]) -> DataFrame:
    """Rows only in one version and mismatches per column, for tables with unique keys."""
    a = old.select(*keys, *[F.col(c).alias(f"__a_{c}") for c in columns], F.lit(True).alias("__in_a"))
    b = new.select(*keys, *[F.col(c).alias(f"__b_{c}") for c in columns], F.lit(True).alias("__in_b"))
    both = F.col("__in_a") & F.col("__in_b")
    counts = [F.count_if(F.col("__in_b").isNull()).alias("only_old"),
              F.count_if(F.col("__in_a").isNull()).alias("only_new"),
              F.count_if(both).alias("in_both")]
    counts += [F.count_if(both & ~F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}"))).alias(f"diff_{c}")
               for c in columns]
    return a.join(b, list(keys), "outer").agg(*counts)


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def enforce(checks: DataFrame) -> None:
    """Raise when any check of a report failed; the report has a few rows only."""
    failed = checks.filter(~F.col("status").isin("pass", "warn")).collect()
    if failed:
        raise ValueError("; ".join(f"{r['check']}({r['target']}): {r['failures']}" for r in failed))
