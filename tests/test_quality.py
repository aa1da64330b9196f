"""Planted violations are counted exactly."""

import pytest
from pyspark.sql import types as T

from meterlane.operators import cleaning, quality


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, "a", 5.0), (1, "b", -1.0), (2, None, 0.0), (None, "x", None)],
                                 "id int, code string, amount double")


def result(frame):
    return [(r["failures"], r["status"]) for r in frame.collect()]


def test_column_checks(rows):
    assert result(quality.not_null(rows, ["id", "code", "amount"])) == [(1, "fail")] * 3
    assert result(quality.unique(rows, "id")) == [(1, "fail")]
    assert result(quality.accepted_values(rows, "code", ["a", "b"])) == [(1, "fail")]
    assert result(quality.accepted_values(rows, "code", ["a", "b", "x"])) == [(0, "pass")]
    assert result(quality.non_negative(rows, "amount")) == [(1, "fail")]
    assert result(quality.positive(rows, "amount")) == [(2, "fail")]
    assert result(quality.unique_combination(rows, ["id", "code"])) == [(0, "pass")]


def test_relationships_count_rows_and_pass_nulls(spark, rows):
    parent = spark.createDataFrame([(2,)], "key int")
    assert result(quality.relationships(rows, "id", parent, "key")) == [(2, "fail")]


def test_row_count(rows):
    assert result(quality.has_rows(rows, "t")) == [(0, "pass")]
    assert result(quality.has_rows(rows.limit(0), "t")) == [(1, "fail")]


@pytest.mark.parametrize("now, status", [("2024-01-02 00:00:00", "pass"), ("2024-01-02 01:00:00", "warn"),
                                         ("2024-01-03 01:00:00", "error")])
def test_freshness(spark, now, status):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS t")
    assert quality.freshness(frame, "t", now).first()["status"] == status
    assert quality.freshness(frame.limit(0), "t", now).first()["status"] == "error"


def test_contract(spark, rows):
    declared = T.StructType.fromDDL("id int, code string, amount double")
    assert quality.contracted(rows, declared) is rows
    with pytest.raises(ValueError, match="missing column extra"):
        quality.contracted(rows, T.StructType.fromDDL("id int, code string, amount double, extra int"))
    with pytest.raises(ValueError, match="declared bigint"):
        quality.contracted(rows, T.StructType.fromDDL("id bigint, code string, amount double"))
    with pytest.raises(ValueError, match="undeclared column amount"):
        quality.contracted(rows, T.StructType.fromDDL("id int, code string"))


def test_schema_evolution():
    base = T.StructType([T.StructField("vendorId", T.StringType(), False)])
    added = T.StructType([*base.fields, T.StructField("pu_location_id", T.LongType())])
    changed = T.StructType([T.StructField("vendorId", T.IntegerType(), False)])
    required = T.StructType([*base.fields, T.StructField("fare", T.DoubleType(), False)])
    assert quality.schema_compatible(base, added) == []
    assert quality.schema_compatible(base, changed) and quality.schema_compatible(base, required)


def test_enforce_raises_on_failures_only(rows):
    quality.enforce(quality.accepted_values(rows, "code", ["a", "b", "x"]))
    with pytest.raises(ValueError, match="unique"):
        quality.enforce(quality.report(quality.unique(rows, "id"), quality.has_rows(rows, "t")))


def test_step_counts_are_cumulative(rows):
    from pyspark.sql import functions as F

    steps = cleaning.step_counts(rows, {"id": F.col("id").isNotNull(), "amount": F.col("amount") >= 0})
    assert [(r["rows_before"], r["rows_after"]) for r in steps.collect()] == [(4, 3), (3, 2)]


def test_days_back_precedence(monkeypatch):
    monkeypatch.setenv("DAYS_BACK", "7")
    assert cleaning.days_back(3) == 3 and cleaning.days_back() == 7
    monkeypatch.delenv("DAYS_BACK")
    assert cleaning.days_back() == 30


def test_delete_keeps_rows_with_unknown_condition(rows):
    from pyspark.sql import functions as F

    assert cleaning.deleted_where(rows, F.col("amount") < 0).count() == 3
