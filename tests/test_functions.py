"""Column expressions on their edges."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.functions import keys, labels, nested, numbers, text, times


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def ntz(value):
    return F.lit(value).cast("timestamp_ntz")


def test_minutes_crossed_and_elapsed(spark):
    start, end = ntz("2024-01-01 00:00:59"), ntz("2024-01-01 00:01:00")
    assert tuple(one(spark, times.minutes_crossed(start, end), times.minutes_elapsed(start, end),
                     times.seconds_between(start, end))) == (1, 0, 1)


def test_minutes_of_backward_trip_are_negative(spark):
    assert one(spark, times.minutes_elapsed(ntz("2024-01-01 01:00:00"), ntz("2024-01-01 00:30:30")))[0] == -29


def test_on_date_is_half_open(spark):
    frame = spark.createDataFrame([("2024-01-01 23:59:59.999999",), ("2024-01-02 00:00:00",),
                                   ("2024-01-02 23:59:59",), ("2024-01-03 00:00:00",)], "t string")
    kept = frame.select(F.col("t").cast("timestamp_ntz").alias("t")).filter(times.on_date("t", "2024-01-02"))
    assert kept.count() == 2


def test_pattern_mismatch_gives_null(spark):
    assert one(spark, times.parsed(F.lit("yesterday"), "yyyy-MM-dd"))[0] is None


def test_half_up(spark):
    values = [(2.675, 2.68), (0.125, 0.13), (-0.125, -0.13), (1.005, 1.01)]
    for value, wanted in values:
        assert one(spark, numbers.half_up(F.lit(value)))[0] == wanted


def test_division_by_zero(spark):
    zero = F.lit(0)
    assert tuple(one(spark, numbers.ratio(F.lit(1), zero), numbers.ratio_or_zero(F.lit(1), zero))) == (None, 0.0)


def test_total_does_not_depend_on_order(spark):
    frame = spark.range(1000).select((F.col("id") / 10).alias("v"))
    assert frame.agg(numbers.total("v")).first()[0] == 49950.0


def test_total_of_huge_tables_does_not_overflow(spark):
    frame = spark.range(10).select(F.lit(9e11).alias("v"))
    doubled = frame.crossJoin(spark.range(100_000).select(F.lit(1)))
    assert doubled.agg(numbers.total("v")).first()[0] == 9e17


@pytest.mark.parametrize("kind", ["double", "decimal(18,6)"])
def test_small_amounts_are_added_before_anything_is_rounded(spark, kind):
    rows = spark.range(1000).select(F.lit(0.000004).cast(kind).alias("v"))
    assert rows.agg(numbers.total("v"), numbers.mean("v")).first() == pytest.approx((0.004, 0.000004))
    ten = spark.range(10).select(F.lit(0.00004).cast(kind).alias("v")).agg(numbers.total("v").alias("t"))
    assert numbers.rounded(ten, 4, "t").first()["t"] == 0.0004
    nothing = spark.createDataFrame([(None,)], f"v {kind}").agg(numbers.total("v"), numbers.mean("v"))
    assert tuple(nothing.first()) == (None, None)


def test_row_hash_counts_null_as_empty(spark):
    got = one(spark, keys.row_hash(F.lit("a"), F.lit(None).cast("int"), F.lit(7)))[0]
    assert got == hashlib.md5(b"a7").hexdigest()


def test_surrogate_key_marks_nulls(spark):
    got = one(spark, keys.surrogate_key(F.lit("a"), F.lit(None).cast("int")))[0]
    assert got == hashlib.md5(f"a-{keys.NULL_PART}".encode()).hexdigest()


@pytest.mark.parametrize("code, wanted", [("B03500", "s/dac"), ("B00003", "a/003"), ("B00001", "e/001"),
                                          ("B00021", "s/015"), ("B99999", "a/1869f")])
def test_base_id(spark, code, wanted):
    frame = spark.createDataFrame([(code,)], "c string")
    assert tuple(frame.select(keys.base_id("c"), keys.base_id_udf("c")).first()) == (wanted, wanted)


def test_labels(spark):
    frame = spark.createDataFrame([(1,), (3,), (None,)], "v int")
    name = labels.labelled("v", labels.VENDOR_NAMES)
    payment = labels.labelled("v", labels.PAYMENT_LABELS, labels.PAYMENT_DEFAULT)
    assert [tuple(r) for r in frame.select(name, payment).collect()] == [
        ("Creative Mobile Technologies", "Credit card"), (None, "No charge"), (None, "Unknown")]


@pytest.mark.parametrize("value, below, upto", [(0.5, "< 1 mile", "up to 1"), (1.0, "1–3 miles", "up to 1"),
                                                (3.0, "3–10 miles", "1 to 3"), (10.0, "10+ miles", "7 to 10"),
                                                (10.1, "10+ miles", "over 10")])
def test_bucket_edges(spark, value, below, upto):
    frame = spark.createDataFrame([(value,)], "v double")
    assert tuple(frame.select(
        labels.bucketed("v", labels.DISTANCE_EDGES, labels.DISTANCE_LABELS),
        labels.bucketed("v", labels.SEGMENT_EDGES, labels.SEGMENT_LABELS, upper_inclusive=True)).first()) == (below, upto)


def test_concat_forms(spark):
    parts = [F.lit("a"), F.lit(None).cast("string"), F.lit("b")]
    assert tuple(one(spark, text.concat_skip_null(*parts), text.concat_propagate(*parts))) == ("ab", None)


@pytest.mark.parametrize("name, wanted, literal", [
    ("VendorID", "vendor_id", "vendor_i_d"), ("PULocationID", "pu_location_id", "p_u_location_i_d"),
    ("Trip_Dropoff_DateTime", "trip_dropoff_date_time", "trip_dropoff_date_time"),
    ("fare_amount", "fare_amount", "fare_amount")])
def test_snake_case(name, wanted, literal):
    assert text.snake_case(name) == wanted
    assert text.snake_case(name, every_capital=True) == literal


def test_delimited_tokens(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    frame = spark.createDataFrame([("1, 2.5",), ("x, 2",), ("3",)], "value string")
    assert [tuple(r) for r in frame.select(*text.columns_from_text(F.col("value"), schema)).collect()] == [
        (1, 2.5), (None, 2.0), (3, None)]


def test_nested_document_becomes_parent_and_child(spark):
    document = """{"vendor_name": "Lumo", "time": {"pickup": "2031-02-03 04:05:06"}, "Trip_Distance": 2.25,
      "coordinates": {"start": {"lon": 11.5, "lat": 48.25}},
      "passengers": [{"name": "Ines", "rating": 1.5}, {"name": "Omar", "rating": 2.5}]}"""
    schema = """vendor_name string, time struct<pickup:string>, Trip_Distance double,
      coordinates struct<start:struct<lon:double,lat:double>>, passengers array<struct<name:string,rating:double>>"""
    frame = spark.createDataFrame([(document,)], "d string").select(F.from_json("d", schema).alias("d")).select("d.*")
    assert nested.flatten(frame).columns == ["vendor_name", "time__pickup", "trip_distance",
                                             "coordinates__start__lon", "coordinates__start__lat"]
    children = nested.child_table(frame, "passengers", ["vendor_name"])
    assert [tuple(r) for r in children.collect()] == [("Lumo", 0, "Ines", 1.5), ("Lumo", 1, "Omar", 2.5)]


def test_missing_json_field_gets_default(spark):
    frame = spark.createDataFrame([('{"brand": "x"}',), ("{}",)], "p string")
    rows = frame.select(*nested.json_fields_or_default("p", ["brand", "price"])).collect()
    assert [tuple(r) for r in rows] == [("x", "N/A"), ("N/A", "N/A")]
