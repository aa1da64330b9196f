"""Schema resolution, and partition listings from footers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.operators import evolution
from meterlane.session import new_path
from meterlane.sources import files


def record(*fields):
    return T.StructType([T.StructField(*f) for f in fields])


BASE = record(("id", T.IntegerType(), False), ("ride", record(("vendor_id", T.StringType()), ("stops", T.ArrayType(T.IntegerType())))))


@pytest.mark.parametrize("wanted, problem", [
    (record(("id", T.LongType(), False)), None),
    (record(("id", T.DoubleType())), None),
    (record(("id", T.ShortType())), "id: int can't be read as smallint"),
    (record(("id", T.StringType())), "id: int can't be read as string"),
    (record(("fare", T.DoubleType())), None),
    (record(("fare", T.DoubleType(), False)), "fare: not written and without a default"),
    (record(("fare", T.DoubleType(), False, {"default": 1.5})), None),
    (record(("fare", T.DoubleType(), False, {"default": None})), "fare: null is its default and not allowed"),
    (record(("ride", record(("vendor_id", T.IntegerType())))), "ride.vendor_id: string can't be read as int"),
    (record(("ride", record(("vendor_id", T.StringType(), False)))), "ride.vendor_id: may be null in what was written"),
    (record(("ride", T.StringType())), "can't be read as string"),
    (record(("ride", record(("stops", T.ArrayType(T.LongType()))))), None),
    (record(("ride", record(("stops", T.ArrayType(T.StringType()))))), "ride.stops[]: int can't be read as string"),
    (record(("ride", record(("stops", T.ArrayType(T.LongType(), False))))), "ride.stops[]: may be null"),
])
def test_rules(wanted, problem):
    found = evolution.problems(BASE, wanted)
    assert found == [] if problem is None else len(found) == 1 and problem in found[0]


def test_rows_are_read_in_the_wanted_schema(spark):
    rows = spark.createDataFrame([(1, ("a", [1, None])), (2, None), (3, (None, None))], BASE)
    wanted = record(
        ("key", T.LongType(), False, {"aliases": ["ident", "id"]}),
        ("ride", record(("vendorId", T.StringType(), True, {"aliases": ["vendor_id"]}), ("stops", T.ArrayType(T.DoubleType())),
                        ("currency", T.StringType(), False, {"default": "USD"}), ("note", T.StringType()))),
        ("place", record(("x", T.IntegerType()), ("tags", T.ArrayType(T.StringType()))), True, {"default": {"x": 7, "tags": ["t"]}}))
    read = evolution.read_as(rows, wanted)
    assert [f.name for f in read.schema.fields] == wanted.names and read.schema["key"].dataType == T.LongType()
    got = [r.asDict(recursive=True) for r in read.orderBy("key").collect()]
    place = {"x": 7, "tags": ["t"]}
    assert got == [
        {"key": 1, "ride": {"vendorId": "a", "stops": [1.0, None], "currency": "USD", "note": None}, "place": place},
        {"key": 2, "ride": None, "place": place},
        {"key": 3, "ride": {"vendorId": None, "stops": None, "currency": "USD", "note": None}, "place": place}]


def test_maps_and_refusal(spark):
    rows = spark.createDataFrame([({"a": 1},), (None,)], "m map<string,int>")
    wanted = record(("m", T.MapType(T.StringType(), T.LongType())))
    assert sorted((str(r["m"]) for r in evolution.read_as(rows, wanted).collect())) == ["None", "{'a': 1}"]
    with pytest.raises(ValueError, match=r"m\{\}: int can't be read as string"):
        evolution.read_as(rows, record(("m", T.MapType(T.StringType(), T.StringType()))))


def test_partitions_are_listed_from_footers(spark):
    path = new_path(spark, "parts")
    rows = spark.createDataFrame([("a b", 1), ("a b", 9), ("x:y%+z", 4), (None, None), ("", 3)], "p string, id long")
    rows.withColumn("p2", F.lit(1)).repartition(3, "id").write.partitionBy("p").parquet(path)
    stored = spark.read.parquet(path)
    got = {r["p"]: (r["n"], r["least"], r["greatest"]) for r in files.partition_stats(stored, "p", "id").collect()}
    # The writer keeps null and empty values in one folder.
    assert got == {"a b": (2, 1, 9), "x:y%+z": (1, 4, 4), None: (2, 3, 3)}
    assert {r["least"] for r in files.footers(stored).collect()} == {None}
    assert files.footers(stored).agg(F.sum("n")).first()[0] == 5
