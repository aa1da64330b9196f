"""Write strategies on small literal tables, run twice where that must change nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlane.functions import keys
from meterlane.operators import joins, merging, quality
from meterlane.session import materialize, new_path, release, shared_root
from meterlane.sinks import tables, versioned
from meterlane.sources import cursor, files, relational


@pytest.fixture()
def people(spark):
    """Ids and ages are those whose totals are published; all texts are invented."""
    names = ("Ada", "Bo", "Cleo", "Dov", "Eli", "Fay", "Gus", "Hal")
    a = spark.createDataFrame([(i, names[i - 1], 25 + i, "Northport") for i in range(1, 6)],
                              "ID int, Name string, Age int, City string")
    b = spark.createDataFrame([(i, names[i - 1], 30 + i, "Southbay", "baker") for i in range(3, 9)],
                              "ID int, Name string, Age int, City string, Occupation string")
    return a, b


def test_append_keeps_duplicates(spark, people):
    path = new_path(spark, "people")
    versioned.load(people[0], path)
    table = versioned.load(people[1], path, "append")
    assert tuple(table.agg(F.count("*"), F.sum("Age")).first()) == (11, 353)
    assert table.filter("Occupation IS NULL").count() == 5


def test_merge_replaces_by_key(spark, people):
    path = new_path(spark, "people")
    versioned.load(people[0], path)
    for _ in range(2):
        table = versioned.load(people[1], path, "merge", ["ID"])
        assert tuple(table.agg(F.count("*"), F.sum("Age")).first()) == (8, 266)
    assert table.filter("ID = 3").first()["Age"] == 33


def test_upsert_counts_a_repeated_source_key_once(spark, people):
    source = people[0].unionByName(people[0].withColumn("Age", F.col("Age") + 100))
    merged = merging.upsert(people[0], source, ["ID"], [F.desc("Age")])
    assert sorted(r["Age"] for r in merged.collect()) == [126, 127, 128, 129, 130]
    assert merging.delete_insert(people[0], source, ["ID"]).count() == 10


def test_insert_only_keeps_source_duplicates_once_run_again(spark, people):
    path = new_path(spark, "insert")
    versioned.load(people[0].filter("ID < 3"), path)
    twice = people[0].unionByName(people[0])
    assert versioned.load(twice, path, "insert_only", ["ID"]).count() == 2 + 6
    assert versioned.load(twice, path, "insert_only", ["ID"]).count() == 2 + 6


def test_full_refresh_overrides_strategy(spark, people):
    path = new_path(spark, "refresh")
    versioned.load(people[0], path)
    assert versioned.load(people[1], path, "append", full_refresh=True).count() == 6


def test_unknown_strategy(spark, people):
    with pytest.raises(ValueError):
        versioned.load(people[0], new_path(spark, "x"), "guess")


def test_merge_partitions_touches_only_its_partitions(spark):
    path = new_path(spark, "parts")
    tables.write_partitioned(spark.range(100).select("id", (F.col("id") % 4).alias("p")), path, ["p"])
    before = files_of(spark, path)
    fresh = spark.createDataFrame([(1, 1), (1001, 1)], "id long, p long")
    assert tables.merge_partitions(fresh, path, ["id", "p"], "p").count() == 101
    after = files_of(spark, path)
    assert {f for f in before if "/p=1/" not in f} == {f for f in after if "/p=1/" not in f}
    assert {f for f in before if "/p=1/" in f}.isdisjoint(after)


def files_of(spark, path):
    return set(spark.read.parquet(path).inputFiles())


def test_merge_partitions_keeps_rows_without_partition(spark):
    path = new_path(spark, "null-part")
    rows = "id long, p string"
    tables.write_partitioned(spark.createDataFrame([(1, None), (2, "a"), (3, "b")], rows), path, ["p"])
    merged = tables.merge_partitions(spark.createDataFrame([(9, None), (2, "a"), (4, "a")], rows), path, ["id", "p"], "p")
    assert sorted((r["id"], r["p"]) for r in merged.fillna("-").collect()) == [
        (1, "-"), (2, "a"), (3, "b"), (4, "a"), (9, "-")]


def test_merge_partitions_needs_partition_in_key(spark):
    with pytest.raises(ValueError):
        tables.merge_partitions(spark.range(1), "nowhere", ["id"], "p")


def test_replace_interval_keeps_rows_without_time(spark):
    target = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", None)], "k string, t string")
    rows = spark.createDataFrame([("x", "2024-01-02"), ("y", "2024-01-03")], "k string, t string")

    def typed(frame):
        return frame.withColumn("t", F.col("t").cast("timestamp_ntz"))

    start, end = F.lit("2024-01-02").cast("timestamp_ntz"), F.lit("2024-01-03").cast("timestamp_ntz")
    result = merging.replace_interval(typed(target), typed(rows), "t", start, end)
    assert sorted(r["k"] for r in result.collect()) == ["a", "c", "x"]


def test_replace_days_empties_days_without_rows(spark):
    path = new_path(spark, "days")
    days = spark.range(30).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("day"))
    tables.write_partitioned(days, path, ["day"])
    rerun = days.filter("day = DATE '2024-01-02' AND id < 10")
    for _ in range(2):
        table = tables.replace_days(rerun, path, "day", "2024-01-02", "2024-01-03")
        assert {str(r["day"]): r["count"] for r in table.groupBy("day").count().collect()} == {
            "2024-01-01": 6, "2024-01-02": 2, "2024-01-04": 6, "2024-01-05": 6}


def test_high_water_mark_of_empty_target_loads_everything(spark):
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, t timestamp_ntz")
    assert merging.newer_than_target(rows.limit(0), rows, "t").count() == 1
    assert merging.newer_than_target(rows, rows, "t").count() == 0


def test_cursor_reads_late_rows_at_the_boundary_once(spark):
    target, state = new_path(spark, "target"), new_path(spark, "state")
    at = dt.datetime(2024, 1, 2)
    first = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, at)], "id int, t timestamp_ntz")

    def run(frame):
        return cursor.load_since_cursor(frame, target, state, "p", "t", ["id"], "2024-01-01")

    assert run(first) == 2
    assert run(first) == 0
    more = first.unionByName(spark.createDataFrame([(3, at)], "id int, t timestamp_ntz"))
    assert run(more) == 1
    assert spark.read.parquet(target).count() == 3


def test_scd2_twice_changes_nothing(spark):
    def at(day):
        return F.lit(day).cast("timestamp_ntz")

    empty = spark.createDataFrame([], "k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    two = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, v string")
    history = merging.scd2(empty, one, "k", ["v"], at("2024-01-01"))
    history = merging.scd2(history, two, "k", ["v"], at("2024-01-02"))
    again = merging.scd2(history, two, "k", ["v"], at("2024-01-03"))
    rows = sorted((r["k"], r["v"], r["valid_to"] is None) for r in again.collect())
    assert rows == [(1, "a", True), (2, "b", False), (2, "c", True), (3, "d", True)]


def test_backfill_of_nothing_done(spark):
    frame = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "id int, month string")
    assert tables.backfill(frame, new_path(spark, "fill"), "month", None).count() == 2


def test_csv_known_columns_ignores_others(spark):
    path = new_path(spark, "extra")
    spark.createDataFrame([("x", 1, "z")], "a string, b int, c string").write.option("header", True).csv(path)
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("c", T.StringType()), T.StructField("b", T.IntegerType())])
    assert tuple(files.csv_known_columns(spark, path, schema).first()) == ("z", 1)


def test_rows_per_file_tells_folders_apart(spark):
    path = new_path(spark, "folders")
    for part in (0, 1):
        spark.range(3).coalesce(1).write.parquet(f"{path}/p={part}")
    assert files.rows_per_file(spark.read.parquet(path)).count() == 2


def test_scd2_sees_moved_text_and_nulls(spark):
    shape = "k int, a string, b string"
    old = spark.createDataFrame([(1, "ab", "c"), (2, None, "x"), (3, "s", "t")], shape).withColumns(
        {"valid_from": F.lit(1), "valid_to": F.lit(None).cast("int")})
    new = spark.createDataFrame([(1, "a", "bc"), (2, "", "x"), (3, "s", "t")], shape)
    got = merging.scd2(old, new, "k", ["a", "b"], F.lit(2))
    assert {r.k for r in got.filter("valid_to = 2").collect()} == {1, 2} and got.count() == 5


def test_not_in_an_empty_lookup_keeps_all(spark):
    facts = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert joins.not_in_either(facts, spark.createDataFrame([], "id int"), "id", ["a", "b"]).count() == 3


def test_accepted_values_with_a_null_in_the_list(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert quality.accepted_values(frame, "v", ["a", None]).first()["failures"] == 1


def test_base_id_of_null(spark):
    got = spark.createDataFrame([("B00021",), (None,)], "c string").select(keys.base_id_udf("c"), keys.base_id("c"))
    assert [r[0] == r[1] for r in got.collect()] == [True, True]


def test_shared_root_follows_the_setting(spark):
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    assert wanted is None or shared_root(spark) == wanted.rstrip("/")


def test_released_intermediate_tables_are_empty(spark):
    stored = materialize(spark.range(5), "release")
    folder = stored.inputFiles()[0].rsplit("/", 1)[0]
    assert release(spark) >= 1 and release(spark) == 0
    assert spark.read.parquet(folder).count() == 0


def test_jdbc_options():
    options = relational.read_options("jdbc:x", "t", "id", 0, 100, 4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    assert "partitionColumn" not in relational.read_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        relational.read_options("jdbc:x", "t", "id")
    assert relational.write_options("jdbc:x", "t")["batchsize"] == "100000"
