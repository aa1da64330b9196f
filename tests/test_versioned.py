"""Versioned tables: copy on write, the switch to a new version, and stored histories."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterlane.session import new_path
from meterlane.sinks import versioned


@pytest.fixture()
def table(spark):
    """A hundred rows in ten files, sorted by id."""
    path = new_path(spark, "versioned")
    rows = spark.range(100).select("id", F.concat(F.lit("v"), "id").alias("v")).repartitionByRange(10, "id")
    versioned.load(rows, path)
    return path


def files(spark, path):
    """The live files with their times."""
    names = [f.removeprefix("file://") for f in versioned.read(spark, path).inputFiles()]
    return {f: os.stat(f).st_mtime_ns for f in names}


def rows_of(frame):
    return ordered(tuple(r) for r in frame.collect())


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is None, 0 if x is None else x) for x in r])


def test_delete_rewrites_only_the_files_concerned(spark, table):
    before = files(spark, table)
    assert versioned.delete_where(spark, table, F.col("id").between(41, 43)).count() == 97
    after = files(spark, table)
    assert len(set(before.items()) & set(after.items())) == len(before) - 1
    # Again: nothing to delete, no new version, all files as they were.
    numbers = versioned.versions(spark, table)
    assert versioned.delete_where(spark, table, F.col("id").between(41, 43)).count() == 97
    assert files(spark, table) == after and versioned.versions(spark, table) == numbers


def test_delete_keeps_rows_for_which_the_condition_is_null(spark):
    path = new_path(spark, "nulls")
    versioned.load(spark.createDataFrame([(1, None), (2, 5), (3, 9)], "k int, x int"), path)
    assert rows_of(versioned.delete_where(spark, path, F.col("x") > 4)) == [(1, None)]
    assert rows_of(versioned.delete_where(spark, path, F.lit(True))) == []
    assert rows_of(versioned.append(spark.createDataFrame([(7, 7)], "k int, x int"), path)) == [(7, 7)]


@pytest.mark.parametrize("strategy", ["merge", "delete_insert"])
def test_merge_rewrites_only_files_with_matching_keys(spark, table, strategy):
    before = files(spark, table)
    new = spark.createDataFrame([(55, "new"), (57, "new"), (500, "new")], "id long, v string")
    for _ in range(2):
        got = versioned.load(new, table, strategy, ["id"])
        assert got.count() == 101 and rows_of(got.filter("v = 'new'")) == [(55, "new"), (57, "new"), (500, "new")]
        after = files(spark, table)
        assert len(set(before.items()) & set(after.items())) == len(before) - 1


def test_files_concerned_are_found_without_taking_paths_apart_per_row(spark, table, monkeypatch):
    frame, plans = type(spark.range(0)), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: plans.append(
        self._jdf.queryExecution().optimizedPlan().toString()) or collect(self))
    new = spark.createDataFrame([(55, "new")], "id long, v string")
    assert versioned.delete_insert(new, table, ["id"]).filter("v = 'new'").count() == 1
    searched = [p for p in plans if "file_path" in p]
    assert searched and not any("regexp" in p for p in searched)


def test_keys_that_repeat_or_are_null(spark, table):
    new = spark.createDataFrame([(3, "a"), (3, "b"), (None, "c"), (None, "c")], "id long, v string")
    got = versioned.merge(new, table, ["id"], [F.desc("v")])
    assert rows_of(got.filter("id = 3 OR id IS NULL")) == [(3, "b"), (None, "c"), (None, "c")]
    got = versioned.delete_insert(new.filter("id = 3"), table, ["id"])
    assert rows_of(got.filter("id = 3")) == [(3, "a"), (3, "b")] and got.count() == 103


def test_keys_of_several_columns(spark):
    path = new_path(spark, "pairs")
    versioned.load(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, None, 3)], "k int, l string, x int"), path)
    new = spark.createDataFrame([(1, "b", 9), (2, None, 8), (None, "z", 7)], "k int, l string, x int")
    assert rows_of(versioned.merge(new, path, ["k", "l"])) == [(1, "a", 1), (1, "b", 9), (2, None, 3), (2, None, 8), (None, "z", 7)]


def test_empty_loads_and_new_columns(spark, table):
    nothing = spark.createDataFrame([], "id long, v string")
    for strategy in ("append", "insert_only", "merge", "delete_insert"):
        assert versioned.load(nothing, table, strategy, ["id"]).count() == 100
    wider = spark.createDataFrame([("x", 4, "n")], "more string, id long, v string")
    got = versioned.load(wider, table, "merge", ["id"])
    assert got.columns == ["id", "v", "more"] and rows_of(got.filter("more IS NOT NULL")) == [(4, "n", "x")] and got.count() == 100
    fresh = new_path(spark, "fresh")
    assert versioned.load(wider, fresh, "merge", ["id"]).count() == versioned.load(wider, fresh, "insert_only", ["id"]).count() == 1


def test_interval_is_replaced_by_its_new_rows(spark, table):
    before = files(spark, table)
    new = spark.createDataFrame([(12, "new"), (90, "outside")], "id long, v string")
    for _ in range(2):
        got = versioned.replace_where(new, table, F.col("id").between(10, 19))
        assert got.count() == 91 and rows_of(got.filter("v IN ('new', 'outside')")) == [(12, "new")]
    assert len(set(before) & set(files(spark, table))) >= len(before) - 2


def test_a_load_that_breaks_off_changes_nothing(spark, table, monkeypatch):
    rows = rows_of(versioned.read(spark, table))

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(versioned, "point", broken)
        for load in (lambda: versioned.delete_where(spark, table, F.col("id") < 50),
                     lambda: versioned.merge(spark.range(3).select("id", F.lit("x").alias("v")), table, ["id"]),
                     lambda: versioned.load_newer(spark.range(300).select("id", F.lit("x").alias("v")), table, "id", ["id"])):
            with pytest.raises(OSError, match="lost"):
                load()
            assert rows_of(versioned.read(spark, table)) == rows
    assert versioned.load_newer(spark.range(300).select("id", F.lit("x").alias("v")), table, "id", ["id"]).count() == 300


def test_of_two_loads_from_one_version_one_wins(spark, table, monkeypatch):
    point = versioned.point

    def overtaken(spark, path, new):
        monkeypatch.setattr(versioned, "point", point)
        versioned.append(spark.createDataFrame([(1000, "first")], "id long, v string"), path)
        return point(spark, path, new)

    monkeypatch.setattr(versioned, "point", overtaken)
    with pytest.raises(versioned.Conflict):
        versioned.delete_where(spark, table, F.col("id") >= 0)
    assert versioned.read(spark, table).count() == 101
    assert not [n for n in os.listdir(f"{table}/versions") if not n.strip(".").removesuffix(".crc").endswith(".json")]


def test_older_versions_can_be_read(spark, table):
    versioned.delete_where(spark, table, F.col("id") < 50)
    versioned.append(spark.createDataFrame([(7, "again", 1)], "id long, v string, w int"), table)
    assert [versioned.read(spark, table, number=n).count() for n in versioned.versions(spark, table)] == [100, 50, 51]
    assert versioned.read(spark, table, number=1).columns == ["id", "v"]
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, new_path(spark, "nothing"))


def day(n):
    return F.lit(f"2024-01-{n:02}").cast("timestamp_ntz")


def brute_history(deliveries):
    """Rows (key, value, from, to) of ``{day: {key: value}}``."""
    out, now = [], {}
    for n, state in deliveries.items():
        for k in [k for k, (v, _) in now.items() if k not in state or state[k] != v]:
            v, since = now.pop(k)
            out.append((k, v, dt.datetime(2024, 1, since), dt.datetime(2024, 1, n)))
        for k, v in state.items():
            now.setdefault(k, (v, n))
    return ordered(out + [(k, v, dt.datetime(2024, 1, n), None) for k, (v, n) in now.items()])


def test_history_of_deliveries(spark):
    path = new_path(spark, "history")
    deliveries = {1: {1: "a", 2: "b", None: "n", 4: None}, 2: {1: "a", 2: "c", None: "n", 4: None, 5: "e"}, 3: {}, 4: {1: "a", 4: "x", None: None},
                  5: {1: "z", 4: "x", None: None}}
    for n in deliveries:
        rows = spark.createDataFrame(list(deliveries[n].items()), "k int, v string")
        for _ in range(2):
            got = versioned.load_history(rows, path, "k", ["v"], day(n))
            assert rows_of(got) == brute_history({m: s for m, s in deliveries.items() if m <= n})
    assert len(versioned.versions(spark, path)) == 5


def test_history_touches_only_files_in_which_a_version_ends(spark):
    path = new_path(spark, "history-files")
    source = spark.range(200).select("id", F.lit("a").alias("v"), F.lit(None).cast("int").alias("unused"))
    versioned.load_history(source, path, "id", ["v"], day(1))
    first = set(versioned.read(spark, path, versioned.OPEN).inputFiles())
    changed = source.withColumn("v", F.when(F.col("id") == 7, "b").otherwise(F.col("v")))
    got = versioned.load_history(changed, path, "id", ["v"], day(2))
    assert got.count() == 201 and got.filter("valid_to IS NULL").count() == 200
    closed = set(versioned.read(spark, path, versioned.CLOSED).inputFiles())
    assert len(first - set(versioned.read(spark, path, versioned.OPEN).inputFiles())) == 1
    again = changed.unionByName(changed).withColumn("v", F.when(F.col("id") == 9, "c").otherwise(F.col("v")))
    versioned.load_history(again, path, "id", ["v"], day(3))
    assert closed < set(versioned.read(spark, path, versioned.CLOSED).inputFiles())
    assert versioned.history(spark, path).count() == 202 and versioned.history(spark, path, 2).count() == 201
