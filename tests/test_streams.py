"""Streams against their batch twins and on planted late, double and broken records."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.session import new_path
from meterlane.sinks import upserts, versioned
from meterlane.streaming import aggregates, decode, joins, run, sources, state


class Topic:
    """A growing folder and one checkpoint."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.folder, self.checkpoint, self.out = (new_path(spark, n) for n in ("topic", "state", "out"))
        spark.createDataFrame([], schema).write.parquet(self.folder)

    def send(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        return self

    def stream(self):
        return sources.folder(self.spark, self.folder, self.spark.read.parquet(self.folder).schema)


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, minute // 60, minute % 60, second)


@pytest.mark.parametrize("batches, wanted", [([["a"]], {"a": 1}), ([["a", "b"]], {"a": 1, "b": 1}),
                                             ([["a"], ["a"]], {"a": 2})])
def test_running_count(spark, batches, wanted):
    topic = Topic(spark, "k string")
    for batch in batches:
        topic.send(*[(k,) for k in batch])
        counted = run.upsert(aggregates.counts_by_key(topic.stream(), "k"), "n", ["k"], topic.out, topic.checkpoint)
    assert {r["k"]: r["n"] for r in counted.collect()} == wanted


def windows(topic, late, sink):
    return sink(aggregates.windowed(topic.stream(), "t", "10 minutes", ["k"], late=late))


def test_late_rows_within_the_bound_count_and_later_ones_do_not(spark):
    topic = Topic(spark, "k int, t timestamp_ntz")

    def closed():
        table = windows(topic, "10 minutes", lambda s: run.append(s, "w", topic.out, topic.checkpoint))
        return sorted((r["window_start"], r["n"]) for r in table.collect())

    topic.send((1, at(5)), (1, at(25)))
    assert closed() == [(at(0), 1)]
    # The watermark is at minute 15: 12 is still counted, 7 belongs to a closed window.
    topic.send((1, at(12)), (1, at(7)))
    assert closed() == [(at(0), 1)]
    topic.send((1, at(45)))
    assert closed() == [(at(0), 1), (at(10), 1), (at(20), 1)]


def test_late_rows_correct_a_window_that_was_shown(spark):
    topic = Topic(spark, "k int, t timestamp_ntz")

    def shown():
        table = windows(topic, "1 hour", lambda s: run.upsert(s, "w", ["window_start", "k"], topic.out, topic.checkpoint))
        return sorted((r["window_start"], r["n"]) for r in table.collect())

    topic.send((1, at(5)), (1, at(25)))
    assert shown() == [(at(0), 1), (at(20), 1)]
    topic.send((1, at(7)))
    assert shown() == [(at(0), 2), (at(20), 1)]


def test_restart_reads_new_files_only(spark):
    topic = Topic(spark, "k int")
    for n in (1, 2):
        topic.send((n,))
        table = run.append(topic.stream(), "copy", topic.out, topic.checkpoint)
        assert sorted(r["k"] for r in table.collect()) == list(range(1, n + 1))


def test_interval_join(spark):
    left = Topic(spark, "k int, lt timestamp_ntz").send((1, at(60)), (2, at(60)))
    right = Topic(spark, "k int, rt timestamp_ntz").send(
        (1, at(70, 59)), (1, at(71)), (1, at(50)), (2, at(100)), (3, at(60)))
    pairs = joins.interval_join(left.stream(), right.stream(), "k", "lt", "rt", 20, 10, 5)
    stored = run.append(pairs, "pairs")
    # Eleven whole minutes are too far, 10:59 are not.
    assert sorted((r["k"], r["rt"].replace(tzinfo=None)) for r in stored.collect()) == [(1, at(50)), (1, at(70, 59))]


def test_duplicates_are_removed_across_restarts(spark):
    topic = Topic(spark, "id int, t timestamp_ntz")
    for rows in ([(1, at(1)), (1, at(2)), (2, at(2))], [(1, at(3)), (3, at(4))]):
        topic.send(*rows)
        once = state.deduplicated(topic.stream(), ["id"], "t", "1 hour")
        table = run.append(once, "once", topic.out, topic.checkpoint)
    assert sorted(r["id"] for r in table.collect()) == [1, 2, 3]


def test_keyed_state_survives_a_restart(spark):
    topic = Topic(spark, "k long, id long, v double")
    for rows in ([(1, 1, 1.25), (1, 2, 2.0)], [(1, 3, 0.5), (2, 4, 1.0)]):
        topic.send(*rows)
        totals = run.upsert(state.keyed_totals(topic.stream(), "k", "id", "v"), "keyed", ["key", "salt"],
                            topic.out, topic.checkpoint)
    assert {r["key"]: (r["trips"], r["amount"]) for r in state.folded(totals).collect()} == {1: (3, 3.75), 2: (1, 1.0)}


def test_hot_key_is_spread_over_the_state_partitions(spark):
    spark.conf.set(run.STATE_PARTITIONS, "6")
    try:
        topic = Topic(spark, "k long, id long, v double").send(*[(1, i, 0.000001) for i in range(200)], (2, 900, None))
        totals = run.upsert(state.keyed_totals(topic.stream(), "k", "id", "v"), "spread", ["key", "salt"],
                            topic.out, topic.checkpoint)
        assert {r["salt"] for r in totals.filter("key = 1").collect()} == set(range(6))
        folded = {r["key"]: (r["trips"], r["amount"]) for r in state.folded(totals).collect()}
        assert folded == {1: (200, pytest.approx(0.0002)), 2: (1, 0.0)}
    finally:
        spark.conf.unset(run.STATE_PARTITIONS)


@pytest.mark.parametrize("portion", [1 << 19, 700])
def test_only_hot_keys_take_more_than_one_state_entry(spark, monkeypatch, portion):
    monkeypatch.setattr(state, "PORTION", portion)
    schema, nan = "k long, id long, v double", float("nan")
    rows = [(k, 1000 * k + i, 0.5) for k in range(300) for i in range(4)] + [(None, i, 0.25) for i in range(3)]
    rows += [(900, i, 2.0) for i in range(2000)] + [(901, 1, None), (902, 1, nan), (902, 2, 1.5)]
    topic = Topic(spark, schema).send(*rows)
    for delivery in (1, 2):
        totals = run.upsert(state.keyed_totals(topic.stream(), "k", "id", "v", salts=8), "few", ["key", "salt"],
                            topic.out, topic.checkpoint)
        assert totals.filter("key = 900").count() >= 5
        assert totals.filter("key < 300").count() == 300
        got = {r["key"]: (r["trips"], r["amount"]) for r in state.folded(totals).collect()}
        assert got == {**{k: (4 * delivery, 2.0 * delivery) for k in range(300)}, None: (3 * delivery, 0.75 * delivery),
                       900: (2000 * delivery, 4000.0 * delivery), 901: (delivery, 0.0), 902: (2 * delivery, 1.5 * delivery)}
        topic.send(*rows)


def test_broken_records_are_kept_apart(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])
    topic = Topic(spark, "value string").send(('{"id": 1, "v": 2.5}',), ('{"id": "x", "v": 1}',), ('{"id": 3',))
    stored = run.append(decode.checked_json(topic.stream(), schema), "checked")
    assert stored.filter(~decode.is_bad(stored)).select("id").collect()[0][0] == 1
    assert stored.filter(decode.is_bad(stored)).count() == 2


def test_session_window_equals_batch(spark):
    topic = Topic(spark, "k int, t timestamp_ntz").send((1, at(0)), (1, at(5)), (1, at(11)), (2, at(3)))
    stored = run.complete(aggregates.session_windows(topic.stream(), "t", "5 minutes", ["k"], "5 seconds"), "s")
    batch = aggregates.session_windows(spark.read.parquet(topic.folder), "t", "5 minutes", ["k"])
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))
    assert sorted(r["n_events"] for r in stored.collect()) == [1, 1, 2]


def test_processing_time_window_counts_everything(spark):
    topic = Topic(spark, "k int").send((1,), (1,), (2,))
    stored = run.complete(aggregates.processing_time_windows(topic.stream(), "5 minutes", ["k"]), "clock")
    assert stored.agg(F.sum("n")).first()[0] == 3


def test_console_runs_until_stopped(spark):
    topic = Topic(spark, "k int").send((1,))
    shown = run.console(aggregates.counts_by_key(topic.stream(), "k"), every="1 second")
    shown.processAllAvailable()
    shown.stop()
    assert shown.exception() is None


@pytest.mark.parametrize("since, wanted", [("2020-01-01", 1), ("2999-01-01", 0)])
def test_start_after_a_time_skips_older_files(spark, since, wanted):
    topic = Topic(spark, "k int").send((1,))
    schema = spark.read.parquet(topic.folder).schema
    assert run.append(sources.folder(spark, topic.folder, schema, since=since), "since").count() == wanted


def test_state_partitions_follow_their_setting_and_never_the_cores(spark):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "5000")
        with run.state_partitions(spark):
            assert spark.conf.get(setting) == "5000"
        spark.conf.set(run.STATE_PARTITIONS, "24")
        with run.state_partitions(spark):
            assert spark.conf.get(setting) == "24"
        assert spark.conf.get(setting) == "5000"
    finally:
        spark.conf.unset(run.STATE_PARTITIONS)
        spark.conf.set(setting, before)


def test_complete_table_survives_a_restart_without_input(spark):
    folder, state_folder = new_path(spark, "restart"), new_path(spark, "restart-state")
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int").write.parquet(folder)
    for _ in range(2):
        counted = spark.readStream.schema("k string, v int").parquet(folder).groupBy("k").count()
        result = run.complete(counted, "restart", checkpoint=state_folder)
        assert {tuple(r) for r in result.collect()} == {("a", 2), ("b", 1)}


def state_rows(spark, checkpoint):
    return spark.read.format("statestore").load(checkpoint).count()


def test_sessions_are_emitted_once_when_closed_and_leave_the_state(spark):
    topic = Topic(spark, "k int, t timestamp_ntz")

    def closed():
        table = run.append(aggregates.session_windows(topic.stream(), "t", "5 minutes", ["k"], "10 minutes"), "s",
                           topic.out, topic.checkpoint)
        return sorted((r["k"], r["session_start"], r["n_events"]) for r in table.collect())

    topic.send((1, at(0)), (1, at(4)), (2, at(12)))
    assert closed() == [] and state_rows(spark, topic.checkpoint) == 2
    # The late row joins an open session, the next one moves the watermark past it; a null time counts nowhere.
    topic.send((1, at(8)), (None, None), (2, at(40)))
    assert closed() == [(1, at(0), 3), (2, at(12), 1)]
    # Later than the watermark: dropped.
    topic.send((1, at(1)))
    assert closed() == [(1, at(0), 3), (2, at(12), 1)]
    aggregates.end_mark(spark.read.parquet(topic.folder), "t").write.mode("append").parquet(topic.folder)
    assert closed() == [(1, at(0), 3), (2, at(12), 1), (2, at(40), 1)]
    assert state_rows(spark, topic.checkpoint) == 0


def test_session_of_a_hot_key_is_one_row_of_state(spark):
    topic = Topic(spark, "k int, t timestamp_ntz").send(*[(1, at(i // 10, i % 10)) for i in range(1000)], (2, at(90)))
    table = run.append(aggregates.session_windows(topic.stream(), "t", "5 minutes", ["k"], "1 hour"), "s",
                       topic.out, topic.checkpoint)
    assert table.count() == 0 and state_rows(spark, topic.checkpoint) == 2


def test_windows_leave_the_state_after_their_retention(spark):
    topic = Topic(spark, "k int, t timestamp_ntz")

    def shown():
        table = windows(topic, "20 minutes", lambda s: run.upsert(s, "w", ["window_start", "k"], topic.out, topic.checkpoint))
        return sorted((r["window_start"], r["n"]) for r in table.collect())

    topic.send((1, at(5)), (1, at(35)))
    assert shown() == [(at(0), 1), (at(30), 1)]
    # The watermark is at minute 15: the first window has left the state, its row stays in the table and late rows change nothing.
    assert state_rows(spark, topic.checkpoint) == 1
    topic.send((1, at(6)), (1, at(16)))
    assert shown() == [(at(0), 1), (at(10), 1), (at(30), 1)]
    aggregates.end_mark(spark.read.parquet(topic.folder), "t").write.mode("append").parquet(topic.folder)
    assert len(shown()) == 3 and state_rows(spark, topic.checkpoint) == 0


def counted(topic, checkpoint, **options):
    table = run.upsert(aggregates.counts_by_key(topic.stream(), "k"), "n", ["k"], topic.out, checkpoint, **options)
    return {r["k"]: r["n"] for r in table.collect()}


def test_upsert_without_input_is_an_empty_table(spark):
    topic = Topic(spark, "k string")
    assert counted(topic, topic.checkpoint) == {}
    topic.send(("a",), (None,))
    assert counted(topic, topic.checkpoint) == {"a": 1, None: 1}


def test_upsert_with_a_new_checkpoint_on_an_old_table_wins(spark):
    topic = Topic(spark, "k string")
    for _ in range(3):
        topic.send(("a",))
        counted(topic, topic.checkpoint)
    # All is counted again in one batch, whose number is lower than those before.
    topic.send(("a",), ("b",))
    assert counted(topic, new_path(spark, "state")) == {"a": 4, "b": 1}


def test_upsert_log_is_folded_while_the_stream_goes_on(spark):
    topic, lengths = Topic(spark, "k string"), []
    for n in range(1, 6):
        topic.send(("a",), (f"k{n}",), (None,))
        assert counted(topic, topic.checkpoint, fold_every=2) == {"a": n, None: n, **{f"k{i}": 1 for i in range(1, n + 1)}}
        lengths.append(upserts.log_length(spark, topic.out))
    assert lengths == [1, 0, 1, 0, 1]


def test_a_batch_and_a_fold_that_meet_lose_nothing(spark, monkeypatch):
    path, schema = new_path(spark, "meet"), "k string, n int"
    upserts.prepare(spark, path, spark.createDataFrame([], schema).schema)
    upserts.add(spark.createDataFrame([("a", 1)], schema), path)
    point = versioned.point

    def overtaken(session, place, new):
        monkeypatch.setattr(versioned, "point", point)
        if folding:
            upserts.add(spark.createDataFrame([("a", 3)], schema), path)
        else:
            upserts.fold(spark, path, ["k"])
        return point(session, place, new)

    folding = False
    monkeypatch.setattr(versioned, "point", overtaken)
    upserts.add(spark.createDataFrame([("a", 2), ("b", 2)], schema), path)
    assert {tuple(r) for r in upserts.read(spark, path, ["k"]).collect()} == {("a", 2), ("b", 2)}
    folding = True
    monkeypatch.setattr(versioned, "point", overtaken)
    with pytest.raises(versioned.Conflict):
        upserts.fold(spark, path, ["k"])
    assert {tuple(r) for r in upserts.read(spark, path, ["k"]).collect()} == {("a", 3), ("b", 2)}


def test_reports_every_n_messages_over_restarts(spark):
    topic = Topic(spark, "id long, v double")
    sent = [(i, None if i == 4 else i / 4) for i in range(1, 18)]
    wanted = [(n, sum(v or 0 for _, v in sent[:n])) for n in (5, 10, 15)]
    for end, reports in ((3, 0), (4, 0), (13, 2), (17, 3)):
        begin = {3: 0, 4: 3, 13: 4, 17: 13}[end]
        topic.send(*sent[begin:end])
        for _ in range(2):  # the second run finds no new input
            table = run.every_n(topic.stream(), "reports", 5, ["id"], "v", topic.out, topic.checkpoint)
            got = sorted((r["messages"], r["revenue"]) for r in table.collect())
            assert got == [(n, pytest.approx(total)) for n, total in wanted[:reports]]
    assert all(r["avg_amount"] == pytest.approx(r["revenue"] / r["messages"]) for r in table.collect())


def test_reports_of_an_empty_stream(spark):
    topic = Topic(spark, "id long, v double")
    assert run.every_n(topic.stream(), "reports", 5, ["id"], "v", topic.out, topic.checkpoint).count() == 0


def test_branches_go_on_after_a_restart(spark):
    topic = Topic(spark, "v int")
    routes = {"high": F.col("v") >= 40, "low": F.col("v") < 40}

    def routed():
        tables = run.branch(topic.stream(), "b", routes, topic.out, topic.checkpoint)
        return {name: sorted(r["v"] for r in table.collect()) for name, table in tables.items()}

    assert routed() == {"high": [], "low": []}
    topic.send((1,), (40,), (None,))
    assert routed() == {"high": [40], "low": [1]}
    topic.send((2,))
    assert routed() == {"high": [40], "low": [1, 2]}


def test_batch_function_goes_on_after_a_restart(spark):
    topic = Topic(spark, "v int")

    def doubled():
        table = run.each_batch(topic.stream(), "each", lambda b: b.select((F.col("v") * 2).alias("twice")), topic.out, topic.checkpoint)
        return sorted(r["twice"] for r in table.collect())

    assert doubled() == []
    for n in (1, 2):
        topic.send((n,))
        assert doubled() == [2 * i for i in range(1, n + 1)]


def test_processing_time_windows_carry_ranks(spark):
    topic = Topic(spark, "k int").send((1,), (1,), (2,), (3,), (3,), (4,))
    stored = run.upsert(aggregates.processing_time_windows(topic.stream(), "5 minutes", ["k"]), "clock",
                        ["window_start", "window_end", "k"])
    ranked = aggregates.busiest_first(stored).collect()
    assert sorted((r["rank"], r["k"], r["n"]) for r in ranked) == [(1, 1, 2), (1, 3, 2), (3, 2, 1), (3, 4, 1)]
    assert all(r["window_end"] - r["window_start"] == dt.timedelta(minutes=5) for r in ranked)
