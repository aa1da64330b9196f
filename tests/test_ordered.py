"""Window results by slices against brute force, with one key holding a third of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlane.operators import cleaning, joins, ordered, sessions

ROWS = 3000


@pytest.fixture(scope="module")
def table(spark):
    random = np.random.default_rng(5)
    keys = np.where(random.random(ROWS) < 0.34, "hot", random.integers(0, 40, ROWS).astype(str))
    keys = np.where(random.random(ROWS) < 0.02, None, keys)
    pdf = pd.DataFrame({"k": keys, "v": random.integers(0, 300, ROWS), "id": np.arange(ROWS)})
    return pdf, spark.createDataFrame(pdf, "k string, v long, id long")


def by_id(frame, column):
    return {r["id"]: r[column] for r in frame.select("id", column).collect()}


def test_row_number_per_key(table):
    pdf, df = table
    got = by_id(ordered.row_number(df, [F.desc("v"), F.asc("id")], ["k"]), "row_number")
    sorted_rows = pdf.sort_values(["v", "id"], ascending=[False, True])
    wanted = (sorted_rows.groupby("k", dropna=False).cumcount() + 1)
    assert got == dict(zip(sorted_rows["id"], wanted))


def test_row_number_global(table):
    pdf, df = table
    got = by_id(ordered.row_number(df, [F.asc("v"), F.asc("id")]), "row_number")
    assert got == {i: n for n, i in enumerate(pdf.sort_values(["v", "id"])["id"], start=1)}


def test_running_sum(table):
    pdf, df = table
    got = by_id(ordered.running_sum(df, ["k"], [F.asc("id")], F.col("v")), "running_sum")
    assert got == dict(zip(pdf["id"], pdf.groupby("k", dropna=False)["v"].cumsum()))


def test_ranks(table):
    pdf, df = table
    ranked = ordered.ranks(df, ["k"], "v")
    groups = pdf.groupby("k", dropna=False)["v"]
    assert by_id(ranked, "rank") == dict(zip(pdf["id"], groups.rank("min", ascending=False).astype(int)))
    assert by_id(ranked, "dense_rank") == dict(zip(pdf["id"], groups.rank("dense", ascending=False).astype(int)))


def test_frames_cross_block_edges(table, monkeypatch):
    pdf, df = table
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 7)
    framed = ordered.framed(df, ["k"], [F.asc("id")], {
        "prev": lambda w: F.lag("v", 2).over(w), "next": lambda w: F.lead("v").over(w),
        "moving": lambda w: F.sum("v").over(w.rowsBetween(-2, 0))}, before=2, after=1)
    groups = pdf.groupby("k", dropna=False)["v"]
    assert framed.count() == ROWS

    def plain(series):
        return {i: None if pd.isna(x) else int(x) for i, x in zip(pdf["id"], series)}

    assert by_id(framed, "prev") == plain(groups.shift(2))
    assert by_id(framed, "next") == plain(groups.shift(-1))
    moving = groups.rolling(3, min_periods=1).sum().reset_index(level=0, drop=True).sort_index()
    assert by_id(framed, "moving") == plain(moving)


def test_frame_longer_than_a_block(table, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_ROWS", 4)
    pdf, df = table
    framed = ordered.framed(df, ["k"], [F.asc("id")], {"prev": lambda w: F.lag("v", 9).over(w)}, before=9)
    want = pdf.groupby("k", dropna=False)["v"].shift(9)
    assert by_id(framed, "prev") == {i: None if pd.isna(x) else int(x) for i, x in zip(pdf["id"], want)}


def test_percentiles(table):
    pdf, df = table
    alone = ordered.percentiles(df, [], "v", {"p50": 0.5}).first()
    assert alone["p50"] == pytest.approx(np.quantile(pdf["v"], 0.5))
    nothing = df.withColumn("v", F.when(F.col("k").isNotNull(), F.col("v")))
    assert {r["p50"] for r in ordered.percentiles(nothing, ["k"], "v", {"p50": 0.5}).filter("k IS NULL").collect()} == {None}
    rows = ordered.percentiles(df, ["k"], "v", {"p50": 0.5, "p90": 0.9, "p100": 1.0}).collect()
    for row in rows:
        values = pdf[pdf["k"].isna() if row["k"] is None else pdf["k"] == row["k"]]["v"]
        for name, p in (("p50", 0.5), ("p90", 0.9), ("p100", 1.0)):
            assert row[name] == pytest.approx(np.quantile(values, p))
    assert len(rows) == pdf["k"].nunique(dropna=False)


def test_first_per_key_keeps_hot_groups_small_before_the_shuffle(table):
    kept = cleaning.first_per_key(table[1], ["k"], [F.desc("v"), F.asc("id")], 2)
    assert kept.count() == 2 * table[0]["k"].nunique(dropna=False)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("gap", [1, 5, 60])
def test_sessions_against_brute_force(spark, gap):
    random = np.random.default_rng(gap)
    at = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(random.integers(0, 4000, 500)), unit="s")
    pdf = pd.DataFrame({"k": np.where(random.random(500) < 0.4, 0, random.integers(1, 6, 500)), "t": at})
    found = sessions.sessions(spark.createDataFrame(pdf).withColumn("t", F.col("t").cast("timestamp_ntz")),
                              ["k"], "t", gap)
    wanted = []
    for key, group in pdf.sort_values("t").groupby("k"):
        opens = group["t"].diff() > pd.Timedelta(seconds=gap)
        for _, run in group.groupby(opens.cumsum()):
            wanted.append((key, run["t"].min(), run["t"].max() + pd.Timedelta(seconds=gap), len(run)))
    got = [tuple(r) for r in found.select("k", "session_start", "session_end", "n_events").collect()]
    assert sorted(got) == sorted((k, a.to_pydatetime(), b.to_pydatetime(), n) for k, a, b, n in wanted)


def test_events_one_gap_apart_share_a_session(spark):
    frame = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:05:00"),
                                   (1, "2024-01-01 00:10:00.000001")], "k int, t string")
    found = sessions.sessions(frame.withColumn("t", F.col("t").cast("timestamp_ntz")), ["k"], "t", 300)
    assert sorted(r["n_events"] for r in found.collect()) == [1, 2]


def test_near_in_time_against_brute_force(spark):
    random = np.random.default_rng(3)

    def side(name, n):
        return pd.DataFrame({"k": np.where(random.random(n) < 0.4, 0, random.integers(1, 4, n)), f"{name}_id": np.arange(n),
                             f"{name}_t": pd.Timestamp("2024-01-01") + pd.to_timedelta(random.integers(0, 3000, n), unit="s")})

    left, right = side("l", 200), side("r", 150)
    frames = [spark.createDataFrame(f).withColumn(c, F.col(c).cast("timestamp_ntz"))
              for f, c in ((left, "l_t"), (right, "r_t"))]
    got = joins.near_in_time(frames[0], frames[1], "k", "l_t", "r_t", 60)
    both = left.merge(right, on="k")
    wanted = both[(both["l_t"] - both["r_t"]).abs() <= pd.Timedelta(seconds=60)]
    assert sorted((r["l_id"], r["r_id"]) for r in got.collect()) == sorted(zip(wanted["l_id"], wanted["r_id"]))


def test_not_in_with_null_in_the_lookup_returns_nothing(spark):
    facts = spark.createDataFrame([(1, 2), (3, None)], "a int, b int")
    known = spark.createDataFrame([(1,), (None,)], "id int")
    assert joins.not_in_either(facts, known, "id", ["a", "b"]).count() == 0
    assert joins.not_in_either(facts, known.na.drop(), "id", ["a", "b"]).count() == 2
