"""Layered model, regression, retrieval, paged source and the shape of plans."""

import numpy as np
import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from meterlane.functions.times import within
from meterlane.operators import regression, unions
from meterlane.plans import catalog, models
from meterlane.session import new_path
from meterlane.sinks import tables
from meterlane.sources.paged import PagedSource

TRIP = """order_key long, vendor_code int, pickup timestamp_ntz, dropoff timestamp_ntz, pickup_id int, dropoff_id int,
          passenger_count int, distance double, fare double, tip double, tax double, total double, payment_code int,
          extra double, tolls double, surcharge double"""


def trip(spark, *rows):
    from datetime import datetime

    full = [(key, 1, datetime(2024, 1, 5, 8), datetime(2024, 1, 5, 8, minute), zone, None, 1, 2.0, 10.0, 1.0, 0.5, 11.0, pay, 0.25, 6.5, 0.000004)
            for key, minute, zone, pay in rows]
    return spark.createDataFrame(full, TRIP)


def test_layers(spark):
    green = trip(spark, (1, 30, 4, 1), (2, 20, 4, 1)).withColumn("trip_type", F.lit(2)).withColumn("ehail_fee", F.lit(0.25))
    yellow = trip(spark, (3, 10, 4, None), (4, 10, 99, 5))
    zones = spark.createDataFrame([(4, "North", "City")], "location_id int, zone string, borough string")
    enriched = models.trips_enriched(models.trips_unioned(green, yellow), models.payment_types(spark))
    # The two green trips share their key; the one that ended first stays.
    kept = {r["order_key"]: (r["payment_type"], r["payment_type_description"], r["ehail_fee"]) for r in enriched.collect()}
    assert kept == {2: (1, "Credit card", 0.25), 3: (0, "Unknown", 0.0), 4: (5, "Unknown", 0.0)}
    mart = models.monthly_zone_revenue(models.fact_trips(enriched, zones))
    got = {(r["zone"], r["service_type"]): (r["total_monthly_trips"], r["revenue_monthly_total_amount"]) for r in mart.collect()}
    assert got == {("North", "Green"): (1, 11.0), ("North", "Yellow"): (1, 11.0), ("Unknown Zone", "Yellow"): (1, 11.0)}
    further = mart.select("revenue_monthly_extra", "revenue_monthly_tolls_amount", "revenue_monthly_improvement_surcharge")
    assert set(map(tuple, further.collect())) == {(0.25, 6.5, 0.000004)}


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([(2, 3.0)], "id int, b double")
    assert sorted(map(tuple, unions.stacked_loosely(a, b).collect()), key=str) == [(1, "x", None), (2, None, 3.0)]


@pytest.fixture(scope="module")
def line(spark):
    random = np.random.default_rng(1)
    rows = [(float(x), str(int(x) % 3), 4.0 * x + 10.0 * (int(x) % 3) + 1.0) for x in random.uniform(0, 50, 400).tolist()]
    return spark.createDataFrame(rows, "x double, c string, label double")


def test_regression_recovers_a_linear_rule(line):
    train, test = regression.split(line)
    assert train.count() + test.count() == 400 and test.count() > 40
    model = regression.train(train, ["x"], ["c"])
    scores = regression.evaluate(regression.predict(model, test), "label", "prediction").first()
    assert scores["mean_absolute_error"] < 1e-6 and scores["r2_score"] > 0.999
    explained = regression.model_attributions(model, test, 2).select(F.explode("top_attributions.feature")).distinct()
    assert "x" in {r[0] for r in explained.collect()}


def test_rows_with_gaps_are_predicted(spark, line):
    model = regression.train(line.unionByName(line.limit(20).withColumn("x", F.lit(None).cast("double"))), ["x"], ["c"])
    rows = spark.createDataFrame([(1, 3.0, "1"), (2, None, "1"), (3, 3.0, None), (4, None, None), (5, 3.0, "new")], "k int, x double, c string")
    got = {r["k"]: r["prediction"] for r in regression.predict(model, rows).collect()}
    mean = line.agg(F.avg("x")).first()[0]
    slope = (got[2] - got[1]) / (mean - 3.0)
    assert len(got) == 5 and got[3] == got[5] and got[4] - got[3] == pytest.approx(got[2] - got[1]) and 3.5 < slope < 4.5
    explained = regression.model_attributions(model, rows, 2)
    assert explained.count() == 5 and "x" in {r[0] for r in explained.select(F.explode("top_attributions.feature")).collect()}


def test_model_queries_cover_the_whole_table(spark):
    keys = lambda name: sorted(r[0] for r in catalog.QUERIES[name](spark, FOLDER).select("order_key").collect())
    catalog.load_all()
    want = keys("ml_feature_table")
    assert want and keys("ml_predict") == want and keys("ml_explain_model") == sorted(3 * want)


def test_attributions_are_per_input_and_add_up(line):
    model = regression.train(line, ["x"], ["c"])
    rows = regression.model_attributions(model, line, 9).select("x", "c", "prediction", "top_attributions").collect()
    assert all(sorted(s["feature"] for s in r["top_attributions"]) == ["c", "x"] for r in rows)
    # The shares explain the distance from one and the same base, and the order is by size.
    bases = [r["prediction"] - sum(s["attribution"] for s in r["top_attributions"]) for r in rows]
    assert max(bases) - min(bases) < 1e-6
    assert all(abs(r["top_attributions"][0][1]) >= abs(r["top_attributions"][1][1]) for r in rows)


def test_shares_are_measured_from_the_mean_row(spark, line):
    model = regression.train(line, ["x"], ["c"])
    rows = spark.createDataFrame([(x, c) for x in (3.0, 8.0, None) for c in ("0", "1", "2", None, "new")], "x double, c string")
    got = regression.model_attributions(model, rows, 9).select("x", "c", "prediction", "top_attributions").collect()
    shares = [{s["feature"]: s["attribution"] for s in r["top_attributions"]} for r in got]
    centre = np.mean([r["prediction"] for r in got])
    assert [sum(s.values()) for s in shares] == pytest.approx([r["prediction"] - centre for r in got])
    for name in ("x", "c"):
        assert sum(s[name] for s in shares) == pytest.approx(0, abs=1e-6)
        assert len({round(s[name], 6) for s in shares}) == {"x": 3, "c": 4}[name]


def test_shares_are_ranked_once_and_without_work_per_position(spark):
    catalog.load_all()
    plan = catalog.QUERIES["ml_explain_model"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(") == 1 and "lambda" not in plan


def test_search_space():
    points = regression.search_points(200)
    assert points == regression.search_points(200) and {l2 for _, l2 in points} == set(regression.L2_CHOICES)
    assert all(0 <= l1 <= 20 for l1, _ in points) and len(regression.SEARCH_POINTS) == 5
    assert regression.penalty(0.0, 0.0) == (0.0, 0.0) and regression.penalty(3.0, 1.0) == (4.0, 0.75)


def test_search_tries_every_point(line):
    found = regression.search(line, ["x"], ["c"])
    assert len(found.validationMetrics) == len(regression.SEARCH_POINTS)


def test_evaluation_against_numpy(spark):
    y, p = np.array([1.0, 2.0, 4.0, 8.0]), np.array([1.5, 1.0, 4.0, 10.0])
    frame = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double")
    got = regression.evaluate(frame, "y", "p").first()
    assert got["mean_absolute_error"] == pytest.approx(np.abs(y - p).mean())
    assert got["median_absolute_error"] == pytest.approx(np.median(np.abs(y - p)))
    assert got["mean_squared_log_error"] == pytest.approx(((np.log1p(y) - np.log1p(p)) ** 2).mean())
    assert got["r2_score"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["explained_variance"] == pytest.approx(1 - (y - p).var() / y.var())


@pytest.mark.parametrize("pages, readers", [(0, 3), (1, 4), (7, 3)])
def test_paged_source_reads_until_the_empty_page(spark, pages, readers):
    root = new_path(spark, "pages")
    rows = spark.range(pages * 10).select("id", (F.floor(F.col("id") / 10) + 1).cast("int").alias("page"))
    tables.rebalanced(rows, "page").write.partitionBy("page").json(root)
    spark.dataSource.register(PagedSource)
    read = spark.read.format("pages").schema("id long").option("readers", readers).load(root)
    assert sorted(r["id"] for r in read.collect()) == list(range(pages * 10))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_date_ranges_and_columns_reach_the_scan(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(lines.filter(within("l_shipdate", "1997-01-01", "1998-01-01")).select("l_orderkey"))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_partition_filter_prunes(spark):
    path = new_path(spark, "prune")
    tables.write_partitioned(spark.range(100).select("id", (F.col("id") % 5).cast("int").alias("p")), path, ["p"], ["id"])
    assert "PartitionFilters: [isnotnull(p" in plan(spark.read.parquet(path).filter("p = 3"))


def test_bucketed_tables_join_without_a_shuffle(spark):
    names = []
    for _ in range(2):
        names.append("j_" + new_path(spark, "b").rsplit("-", 1)[1])
        tables.create_bucketed(spark.range(1000).toDF("k"), names[-1], new_path(spark, "b"), "k", 4)
    joined = spark.table(names[0]).join(spark.table(names[1]).hint("merge"), "k")
    assert "Exchange" not in plan(joined) and joined.count() == 1000
