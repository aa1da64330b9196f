"""Regression and vector retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.functions.numbers import half_up, mean
from meterlane.operators import regression, similarity
from meterlane.plans import sqltext
from meterlane.plans.catalog import query
from meterlane.plans.sqltext import TRIPS
from meterlane.plans.stand_ins import Data
from meterlane.session import materialize

NUMERIC = ["passenger_count", "distance", "fare", "tolls"]
CATEGORICAL = ["pickup_id", "dropoff_id", "payment_type"]


def features(data: Data):
    """All trips with a fare; an unknown zone is a category of its own."""
    trips = data.trips(*NUMERIC, *CATEGORICAL, "tip", "order_key")
    return regression.feature_table(trips, [*NUMERIC, "order_key"], CATEGORICAL, "tip", nonzero="fare")


FEATURES = f"""{TRIPS}, f AS (SELECT CAST(passenger_count AS DOUBLE) AS passenger_count, distance,
 CAST(fare AS DOUBLE) AS fare, CAST(tolls AS DOUBLE) AS tolls, CAST(order_key AS DOUBLE) AS order_key,
 CAST(pickup_id AS VARCHAR) AS pickup_id, CAST(dropoff_id AS VARCHAR) AS dropoff_id,
 payment_type, CAST(tip AS DOUBLE) AS label FROM trips WHERE tip IS NOT NULL AND fare <> 0)"""


@query("ml_feature_table", f"{FEATURES} SELECT * FROM f")
def ml_feature_table(data: Data):
    return features(data)


def fitted(data: Data):
    """The model of the training share, and all rows; they are stored because training reads them often."""
    rows = materialize(features(data), "features")
    train, _ = regression.split(rows)
    return regression.train(train, NUMERIC, CATEGORICAL), rows


@query("ml_train_summary")
def ml_train_summary(data: Data):
    model, _ = fitted(data)
    return data.spark.createDataFrame([regression.training_summary(model)],
                                      "iterations int, rmse double, r2 double, coefficients int")


def info_sql(column: str, numeric: bool) -> str:
    if numeric:
        return f"""SELECT '{column}' AS input, CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max,
 round(AVG({column}), 6) AS mean, round(stddev_samp({column}), 4) AS stddev, NULL::BIGINT AS category_count,
 count(*) FILTER ({column} IS NULL) AS null_count, round(quantile_cont({column}, 0.5), 6) AS median FROM f"""
    return f"""SELECT '{column}', NULL, NULL, NULL, NULL, count(DISTINCT {column}),
 count(*) FILTER ({column} IS NULL), NULL FROM f"""


@query("ml_feature_info", FEATURES + " " + " UNION ALL ".join(
    [info_sql(c, True) for c in NUMERIC] + [info_sql(c, False) for c in CATEGORICAL]))
def ml_feature_info(data: Data):
    rows = materialize(features(data), "features")
    return regression.feature_info(rows, NUMERIC, CATEGORICAL).withColumn("median", F.round("median", 6))


# A fixed formula instead of a fitted model makes the scores comparable.
WEIGHTS = {"fare": 0.05, "distance": 1.5, "passenger_count": -2.0}


@query("ml_evaluate", f"""{FEATURES}, p AS (SELECT label AS y, 10.0::DOUBLE + fare * 0.05::DOUBLE + distance * 1.5::DOUBLE
 + passenger_count * -2.0::DOUBLE AS p FROM f)
 SELECT round(avg(abs(y - p)), 4) AS mean_absolute_error, round(avg((y - p) * (y - p)), 2) AS mean_squared_error,
 round(avg(pow(ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0)), 2)), 6) AS mean_squared_log_error,
 round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2_score,
 round(1 - var_pop(y - p) / var_pop(y), 6) AS explained_variance,
 round(quantile_cont(abs(y - p), 0.5), 4) AS median_absolute_error FROM p""")
def ml_evaluate(data: Data):
    predicted = features(data).withColumn("predicted", regression.linear_prediction(WEIGHTS, 10.0))
    scores = regression.evaluate(materialize(predicted.select("label", "predicted"), "predictions"),
                                 "label", "predicted")
    digits = {"mean_absolute_error": 4, "mean_squared_error": 2, "median_absolute_error": 4}
    return scores.select(*[F.round(c, digits.get(c, 6)).alias(c) for c in scores.columns])


@query("ml_predict")
def ml_predict(data: Data):
    model, rows = fitted(data)
    return regression.predict(model, rows).select("order_key", "label", F.round("prediction", 6).alias("prediction"))


@query("ml_explain_model")
def ml_explain_model(data: Data):
    model, rows = fitted(data)
    explained = regression.model_attributions(model, rows, 3).withColumn("prediction", F.round("prediction", 6))
    # No list is empty; for the plain form Spark adds a filter on their size, which ranks all shares a second time.
    return explained.select("order_key", "prediction", F.posexplode_outer("top_attributions").alias("place", "share")).select(
        "order_key", "prediction", "place", "share.feature", F.round("share.attribution", 6).alias("attribution"))


SHARES = """SELECT *, unnest([{'r': -abs(s1), 'feature': 'fare', 'a': s1}, {'r': -abs(s2), 'feature': 'distance', 'a': s2},
 {'r': -abs(s3), 'feature': 'passenger_count', 'a': s3}]) AS s"""


@query("ml_explain_topk", f"""{FEATURES}, m AS (SELECT {sqltext.mean('fare')} AS mf,
 {sqltext.mean('distance')} AS md, {sqltext.mean('passenger_count')} AS mp FROM f),
 w AS (SELECT order_key, passenger_count, distance, fare, row_number() OVER () AS rid,
 0.05::DOUBLE * (fare - mf) AS s1, 1.5::DOUBLE * (distance - md) AS s2, -2.0::DOUBLE * (passenger_count - mp) AS s3 FROM f, m),
 u AS ({SHARES} FROM w), r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY s.r, s.feature) AS place FROM u)
 SELECT order_key, fare, CAST(place - 1 AS INTEGER) AS place, s.feature AS feature, {sqltext.half_up('s.a', 4)} AS attribution
 FROM r WHERE place <= 2""")
def ml_explain_topk(data: Data):
    rows = materialize(features(data), "features")
    centre = rows.agg(*[half_up(mean(c), 4).alias(c) for c in WEIGHTS]).first().asDict()
    strongest = rows.withColumn("top", regression.attributions(WEIGHTS, centre, 2))
    return strongest.select("order_key", "fare", F.posexplode("top").alias("place", "share")).select(
        "order_key", "fare", "place", "share.feature", half_up(F.col("share.attribution"), 4).alias("attribution"))


@query("ml_hparam_search")
def ml_hparam_search(data: Data):
    rows = materialize(features(data), "features")
    found = regression.search(rows, NUMERIC, CATEGORICAL)
    trials = [(i, l1, l2, float(rmse)) for i, ((l1, l2), rmse) in
              enumerate(zip(regression.SEARCH_POINTS, found.validationMetrics))]
    return data.spark.createDataFrame(trials, "trial int, l1 double, l2 double, rmse double")


# Similarities are ranked as they are and rounded in the result; equal vectors tie.
TOPK = """WITH q AS (SELECT label AS query_id, list(c ORDER BY pos) AS centre FROM (SELECT label, pos, avg(v) AS c FROM
 (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1),
 s AS (SELECT query_id, vec_id, list_cosine_similarity(embedding::DOUBLE[], centre) AS similarity FROM embeddings, q)
 SELECT query_id, vec_id, round(similarity, 6) AS similarity FROM s
 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) <= 5"""


def label_centres(vectors: DataFrame) -> DataFrame:
    """One query per label: the mean of its vectors."""
    parts = vectors.select("label", F.posexplode("embedding").alias("pos", "v"))
    means = parts.groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("c"))
    # One entry per dimension: the length of a vector bounds the list.
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "c")))["c"].alias("centre"))


@query("vector_topk", TOPK)
def vector_topk(data: Data):
    vectors = data.table("embeddings")
    found = similarity.nearest(vectors, "vec_id", "embedding", label_centres(vectors), "query_id", "centre", 5)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("vector_topk_lists", TOPK)
def vector_topk_lists(data: Data):
    # The same through inverted lists: only lists are read that may hold one of the five nearest.
    vectors = data.table("embeddings")
    lists = similarity.index(vectors, "vec_id", "embedding")
    found = similarity.search(lists, label_centres(vectors), "query_id", "centre", 5)
    return found.withColumn("similarity", F.round("similarity", 6))
