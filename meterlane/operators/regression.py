"""Linear regression on trip features: feature table, training, scores, explanations."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, OneHotEncoderModel, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlane.functions.numbers import mean
from meterlane.operators.ordered import percentiles

# Fixed values of the search: the range of l1, the choices of l2, how many trials, and how many at a time.
L1_RANGE = (0.0, 20.0)
L2_CHOICES = (0.0, 0.1, 1.0, 10.0)
SEARCH_TRIALS = 5
SEARCH_PARALLELISM = 2
# Ends the names of number columns whose gaps are filled.
FILLED = "__filled"
# Stands between a category column and its one-hot position.
HOT = "__hot"


def search_points(trials: int = SEARCH_TRIALS, seed: int = 7) -> tuple[tuple[float, float], ...]:
    """(l1, l2) of each trial, drawn from the search space; the same for the same seed."""
    draw = random.Random(seed)
    return tuple((draw.uniform(*L1_RANGE), draw.choice(L2_CHOICES)) for _ in range(trials))


SEARCH_POINTS = search_points()


def penalty(l1: float, l2: float) -> tuple[float, float]:
    """The two penalties as (regParam, elasticNetParam): their sum and the share of l1."""
    both = l1 + l2
    return both, l1 / both if both else 0.0


def feature_table(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                  label: str, nonzero: str) -> DataFrame:
    """Typed feature columns; ids become text so they count as categories.

    Rows need a label and a value other than zero in ``nonzero``; a label of zero is one.
    """
    return df.filter(F.col(label).isNotNull() & (F.col(nonzero) != 0)).select(
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *[F.col(c).cast("string").alias(c) for c in categorical],
        F.col(label).cast("double").alias("label"))


def split(df: DataFrame, train_share: float = 0.8, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the row, the same on every run."""
    bucket = F.pmod(F.xxhash64(*(columns or df.columns)), F.lit(1000))
    border = int(train_share * 1000)
    return df.filter(bucket < border), df.filter(bucket >= border)


def estimator(numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    """Every row counts: a missing number is the mean of the training rows, a missing or new category is one of its own."""
    filled = [f"{c}{FILLED}" for c in numeric]
    indexed = [f"{c}__index" for c in categorical]
    encoded = [f"{c}{HOT}" for c in categorical]
    stages = []
    if categorical:
        stages = [StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
                  OneHotEncoder(inputCols=indexed, outputCols=encoded)]
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=filled, strategy="mean"))
    return Pipeline(stages=[
        *stages,
        VectorAssembler(inputCols=[*filled, *encoded], outputCol="features", handleInvalid="error"),
        LinearRegression(featuresCol="features", labelCol="label")])


def train(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    return estimator(numeric, categorical).fit(df)


def training_summary(model: PipelineModel) -> tuple:
    """Iterations, RMSE, R2 and number of coefficients of the fitted regression."""
    fitted = model.stages[-1]
    return (fitted.summary.totalIterations, float(fitted.summary.rootMeanSquaredError),
            float(fitted.summary.r2), int(fitted.coefficients.size))


def search(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]):
    """Try the (l1, l2) pairs on one train/validation split; returns the fitted search."""
    pipeline = estimator(numeric, categorical)
    regression = pipeline.getStages()[-1]
    grid = [{regression.regParam: reg, regression.elasticNetParam: mix}
            for reg, mix in (penalty(l1, l2) for l1, l2 in SEARCH_POINTS)]
    return TrainValidationSplit(
        estimator=pipeline, estimatorParamMaps=grid, trainRatio=0.8, seed=7,
        evaluator=RegressionEvaluator(labelCol="label", metricName="rmse"),
        parallelism=SEARCH_PARALLELISM).fit(df)


def feature_info(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Per feature: extremes, mean, median, deviation, categories and nulls."""
    parts = [F.struct(
        F.lit(c).alias("input"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        F.round(mean(c), 6).alias("mean"), F.round(F.stddev_samp(c), 4).alias("stddev"),
        F.lit(None).cast("bigint").alias("category_count"),
        F.count_if(F.col(c).isNull()).alias("null_count")) for c in numeric]
    parts += [F.struct(
        F.lit(c).alias("input"), F.lit(None).cast("double").alias("min"),
        F.lit(None).cast("double").alias("max"), F.lit(None).cast("double").alias("mean"),
        F.lit(None).cast("double").alias("stddev"), F.count_distinct(c).alias("category_count"),
        F.count_if(F.col(c).isNull()).alias("null_count")) for c in categorical]
    stats = df.agg(F.array(*parts).alias("all")).select(F.inline("all"))
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("input"), F.col(c).cast("double").alias("v")) for c in numeric]))
        .alias("f")).select("f.input", "f.v")
    medians = percentiles(long, ["input"], "v", {"median": 0.5})
    return stats.join(medians, "input", "left")


def evaluate(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Error measures of predictions, as plain aggregates plus one exact median."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    log_error = F.log1p(F.greatest(y, F.lit(0.0))) - F.log1p(F.greatest(p, F.lit(0.0)))
    sums = df.agg(
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(error * error).alias("mean_squared_error"),
        F.avg(log_error * log_error).alias("mean_squared_log_error"),
        (F.lit(1.0) - F.sum(error * error) / (F.var_pop(y) * F.count(y))).alias("r2_score"),
        (F.lit(1.0) - F.var_pop(error) / F.var_pop(y)).alias("explained_variance"))
    medians = percentiles(df.select(F.abs(error).alias("e")), [], "e", {"median_absolute_error": 0.5})
    # Two one-row aggregates side by side.
    return sums.withColumn("median_absolute_error", medians.scalar())


def linear_prediction(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Prediction of a linear formula with given weights."""
    value = F.lit(float(intercept))
    for column, weight in weights.items():
        value = value + F.col(column).cast("double") * F.lit(float(weight))
    return value


def attributions(weights: Mapping[str, float], means: Mapping[str, float], k: int) -> Column:
    """The ``k`` features with the largest share in a linear prediction.

    A share is weight x (value - mean of the feature); ties are ordered by name.
    """
    parts = [F.struct(_strength(_share(c, w, means[c])).alias("rank"), F.lit(c).alias("feature"),
                      _share(c, w, means[c]).alias("attribution")) for c, w in weights.items()]
    first = F.slice(F.sort_array(F.array(*parts)), 1, k)
    return F.transform(first, lambda s: F.struct(s["feature"].alias("feature"),
                                                 s["attribution"].alias("attribution")))


def _strength(share: Column) -> Column:
    """Sorts the largest share first and a missing one last."""
    return F.coalesce(-F.abs(share), F.lit(0.0))


def _share(column: str, weight: float, mean_value: float) -> Column:
    return F.lit(float(weight)) * (F.col(column).cast("double") - F.lit(float(mean_value)))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def _inputs(model: PipelineModel) -> list[tuple[str, Column]]:
    """Each input of a fitted model with what it adds to the prediction, before any mean is taken off.

    A category has one weight per one-hot position; its index picks it. The last category, missing and new values, has none.
    """
    encoded = {hot: (index, size) for stage in model.stages if isinstance(stage, OneHotEncoderModel) for index, hot, size in
               zip(stage.getInputCols(), stage.getOutputCols(), stage.categorySizes)}
    assembler, fitted = model.stages[-2:]
    weights = [float(w) for w in fitted.coefficients.toArray()]
    out, at = [], 0
    for column in assembler.getInputCols():
        index, size = encoded.get(column, (None, 2))
        own, at = weights[at:at + size - 1], at + size - 1
        if index is None:
            out.append((column.removesuffix(FILLED), F.lit(own[0]) * F.col(column)))
        elif own:
            weight = F.get(F.array(*[F.lit(w) for w in own]), F.col(index).cast("int"))
            out.append((column.removesuffix(HOT), F.coalesce(weight, F.lit(0.0))))
    return out


def model_attributions(model: PipelineModel, df: DataFrame, k: int) -> DataFrame:
    """Predictions of a fitted model with the ``k`` inputs that moved each row's prediction most.

    A category's share is that of all its one-hot positions together, so that the shares of all
    inputs add up to the prediction less the one for mean features. Shares are plain columns, one per
    input, so the number of one-hot positions doesn't count for a row.
    """
    predicted = model.transform(df)
    inputs = _inputs(model)
    centre = predicted.agg(*[F.avg(part) for _, part in inputs]).first()
    parts = [(part - F.lit(mean_part)).alias(f"__share_{n}") for n, ((_, part), mean_part) in enumerate(zip(inputs, centre))]
    shared = predicted.select(*predicted.columns, *parts)
    shares = [F.struct(_strength(F.col(f"__share_{n}")).alias("rank"), F.struct(
        F.lit(name).alias("feature"), F.col(f"__share_{n}").alias("attribution")).alias("share")) for n, (name, _) in enumerate(inputs)]
    strongest = F.slice(F.sort_array(F.array(*shares)), 1, k)["share"]
    return shared.select(*predicted.columns, strongest.alias("top_attributions"))
