"""Nearest vectors by cosine similarity: in blocks, or through inverted lists.

Rows and queries meet in blocks of bounded size, one matrix product each. A list of rows is dealt over as many
blocks as its size asks for, and so are the queries that look into it, so neither a hot list nor a great number
of queries ends in one task, and nothing but the centres of an index passes through the driver.

Vectors that are null, empty, hold a null or have no length are like nothing: they are in no list, never found, and
as queries find nothing. A vector of another length than the index's raises an error. Equal vectors have
equal similarities, and ties go to the lower id; a row given twice can be found twice.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.operators.cleaning import first_per_key
from meterlane.session import materialize

# Workers get the functions below with the job and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 8192, 1024
# Centres are fitted on at most this many rows, chosen by a hash of the id; all rows are put into lists.
SAMPLE_ROWS, ROWS_PER_CENTRE = 20_000, 20
# Products of unit vectors are nearer to the truth than this, whatever the order of addition.
SLACK = 1e-9
# The same for angles, whose errors are largest near 0: the root of the slack, doubled.
ANGLE_SLACK = 1e-4


class Index(NamedTuple):
    """All rows of a corpus with their list, and per list its centre and its widest angle (``centres`` is bounded
    by the fitting sample: a matrix with a row per list, and the angles)."""

    rows: DataFrame
    vec_id: str
    centres: np.ndarray
    widest: np.ndarray


def unit(vector: Column) -> Column:
    """The vector in doubles, at length 1; null if it has none."""
    doubles = vector.cast("array<double>")
    length = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda s, x: s + x * x))
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x)) & (length > 0) & (length < float("inf"))
    return F.when(usable, F.transform(doubles, lambda x: x / length))


def nearest(corpus: DataFrame, vec_id: str, vector: str, queries: DataFrame, query_id: str,
            query_vector: str, k: int) -> DataFrame:
    """The ``k`` most similar vectors of the whole corpus for each query, every pair scored: one list for all,
    one scan of the corpus for any number of queries."""
    rows = _numbered(corpus.select(F.col(vec_id).alias("__id"), unit(F.col(vector)).alias("__v"), F.lit(0).alias("__list"))
                     .filter("__v IS NOT NULL"))
    asked = _numbered(_asked(queries, query_id, query_vector).withColumn("__list", F.lit(0)))
    return _named(_best(_scored(rows, asked, k), k), query_id, vec_id)


def index(corpus: DataFrame, vec_id: str, vector: str, lists: int | None = None) -> Index:
    """Inverted lists over a corpus: centres from a bounded sample, then each row to the centre nearest to it.

    ``lists`` defaults to the root of the number of rows, at most ``SAMPLE_ROWS / ROWS_PER_CENTRE``.
    """
    vectors = materialize(corpus.select(F.col(vec_id).alias("__id"), unit(F.col(vector)).alias("__v"))
                          .filter("__v IS NOT NULL"), "vectors")
    sample = materialize(vectors.orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE_ROWS)
                         .select(array_to_vector("__v").alias("features")), "sample")
    lists = lists or round(vectors.count() ** 0.5)
    lists = max(1, min(lists, SAMPLE_ROWS // ROWS_PER_CENTRE))
    if sample.isEmpty():
        centres = np.zeros((0, 0))
    elif lists == 1:
        centres = np.array([vectors.first()["__v"]])
    else:
        centres = np.array(KMeans(k=lists, seed=1, maxIter=10).fit(sample).clusterCenters())
        length = np.linalg.norm(centres, axis=1, keepdims=True)
        centres = (centres / np.where(length > 0, length, 1))[length[:, 0] > 0]
        if not len(centres):
            centres = np.array([vectors.first()["__v"]])

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                angles = _angles(np.stack(batch["__v"]), centres)
                batch["__list"] = angles.argmin(axis=1).astype("int32")
                batch["__angle"] = angles.min(axis=1)
                yield batch

    schema = T.StructType(list(vectors.schema.fields)).add("__list", T.IntegerType()).add("__angle", T.DoubleType())
    rows = _numbered(vectors.mapInPandas(listed, schema))
    widest = np.full(len(centres), -np.inf)
    for r in rows.groupBy("__list").agg(F.max("__angle").alias("a")).collect():  # a row per list
        widest[r["__list"]] = r["a"]
    return Index(rows.drop("__angle"), vec_id, centres, widest)


def search(at: Index, queries: DataFrame, query_id: str, query_vector: str, k: int, probes: int = 8,
           exact: bool = True) -> DataFrame:
    """The ``k`` most similar rows of an index for each query.

    First the ``probes`` lists with the nearest centres are searched. With ``exact`` all lists follow that may
    hold a better row than the k-th found: a row of a list is no nearer to the query than the centre's angle
    less the widest angle of the list. Without, rows of lists that were not probed are missed.
    """
    asked = materialize(_asked(queries, query_id, query_vector), "asked")
    near = _numbered(_looking(asked.withColumn("__worst", F.lit(np.pi)), at, 0, probes))
    found = _scored(at.rows, near, k)
    if exact and probes < len(at.centres):
        found = materialize(_best(found, k), "found")
        worst = found.groupBy("__query").agg(F.when(F.count(F.lit(1)) >= k, F.acos(F.least(F.min("similarity"), F.lit(1.0))))
                                             .alias("__kth"))
        bounded = (asked.join(worst.withColumnRenamed("__query", "__q"), F.col("__query").eqNullSafe(F.col("__q")), "left")
                   .select("__query", "__v", F.coalesce("__kth", F.lit(np.pi)).alias("__worst")))
        rest = _numbered(_looking(bounded, at, probes, len(at.centres)))
        found = found.unionByName(_scored(at.rows, rest, k))
    return _named(_best(found, k), query_id, at.vec_id)


def _asked(queries: DataFrame, query_id: str, query_vector: str) -> DataFrame:
    return (queries.select(F.col(query_id).alias("__query"), unit(F.col(query_vector)).alias("__v"))
            .filter("__v IS NOT NULL"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number that decides their block; written, so that it stays the same when a task is re-run."""
    return materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def _angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ centres.T, -1, 1))


def _looking(asked: DataFrame, at: Index, first: int, last: int) -> DataFrame:
    """Each query with the lists from the ``first`` to the ``last`` nearest one that may hold something better than its worst row."""
    centres, widest = at.centres, at.widest

    def lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch) or not len(centres):
                continue
            angles = _angles(np.stack(batch["__v"]), centres)
            order = np.argsort(angles, axis=1, kind="stable")[:, first:last]
            least = np.take_along_axis(angles - widest, order, axis=1)
            kept = least <= batch["__worst"].to_numpy()[:, None] + ANGLE_SLACK
            which, place = np.nonzero(kept)
            out = batch.iloc[which][["__query", "__v"]].copy()
            out["__list"] = order[which, place].astype("int32")
            yield out

    schema = T.StructType([asked.schema["__query"], asked.schema["__v"]]).add("__list", T.IntegerType())
    return asked.mapInPandas(lists, schema)


def _scored(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each query in each block of its lists."""
    def sizes(frame: DataFrame, most: int, name: str) -> DataFrame:
        return frame.groupBy("__list").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))

    # A row per list: what is looked into, and in how many blocks.
    blocks = materialize(sizes(asked, QUERIES_PER_BLOCK, "__qs").join(sizes(rows, ROWS_PER_BLOCK, "__rs"), "__list"), "blocks")

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.col("__row"), F.col(f"__{own}s")).cast("int")
        return (frame.join(blocks, "__list").withColumn(f"__{own}", mine)
                .withColumn(f"__{other}", F.explode(F.sequence(F.lit(0), F.col(f"__{other}s") - 1)))
                .drop("__qs", "__rs", "__row"))

    keys = ["__list", "__q", "__r"]
    left = dealt(asked.select("__query", "__v", "__list", "__row"), "q", "r")
    right = dealt(rows.select("__id", "__v", "__list", "__row"), "r", "q")
    schema = T.StructType([asked.schema["__query"], rows.schema["__id"]]).add("similarity", T.DoubleType())

    def block(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(members):
            return pd.DataFrame({"__query": [], "__id": [], "similarity": []})
        a, b = np.stack(queries["__v"]), np.stack(members["__v"])
        ids = members["__id"].to_numpy()
        places, scores = [], []
        products = a @ b.T
        for i, line in enumerate(products):
            kth = np.partition(line, -k)[-k] if k < len(line) else -np.inf
            near = np.flatnonzero(line >= kth - SLACK)
            # Added up in one order everywhere, so that equal vectors tie in all blocks.
            sure = (b[near] * a[i]).sum(axis=1)
            best = sorted(zip(-sure, ids[near], near))[:k]
            places += [(i, n) for _, _, n in best]
            scores += [-s for s, _, _ in best]
        which = np.array(places).reshape(-1, 2)
        return pd.DataFrame({"__query": queries["__query"].to_numpy()[which[:, 0]], "__id": ids[which[:, 1]],
                             "similarity": scores})

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(block, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    return first_per_key(found, ["__query"], [F.col("similarity").desc(), F.col("__id")], k)


def _named(found: DataFrame, query_id: str, vec_id: str) -> DataFrame:
    return found.select(F.col("__query").alias(query_id), F.col("__id").alias(vec_id), "similarity")
