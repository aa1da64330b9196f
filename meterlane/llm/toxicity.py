"""Toxicity classifier whose scores do not hang on which group a text mentions.

A logistic model over hashed words and word beginnings (stems tell in languages that build
long words). Each labelled text is also read with its
identity terms swapped for their counterparts; the squared difference of the two scores is
a penalty, so a term that only names a group gets no weight of its own.
"""

from __future__ import annotations

from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlane.llm.quality_rules import in_held_out
from meterlane.llm.words import LETTERS, hash_of, owners, portions, spans, text_bytes, word_hashes
from meterlane.session import materialize

CELL_BITS = 18
# The model is fitted on at most so many labelled documents, chosen by a hash of their id.
TRAINING_DOCS = 20_000
# Cells that tell the classes apart: rows they must occur in, least z value, and how many.
LEAST_DOCS, LEAST_Z, FEATURES = 4, 5.0, 4096
# Lengths of word beginnings, in bytes.
PREFIXES = (5, 6, 7)
PENALTY, RIDGE = 1.0, 3e-4
# Newton steps, and steps of conjugate gradients inside each, at most.
NEWTON_STEPS, INNER_STEPS = 60, 200
# A missed toxic document counts as much as this many clean ones that are rejected.
TOXIC_WEIGHT = 3.0

# Identity terms and their counterparts, swapped both ways.
IDENTITY_PAIRS = (
    ("he", "she"), ("him", "her"), ("his", "hers"), ("himself", "herself"), ("man", "woman"), ("men", "women"),
    ("boy", "girl"), ("boys", "girls"), ("male", "female"), ("father", "mother"), ("son", "daughter"), ("husband", "wife"),
    ("gay", "straight"), ("lesbian", "heterosexual"), ("homosexual", "bisexual"), ("transgender", "cisgender"),
    ("black", "white"), ("african", "european"), ("asian", "american"), ("arab", "latino"), ("mexican", "canadian"),
    ("muslim", "christian"), ("muslims", "christians"), ("jewish", "catholic"), ("jews", "catholics"), ("hindu", "buddhist"),
    ("islam", "christianity"), ("immigrant", "citizen"), ("immigrants", "citizens"), ("refugee", "resident"),
    ("old", "young"), ("elderly", "teenage"), ("disabled", "able"), ("blind", "sighted"), ("deaf", "hearing"),
    ("hombre", "mujer"), ("hombres", "mujeres"), ("homme", "femme"), ("hommes", "femmes"), ("mann", "frau"), ("männer", "frauen"),
    ("musulmán", "cristiano"), ("musulman", "chrétien"), ("judío", "católico"), ("juif", "catholique"),
    ("schwarz", "weiß"), ("noir", "blanc"), ("negro", "blanco"),
)


class Model(NamedTuple):
    """Weights by cell and the constant."""

    weights: np.ndarray
    constant: float


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCS, penalty: float = PENALTY) -> Model:
    """Fit on labelled documents outside the held-out fold.

    Labels with a null id or class are left out; of several for an id the toxic one counts. Null and
    empty texts are documents without words; rows that repeat count each. Identity terms are always among the
    features, so that the penalty holds for all of them. Without a document of each class, every
    score is the share of toxic labels, or 0; without words that tell the classes apart, it is the constant's.
    """
    chosen = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~in_held_out())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    # Bounded by ``most`` rows, so it may be broadcast.
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
            .select("toxic", "text").mapInArrow(_examples, "toxic int, cells array<int>, swapped array<int>"))
    examples = materialize(rows, "toxic-examples")
    per_cell = (examples.select("toxic", F.explode("cells").alias("cell")).groupBy("cell")
                .agg(F.sum("toxic").alias("bad"), F.count("*").alias("docs")).filter(F.col("docs") >= LEAST_DOCS).toPandas())
    count, bad = examples.agg(F.count("*"), F.sum("toxic")).first()
    share = (bad or 0) / max(count, 1)
    weights = np.zeros(1 << CELL_BITS, np.float32)
    if not 0 < share < 1:
        return Model(weights, 20.0 if share else -20.0)
    expected = per_cell["docs"] * share
    z = (per_cell["bad"] - expected) / np.sqrt(expected * (1 - share))
    table = per_cell.assign(z=z.abs())
    table = table[table.z >= LEAST_Z].sort_values(["z", "cell"], ascending=[False, True]).head(FEATURES)
    identity = (_swap_table()[:, 0] >> np.uint64(64 - CELL_BITS)).astype(np.int64)
    features = np.union1d(table["cell"].to_numpy().astype(np.int64), identity)
    picked = F.array(*[F.lit(int(c)) for c in features])
    kept = examples.select("toxic", F.array_intersect("cells", picked).alias("a"),
                           F.array_intersect("swapped", picked).alias("b")).toPandas()
    found, constant = _fit(kept, features, penalty)
    weights[features] = found
    return Model(weights, constant)


def score_column(model: Model, text: str = "text") -> Column:
    """Score of a text column, 0 to 1; null and empty texts get the constant's score."""
    cells = np.flatnonzero(model.weights)
    scorer = partial(_scores, cells=cells, weights=model.weights[cells], constant=model.constant)

    def score(texts: pa.Array) -> pa.Array:
        return scorer(texts)

    return F.arrow_udf(score, "double")(F.col(text).cast("string"))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; rows that repeat are scored each."""
    rows = docs.select(F.col(id_column).alias("doc_id"), score_column(model, text_column).alias("score"))
    return rows.select("doc_id", in_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _swap_table() -> np.ndarray:
    pairs = [(hash_of(a), hash_of(b)) for a, b in IDENTITY_PAIRS]
    return np.array(sorted(pairs + [(b, a) for a, b in pairs]), np.uint64)


def _read(texts: pa.Array, swaps: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, text) of all words and beginnings, and (cell, text) once more with identity terms
    swapped; a swapped term is read without its beginnings, as its counterpart's are not at hand."""
    data, offsets = text_bytes(texts)
    data = LETTERS[data]
    starts, ends, first = spans(data, offsets)
    hashes = word_hashes(data, starts, ends, *PREFIXES)
    owner = np.tile(owners(first), len(hashes))
    if swaps is not None:
        at = np.minimum(np.searchsorted(swaps[:, 0], hashes[0]), len(swaps) - 1)
        named = swaps[at, 0] == hashes[0]
        hashes[1:, named] = 0
        other = hashes.copy()
        other[0] = np.where(named, swaps[at, 1], hashes[0])
    else:
        other = hashes
    cells = [np.where(h == 0, -1, (h >> np.uint64(64 - CELL_BITS)).astype(np.int32)).ravel() for h in (hashes, other)]
    return *cells, owner


def _sets(cells: np.ndarray, owner: np.ndarray, texts: int) -> list[np.ndarray]:
    order = np.argsort(owner, kind="stable")
    cells, bounds = cells[order], np.searchsorted(owner[order], np.arange(texts + 1))
    return [np.unique(part[part >= 0]) for part in (cells[a:b] for a, b in zip(bounds[:-1], bounds[1:]))]


def _examples(batches):
    swaps = _swap_table()
    for batch in batches:
        for part in portions(batch, "text"):
            cells, other, owner = _read(part.column("text"), swaps)
            plain = _sets(cells, owner, part.num_rows)
            changed = plain if (cells == other).all() else _sets(other, owner, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), pa.array(plain, pa.list_(pa.int32())), pa.array(changed, pa.list_(pa.int32()))],
                ["toxic", "cells", "swapped"])


def _scores(texts: pa.Array, cells: np.ndarray, weights: np.ndarray, constant: float) -> pa.Array:
    out = []
    # Read as for training: identity terms have no beginnings, so no weight of another word's falls on them.
    swaps = _swap_table()
    for part in portions(pa.record_batch([texts.fill_null("")], ["text"]), "text"):
        found, _, owner = _read(part.column("text"), swaps)
        total = np.zeros(part.num_rows)
        if len(cells):
            at = np.minimum(np.searchsorted(cells, found), len(cells) - 1)
            hit = cells[at] == found
            once = np.unique(owner[hit].astype(np.int64) * len(cells) + at[hit])
            total = np.bincount(once // len(cells), weights[once % len(cells)], part.num_rows)
        out.append(1 / (1 + np.exp(-np.clip(total + constant, -30, 30))))
    return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())


def _fit(rows, features: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and constant that minimise log loss, ridge and the counterfactual penalty.

    The sum is convex. Newton steps, each solved by conjugate gradients on the sparse rows, are
    shortened until it falls, so the fit ends at its minimum for any corpus.
    """
    def sparse(lists):
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate([np.asarray(x, np.int64) for x in lists]) if sizes.sum() else np.zeros(0, np.int64)
        return np.repeat(np.arange(len(sizes)), sizes), np.searchsorted(features, flat)

    y = rows["toxic"].to_numpy(np.float64)
    cost = np.where(y > 0, TOXIC_WEIGHT, 1.0) / len(y)
    n, k = len(y), len(features)
    (ra, ca), (rb, cb) = sparse(rows["a"]), sparse(rows["b"])
    # The last entry of a vector of weights is the constant, which no ridge holds down.
    ridge = np.append(np.full(k, RIDGE), 1e-9)
    read = lambda w: np.bincount(ra, w[ca], n) + w[k]
    gap = lambda w: np.bincount(ra, w[ca], n) - np.bincount(rb, w[cb], n)

    def back(error: np.ndarray, pull: np.ndarray) -> np.ndarray:
        plain = np.bincount(ca, (error + pull)[ra], k) - np.bincount(cb, pull[rb], k)
        return np.append(plain, error.sum())

    def loss(w: np.ndarray) -> float:
        a = read(w)
        return float((cost * np.logaddexp(0, np.where(y > 0, -a, a))).sum() + penalty * (gap(w) ** 2).mean() + (ridge * w * w).sum() / 2)

    w = np.append(np.zeros(k), np.log(y.mean() / (1 - y.mean())))
    now = loss(w)
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(read(w), -500, 500)))
        slope = back(cost * (p - y), 2 * penalty / n * gap(w)) + ridge * w
        curve = cost * p * (1 - p)
        step = _conjugate(lambda v: back(curve * read(v), 2 * penalty / n * gap(v)) + ridge * v, -slope)  # noqa: B023
        size = 1.0
        while (after := loss(w + size * step)) > now + 1e-4 * size * float(slope @ step) and size > 1e-9:
            size /= 2
        if not after < now - 1e-12:
            break
        w, now = w + size * step, after
    if not np.isfinite(w).all():
        raise ArithmeticError("the fit has no finite weights")
    return w[:k].astype(np.float32), float(w[k])


def _conjugate(times, right: np.ndarray) -> np.ndarray:
    """x with times(x) = right, for a symmetric positive map; stops early once it is near."""
    x, rest = np.zeros_like(right), right.copy()
    way, size = rest.copy(), float(rest @ rest)
    for _ in range(INNER_STEPS):
        if size <= 1e-16 * float(right @ right):
            break
        moved = times(way)
        pace = size / float(way @ moved)
        x, rest = x + pace * way, rest - pace * moved
        size, last = float(rest @ rest), size
        way = rest + size / last * way
    return x
