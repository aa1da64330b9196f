"""Nearest vectors against all products, in blocks and through lists."""

import numpy as np
import pytest

from meterlane.operators import similarity


def frame(spark, vectors, names="id int, v array<double>"):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)], names)


def wanted(corpus, asked, k):
    """Brute force; ties go to the lower id."""
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in (corpus, asked)]
    scores = [[float((row * q).sum()) for row in unit[0]] for q in unit[1]]
    return {q: sorted(range(len(corpus)), key=lambda i: (-line[i], i))[:k] for q, line in enumerate(scores)}


def got(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["q"], -r["similarity"], r["id"])):
        out.setdefault(r["q"], []).append(r["id"])
    return out


def clustered(seed, rows, dimensions=8, clusters=12):
    random = np.random.default_rng(seed)
    middles = random.normal(size=(clusters, dimensions)) * 3
    return middles[random.integers(0, clusters, rows)] + random.normal(size=(rows, dimensions))


@pytest.mark.parametrize("rows_per_block, queries_per_block", [(8192, 1024), (7, 4)])
def test_nearest_in_one_or_many_blocks(spark, monkeypatch, rows_per_block, queries_per_block):
    monkeypatch.setattr(similarity, "ROWS_PER_BLOCK", rows_per_block)
    monkeypatch.setattr(similarity, "QUERIES_PER_BLOCK", queries_per_block)
    random = np.random.default_rng(2)
    corpus, asked = random.normal(size=(60, 8)), random.normal(size=(9, 8))
    corpus[40:] = corpus[11]  # copies, more than k of them, in several blocks
    asked[8] = corpus[11]
    found = similarity.nearest(frame(spark, corpus), "id", "v", frame(spark, asked, "q int, qv array<double>"), "q", "qv", 3)
    assert got(found) == wanted(corpus, asked, 3)


def test_lists_find_exactly_what_all_products_find(spark, monkeypatch):
    monkeypatch.setattr(similarity, "ROWS_PER_BLOCK", 50)
    corpus = clustered(3, 900)
    corpus[300:600] = corpus[5]  # a third of all rows in one list
    asked = np.concatenate([clustered(4, 25), corpus[5:6]])
    at = similarity.index(frame(spark, corpus), "id", "v", lists=20)
    queries = frame(spark, asked, "q int, qv array<double>")
    assert at.rows.count() == 900
    assert got(similarity.search(at, queries, "q", "qv", 5, probes=2)) == wanted(corpus, asked, 5)


def test_recall_of_the_nearest_lists(spark):
    corpus, asked = clustered(5, 2000), clustered(6, 60)
    at = similarity.index(frame(spark, corpus), "id", "v")
    near = got(similarity.search(at, frame(spark, asked, "q int, qv array<double>"), "q", "qv", 5, probes=12, exact=False))
    right = wanted(corpus, asked, 5)
    assert sum(len(set(near[q]) & set(right[q])) for q in right) / (5 * len(right)) >= 0.9


def test_vectors_without_a_direction(spark):
    odd = frame(spark, [[1, 0], None, [], [0, 0], [float("nan"), 1], [0, 2], [1, 0]])
    queries = frame(spark, [[1, 0], None, [0, 0]], "q int, qv array<double>")
    assert got(similarity.nearest(odd, "id", "v", queries, "q", "qv", 9)) == {0: [0, 6, 5]}
    at = similarity.index(odd, "id", "v", lists=2)
    assert got(similarity.search(at, queries, "q", "qv", 9, probes=1)) == {0: [0, 6, 5]}
    nothing = similarity.index(odd.limit(0), "id", "v")
    assert similarity.search(nothing, queries, "q", "qv", 3).count() == 0
    assert similarity.nearest(odd.limit(0), "id", "v", queries, "q", "qv", 3).count() == 0
