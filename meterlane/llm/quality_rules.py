"""Quality rules: base counts of each text and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed to a fixed number of cells. Two multinomials over the cells
are counted from whole tables: the trusted target (documents labelled good, outside the
held-out fold) and the raw corpus. A document's score is the mean log ratio of its n-grams,
so length does not matter; it is kept if the score reaches the threshold. The threshold is
the middle between the mean scores of good and bad documents of the held-out fold, which
did not shape the target; without such documents it is 0.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.llm.words import ngrams, owners, portions, spans, text_bytes, windows, word_hashes, words_of
from meterlane.session import materialize

CELL_BITS = 16
FOLDS = 5
# Counts added to every cell, so that an unseen n-gram has a probability.
SMOOTHING = 1.0
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def in_held_out(id_column: str = "doc_id"):
    """Whether crc32 of the id as text is divisible by the number of folds; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept).

    One row per row of ``docs``; null texts have no words and fail the base rules, rows that
    repeat are judged each. Labels with a null id or quality are left out; of several
    labels for an id the worst counts. Without labels, the score is 0 for all.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    known = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")))
    ratio = log_ratio(rows, known.filter((F.col("quality") == 1) & ~in_held_out()).select("doc_id"))
    kind = dict(rows.dtypes)["doc_id"]
    scored = materialize(rows.mapInArrow(
        partial(_score, ratio=ratio), f"doc_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, score double"), "scores")
    held = scored.filter(in_held_out()).join(known, "doc_id")
    means = tuple(held.agg(*[F.avg(F.when(F.col("quality") == q, F.col("score"))) for q in (0, 1)]).first())
    threshold = 0.0 if None in means else (means[0] + means[1]) / 2
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.select("doc_id", *COUNTS, failed.alias("base_failed"),
                         (~failed & (F.col("score") >= threshold)).alias("kept"), "score")


def log_ratio(rows: DataFrame, target: DataFrame) -> np.ndarray:
    """log(target / raw) of each cell; as many numbers as there are cells, whatever the corpus."""
    # Labels grow with the corpus: they are merged at every size, never broadcast.
    good = target.withColumn("good", F.lit(True)).hint("merge")
    marked = rows.filter("doc_id IS NOT NULL").join(good, "doc_id", "left").select(
        "text", F.coalesce("good", F.lit(False)).alias("good"))
    unnamed = rows.filter("doc_id IS NULL").select("text", F.lit(False).alias("good"))
    counted = (marked.union(unnamed).mapInArrow(_count, "cell int, raw long, good long")
               .groupBy("cell").agg(F.sum("raw"), F.sum("good")).toPandas().to_numpy())
    raw, good = np.zeros(1 << CELL_BITS), np.zeros(1 << CELL_BITS)
    if len(counted):
        raw[counted[:, 0]], good[counted[:, 0]] = counted[:, 1], counted[:, 2]
    if not good.any():
        return np.zeros(1 << CELL_BITS, np.float32)
    raw, good = raw + SMOOTHING, good + SMOOTHING
    return (np.log(good / good.sum()) - np.log(raw / raw.sum())).astype(np.float32)


def _features(words) -> tuple[np.ndarray, np.ndarray]:
    """(cell, text) of all words and word pairs."""
    pairs, owner = ngrams(words, 2)
    both = np.concatenate([words.hashes, pairs])
    return (both >> np.uint64(64 - CELL_BITS)).astype(np.int64), np.concatenate([owners(words.first), owner])


def _count(batches):
    """Cells that this task has seen, with their counts: one row per cell at most."""
    raw, good = np.zeros(1 << CELL_BITS, np.int64), np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        for part in portions(batch, "text"):
            cells, owner = _features(words_of(part.column("text"), lower=True))
            chosen = np.asarray(part.column("good").to_numpy(zero_copy_only=False), bool)
            raw += np.bincount(cells, minlength=1 << CELL_BITS)
            good += np.bincount(cells[chosen[owner]], minlength=1 << CELL_BITS)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(raw[seen]), pa.array(good[seen])],
                                     ["cell", "raw", "good"])


def _score(batches, ratio: np.ndarray):
    for batch in batches:
        for part in portions(batch, "text"):
            texts = part.column("text")
            cells, owner = _features(words_of(texts, lower=True))
            total = np.bincount(owner, ratio[cells].astype(np.float64), part.num_rows)
            counts = np.bincount(owner, minlength=part.num_rows)
            columns = base_counts(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(columns[c].astype(np.int64)) for c in COUNTS],
                 pa.array(total / np.maximum(counts, 1))], ["doc_id", *COUNTS, "score"])


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text of a portion."""
    data, offsets = text_bytes(texts)
    starts, ends, first = spans(data, offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    in_word = np.cumsum(inside[:-1]).astype(bool)
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    words = words_of(texts)
    return {"n_words": np.diff(first), "word_chars": per_text(in_word & ((data & 0xC0) != 0x80)),
            "n_symbols": per_text(_IS_SYMBOL[data]), "n_dup_lines": _repeated_lines(data, offsets, in_word),
            "n_repeat_words": _repeated_words(words)}


def _repeats(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of values that the same owner has again or had before, and of those it had before."""
    order = np.lexsort((np.arange(len(values)), values, owner))
    v, o = values[order], owner[order]
    same = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
    some, later = np.zeros(len(v), bool), np.zeros(len(v), bool)
    some[order[1:][same]] = True
    some[order[:-1][same]] = True
    later[order[1:][same]] = True
    return some, later


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> np.ndarray:
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offsets[1:]]))
    filled = np.concatenate([[0], np.cumsum(in_word)])
    some = filled[end] > filled[begin]
    begin, end = begin[some], end[some]
    owner = np.searchsorted(offsets, begin, "right") - 1
    hashes = word_hashes(data, begin, end) if len(begin) else np.zeros(0, np.uint64)
    return np.bincount(owner[_repeats(hashes, owner)[1]], minlength=len(offsets) - 1)


def _repeated_words(words, n: int = 5) -> np.ndarray:
    grams, at, owner = windows(words, n)
    found = at[_repeats(grams, owner)[0]]
    covered = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(covered, found, 1)
    np.add.at(covered, found + n, -1)
    hit = np.cumsum(covered[:-1]) > 0
    return np.diff(np.concatenate([[0], np.cumsum(hit)])[words.first])
