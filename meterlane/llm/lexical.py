"""Ranked lexical search: dense tiles of query items times tiles of document impacts.

The items' own vocabulary, made compact, numbers the columns. A first pass over the documents
writes, for each one, which of these terms it holds and how often, with the document
frequencies added up in each task. In the second pass a tile of documents becomes a dense matrix of
impacts over the terms that occur in the tile, and a matrix product with the items' term
counts gives all scores at once. Everything is a whole number; vocabulary tiles end before a
partial sum could reach 2**53, so float64 holds each sum exactly, and tiles are added up as integers.

Tasks keep the best of each item, ties by id, so a task sends items x k rows however many
documents it read. Items are taken in blocks of a bounded size; the corpus is read once per block.
"""

from __future__ import annotations

import math
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlane.llm.words import owners, portions, spans, text_bytes, word_hashes
from meterlane.session import materialize

TOP = 20
# Items that a pass over the documents answers; their terms reach the driver and every task.
BLOCK_ITEMS = 500
# A tile holds so many terms and documents at most: 16 MB of impacts.
TILE_TERMS = 4096
TILE_DOCS = 512
# Whole numbers below this are exact in float64.
EXACT = 1 << 53
# The part of an impact that doesn't depend on the term is below this.
MOST_WEIGHTLESS = 1_000_000
# Candidates kept before an item's best are sorted out.
WAITING = 200_000

# Bytes of terms, in lower case; everything else is a blank.
_TERM = np.full(256, 0x20, np.uint8)
_TERM[0x80:] = np.arange(0x80, 0x100)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A)):
    _TERM[_first:_last + 1] = np.arange(_first, _last + 1)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)


class Items(NamedTuple):
    """The term counts of a block: item ``row[i]`` has term ``column[i]`` ``count[i]`` times.
    ``vocabulary`` holds the sorted hashes of the columns."""

    ids: list
    row: np.ndarray
    column: np.ndarray
    count: np.ndarray
    vocabulary: np.ndarray


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_column: str = "doc_id", text_column: str = "text",
           item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item, score above 0.

    Equal scores go by ascending doc_id, null ids last. Null and empty texts have no terms: such
    documents are never found and such items find nothing. Items that repeat with id and text
    count once; documents that repeat count and are listed each. An empty table gives no rows. Document ids are whole
    numbers. Terms are told apart by 64-bit hashes. An item may have up to 10**8 terms.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    asked = items.select(F.col(f"`{item_column}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    kind = dict(asked.dtypes)["item_id"]
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    counted = asked.distinct().mapInArrow(_item_terms, f"item_id {kind}, terms array<long>, counts array<long>")
    placed = materialize(counted.filter("size(terms) > 0").withColumn("draw", F.xxhash64("item_id", "terms", "counts")), "items")
    blocks = math.ceil(placed.count() / BLOCK_ITEMS)
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        chosen = placed.filter(F.pmod("draw", F.lit(blocks)) == block)
        found = found.unionByName(_block(rows, _items(chosen), top, kind).select(*found.columns))
    return found


def _block(rows: DataFrame, items: Items, top: int, kind: str) -> DataFrame:
    written = materialize(rows.mapInArrow(partial(_postings, vocabulary=items.vocabulary),
                                          "doc_id long, n long, terms array<int>, counts array<long>, documents long"), "postings")
    totals = written.filter("documents IS NOT NULL")
    documents, length = totals.agg(F.sum("documents"), F.sum("n")).first()
    # As many rows as the block has terms, at most.
    held = totals.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts")).collect()
    holding = np.zeros(len(items.vocabulary), np.int64)
    for term, n in held:
        holding[term] = n
    how = Scoring(items, weights(holding, documents or 0), documents or 0, length or 0, top)
    best = written.filter("documents IS NULL").mapInArrow(partial(_best, how=how), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    # At most BLOCK_ITEMS ids, give or take the hash.
    names = rows.sparkSession.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {kind}")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def weights(holding: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term; never below 0."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.int64)


def _items(chosen: DataFrame) -> Items:
    """The block's terms, on the driver: bounded by BLOCK_ITEMS items."""
    found = chosen.select("item_id", "terms", "counts").collect()
    sizes = [len(r.terms) for r in found]
    terms = np.fromiter((t for r in found for t in r.terms), np.int64, sum(sizes)).view(np.uint64)
    vocabulary, column = np.unique(terms, return_inverse=True)
    return Items([r.item_id for r in found], np.repeat(np.arange(len(found)), sizes), column,
                 np.fromiter((c for r in found for c in r.counts), np.int64, sum(sizes)), vocabulary)


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all terms of some texts, and the place of each text's first."""
    data, offsets = text_bytes(texts)
    data = _TERM[data]
    starts, ends, first = spans(data, offsets)
    return (word_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)), first


def _counted(column: np.ndarray, owner: np.ndarray, width: int, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct columns of each text, how often each is there, and the place of each text's first."""
    key, counts = np.unique(owner * max(width, 1) + column, return_counts=True)
    return key % max(width, 1), counts, np.searchsorted(key, np.arange(texts + 1) * max(width, 1))


def _item_terms(batches):
    for batch in batches:
        for part in portions(batch, "text"):
            hashes, first = terms_of(part.column("text"))
            vocabulary, column = np.unique(hashes, return_inverse=True)
            column, counts, edges = _counted(column, owners(first), len(vocabulary), part.num_rows)
            edges = pa.array(edges, pa.int32())
            terms = vocabulary[column].view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.ListArray.from_arrays(edges, pa.array(terms, pa.int64())),
                                              pa.ListArray.from_arrays(edges, pa.array(counts, pa.int64()))], ["item_id", "terms", "counts"])


def _postings(batches, vocabulary: np.ndarray):
    """A row for each document that holds a term of the vocabulary, and one with the task's sums:
    documents with a term, terms, and documents that hold each term of the vocabulary."""
    holding, documents, length = np.zeros(len(vocabulary), np.int64), 0, 0
    names = ["doc_id", "n", "terms", "counts", "documents"]
    for batch in batches:
        for part in portions(batch, "text"):
            hashes, first = terms_of(part.column("text"))
            sizes = np.diff(first)
            documents, length = documents + int((sizes > 0).sum()), length + len(hashes)
            place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            hit = vocabulary[place] == hashes
            column, counts, edges = _counted(place[hit], owners(first)[hit], len(vocabulary), part.num_rows)
            holding += np.bincount(column, minlength=len(vocabulary))
            some = np.flatnonzero(np.diff(edges))
            if len(some):
                edges = pa.array(np.append(edges[some], edges[-1]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(some)), pa.array(sizes[some], pa.int64()),
                     pa.ListArray.from_arrays(edges, pa.array(column, pa.int32())),
                     pa.ListArray.from_arrays(edges, pa.array(counts, pa.int64())), pa.nulls(len(some), pa.int64())], names)
    terms = np.flatnonzero(holding)
    ends = pa.array([0, len(terms)], pa.int32())
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([length], pa.int64()),
                                      pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                                      pa.ListArray.from_arrays(ends, pa.array(holding[terms], pa.int64())), pa.array([documents], pa.int64())], names)


class Scoring(NamedTuple):
    """What a task needs to score documents for a block of items."""

    items: Items
    weight: np.ndarray
    documents: int
    length: int
    top: int


class Tile(NamedTuple):
    """Columns [begin, end) of the vocabulary with the counts of all items there."""

    begin: int
    end: int
    row: np.ndarray
    column: np.ndarray
    count: np.ndarray


def tiles(items: Items, weight: np.ndarray, limit: int = EXACT, widest: int = TILE_TERMS) -> list[Tile]:
    """Vocabulary tiles in which no item's sum can reach ``limit``.

    A count that alone would is spread over several tiles of that term.
    """
    order = np.argsort(items.column, kind="stable")
    row, column, count = items.row[order], items.column[order], items.count[order].astype(np.int64)
    edges = np.searchsorted(column, np.arange(len(weight) + 1))
    out, begin, sums = [], 0, np.zeros(len(items.ids), object)

    def close(end: int) -> None:
        nonlocal begin, sums
        if end > begin:
            part = slice(edges[begin], edges[end])
            out.append(Tile(begin, end, row[part], column[part] - begin, count[part]))
        begin, sums = end, np.zeros(len(items.ids), object)

    for t in range(len(weight)):
        part = slice(edges[t], edges[t + 1])
        most = int(weight[t]) * MOST_WEIGHTLESS
        added = count[part].astype(object) * most
        if begin < t and (t - begin == widest or (sums[row[part]] + added >= limit).any()):
            close(t)
        if (added >= limit).any():
            step = max(1, (limit - 1) // most)
            left = count[part].copy()
            while left.any():
                now = np.minimum(left, step)
                out.append(Tile(t, t + 1, row[part][now > 0], np.zeros(int((now > 0).sum()), np.int64), now[now > 0]))
                left -= now
            begin = t + 1
        else:
            sums[row[part]] += added
    close(len(weight))
    return out


def impacts(weight: np.ndarray, counts: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """w * ((1000000000 tf) div (1000 tf + 12 m)) with m = 75 + ((25 n N) div L)."""
    m = 100 - 25 + (25 * n * documents) // length
    return weight * ((1_000_000_000 * counts) // (1000 * counts + 12 * m))


def scores(parts: list[Tile], items: int, owner: np.ndarray, column: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
    """Scores of all items (rows) for a tile of documents (columns), by dense products."""
    total = np.zeros((items, docs), np.int64)
    order = np.argsort(column, kind="stable")
    owner, column, impact = owner[order], column[order], impact[order]
    for part in parts:
        begin, end = np.searchsorted(column, (part.begin, part.end))
        present, place = np.unique(column[begin:end] - part.begin, return_inverse=True)
        if not len(present):
            continue
        slot = np.full(part.end - part.begin, -1)
        slot[present] = np.arange(len(present))
        kept = slot[part.column] >= 0
        left = np.zeros((items, len(present)))
        left[part.row[kept], slot[part.column[kept]]] = part.count[kept]
        right = np.zeros((len(present), docs))
        right[place, owner[begin:end]] = impact[begin:end]
        total += (left @ right).astype(np.int64)
    return total


class Best:
    """The best documents of each item so far; equal scores by id, missing ids last."""

    def __init__(self, items: int, top: int):
        self.items, self.top = items, top
        self.least = np.ones(items, np.int64)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, found: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        """``found``: scores of all items for documents ``ids``."""
        # Equal to the worst score kept may still win by its id.
        item, doc = np.nonzero(found >= self.least[:, None])
        if len(item):
            self.held.append((item, found[item, doc], unnamed[doc], ids[doc]))
            self.waiting += len(item)
        if self.waiting > WAITING:
            self._sort()

    def _sort(self) -> None:
        item, score, unnamed, ids = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((ids, unnamed, -score, item))
        item, score, unnamed, ids = item[order], score[order], unnamed[order], ids[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.top - 1
        self.least[item[last]] = score[last]
        kept = place < self.top
        self.held = [(item[kept], score[kept], unnamed[kept], ids[kept])]
        self.waiting = int(kept.sum())

    def rows(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        self._sort()
        return self.held[0]


def _best(batches, how: Scoring):
    parts, best = tiles(how.items, how.weight), Best(len(how.items.ids), how.top)
    for batch in batches:
        for at in range(0, batch.num_rows, TILE_DOCS):
            rows = batch.slice(at, TILE_DOCS)
            lists = rows.column("terms")
            column = lists.flatten().to_numpy().astype(np.int64)
            counts = rows.column("counts").flatten().to_numpy()
            owner = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
            impact = impacts(how.weight[column], counts, rows.column("n").to_numpy()[owner], how.documents, how.length)
            ids = rows.column("doc_id")
            best.add(scores(parts, len(how.items.ids), owner, column, impact, rows.num_rows),
                     ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
    item, score, unnamed, ids = best.rows()
    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=unnamed.astype(bool)),
                                      pa.array(score, pa.int64())], ["item", "doc_id", "score"])


#: The same for DuckDB over ``documents`` and ``benchmark``, with the defaults.
_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH i AS (SELECT DISTINCT item_id, text FROM benchmark),
q AS (SELECT item_id, text, term, count(*) AS c
      FROM (SELECT item_id, text, unnest(regexp_extract_all({_LOWER.format('text')}, '{_PATTERN}')) AS term FROM i) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER.format('text')}, '{_PATTERN}') AS terms FROM documents),
s AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM d),
p AS (SELECT k, doc_id, n, term, count(*) AS tf
      FROM (SELECT k, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
r AS (SELECT q.item_id, q.text, k, doc_id,
             CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // length)))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN f USING (term), s GROUP BY ALL),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
             doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {TOP}
"""
