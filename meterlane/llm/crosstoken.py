"""Alignment of two tokenizers over whole texts by products of hand-built sparse matrices.

Vocabulary A is byte-level, B a piece model with byte fallback; both read a blank and the text.
A token covers bytes, which is a row of a token-byte incidence matrix in CSR form. The
product A·Bᵀ, made row by row (Gustavson), has an entry for each pair of tokens whose bytes
overlap: the links. Offsets where a token of both ends cut the text into groups, and the
product of the token-group incidences stands for the pairs that share a group.

Neither vocabulary joins a blank to what stands before it when a visible character follows, nor
ASCII punctuation to a letter or digit before it (B has no such pieces, which is checked). Texts are cut there, so a
segment's tokens, links and groups are its own, and each distinct segment is aligned once.

How many documents hold an id pair linked is counted over the whole corpus: tasks write
their documents with the distinct pairs of each, and for a chunk of documents at a time how
many of them hold each pair. Only these counts are exchanged, so a pair in every document
costs a row per chunk; a chunk gets the totals of its own pairs back.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.llm.words import portions, text_bytes
from meterlane.session import materialize

# Pairs of (document, id pair) after which a chunk ends; the task that adds up holds one chunk.
CHUNK_ENTRIES = 4_000_000
# Segments kept between portions of a task; beyond it the store starts anew.
STORE_SEGMENTS = 300_000
# Longer segments are aligned but not kept.
KEPT_BYTES = 64
PORTION_BYTES = 1 << 20

COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_shared")
# Chunk numbers are the partition's number times this, counted up.
PER_PARTITION = 1 << 32

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
# Lead bytes that can't begin a white space character outside ASCII.
_VISIBLE[0xC3:0xF5] = True
_VISIBLE[[0xE1, 0xE2, 0xE3]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[0x21:0x7F] = True
_PUNCTUATION &= ~_ALNUM

_SHARED: dict[tuple[str, str], Aligner] = {}


class CSR(NamedTuple):
    """A sparse matrix of whole numbers: row i holds ``values[start[i]:start[i + 1]]`` in ``columns``."""

    start: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.start) - 1


def spans_matrix(ends: np.ndarray) -> CSR:
    """Incidence of tokens (rows) and bytes: token i covers the bytes from the last end to its own."""
    size = int(ends[-1]) if len(ends) else 0
    return CSR(np.concatenate([[0], ends]).astype(np.int64), np.arange(size), np.ones(size, np.int64), size)


def labels_matrix(labels: np.ndarray, width: int) -> CSR:
    """Incidence of tokens (rows) and groups: one entry a row."""
    return CSR(np.arange(len(labels) + 1), labels.astype(np.int64), np.ones(len(labels), np.int64), width)


def transposed(m: CSR) -> CSR:
    order = np.argsort(m.columns, kind="stable")
    rows = np.repeat(np.arange(m.height), np.diff(m.start))[order]
    counts = np.bincount(m.columns, minlength=m.width)
    return CSR(np.concatenate([[0], np.cumsum(counts)]), rows, m.values[order], m.height)


def product_sizes(a: CSR, b: CSR) -> np.ndarray:
    """Terms of each row of a·b before equal columns are added: Gustavson's symbolic pass."""
    total = np.concatenate([[0], np.cumsum(np.diff(b.start)[a.columns])])
    return total[a.start[1:]] - total[a.start[:-1]]


def product(a: CSR, b: CSR) -> CSR:
    """a·b by rows: row i of the result adds up the rows of b that row i of a names."""
    lengths = np.diff(b.start)[a.columns]
    ends = np.cumsum(lengths)
    count = int(ends[-1]) if len(ends) else 0
    taken = np.repeat(b.start[a.columns] - (ends - lengths), lengths) + np.arange(count)
    row = np.repeat(np.repeat(np.arange(a.height), np.diff(a.start)), lengths)
    key = row * max(b.width, 1) + b.columns[taken]
    value = np.repeat(a.values, lengths) * b.values[taken]
    if count and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if count else np.zeros(0, np.int64)
    key = key[new]
    sums = np.add.reduceat(value, new) if count else value
    start = np.searchsorted(key, np.arange(a.height + 1) * max(b.width, 1))
    return CSR(start, key % max(b.width, 1), sums, b.width)


class Alignment(NamedTuple):
    """Tokens of some byte strings laid end to end; entry i of a ``first`` begins string i's."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    first_group: np.ndarray
    links: CSR

    def shared(self) -> CSR:
        """Pairs of tokens (rows of A, columns of B) that share a group."""
        width = int(self.first_group[-1])
        return product(labels_matrix(self.group_a, width), transposed(labels_matrix(self.group_b, width)))


def align(a: list[list[int]], b: list[list[int]], size_a: np.ndarray, size_b: np.ndarray) -> Alignment:
    """Links and groups of strings that both vocabularies spell alike; ``size_a`` and ``size_b``
    are the bytes of each id."""
    ids_a, ids_b = (np.fromiter((i for ids in lists for i in ids), np.int64) for lists in (a, b))
    first_a, first_b = (np.concatenate([[0], np.cumsum([len(ids) for ids in lists], dtype=np.int64)]) for lists in (a, b))
    ends_a, ends_b = np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])
    both = np.intersect1d(ends_a, ends_b, assume_unique=True)
    until = np.concatenate([[0], ends_a])[first_a]
    links = product(spans_matrix(ends_a), transposed(spans_matrix(ends_b)))
    return Alignment(ids_a, ids_b, first_a, first_b, np.searchsorted(both, ends_a), np.searchsorted(both, ends_b),
                     np.searchsorted(both, until, "right"), links)


def byte_letters() -> dict[str, int]:
    """The byte behind each letter that byte-level vocabularies write."""
    stays = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in stays]
    return {**{chr(b): b for b in stays}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Aligner:
    """Aligns portions of texts; one per Python worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.tokenizer_a, self.tokenizer_b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.tokenizer_a.encode_special_tokens = True
        letters, entries = byte_letters(), self.tokenizer_a.get_vocab()
        self.bytes_a = [b""] * (1 + max(entries.values()))
        for token, i in entries.items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.tokenizer_b.id_to_piece(i) for i in range(self.tokenizer_b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                        for p in pieces]
        own = [p for i, p in enumerate(pieces) if not (self.tokenizer_b.is_byte(i) or self.tokenizer_b.is_control(i)
                                                        or self.tokenizer_b.is_unknown(i))]
        if any(re.search(r"[^▁]▁|[0-9A-Za-z][!-/:-@\[-`{-~]|\n", p) for p in own):
            raise ValueError("texts can't be cut: a piece goes over a blank, a line break or the end of a word")
        self.size_a, self.size_b = (np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        self._clear()

    @classmethod
    def shared(cls, path_a: str, path_b: str) -> Aligner:
        if (path_a, path_b) not in _SHARED:
            _SHARED[path_a, path_b] = cls(path_a, path_b)
        return _SHARED[path_a, path_b]

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        # A row per segment: the counts and whether both spell it; pairs behind one another.
        self.counts = np.zeros((0, len(COUNTS)), np.int64)
        self.right = np.zeros(0, bool)
        self.pairs = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def _learn(self, segments: list[bytes]) -> None:
        texts = [s.decode() for s in segments]
        a = [e.ids for e in self.tokenizer_a.encode_batch(texts, add_special_tokens=False)]
        # B puts a blank in front: the segment's own, or one that a line break keeps apart from it.
        b = self.tokenizer_b.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        b = [ids if t[0] == " " else ids[2:] for t, ids in zip(texts, b)]
        right = np.zeros(len(segments), bool)
        for i, segment in enumerate(segments):
            right[i] = (b"".join([self.bytes_a[k] for k in a[i]]) == segment
                        and b"".join([self.bytes_b[k] for k in b[i]]) == segment)
        a, b = ([ids if ok else [] for ids, ok in zip(lists, right)] for lists in (a, b))
        found = align(a, b, self.size_a, self.size_b)
        width = int(found.first_group[-1])
        shared = product_sizes(labels_matrix(found.group_a, width), transposed(labels_matrix(found.group_b, width)))
        shared = np.concatenate([[0], np.cumsum(shared)])[found.first_a]
        first_link = found.links.start[found.first_a]
        row = np.repeat(found.a, np.diff(found.links.start))
        counts = np.stack([np.diff(x) for x in (found.first_a, found.first_b, found.first_group, first_link, shared)], axis=1)
        texts_of = _group_texts(found)
        self.groups += [b";".join(texts_of[x:y]) for x, y in zip(found.first_group[:-1].tolist(), found.first_group[1:].tolist())]
        self.counts, self.right = np.concatenate([self.counts, counts]), np.concatenate([self.right, right])
        self.first = np.concatenate([self.first, self.first[-1] + first_link[1:]])
        self.pairs = np.concatenate([self.pairs, row * len(self.bytes_b) + found.b[found.links.columns]])
        self.known.update(zip(segments, range(len(self.known), len(self.known) + len(segments))))

    def read(self, texts: pa.Array) -> dict[str, list | np.ndarray]:
        """Columns for each text: the counts, the digest of the groups, the distinct id pairs
        (entries ``first[i]:first[i + 1]`` of ``pairs``) and how often each is linked there."""
        data, offsets = text_bytes(texts)
        sizes = np.diff(offsets)
        # A blank before every text that has one.
        data = np.insert(data, offsets[:-1][sizes > 0], 0x20)
        offsets = np.concatenate([[0], np.cumsum(sizes + (sizes > 0))])
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            cut[1:-2] = (data[1:-1] == 0x20) & (data[:-2] != 0x20) & _VISIBLE[data[2:]]
            cut[1:-1] |= _ALNUM[data[:-1]] & _PUNCTUATION[data[1:]]
            # What begins the next text doesn't cut the end of this one.
            cut[np.maximum(offsets[1:] - 1, 0)] = False
        cut[offsets] = True
        places = np.flatnonzero(cut)
        if len(self.known) > STORE_SEGMENTS:
            self._clear()
        column = pa.Array.from_buffers(pa.large_binary(), len(places) - 1,
                                       [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        segments = coded.dictionary.to_pylist()
        new = [s for s in segments if s not in self.known]
        if new:
            self._learn(new)
        code = np.fromiter((self.known[s] for s in segments), np.int64, len(segments))[
            coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
        first = np.searchsorted(places[:-1], offsets)
        out = self._texts(code, first, len(sizes))
        long = [s for s in new if len(s) > KEPT_BYTES]
        if sum(map(len, long)) > 16 * PORTION_BYTES:
            self._clear()
        return out

    def _texts(self, code: np.ndarray, first: np.ndarray, texts: int) -> dict[str, list | np.ndarray]:
        def per_text(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0, dtype=np.int64)])
            return total[first[1:]] - total[first[:-1]]

        good = per_text(~self.right[code]) == 0
        counts = per_text(self.counts[code]) * good[:, None]
        listed, digests = code.tolist(), []
        for i, (x, y) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            whole = b";".join([self.groups[c] for c in listed[x:y]]) if good[i] and x < y else b""
            digests.append(hashlib.sha256(whole).hexdigest() if whole else "")
        # Equal segments of a text first, then their links.
        owner = np.repeat(np.arange(texts), np.diff(first))
        keep = good[owner]
        key, times = np.unique(owner[keep] * max(len(self.known), 1) + code[keep], return_counts=True)
        owner, code = key // max(len(self.known), 1), key % max(len(self.known), 1)
        sizes = self.first[code + 1] - self.first[code]
        ends = np.cumsum(sizes)
        at = np.repeat(self.first[code] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        space = len(self.bytes_a) * len(self.bytes_b)
        key, times = np.repeat(owner, sizes) * space + self.pairs[at], np.repeat(times, sizes)
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        key = key[new]
        return {"counts": counts, "digests": digests, "first": np.searchsorted(key, np.arange(texts + 1) * space),
                "pairs": key % space, "times": np.add.reduceat(times, new) if len(new) else np.zeros(0, np.int64)}


def _group_texts(found: Alignment) -> list[bytes]:
    """``a1,a2|b1`` for each group."""
    sides = []
    for ids, group in ((found.a, found.group_a), (found.b, found.group_b)):
        names = [str(i) for i in ids.tolist()]
        edges = np.searchsorted(group, np.arange(int(found.first_group[-1]) + 1)).tolist()
        sides.append([",".join(names[x:y]) for x, y in zip(edges[:-1], edges[1:])])
    return [f"{a}|{b}".encode() for a, b in zip(*sides)]


def report(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256 per row.

    ``n_best`` counts the links whose id pair is in as many documents as any pair of its A id,
    ``count_sum`` adds up over the links how many documents hold their pair. Null and empty
    texts, and texts that a vocabulary doesn't spell byte for byte, have zeros, an empty digest
    and no part in the counts. Rows that repeat count as documents each, also under one id; null
    ids stay null; an empty table gives no rows. Other columns are not read.
    """
    documents, pairs = aligned(docs, path_a, path_b, id_column, text_column)
    totals = pair_counts(pairs)
    replies = pairs.join(totals, "pair").select(F.col("chunk").alias("to_chunk"), "pair", "n_docs", "best")
    schema = ", ".join([f"doc_id {dict(documents.dtypes)['doc_id']}", *(f"{c} long" for c in COUNTS),
                        "n_best long, count_sum long, groups_sha256 string"])
    return documents.groupBy("chunk").cogroup(replies.groupBy("to_chunk")).applyInArrow(_added, schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, a_id, n_docs, best): in how many documents an id pair is linked, and whether no pair
    of its A id is in more. An A id has as many pairs as B has ids at most."""
    totals = pairs.groupBy("pair", "a_id").agg(F.sum("docs").alias("n_docs"))
    most = totals.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    return totals.join(most, "a_id").select("pair", "a_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id",
            text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents with their distinct linked id pairs, and (chunk, pair, a_id, docs)."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    schema = ", ".join(["chunk long", f"doc_id {dict(rows.dtypes)['doc_id']}", *(f"{c} long" for c in COUNTS), "groups_sha256 string",
                        "linked binary, times binary, pairs array<long>, docs array<int>"])
    written = materialize(rows.mapInArrow(partial(_read, path_a=path_a, path_b=path_b), schema), "aligned")
    documents = written.filter("linked IS NOT NULL").drop("pairs", "docs")
    from sentencepiece import SentencePieceProcessor

    size_b = SentencePieceProcessor(model_file=path_b).get_piece_size()
    pairs = (written.filter("linked IS NULL").select("chunk", F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
             .select("chunk", F.col("p.pairs").alias("pair"), F.floor(F.col("p.pairs") / size_b).alias("a_id"),
                     F.col("p.docs").cast("long").alias("docs")))
    return documents, pairs


def _read(batches, path_a: str, path_b: str):
    """Rows of documents, and at the end of each chunk a row with the documents of each id pair."""
    chunk, held, entries = TaskContext.get().partitionId() * PER_PARTITION, [], 0
    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for rows in portions(batch, "text", PORTION_BYTES):
            found = Aligner.shared(path_a, path_b).read(rows.column("text"))
            first = found["first"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows.num_rows, chunk)), rows.column("doc_id"), *map(pa.array, found["counts"].T),
                 pa.array(found["digests"], pa.string()), _blobs(found["pairs"].astype("<i8"), first),
                 _blobs(found["times"].astype("<u4"), first),
                 pa.nulls(rows.num_rows, pa.list_(pa.int64())), pa.nulls(rows.num_rows, pa.list_(pa.int32()))],
                ["chunk", "doc_id", *COUNTS, "groups_sha256", "linked", "times", "pairs", "docs"])
            held.append(np.unique(found["pairs"], return_counts=True))
            entries += len(found["pairs"])
            if len(held) > 15:
                held = [_summed(held)]
            if entries >= CHUNK_ENTRIES:
                yield _chunk_row(chunk, _summed(held), kind)
                chunk, held, entries = chunk + 1, [], 0
    if entries:
        yield _chunk_row(chunk, _summed(held), kind)


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
    return pairs, np.bincount(place, np.concatenate([n for _, n in held]), len(pairs)).astype(np.int64)


def _chunk_row(chunk: int, counted: tuple[np.ndarray, np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    pairs, docs = counted
    ends = pa.array([0, len(pairs)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), pa.nulls(1, kind), *[pa.nulls(1, pa.int64()) for _ in COUNTS], pa.nulls(1, pa.string()),
         pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.ListArray.from_arrays(ends, pa.array(pairs)),
         pa.ListArray.from_arrays(ends, pa.array(docs.astype(np.int32)))],
        ["chunk", "doc_id", *COUNTS, "groups_sha256", "linked", "times", "pairs", "docs"])


def _blobs(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The values of each text as its bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(first) - 1, [
        None, pa.py_buffer((first * values.itemsize).astype(np.int64)), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _added(documents: pa.Table, replies: pa.Table) -> pa.Table:
    pair, docs, best = (replies.column(c).to_numpy() for c in ("pair", "n_docs", "best"))
    order = np.argsort(pair)
    pair, docs, best = pair[order], docs[order], best[order]
    n_best, count_sum = [], []
    for linked, times in zip(documents.column("linked"), documents.column("times")):
        at = np.searchsorted(pair, np.frombuffer(linked.as_py(), "<i8"))
        often = np.frombuffer(times.as_py(), "<u4").astype(np.int64)
        n_best.append(int(often[best[at].astype(bool)].sum()))
        count_sum.append(int((often * docs[at]).sum()))
    return pa.table({"doc_id": documents.column("doc_id"), **{c: documents.column(c) for c in COUNTS},
                     "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                     "groups_sha256": documents.column("groups_sha256")})
