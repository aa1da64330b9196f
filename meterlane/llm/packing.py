"""Packing token sequences of a fixed length by the sum-of-squares rule.

Every task packs its own partition online: whole windows are cut off a document, and what
remains goes to the fill level that makes the sum of squared counts of partially filled
windows smallest, counted in an array by level. At the end of a partition the pieces of
the windows that stayed open are laid behind one another and cut anew, so that at most one
window is not full; as a sequence whose length is a power of two needs no padding, that one
is cut into such lengths. Windows never cross partitions: no shuffle, and a lost task only
repeats its own.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.llm.tokens import PORTION_BYTES, Encoder
from meterlane.llm.words import give_back, portions

LENGTH = 1024
COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
# Sequence numbers are the partition's number times this, counted up.
PER_PARTITION = 1 << 40


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts hold the end id alone. Rows that repeat are packed each; null ids
    stay null. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(partial(_pack, tokenizer=tokenizer, end_id=end_id, length=length),
                           f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COLUMNS))


class Packer:
    """Open windows of one partition. Pieces are (key, start, ids, doc_tokens)."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.next = length, first_sequence
        self.counts = np.zeros(length + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(length)]
        self.rows: list[tuple] = []

    def add(self, key, ids: np.ndarray) -> None:
        total = len(ids)
        whole = total - total % self.length
        for at in range(0, whole, self.length):
            self._out([(key, at, ids[at:at + self.length], total)])
        if whole < total:
            self._place((key, whole, ids[whole:], total))

    def _place(self, piece: tuple) -> None:
        size, n = len(piece[2]), self.counts
        # Growth of the sum of squares if a window at level h moves to level h + size;
        # level 0 stands for a new window, and a full one is counted no more.
        levels = np.arange(0, self.length - size + 1)
        growth = 2 * (n[levels + size] - n[levels]) + 2
        growth[-1] = 1 - 2 * n[self.length - size]
        growth[0] = 2 * n[size] + 1
        usable = n[levels] > 0
        usable[0] = True
        level = int(np.argmin(np.where(usable, growth, np.iinfo(np.int64).max)))
        window = self.open[level].pop() if level else []
        if level:
            n[level] -= 1
        window.append(piece)
        if level + size == self.length:
            self._out(window)
        else:
            self.open[level + size].append(window)
            n[level + size] += 1

    def _out(self, window: list[tuple]) -> None:
        offset = 0
        for key, start, ids, total in window:
            self.rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def close(self) -> None:
        """Lay out the open windows, fullest first, and cut full windows from them."""
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        left = sum(len(p[2]) for p in pieces)
        window, room = [], self._room(left)
        for key, start, ids, total in pieces:
            while len(ids):
                taken = ids[:room]
                window.append((key, start, taken, total))
                ids, start, room, left = ids[len(taken):], start + len(taken), room - len(taken), left - len(taken)
                if not room:
                    self._out(window)
                    window, room = [], self._room(left)

    def _room(self, left: int) -> int:
        """The next window: full, or the largest power of two that the rest still fills."""
        return self.length if left >= self.length else 1 << max(0, left.bit_length() - 1)


def _pack(batches, tokenizer: str, end_id: int, length: int):
    # What earlier stages left in this worker goes back before the encoder needs room.
    give_back()
    packer, encoder = Packer(length, TaskContext.get().partitionId() * PER_PARTITION), None
    kind = None
    for batch in batches:
        kind = batch.column("doc_id").type
        for rows in portions(batch, "text", PORTION_BYTES):
            encoder = encoder or Encoder.shared(tokenizer)
            coded = encoder.encode(rows.column("text"), end_id)
            for i, key in enumerate(rows.column("doc_id").to_pylist()):
                # A copy, so that a piece that waits doesn't keep the portion's ids.
                packer.add(key, coded.ids[coded.first[i]:coded.first[i + 1]].copy())
            yield from _batches(packer, kind)
    if kind is not None:
        packer.close()
        yield from _batches(packer, kind)
    give_back()


def _batches(packer: Packer, kind: pa.DataType):
    if packer.rows:
        keys, *values = zip(*packer.rows)
        packer.rows = []
        yield pa.RecordBatch.from_arrays([pa.array(keys, kind), *[pa.array(v, pa.int64()) for v in values]],
                                         ["doc_id", *COLUMNS])
