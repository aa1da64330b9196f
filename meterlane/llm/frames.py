"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a run of zstandard frames, each with whole documents; an index in a skippable
frame (first and last document id, documents and ids of each frame); and the public
seekable format's table in a skippable frame: packed size, plain size and checksum (low 32
bits of xxHash64 of the plain bytes) per frame, then the number of frames, a flag byte and
the table's magic number. Any zstandard reader can decompress the file as a whole; a reader
of one document fetches the table, the index and one frame.

A frame's plain bytes, little-endian: number of documents (u32), bytes per id (u32), ids of
the documents (i64 each), whether the id is null (u8 each), ids per document (u32 each), ids.

Tasks write under a name of their own and the manifest lists only what successful tasks
returned, so a task that runs twice leaves at most a file that nothing refers to.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlane.llm.tokens import PORTION_BYTES, Encoder
from meterlane.llm.words import portions
from meterlane.session import materialize, new_path, slice_count

# Ids in a frame, unless a single document has more.
FRAME_IDS = 1 << 16
# Magic numbers of the public formats.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, TABLE_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80

ROW = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write all documents in ascending order of id; returns the manifest (one row per file).

    Ids are integers, null ones come last; rows with one id are ordered by their text and
    each is written. Null texts are empty and hold the end id alone. An empty table gives
    an empty manifest. ``start`` is the number of ids in all files before this one.
    """
    spark = docs.sparkSession
    folder = folder or new_path(spark, "token-files")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # Cut points are sampled on the driver: ids only, no text.
    order = F.col("doc_id").asc_nulls_last()
    written = (rows.repartitionByRange(slice_count(spark), order).sortWithinPartitions(order, "text")
               .mapInArrow(partial(_write, tokenizer=tokenizer, end_id=end_id, folder=folder),
                           "path string, part int, n_docs long, n_ids long"))
    manifest = materialize(written, "token-manifest")
    # One row per file, as many as there are slices.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_rows(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    files = slice_count(manifest.sparkSession)
    return manifest.select("path", "start").repartition(files, "path").mapInArrow(_read, ROW)


def lookup(path: str, wanted: set[int]) -> dict[int, list[np.ndarray]]:
    """Ids of the wanted documents of one file; only their frames are decompressed."""
    file, size = _open(path)
    with file:
        table, index = _tail(file, size)
        found: dict[int, list[np.ndarray]] = {}
        for (at, packed, plain, check), (low, high) in zip(table, index):
            if any(low <= w <= high for w in wanted):
                ids, nulls, docs = _frame(file, at, packed, plain, check)
                for key, null, doc in zip(ids, nulls, docs):
                    if not null and int(key) in wanted:
                        found.setdefault(int(key), []).append(doc)
        return found


def _open(path: str):
    system, inner = pafs.FileSystem.from_uri(path)
    return system.open_input_file(inner), system.get_file_info(inner).size


class _Writer:
    """One file; frames are closed when they are full."""

    def __init__(self, folder: str, part: int):
        self.path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zst"
        system, inner = pafs.FileSystem.from_uri(self.path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(inner, compression=None)
        self.packer = zstandard.ZstdCompressor(level=3)
        self.table, self.index = [], []
        self.docs = self.ids = 0
        self._new()

    def _new(self) -> None:
        self.keys, self.nulls, self.parts, self.waiting = [], [], [], 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key or 0)
        self.nulls.append(key is None)
        self.parts.append(ids)
        self.waiting += len(ids)
        if self.waiting >= FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.keys:
            return
        ids = np.concatenate(self.parts)
        width = 2 if int(ids.max()) < 1 << 16 else 4
        plain = b"".join([
            np.array([len(self.keys), width], "<u4").tobytes(), np.array(self.keys, "<i8").tobytes(),
            np.array(self.nulls, np.uint8).tobytes(), np.array([len(p) for p in self.parts], "<u4").tobytes(),
            ids.astype(f"<u{width}").tobytes()])
        packed = self.packer.compress(plain)
        self.out.write(packed)
        self.table.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        real = [k for k, null in zip(self.keys, self.nulls) if not null]
        self.index.append((min(real, default=0), max(real, default=-1)))
        self.docs += len(self.keys)
        self.ids += len(ids)
        self._new()

    def close(self) -> None:
        self.flush()
        index = np.array(self.index, "<i8").tobytes()
        table = np.array(self.table, "<u4").tobytes()
        tail = np.array([len(self.table)], "<u4").tobytes() + bytes([CHECKSUMS]) + np.array([TABLE_END], "<u4").tobytes()
        for magic, body in ((SKIPPABLE_INDEX, index), (SKIPPABLE_TABLE, table + tail)):
            self.out.write(np.array([magic, len(body)], "<u4").tobytes() + body)
        self.out.close()


def _write(batches, tokenizer: str, end_id: int, folder: str):
    encoder, writer, part = None, None, TaskContext.get().partitionId()
    for batch in batches:
        for rows in portions(batch, "text", PORTION_BYTES):
            encoder = encoder or Encoder.shared(tokenizer)
            writer = writer or _Writer(folder, part)
            coded = encoder.encode(rows.column("text"), end_id)
            for i, key in enumerate(rows.column("doc_id").to_pylist()):
                writer.add(key, coded.ids[coded.first[i]:coded.first[i + 1]])
    if writer:
        writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([writer.path]), pa.array([part], pa.int32()), pa.array([writer.docs]), pa.array([writer.ids])],
            ["path", "part", "n_docs", "n_ids"])


def _tail(file, size: int) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """(offset, packed size, plain size, checksum) of all frames, and their first and last id."""
    file.seek(size - 9)
    tail = file.read(9)
    frames, flags, end = int.from_bytes(tail[:4], "little"), tail[4], int.from_bytes(tail[5:], "little")
    if end != TABLE_END or flags != CHECKSUMS:
        raise ValueError("no seek table at the end of the file")
    table_at = size - 9 - 12 * frames
    index_at = table_at - 8 - 16 * frames
    file.seek(index_at)
    index = np.frombuffer(file.read(16 * frames), "<i8").reshape(frames, 2)
    file.seek(table_at)
    table = np.frombuffer(file.read(12 * frames), "<u4").reshape(frames, 3).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(table[:, 0])])
    return [(int(a), *map(int, t)) for a, t in zip(offsets, table)], [tuple(map(int, x)) for x in index]


def _frame(file, at: int, packed: int, plain: int, check: int):
    """(ids of the documents, null flags, token ids of each) of one frame, checked."""
    file.seek(at)
    raw = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
    if len(raw) != plain or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
        raise ValueError(f"frame at {at}: checksum differs")
    count, width = np.frombuffer(raw, "<u4", 2)
    keys = np.frombuffer(raw, "<i8", count, 8)
    nulls = np.frombuffer(raw, np.uint8, count, 8 + 8 * count)
    sizes = np.frombuffer(raw, "<u4", count, 8 + 9 * count)
    ids = np.frombuffer(raw, f"<u{width}", offset=8 + 13 * int(count)).astype("<u4")
    return keys, nulls, np.split(ids, np.cumsum(sizes[:-1], dtype=np.int64))


def documents_of(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """All documents of a file in order, a frame at a time."""
    file, size = _open(path)
    with file:
        for entry in _tail(file, size)[0]:
            keys, nulls, docs = _frame(file, *entry)
            yield from ((None if null else int(key), doc) for key, null, doc in zip(keys, nulls, docs))


def _read(batches):
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            rows = []
            for key, ids in documents_of(path):
                rows.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
                start += len(ids)
                if len(rows) == 10_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])
