"""Words and word n-grams of whole texts on Arrow batches, with numpy.

A word is a run of bytes other than space and ``\\t\\n\\v\\f\\r``. UTF-8 keeps those six
bytes for themselves, so bytes can be looked at instead of code points. Work goes on in
portions of about a MB of text, however many rows a batch has; only a single text that is
larger than a portion makes a larger one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Large buffers go back to the system when they are free; a worker outlives its task.
pa.set_memory_pool(pa.system_memory_pool())

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
PORTION_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
LETTERS = _LOWER.copy()
LETTERS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 0x20

# Fixed for ever, as signatures of different jobs are compared: an odd base and seeded byte values.
_BASE = np.uint64(0x9E3779B97F4A7C1B)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C1B, -1, 1 << 64))
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20_260)).integers(0, 1 << 64, 256, np.uint64)
_BASE_POWERS = np.ones(1, np.uint64)
_INVERSE_POWERS = np.ones(1, np.uint64)


def give_back() -> None:
    """Return what this worker has freed to the system; it outlives its task and others need the memory."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Words(NamedTuple):
    """Words of some texts: ``hashes[first[i]:first[i + 1]]`` belong to text i."""

    hashes: np.ndarray
    first: np.ndarray
    lengths: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind one another and the offset of each; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not (wide or pa.types.is_string(texts.type) or pa.types.is_binary(texts.type)):
        texts, wide = texts.cast(pa.large_string()), True
    buffers, kind = texts.buffers(), np.int64 if wide else np.int32
    if not len(texts) or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def portions(batch: pa.RecordBatch | pa.Table, column: str, limit: int = PORTION_BYTES) -> Iterator[pa.RecordBatch | pa.Table]:
    """Slices of a batch with at most ``limit`` bytes of text each, or a single row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(np.asarray(sizes), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, until - at)
        at = until


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends) of all words in bytes, and the number of the first word of each text."""
    inside = ~_IS_SPACE[data]
    opens, closes = inside.copy(), inside.copy()
    if len(data) > 1:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(count: int) -> np.ndarray:
    """BASE to the powers 0 .. count - 1, modulo 2**64; kept for the next portion."""
    global _BASE_POWERS
    while len(_BASE_POWERS) < count:
        step = _BASE_POWERS[-1:] * _BASE
        _BASE_POWERS = np.concatenate([_BASE_POWERS, _BASE_POWERS * step])
    return _BASE_POWERS[:count]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, *prefixes: int) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in random values of its bytes.

    With ``prefixes``, a row for the words, then one for their first bytes of each length;
    0 for words that are not longer.

    Sums of value * base**position over all bytes are kept once; a word's part is a
    difference of two, moved to position 0 by the inverse power of the base.
    """
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers(len(data)), out=total[1:])
    back = _inverse_powers(len(data))[starts]
    rows = []
    for size in (None, *prefixes):
        until = ends if size is None else np.minimum(starts + size, ends)
        found = mixed((total[until] - total[starts]) * back + (until - starts).astype(np.uint64))
        rows.append(found if size is None else np.where(until < ends, found, np.uint64(0)))
    return np.stack(rows) if prefixes else rows[0]


def _inverse_powers(count: int) -> np.ndarray:
    global _INVERSE_POWERS
    while len(_INVERSE_POWERS) < max(count, 1):
        step = _INVERSE_POWERS[-1:] * _INVERSE
        _INVERSE_POWERS = np.concatenate([_INVERSE_POWERS, _INVERSE_POWERS * step])
    return _INVERSE_POWERS


def words_of(texts: pa.Array, lower: bool = False, letters: bool = False) -> Words:
    """Hashed words of all texts of a portion; with ``letters``, ASCII punctuation is white space."""
    data, offsets = text_bytes(texts)
    if lower or letters:
        data = (LETTERS if letters else _LOWER)[data]
    starts, ends, first = spans(data, offsets)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), first, np.zeros(0, np.int64))
    return Words(word_hashes(data, starts, ends), first, ends - starts)


def hash_of(word: str) -> np.uint64:
    """The hash that ``words_of`` gives this word."""
    return words_of(pa.array([word])).hashes[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits, one to one (finaliser of a public generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def owners(first: np.ndarray) -> np.ndarray:
    """The number of the text for each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of the first word, text) of each n-word window inside a text, in order."""
    h = words.hashes
    text = owners(words.first)
    count = max(0, len(h) - n + 1)
    acc = mixed(h[:count] + np.uint64(n))
    for k in range(1, n):
        acc = mixed(acc * np.uint64(0x9E3779B97F4A7C15) + h[k:k + count])
    inside = np.flatnonzero(text[:count] == text[n - 1:n - 1 + count])
    return acc[inside], inside, text[inside]


def ngrams(words: Words, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each n-word window inside a text, in order.

    With ``short``, a text of fewer than n words, but at least one, has them all as one window.
    """
    h, first = words.hashes, words.first
    grams, _, owner = windows(words, n)
    sizes = np.diff(first)
    few = np.flatnonzero((sizes > 0) & (sizes < n)) if short else ()
    if len(few):
        extra = np.empty(len(few), np.uint64)
        for i, t in enumerate(few):
            one = mixed(h[first[t]:first[t] + 1] + np.uint64(sizes[t]))
            for k in range(1, sizes[t]):
                one = mixed(one * np.uint64(0x9E3779B97F4A7C15) + h[first[t] + k:first[t] + k + 1])
            extra[i] = one[0]
        grams, owner = np.concatenate([grams, extra]), np.concatenate([owner, few])
    return grams, owner


def distinct_sets(grams: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams sorted inside each text, and the first position of each text."""
    order = np.argsort(grams)
    small = owner.astype(np.uint16 if texts < 1 << 16 else np.int64)
    order = order[np.argsort(small[order], kind="stable")]
    g, o = grams[order], owner[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
    g, o = g[new], o[new]
    return g, np.searchsorted(o, np.arange(texts + 1))
