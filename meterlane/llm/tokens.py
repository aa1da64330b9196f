"""Token ids of whole texts with a public byte-level vocabulary, tokenised once per distinct piece.

The vocabulary's pattern never joins a blank or line break to what stands before it when a
visible character follows, nor a letter or digit to punctuation after it. Texts are
therefore cut at both places, the pieces are made distinct
(Arrow compares their bytes, so nothing rests on hashes), only new pieces go through the
tokenizer, and ids are gathered by piece. Added tokens such as an end marker are cut out
first, as the tokenizer does. The result equals tokenising the whole text; a test compares both.
"""

from __future__ import annotations

import os
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from meterlane.llm.words import text_bytes

# Pieces kept between batches; beyond it the store starts anew.
STORE_PIECES = 300_000
# Bytes of text in a portion: the larger, the fewer distinct pieces a byte.
PORTION_BYTES = 3 << 20
# New pieces tokenised at once.
NEW_PIECES = 10_000

# A cut is made before 0x20 or 0x0A if the next byte is visible ASCII or a lead byte that
# can't begin a Unicode white space character (those begin with C2, E1, E2 or E3).
_AFTER_CUT = np.zeros(256, bool)
_AFTER_CUT[0x21:0x7F] = True
_AFTER_CUT[0xC3:0xF5] = True
_AFTER_CUT[[0xE1, 0xE2, 0xE3]] = False
# A cut is made between an ASCII letter or digit and ASCII punctuation, too.
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[0x21:0x7F] = True
_PUNCTUATION &= ~_ALNUM


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stays
    as it is, the other bytes take the code points from 256 on, in order."""
    stays = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in stays]
    return {**{b: b for b in stays}, **{b: 256 + k for k, b in enumerate(others)}}


_BYTE_LETTERS = _byte_letters()
_SHARED: dict[str, Encoder] = {}


class Ids(NamedTuple):
    """Ids of some texts: ``ids[first[i]:first[i + 1]]`` belong to text i."""

    ids: np.ndarray
    first: np.ndarray


class Encoder:
    """Tokenises portions of texts; one per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        contents = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.marker = re.compile(b"|".join(map(re.escape, contents))) if contents else None
        # Added tokens that take in what stands around them are left to the tokenizer with their whole text.
        self.plain = not any(t.single_word or t.lstrip or t.rstrip for t in added)
        self._clear()

    @classmethod
    def shared(cls, path: str) -> Encoder:
        """The worker's encoder for this vocabulary; it keeps its pieces from task to task."""
        if path not in _SHARED:
            _SHARED[path] = cls(path)
        return _SHARED[path]

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 18, np.int64)
        self.used = 0

    def _learn(self, pieces: list[bytes]) -> None:
        """Tokenise new pieces: letters alone are one unit of the pattern and go straight to
        the vocabulary's merges; whatever else there is goes through the whole tokenizer."""
        texts = [p.decode() for p in pieces]
        merge, letters = self.tokenizer.model.tokenize, _BYTE_LETTERS
        whole = [(t.isalpha() or (t[0] == " " and t[1:].isalpha())) and not (self.marker and self.marker.search(p))
                 for p, t in zip(pieces, texts)]
        alone = [p for p, w in zip(pieces, whole) if w]
        self._store(alone, [[k.id for k in merge(p.decode("latin-1").translate(letters))] for p in alone])
        rest = [t for t, w in zip(texts, whole) if not w]
        self._store([p for p, w in zip(pieces, whole) if not w],
                    [e.ids for e in self.tokenizer.encode_batch(rest, add_special_tokens=False)])

    def _store(self, pieces: list[bytes], lists: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        total, base = int(sizes.sum()), len(self.known)
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while base + len(pieces) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.pool[self.used:self.used + total] = np.fromiter((i for ids in lists for i in ids), np.uint32, total)
        self.ends[base + 1:base + 1 + len(pieces)] = self.used + np.cumsum(sizes)
        self.used += total
        self.known.update(zip(pieces, range(base, base + len(pieces))))

    def _cut_markers(self, cut: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        """Cut around added tokens and not inside them, nor before a blank that they follow: white
        space before an added token ends its part of the text and stays together."""
        raw = data.tobytes()
        if not self.marker or not self.marker.search(raw):
            return
        found = []
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            spans = [m.span() for m in self.marker.finditer(raw, begin, end)]
            if spans and not self.plain:
                cut[begin:end] = False
            elif spans:
                found += spans
        for begin, end in found:
            cut[max(begin - 1, 0)] = False
            cut[begin + 1:end] = False
        cut[[place for span in found for place in span]] = True

    def encode(self, texts: pa.Array, end_id: int | None = None) -> Ids:
        """Ids of all texts, each followed by ``end_id`` if given."""
        data, offsets = text_bytes(texts)
        ids = np.zeros(0, np.uint32)
        first = np.zeros(len(offsets), np.int64)
        if len(data):
            cut = np.zeros(len(data) + 1, bool)
            blank = (data == 0x20) | (data == 0x0A)
            cut[:len(data) - 1] = blank[:-1] & _AFTER_CUT[data[1:]]
            cut[1:-1] |= _ALNUM[data[:-1]] & _PUNCTUATION[data[1:]]
            # What begins the next text doesn't cut the end of this one.
            cut[np.maximum(offsets[1:] - 1, 0)] &= data[np.maximum(offsets[1:] - 1, 0)] > 0x20
            self._cut_markers(cut, data, offsets)
            cut[offsets] = True
            places = np.flatnonzero(cut)
            column = pa.Array.from_buffers(pa.large_binary(), len(places) - 1,
                                           [None, pa.py_buffer(places.astype(np.int64)),
                                            pa.py_buffer(np.ascontiguousarray(data))])
            coded = column.dictionary_encode()
            pieces = coded.dictionary.to_pylist()
            if len(self.known) > STORE_PIECES:
                self._clear()
            new = [p for p in pieces if p not in self.known]
            for at in range(0, len(new), NEW_PIECES):
                self._learn(new[at:at + NEW_PIECES])
            slot = np.fromiter((self.known[p] for p in pieces), np.int64, len(pieces))
            begin, size = self.ends[slot], self.ends[slot + 1] - self.ends[slot]
            code = coded.indices.to_numpy(zero_copy_only=False)
            sizes = size[code]
            ends = np.cumsum(sizes)
            ids = self.pool[np.repeat(begin[code] - (ends - sizes), sizes) + np.arange(int(ends[-1]))]
            piece_of_text = np.searchsorted(places[:-1], offsets)
            first = np.concatenate([[0], ends])[piece_of_text]
        if end_id is None:
            return Ids(ids, first)
        counts = np.diff(first)
        out = np.full(len(ids) + len(counts), end_id, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        return Ids(out, first + np.arange(len(first)))
