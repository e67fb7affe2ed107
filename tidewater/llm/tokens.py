"""Token ids of whole texts, by the tokenizers library, in Arrow batches.

Byte-level BPE splits a text before every white-space run that follows a
non-space character, and before a mark that follows a letter, whatever comes
around them, so such pieces can be encoded on their own.  Most pieces repeat: each batch is cut into pieces, the
distinct ones are found by Arrow's dictionary encoding, new ones are encoded
once, and the ids of the whole texts are gathered with numpy.  A new piece that
is one word in any case goes straight to the library's merges, the others
through its whole encoder.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .textkit import bytes_of, concat_ranges, rows_of

#: Distinct pieces remembered by a worker; beyond it the memory starts anew.
REMEMBERED = 600_000
REMEMBERED_BYTES = 16 << 20
SLICE_BYTES = 4 << 20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?)*#%&$"]] = True
_LATIN = np.zeros(256, bool)          # last bytes of the letters after lead byte C3
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False          # the signs x and division
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z")     # letters of any version of Unicode


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # the characters that stand for bytes in the vocabulary, by the library's own mapping
        visible = [b for b in range(256) if b < 0x7F and b > 0x20 or 0xA0 < b != 0xAD]
        self.letters = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in visible)}
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.bytes = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)     # first id of each known piece, and the end

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces; each is split and merged on its own."""
        words = [_WORD.match(p) is not None for p in pieces]
        rest = [p.decode("utf-8", "replace") for p, w in zip(pieces, words) if not w]
        e = self.tokenizer.encode(rest, is_pretokenized=True, add_special_tokens=False)
        many = np.bincount(np.array(e.word_ids, np.int64), minlength=len(rest)) if rest else []
        ends = np.cumsum(many, dtype=np.int64).tolist()
        others = map(e.ids.__getitem__, map(slice, [0, *ends], ends))
        merge, letters = self.tokenizer.model.tokenize, self.letters
        ids = [[t.id for t in merge(p.decode("latin-1").translate(letters))] if w else next(others)
               for p, w in zip(pieces, words)]
        n = len(self.known)
        ends = self.start[n] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        while n + len(pieces) >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.start[n]:ends[-1]] = np.fromiter(itertools.chain.from_iterable(ids), np.uint32)
        self.start[n + 1:n + 1 + len(pieces)] = ends
        self.bytes += sum(map(len, pieces))
        self.known.update(zip(pieces, range(n, n + len(pieces))))

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of the texts)."""
        n = len(offs) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        cut = np.zeros(len(data), bool)
        white = (data[1:] == 0x20) | (data[1:] == 0x0A)
        before = data[:-1]
        # the byte before ends a character that is surely not white space: an
        # ASCII mark or letter, or a Latin-1 letter (lead byte C3)
        letter = _LETTER[before]
        letter[1:] |= _LATIN[before[1:]] & (before[:-1] == 0xC3)
        cut[1:] = (white & (letter | (before > 0x20) & (before < 0x7F))) | (_MARK[data[1:]] & letter)
        cut[offs[:-1][offs[:-1] < len(data)]] = True
        at = np.flatnonzero(cut)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at),
            [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = bytes_of(coded.dictionary)
        if len(self.known) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self.forget()
        fresh = [p for p in distinct if p not in self.known]
        if fresh:
            self._learn(fresh)
        which = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        start = self.start[which]
        code = coded.indices.to_numpy()
        sizes = (self.start[which + 1] - start)[code]
        ids = self.flat[concat_ranges(start[code], sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, total[np.searchsorted(at, offs)]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary file."""
    return Encoder(path)


def encoded(batch: pa.RecordBatch, path: str, column: str = "text", end_id: int | None = None
            ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, ids, offsets) of successive slices of
    a batch; ``end_id`` is appended to every text."""
    enc = encoder(path)
    for lo, hi, data, offs in rows_of(batch, column, SLICE_BYTES):
        ids, at = enc.encode(data, offs)
        if end_id is not None:
            ids = np.insert(ids, at[1:], end_id)
            at = at + np.arange(len(at))
        yield lo, hi, ids, at
