"""Byte-level BPE encoding and decoding with contiguous rank arrays.

A vocabulary file of the tokenizers library (byte-level BPE) is read for its
merges; texts are encoded here.  A text is cut into words by the file's own
splitting rule, and a word's parts are merged on a contiguous array: it holds
the parts, and the rank of every two neighbours (the number of their merge, or
none).  The smallest rank is found by a scan, the boundary between its two
parts is deleted, what follows moves up by one, and the ranks to the left and
right of the new part are looked up afresh, until no rank is left.  Words of
up to ``SHORT`` bytes of one length class are the rows of a matrix, so one scan
serves all of them; the few longer ones, for which repeated scans would be
quadratic, are merged in the same order (rank, then place) from a heap.

Most words repeat: a text is first cut where the splitting rule always cuts
(before white space that follows another character, before a mark that follows
a letter), the distinct pieces of a slice are found by Arrow, and only pieces
that the worker does not remember are split and merged.

Decoding joins the tokens' bytes; what is no UTF-8 becomes U+FFFD, ids that
the vocabulary lacks are skipped.

Defined cases: a null or empty text has no ids, and null ids decode to the
empty text; a special token's text inside a text is that token; null ids and
repeated rows are carried through; a long text is encoded whole; an empty table
gives no rows.  Columns are taken by name, so further ones can't clash.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import columns, prepare
from .textkit import as_batch, bytes_of, rows_of
from .tokens import default_path

SHORT = 64                  # bytes of the longest word that is merged by scans
CHUNK = 1 << 13             # words merged at once
REMEMBERED = 600_000        # pieces that a worker remembers, and their bytes
REMEMBERED_BYTES = 24 << 20
SLICE_BYTES = 4 << 20
NONE = np.int32(2**31 - 1)  # rank of neighbours that never merge

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?)*#%&$"]] = True
# The splitting rule on ASCII and the Latin-1 letters behind lead byte C3, whose
# classes no version of Unicode changes; other characters go to the library.
_L = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_PLAIN = re.compile(rb" ?" + _L + rb"+\Z")
_KNOWN = re.compile(rb"(?:[\x00-\x7f]|\xc3[\x80-\xbf])*\Z")
_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d| ?" + _L + rb"+| ?[0-9]+"
                    rb"| ?(?:[^\sA-Za-z0-9\x80-\xff]|\xc3[\x97\xb7])+|\s+(?!\S)|\s+")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself where it is visible in Latin-1, else the next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        from tokenizers import pre_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if (model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or pre["add_prefix_space"]
                or not pre["use_regex"] or any(model.get(o) for o in options)):
            raise ValueError("not a plain byte-level BPE vocabulary")
        # the library's splitting rule alone, for its tables of letters and numbers
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        ids = model["vocab"]
        size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
        self.text = [b""] * size
        for t, i in ids.items():
            self.text[i] = (bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode())
        self.special: dict[bytes, int] = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("special tokens that take white space are not supported")
            self.text[t["id"]] = t["content"].encode()
            self.special[t["content"].encode()] = t["id"]
        self.specials = (re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + b")")
                         if self.special else None)
        self.byte = np.array([ids[c] for c in letters], np.int32)
        self.size = size
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        key = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int32)
        order = np.argsort(key, kind="stable")
        self.key, self.rank_of, self.made = key[order], order.astype(np.int32), made
        # ranks of two bytes, by both
        self.first = self.ranks(np.repeat(self.byte, 256), np.tile(self.byte, 256)).reshape(256, 256)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbouring parts, or NONE."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank_of[at], NONE)

    @functools.cached_property
    def pairs(self) -> dict[int, int]:
        """Rank by pair, for one at a time."""
        return dict(zip(self.key.tolist(), self.rank_of.tolist()))


def merge_short(v: Vocabulary, rows: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge words that are the rows of a byte matrix: (parts, how many)."""
    n, width = rows.shape
    place = np.arange(width, dtype=np.int32)
    parts = v.byte[rows]
    ranks = np.full((n, width), NONE, np.int32)
    if width > 1:
        ranks[:, :-1] = v.first[rows[:, :-1], rows[:, 1:]]
    ranks[place >= lens[:, None] - 1] = NONE
    count = lens.copy()
    out = np.empty((n, width), np.int32)
    live = np.arange(n)
    while len(live):
        low = ranks.argmin(1)                       # the first of the smallest
        rank = ranks[np.arange(len(live)), low]
        done = rank == NONE
        if done.any():
            out[live[done]] = parts[done]
            keep = ~done
            live, parts, ranks, low, rank = live[keep], parts[keep], ranks[keep], low[keep], rank[keep]
            if not len(live):
                break
        # delete the boundary: what follows moves up by one
        parts[:, :-1] = np.where((place > low[:, None])[:, :-1], parts[:, 1:], parts[:, :-1])
        ranks[:, :-1] = np.where((place >= low[:, None])[:, :-1], ranks[:, 1:], ranks[:, :-1])
        ranks[:, -1] = NONE
        parts[np.arange(len(live)), low] = v.made[rank]
        count[live] -= 1
        last = count[live] - 1
        left, right, end = np.flatnonzero(low > 0), np.flatnonzero(low < last), np.flatnonzero(low >= last)
        who, at = np.concatenate([left, right]), np.concatenate([low[left] - 1, low[right]])
        ranks[who, at] = v.ranks(parts[who, at], parts[who, at + 1])
        ranks[end, low[end]] = NONE
    return out, count


def merge_long(v: Vocabulary, word: bytes) -> list[int]:
    """The same merges for one long word: the smallest rank, then the first
    place, from a heap of pairs over a linked list of parts."""
    raw = np.frombuffer(word, np.uint8)
    parts = v.byte[raw].tolist()
    n = len(parts)
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(v.first[raw[:-1], raw[1:]].tolist()) if r != NONE]
    heapq.heapify(heap)
    known = v.pairs
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = following[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue                                # one of the two parts has merged since
        parts[i], parts[j] = int(v.made[rank]), -1
        following[i] = k = following[j]
        if k < n:
            previous[k] = i
        for x, y in ((previous[i], i), (i, k)):
            if x >= 0 and y < n:
                r = known.get(parts[x] * v.size + parts[y])
                if r is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
    return [p for p in parts if p >= 0]


def merge_words(v: Vocabulary, words: list[bytes]) -> list[bytes]:
    """The ids of every word, as little-endian int32."""
    out: list = [None] * len(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(lens) - lens
    low = 0
    for width in (1, 4, 8, 12, 16, 32, SHORT):
        members = np.flatnonzero((lens > low) & (lens <= width))
        low = width
        for c in range(0, len(members), CHUNK):
            m = members[c:c + CHUNK]
            cells = np.minimum(start[m][:, None] + np.arange(width), len(flat) - 1)
            rows = np.where(np.arange(width) < lens[m][:, None], flat[cells], 0)
            parts, count = merge_short(v, rows, lens[m])
            ids = parts[np.arange(width) < count[:, None]].astype("<i4").tobytes()
            end = (4 * np.cumsum(count)).tolist()
            for i, p, q in zip(m.tolist(), [0, *end], end):
                out[i] = ids[p:q]
    for i in np.flatnonzero(lens > SHORT).tolist():
        out[i] = np.array(merge_long(v, words[i]), "<i4").tobytes()
    return out


class Encoder:
    """Encodes slices of texts; remembers a bounded number of pieces."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.tokens = pa.array(self.vocabulary.text, pa.large_binary())
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, bytes] = {}
        self.bytes = 0

    def _split(self, piece: bytes) -> list:
        """The words of a piece, and the ids of special tokens in it."""
        v = self.vocabulary
        out: list = []
        for section in (v.specials.split(piece) if v.specials else [piece]):
            if section in v.special:
                out.append(v.special[section])
            elif _KNOWN.match(section):
                out += _WORDS.findall(section)
            else:
                at = 0
                for letters, _ in v.split(section.decode("utf-8", "replace")):
                    out.append(section[at:at + len(letters)])           # a letter stands for each byte
                    at += len(letters)
        return out

    def _learn(self, pieces: list[bytes]) -> None:
        """Split new pieces into words, merge the words, remember the ids."""
        plain, split = [], []
        for p in pieces:
            if _PLAIN.match(p):                                         # one word in any case
                plain.append(p)
            else:
                split.append((p, self._split(p)))
        words = plain + [w for _, found in split for w in found if isinstance(w, bytes)]
        ids = merge_words(self.vocabulary, words)
        self.known.update(zip(plain, ids))
        rest = iter(ids[len(plain):])
        for p, found in split:
            self.known[p] = b"".join([next(rest) if isinstance(w, bytes) else w.to_bytes(4, "little") for w in found])
        self.bytes += sum(map(len, pieces)) + sum(map(len, ids))

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, first id of each text and the
        total)."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        cut = np.zeros(len(data), bool)
        before, after = data[:-1], data[1:]
        white = (after == 0x20) | (after == 0x0A)
        # an ASCII character that is surely no white space stands before
        cut[1:] = (white & (before > 0x20) & (before < 0x7F)) | (_MARK[after] & _LETTER[before])
        cut[offs[:-1][offs[:-1] < len(data)]] = True
        at = np.flatnonzero(cut)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [
            None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        distinct = bytes_of(coded.dictionary)
        if len(self.known) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self.forget()
        fresh = [p for p in distinct if p not in self.known]
        if fresh:
            self._learn(fresh)
        joined = pa.array(list(map(self.known.__getitem__, distinct)), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(joined.buffers()[1], np.int64)[:len(at) + 1]
        raw = joined.buffers()[2]
        ids = np.frombuffer(raw, "<i4")[:int(ends[-1]) // 4] if raw is not None else np.zeros(0, np.int32)
        return ids, ends[np.searchsorted(at, offs)] // 4

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The texts of the ids between the offsets ``at``."""
        fine = (ids >= 0) & (ids < self.vocabulary.size)
        kept = np.concatenate([[0], np.cumsum(fine)])[at]
        joined = self.tokens.take(pa.array(ids[fine]))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[:len(joined) + 1][kept].tolist()
        raw = memoryview(joined.buffers()[2] or b"")
        return [str(raw[a:b], "utf-8", "replace") for a, b in zip(ends, ends[1:])]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary file."""
    return Encoder(path)


_CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_ROUND = pa.schema([*_CODED, ("decoded", pa.string())])


def _lists(ids: np.ndarray, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))


def _run(vocabulary: str, back: bool):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in it:
            for lo, hi, data, offs in rows_of(batch, "text", SLICE_BYTES):
                ids, at = enc.encode(data, offs)
                row = [batch.column(0).slice(lo, hi - lo), _lists(ids, at)]
                yield as_batch(_ROUND, *row, enc.decode(ids, at)) if back else as_batch(_CODED, *row)
    return run


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every whole text."""
    prepare(docs)
    d = columns(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return d.mapInArrow(_run(vocabulary or default_path(), False), "doc_id long, ids array<int>")


def decode(coded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """doc_id and text of every list of ids."""
    prepare(coded)
    path = vocabulary or default_path()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in it:
            lists = batch.column(1)
            ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield as_batch(schema, batch.column(0), enc.decode(ids, at))

    d = columns(coded, id_col, ids_col).toDF("doc_id", "ids").select(
        F.col("doc_id").cast("long"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return d.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids, and the text decoded from them, in one pass."""
    prepare(docs)
    d = columns(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return d.mapInArrow(_run(vocabulary or default_path(), True), "doc_id long, ids array<int>, decoded string")
