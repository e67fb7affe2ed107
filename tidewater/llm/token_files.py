"""Token ids in patched frame-of-reference blocks.

A file is a sequence of frames in document order, each followed by one LF.
A frame holds whole documents, closed at ``frame_ids`` ids or more:

    magic "PFR1", number of documents, ids and blocks (uint32 each)
    documents: flags and id (int64, flag 0 where the id is null), number of ids (uint32)
    block index: byte offset of each block in the block area (uint32)
    block area

A block codes 128 ids (the last of a frame may be shorter, padded with its
minimum): the minimum is subtracted; the rest is packed in w bits, the width
of the smallest total size that covers at least ``percentile`` of the block;
what does not fit is an exception, kept whole in a list.

    minimum (uint32), width (uint8), exceptions (uint8), packed 128 * w bits
    little-endian, exception positions (uint8 each), exception values (uint32 each)

The block index gives random access: ``read_range`` decodes only the blocks
that a range of ids covers.

Defined cases: a null or empty text is a document of the end id alone;
repeated ids are separate documents next to each other, nulls come first; an
empty table makes no frames.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import prepare, written
from .textfile import files, write_frames
from .textkit import as_batch, concat_ranges
from .tokens import default_path, encoded

MAGIC = b"PFR1"
BLOCK = 128
FRAME_IDS = 1 << 16
FRAMES_PER_FILE = 64            # files of about 8 MB, since a reader takes one at a time
PERCENTILE = 0.9
END_ID = 2


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.frexp(x.astype(np.float64))[1], 0).astype(np.int64)


def _pack(delta: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 numbers below 2**width as rows of 16 * width bytes."""
    out = np.zeros((len(delta), 2 * width), np.uint64)
    cols = np.ascontiguousarray(delta.T).astype(np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[:, word] |= cols[i] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= cols[i] >> np.uint64(64 - shift)
    return out.astype("<u8").view(np.uint8).reshape(len(delta), 16 * width)


def _unpack(raw: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``_pack``: rows of 16 * width bytes to rows of 128 numbers."""
    if not width:
        return np.zeros((len(raw), BLOCK), np.uint64)
    words = np.ascontiguousarray(raw).view("<u8").astype(np.uint64)
    out = np.empty((BLOCK, len(raw)), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (words[:, word + 1] << np.uint64(64 - shift))
        out[i] = x & mask
    return np.ascontiguousarray(out.T)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, np.ndarray]:
    """(byte offsets of the blocks, block area)."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    full = np.empty(n * BLOCK, np.uint32)
    full[:len(ids)] = ids
    full[len(ids):] = ids[(n - 1) * BLOCK:].min()
    rows = full.reshape(n, BLOCK)
    low = rows.min(1)
    delta = rows - low[:, None]
    bits = _bit_length(delta)
    # size of a block for each width: packed bits and five bytes an exception
    count = np.zeros((n, 33), np.int64)
    np.add.at(count, (np.repeat(np.arange(n), BLOCK), bits.ravel()), 1)
    within = count.cumsum(1)
    size = 16 * np.arange(33) + 5 * (BLOCK - within)
    size[within < percentile * BLOCK] = 1 << 30
    width = size.argmin(1)
    exception = bits > width[:, None]
    many = exception.sum(1)
    lens = 6 + 16 * width + 5 * many
    start = np.cumsum(lens) - lens
    area = np.zeros(int(lens.sum()), np.uint8)
    area[start[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    area[start + 4] = width
    area[start + 5] = many
    for w in np.unique(width).tolist():
        b = np.flatnonzero(width == w)
        if w:
            kept = np.where(exception[b], 0, delta[b])
            area[(start[b] + 6)[:, None] + np.arange(16 * w)] = _pack(kept, w)
    if many.any():
        row, col = np.nonzero(exception)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        head = start[row] + 6 + 16 * width[row]
        area[head + nth] = col
        at = head + many[row] + 4 * nth
        area[at[:, None] + np.arange(4)] = rows[row, col].astype("<u4").view(np.uint8).reshape(-1, 4)
    return start, area


def decode_blocks(area: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``start``, 128 for each."""
    n = len(start)
    if not n:
        return np.zeros(0, np.uint32)
    low = area[start[:, None] + np.arange(4)].copy().view("<u4").ravel()
    width, many = area[start + 4].astype(np.int64), area[start + 5].astype(np.int64)
    out = np.empty((n, BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        b = np.flatnonzero(width == w)
        out[b] = _unpack(area[(start[b] + 6)[:, None] + np.arange(16 * w)], w).astype(np.uint32) + low[b][:, None]
    if many.any():
        row = np.repeat(np.arange(n), many)
        nth = concat_ranges(np.zeros(n, np.int64), many)
        head = start[row] + 6 + 16 * width[row]
        at = head + many[row] + 4 * nth
        out[row, area[head + nth]] = area[at[:, None] + np.arange(4)].copy().view("<u4").ravel()
    return out.ravel()


def frame(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    start, area = encode_blocks(ids)
    head = np.array([len(doc_ids), len(ids), len(start)], "<u4").tobytes()
    flags = np.array([d is not None for d in doc_ids], np.uint8).tobytes()
    named = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    return b"".join([MAGIC, head, flags, named, lengths.astype("<u4").tobytes(),
                     start.astype("<u4").tobytes(), area.tobytes()])


class Frame:
    """A frame inside a file's bytes, from byte ``at``."""

    def __init__(self, data: np.ndarray, at: int):
        if data[at:at + 4].tobytes() != MAGIC:
            raise ValueError(f"no frame at byte {at}")
        docs, self.n_ids, blocks = data[at + 4:at + 16].view("<u4").tolist()
        p = at + 16
        flags = data[p:p + docs]
        p += docs
        named = data[p:p + 8 * docs].copy().view("<i8").tolist()
        self.doc_ids = [d if f else None for d, f in zip(named, flags.tolist())]
        p += 8 * docs
        self.lengths = data[p:p + 4 * docs].copy().view("<u4").astype(np.int64)
        p += 4 * docs
        self.start = data[p:p + 4 * blocks].copy().view("<u4").astype(np.int64)
        self.area = data[p + 4 * blocks:]
        self.size = p + 4 * blocks - at
        if blocks:
            last = int(self.start[-1])
            self.size += last + 6 + 16 * int(self.area[last + 4]) + 5 * int(self.area[last + 5])

    def ids(self) -> np.ndarray:
        return decode_blocks(self.area, self.start)[:self.n_ids]

    def read_range(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi-1 of the frame, from the blocks that hold them."""
        hi = min(hi, self.n_ids)
        if lo >= hi:
            return np.zeros(0, np.uint32)
        first = lo // BLOCK
        part = decode_blocks(self.area, self.start[first:-(-hi // BLOCK)])
        return part[lo - first * BLOCK:hi - first * BLOCK]


def frames_of(content: bytes) -> Iterator[Frame]:
    data = np.frombuffer(content, np.uint8)
    at = 0
    while at < len(data):
        f = Frame(data, at)
        yield f
        at += f.size + 1            # and the LF


def write(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
          tokenizer: str | None = None, frame_ids: int = FRAME_IDS, frames_per_file: int = FRAMES_PER_FILE) -> None:
    """Tokenise whole texts and write them in ascending order of the id (ties
    by a hash of the text) to files whose names follow that order."""
    prepare(docs)
    vocabulary = tokenizer or default_path()
    schema = pa.schema([("frame", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list = []
        lengths: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            return as_batch(schema, [frame(names, np.concatenate(lengths), np.concatenate(parts))])

        for batch in it:
            for lo, hi, ids, at in encoded(batch, vocabulary, end_id=end_id):
                doc_ids = batch.column(0).slice(lo, hi - lo).to_pylist()
                i = 0
                while i < len(doc_ids):
                    # the documents up to the one that fills the frame
                    j = int(np.searchsorted(at, at[i] + frame_ids - held))
                    j = min(max(j, i + 1), len(doc_ids))
                    names += doc_ids[i:j]
                    lengths.append(np.diff(at[i:j + 1]))
                    parts.append(ids[at[i]:at[j]])
                    held += int(at[j] - at[i])
                    if held >= frame_ids:
                        yield close()
                        names, lengths, parts, held = [], [], [], 0
                    i = j
        if names:
            yield close()

    # short sort keys: range bounds are sampled to the driver; the last one
    # lets even a row that repeats without end be cut into several ranges
    keys = ["doc_id", "tie", "row"]
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                    F.xxhash64(text_col).alias("tie"), F.monotonically_increasing_id().alias("row"))
    ordered = d.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    write_frames(ordered.mapInArrow(run, "frame binary"), "frame", path, "\n", frames_per_file)


_DOCS = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64())])


def read(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in range(batch.num_rows):
                before = 0
                name = batch.column(0)[row].as_py()
                for f in frames_of(batch.column(1)[row].as_buffer()):
                    ends = np.cumsum(f.lengths)
                    raw = memoryview(f.ids().astype("<u4").tobytes())
                    crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), f.lengths.tolist())]
                    yield as_batch(_DOCS, [name] * len(crc), f.doc_ids, before + ends - f.lengths, f.lengths, crc)
                    before += f.n_ids

    content = files(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    # a row for each document, written, so that the files are read once
    docs = written(content.mapInArrow(run, "file string, doc_id long, before long, n_tokens long, ids_crc32 long"), "token-docs")
    # one row for each file of some 4 million ids
    number = [F.regexp_extract("file", p, 1).cast("long") for p in (r"^part-(\d+)", r"-c(\d+)")]
    before = Window.orderBy(*number).rowsBetween(Window.unboundedPreceding, -1)
    base = (docs.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
            .select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base")))
    return docs.join(base, "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"),
                                          "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the documents' ids and read them back."""
    spark = prepare(docs)
    path = path or scratch_path(spark, "token-files")
    write(docs, path, **options)
    return read(spark, path)
