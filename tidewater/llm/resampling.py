"""Target-distribution importance resampling over hashed word runs.

Documents are drawn so that their words look like a target corpus.  Features
are all runs of 1 to ``max_run`` consecutive words (A-Z lower-cased; a word is
a run of ASCII letters, digits and characters beyond ASCII), a feature's bucket
is the CRC-32 of its words, joined by one space, modulo ``buckets``.  A
bucket's gain is the logarithm of its smoothed share in the target over its
share in the source; a document's weight is the mean gain of its features, and
a Gumbel number from a hash of its id turns the ``share`` highest sums into a
draw without replacement in proportion to exp(weight).

Head-tail vocabulary: the most frequent words, counted over the whole corpus,
are broadcast with their CRC-32 states, both ended and after the joining
space, and the most frequent pairs of them with their buckets, so that most
features are looked up by number; all other words and runs go through CRC-32
directly, continued from their first word's state.  Both ways give the same
number and feed the same exact totals, so the head's size changes the time
only.  The head holds the words of the highest counts, down to a power of two,
at most ``head_words`` of at most ``HEAD_BYTES`` bytes, and at most
``head_pairs`` pairs, whatever the corpus.

The draw needs no global sort: scores are whole numbers, so a count by score
gives the last score that is drawn and the ranks before every score; ranks
inside a score follow the id.

Defined cases: a null text has no words; a document without words has weight
0; a null id hashes as the empty text and comes first among equal scores; rows
of equal ids are separate documents with the same noise, the one with fewer
features first; a long text is worked on whole; an empty table draws nothing,
an empty target leaves t = T = 0.  Columns are taken by name, so further ones
can't clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import columns, prepare, written
from .textkit import as_batch, bytes_of, rows_of

BUCKETS = 10_000
MAX_RUN = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
HEAD_WORDS = 1 << 16
HEAD_PAIRS = 1 << 16
HEAD_BYTES = 32             # longer words are always in the tail
SLICE_BYTES = 2 << 20
HELD = 1 << 18              # distinct words that a task counts before it passes them on

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def find_words(data: np.ndarray, offs: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """(the words of all texts of a slice one after another, first word of
    each text and the total)."""
    low = _LOWER[data]
    inside = np.append(_WORD[low], False)
    start = inside[:-1].copy()
    start[1:] &= ~inside[:-2]
    firsts = offs[:-1][offs[:-1] < len(data)]
    start[firsts] |= inside[firsts]
    begin = np.flatnonzero(start)
    stop = inside[:-1] & ~inside[1:]
    lasts = offs[1:][offs[1:] > 0] - 1
    stop[lasts] |= inside[lasts]
    end = np.flatnonzero(stop) + 1
    # words without what lies between them
    kept = low[inside[:-1]]
    at = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin),
                                             [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(kept))])
    return words, np.searchsorted(begin, offs).astype(np.int64)


class Vocabulary:
    """Head of the vocabulary: words with their CRC-32 states, and pairs of
    them with their buckets."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.buckets = buckets
        self.words = pa.array(words, pa.large_binary())
        self.crc = np.array([zlib.crc32(w) for w in words], np.int64)
        self.state = np.array([zlib.crc32(w + b" ") for w in words], np.int64)
        number = {w: i for i, w in enumerate(words)}
        known = sorted((number[a] * len(words) + number[b], zlib.crc32(b, zlib.crc32(a + b" ")) % buckets)
                       for a, b in pairs if a in number and b in number)
        self.pairs = np.array([k for k, _ in known], np.int64)
        self.pair_buckets = np.array([b for _, b in known], np.int64)

    def features(self, words: pa.LargeBinaryArray, bounds: np.ndarray, max_run: int
                 ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket, text) of the features of 1, 2, .. words.  The words of a
        slice are numbered: below the head's size by the head, others as they
        come."""
        n, head = len(words), len(self.words)
        number = (pc.index_in(words, self.words).fill_null(head).to_numpy() if head
                  else np.full(n, head)).astype(np.int64)
        tail = np.flatnonzero(number == head)
        coded = words.take(pa.array(tail)).dictionary_encode()
        rest = bytes_of(coded.dictionary)
        number[tail] = head + coded.indices.to_numpy()
        crc = np.concatenate([self.crc, np.array([zlib.crc32(w) for w in rest], np.int64)])
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        yield crc[number] % self.buckets, text
        if max_run < 2 or not n:
            return
        state = np.concatenate([self.state, np.array([zlib.crc32(b" ", c) for c in crc[head:].tolist()], np.int64)])
        # a run is a number of its own: its first words' number and its last word
        run, at, run_state = number, np.arange(n), state
        for length in range(2, max_run + 1):
            ok = at + length - 1 < n
            ok &= text[np.minimum(at + length - 1, n - 1)] == text[at]
            at, first = at[ok], run[ok]
            last = number[at + length - 1]
            if not len(at):
                return
            bucket = np.full(len(at), -1, np.int64)
            if length == 2 and len(self.pairs):
                both = (first < head) & (last < head)
                key = np.where(both, first * head + last, -1)
                place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
                found = both & (self.pairs[place] == key)
                bucket[found] = self.pair_buckets[place[found]]
            key = first * (head + len(rest)) + last
            distinct, where, run = np.unique(key, return_index=True, return_inverse=True)
            # only runs that the head does not hold, or that go on, need their CRC-32
            need = np.ones(len(distinct), bool) if length < max_run else bucket[where] < 0
            got = np.zeros(len(distinct), np.int64)
            todo = np.flatnonzero(need)
            lasts = bytes_of(words.take(pa.array(at[where[todo]] + length - 1)))
            got[todo] = [zlib.crc32(w, s) for w, s in zip(lasts, run_state[first[where[todo]]].tolist())]
            bucket = np.where(bucket < 0, got[run] % self.buckets, bucket)
            yield bucket, text[at]
            if length < max_run:
                run_state = np.array([zlib.crc32(b" ", c) for c in got.tolist()], np.int64)


def _counted(counts: dict, keys: list, n: np.ndarray) -> None:
    for k, c in zip(keys, n.tolist()):
        counts[k] = counts.get(k, 0) + c


def _head(counts: DataFrame, size: int) -> DataFrame:
    """The rows of a written table with ``n`` of at least T, for the least
    power of two T that leaves at most ``size`` rows.  One count for each
    power decides it, so no more than the head itself reaches the driver."""
    power = F.floor(F.log2("n")).cast("int")
    by = {r.power: r.rows for r in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    least, held = 63, 0
    while least and held + by.get(least - 1, 0) <= size:
        least -= 1
        held += by.get(least, 0)
    return counts.filter(F.col("n") >= (1 << least)).orderBy(F.desc("n"), counts.columns[0])


def frequent_words(docs: DataFrame, size: int) -> list[bytes]:
    """The most frequent words of at most ``HEAD_BYTES`` bytes, counted over
    all texts: at most ``size``, see ``_head``."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in it:
            for _, _, data, offs in rows_of(batch, "text", SLICE_BYTES):
                coded = find_words(data, offs)[0].dictionary_encode()
                n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                short = np.flatnonzero(pc.binary_length(coded.dictionary).to_numpy() <= HEAD_BYTES)
                _counted(counts, bytes_of(coded.dictionary.take(pa.array(short))), n[short])
                if len(counts) > HELD:
                    yield as_batch(schema, list(counts), list(counts.values()))
                    counts = {}
        yield as_batch(schema, list(counts), list(counts.values()))

    counts = written(docs.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    return [bytes(r.word) for r in _head(counts, size).collect()]


def frequent_pairs(docs: DataFrame, words: list[bytes], size: int) -> list[tuple[bytes, bytes]]:
    """The most frequent pairs of neighbouring head words, at most ``size``."""
    sent = docs.sparkSession.sparkContext.broadcast(words)
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = pa.array(sent.value, pa.large_binary())
        held, size_held = [], 0
        for batch in it:
            for _, _, data, offs in rows_of(batch, "text", SLICE_BYTES):
                found, bounds = find_words(data, offs)
                number = pc.index_in(found, head).fill_null(-1).to_numpy().astype(np.int64)
                text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                ok = (text[1:] == text[:-1]) & (number[1:] >= 0) & (number[:-1] >= 0)
                pair, n = np.unique(number[:-1][ok] * len(head) + number[1:][ok], return_counts=True)
                held.append((pair, n))
                size_held += len(pair)
                if size_held > HELD:
                    yield merged(held)
                    held, size_held = [], 0
        if held:
            yield merged(held)

    def merged(held: list) -> pa.RecordBatch:
        pair, where = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate([c for _, c in held]), minlength=len(pair))
        return as_batch(schema, pair, n.astype(np.int64))

    counts = written(docs.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    return [(words[r.pair // len(words)], words[r.pair % len(words)]) for r in _head(counts, size).collect()]


def bucket_totals(docs: DataFrame, vocabulary, buckets: int, max_run: int) -> np.ndarray:
    """Features of all texts by bucket, exactly."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in it:
            for _, _, data, offs in rows_of(batch, "text", SLICE_BYTES):
                for bucket, _ in vocabulary.value.features(*find_words(data, offs), max_run):
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield as_batch(schema, used.astype(np.int32), total[used])

    total = np.zeros(buckets, np.int64)
    for r in docs.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r.bucket] = r.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of smoothed target over source share by bucket, in thousandths."""
    k = len(source)
    all_s, all_t = int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + k) / ((s + 1) * (all_t + k))))
                     for s, t in zip(map(float, source.tolist()), map(float, target.tolist()))], np.int64)


def weights(docs: DataFrame, gain, vocabulary, max_run: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for lo, hi, data, offs in rows_of(batch, "text", SLICE_BYTES):
                words, bounds = find_words(data, offs)
                n = np.zeros(hi - lo, np.int64)
                total = np.zeros(hi - lo, np.int64)
                for bucket, text in vocabulary.value.features(words, bounds, max_run):
                    n += np.bincount(text, minlength=hi - lo)
                    # sums of whole numbers far below 2**53: exact as doubles
                    total += np.bincount(text, weights=gain.value[bucket], minlength=hi - lo).astype(np.int64)
                yield as_batch(schema, batch.column(0).slice(lo, hi - lo), np.diff(bounds), n,
                               np.where(n > 0, total // np.maximum(n, 1), 0))

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def _drawn(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``scored`` (a written table) with the rank of the drawn rows."""
    able = scored.filter(F.col("n_words") >= min_words)
    want = able.count() * percent // 100
    # a row for each whole-number score: some ten thousand at most
    upto = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (able.groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(upto))
           .select("score", (F.col("upto") - F.col("n")).alias("before")).filter(F.col("before") < want))
    last = cut.agg(F.min("score")).first()[0]
    drawn = (F.col("n_words") >= min_words) & (F.col("score") >= F.lit(last).cast("long"))
    inside = Window.partitionBy("score").orderBy("doc_id", "n_features")
    ranked = scored.filter(drawn).join(cut, "score").withColumn("rank", F.col("before") + F.row_number().over(inside))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= want, F.col("rank")))
    rest = scored.filter(~F.coalesce(drawn, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*scored.columns, "rank").unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", max_run: int = MAX_RUN, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED, head_words: int = HEAD_WORDS,
             head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document;
    rank is null for those that are not drawn."""
    spark = prepare(docs)
    sc = spark.sparkContext
    d = columns(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    t = columns(target, target_col).toDF("text")
    words = frequent_words(d.select("text"), head_words) if head_words else []
    pairs = frequent_pairs(d.select("text"), words, head_pairs) if max_run > 1 and words and head_pairs else []
    vocabulary = sc.broadcast(Vocabulary(words, pairs, buckets))
    source = bucket_totals(d.select("text"), vocabulary, buckets, max_run)
    gain = sc.broadcast(gains(source, bucket_totals(t, vocabulary, buckets, max_run)))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256),
                           1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weights(d, gain, vocabulary, max_run).withColumn("score", F.col("weight") + noise)
    return _drawn(written(scored, "resampling"), percent, min_words)
