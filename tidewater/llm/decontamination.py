"""Benchmark decontamination by size-partitioned MinHash containment search.

Question: which short test items lie, at least to ``threshold`` of their
5-word shingles, inside which documents?  Containment is asymmetric, so plain
MinHash (which estimates Jaccard) misses a short item in a long document.
Documents are therefore partitioned by set size, items by theirs, and each
pair of size classes gets its own one-permutation MinHash: the hash space is
cut into 2**b bins, a set's signature is the minimum of every bin, and b is
the smallest for which a contained item shares a bin minimum with the
document except with probability ``miss``.  Candidates that share a minimum
are verified by exact shingle containment.

Defined cases: a null or wordless text has no shingles and matches nothing;
an item of fewer than five words is one shingle, its whole sequence, and is
sought among the documents' runs of as many words; repeated items and
documents are each reported; null ids are carried through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import prepare
from .textkit import SHINGLE_WORDS, as_batch, concat_ranges, ngrams, rows_of, shingle_sets, words

THRESHOLD = 0.8
MISS = 1e-6
#: Item shingles sent to the executors at a time (8 bytes each, so 24 MB with
#: their owners); more items are searched in further passes of this size.
BLOCK_SHINGLES = 1_000_000

_SETS = "item_row long, item_id long, n_words int, hashes array<long>"
_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()),
                   ("n_item_shingles", pa.int64()), ("n_shared", pa.int64())])


def _item_sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("item_row", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int32()),
                        ("hashes", pa.list_(pa.int64()))])
    for batch in it:
        for lo, hi, data, offs in rows_of(batch):
            _, _, _, bounds = words(data, offs)
            sets = shingle_sets(data, offs)
            n = np.minimum(np.diff(bounds), SHINGLE_WORDS).astype(np.int32)
            yield as_batch(schema, batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                           n, [s.view(np.int64) for s in sets])


def load_limit(shared: int, miss: float) -> float:
    """Largest mean number of a document's shingles in a bin at which one of
    ``shared`` common shingles is a bin minimum except with probability
    ``miss``: a shingle is its bin's minimum with (1 - exp(-x)) / x."""
    need = 1.0 - miss ** (1.0 / shared)
    lo, hi = 1e-9, 64.0
    for _ in range(80):
        mid = math.sqrt(lo * hi)
        if (1.0 - math.exp(-mid)) / mid >= need:
            lo = mid
        else:
            hi = mid
    return lo


class ItemIndex:
    """Signature side of the search: the sorted shingles of a block of items,
    one array per class of item sizes."""

    def __init__(self, ids: list, n_words: list[int], sets: list[np.ndarray], threshold: float, miss: float):
        self.ids, self.threshold = ids, threshold
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.sets = sets
        self.classes = []
        kinds: dict[tuple[int, int], list[int]] = {}
        for i, (s, w) in enumerate(zip(sets, n_words)):
            if len(s):
                kinds.setdefault((min(w, SHINGLE_WORDS), int(len(s)).bit_length()), []).append(i)
        for (w, bits), members in sorted(kinds.items()):
            h = np.concatenate([sets[i] for i in members])
            owner = np.repeat(members, [len(sets[i]) for i in members])
            before = np.concatenate([np.concatenate([[np.uint64(0)], sets[i][:-1]]) for i in members])
            fresh = np.concatenate([np.arange(len(sets[i])) == 0 for i in members])
            least = np.where(fresh, 0, _common_bits(h, before) + 1)   # bins needed to be a minimum
            order = np.argsort(h, kind="stable")
            shared = max(1, math.ceil(threshold * (1 << (bits - 1)) - 1e-9))
            self.classes.append((w, load_limit(shared, miss), h[order], owner[order], least[order]))

    def search(self, doc_sets: dict[int, list[np.ndarray]]) -> Iterator[tuple[int, int, int]]:
        """(document, item, shared shingles) of every verified pair;
        ``doc_sets`` holds the documents' sets of w-word runs for each w."""
        for w, load, h, owner, least in self.classes:
            sets = doc_sets[w]
            sizes = np.array([len(s) for s in sets], np.int64)
            if not sizes.sum():
                continue
            # a document's size class is the power of two above its size
            upper = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
            bins = np.maximum(0, np.ceil(np.log2(upper / load))).astype(np.int64)
            flat = np.concatenate(sets)
            doc = np.repeat(np.arange(len(sets)), sizes)
            b = np.minimum(bins, 63)[doc]
            minimum = np.ones(len(flat), bool)
            minimum[1:] = (doc[1:] != doc[:-1]) | (_common_bits(flat[1:], flat[:-1]) < b[1:])
            at = np.searchsorted(h, flat)
            hit = minimum & (at < len(h))
            hit[hit] = h[at[hit]] == flat[hit]
            if not hit.any():
                continue
            left = at[hit]
            many = np.searchsorted(h, flat[hit], side="right") - left
            entry = concat_ranges(left, many)
            d, bb = np.repeat(doc[hit], many), np.repeat(b[hit], many)
            good = least[entry] <= bb
            pairs = np.unique(np.stack([d[good], owner[entry[good]]]), axis=1)
            for di, ii in pairs.T.tolist():
                q = self.sets[ii]
                x = sets[di]
                p = np.searchsorted(x, q)
                p[p == len(x)] = 0
                shared = int((x[p] == q).sum())
                if shared >= self.threshold * len(q) - 1e-9:
                    yield di, ii, shared


def _common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of leading bits that two uint64 arrays share."""
    x = a ^ b
    high, low = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    bits = np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1])
    return 64 - bits


def _search(items):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(*items.value)
        short = sorted({c[0] for c in index.classes} - {SHINGLE_WORDS})
        for batch in it:
            ids = batch.column(0)
            for lo, hi, data, offs in rows_of(batch):
                doc_sets = {SHINGLE_WORDS: shingle_sets(data, offs)}
                if short:
                    h, _, _, bounds = words(data, offs)
                    edges = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                    for w in short:
                        grams = ngrams(h, w)
                        doc_sets[w] = [np.unique(grams[a:max(a, b - w + 1)]) for a, b in edges]
                hits = list(index.search(doc_sets))
                if hits:
                    rows = pa.array([lo + d for d, _, _ in hits])
                    yield as_batch(_HITS, ids.take(rows), [index.ids[i] for _, i, _ in hits],
                                   [int(index.sizes[i]) for _, i, _ in hits], [s for _, _, s in hits])
    return run


def find_contained(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD,
                   miss: float = MISS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row (doc_id, item_id, n_item_shingles, n_shared, containment) per
    document and test item with containment of at least ``threshold``.

    The items are the stated query set.  They are searched against all
    documents in blocks of at most ``block_shingles`` shingles (or one item):
    one block is what is sent to the executors, and each further block is a
    further pass over the documents, so nothing grows with either table."""
    spark = prepare(docs)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = [spark.createDataFrame([], "doc_id long, item_id long, n_item_shingles long, n_shared long")]
    source = (items.select(F.monotonically_increasing_id().alias("item_row"),
                           F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
              .mapInArrow(_item_sets, _SETS).filter(F.size("hashes") > 0))
    block: list = []
    held = 0

    def search(rows: list) -> None:
        sent = spark.sparkContext.broadcast((
            [r.item_id for r in rows], [r.n_words for r in rows],
            [np.array(r.hashes, np.int64).view(np.uint64) for r in rows], threshold, miss))
        found.append(d.mapInArrow(_search(sent), found[0].schema))

    for r in source.toLocalIterator():
        if block and held + len(r.hashes) > block_shingles:
            search(block)
            block, held = [], 0
        block.append(r)
        held += len(r.hashes)
    if block:
        search(block)
    out = found[0]
    for part in found[1:]:
        out = part if out is found[0] else out.unionByName(part)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that contain a test item; documents
    with a null id are judged together, as one id."""
    bad = (find_contained(docs, items, id_col=id_col, **options)
           .select(F.col("doc_id").alias("__bad")).distinct())
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__bad"]), "left_anti")
