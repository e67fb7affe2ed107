"""Substring deduplication by collinear chaining of shared k-mer seeds.

1. Seeds: hashes of ``k`` words (a word that repeats at once counts its
   repeats), thinned to the minimum of every ``window``
   successive ones, so texts that share window + k - 1 words share a seed.
   A chain of one match is left: short seeds meet by chance.
2. Seeds meet in buckets of their hashes, dealt out as arrays: each occurrence
   is matched with the first document that has the seed, and later with the
   one before it, but only where no passage with a first document covers it: a
   near copy of a group then has few partners.  That is at most two matches
   for an occurrence, however many documents share the seed.  A seed that is
   very common in some task's texts, or that alone would crowd a task, meets
   by sort order, which cuts it over several tasks; the rows at the cuts are matched afterwards, so the matches do not
   depend on the partitions.
   Exact repeats need more, as every seed of a passage may be common while the
   passage is rare: thinned grams of min_words - 16 words, of which every
   repeat of min_words words has one, meet in the same way, and where one has
   over two occurrences, or is at a partition's edge, all min_words-word
   windows around its occurrences meet their first holder.  So every exact
   repeat of min_words words is matched with the first text that has it.
3. The matches of a pair of texts are chained: the best chain of matches that
   ascend in both texts, each gaining its words and paying for the gap, found
   with a Fenwick tree of best predecessors over the second text's positions;
   chains are cut at wide gaps and taken until none is left.  Of a run whose
   words come again and again, a few places are chained at first; the others
   are, where no passage that these lead to covers them.
4. Both texts are cut out around each chain and aligned: equal runs between
   matches, longest common subsequences in the gaps, x-drop extension at the
   ends.  The chain is reported if it has at least ``min_words`` words with
   at least ``identity`` of them equal, else every such stretch of it.

Equal texts are one class, named by a 64-bit hash; unequal texts of one hash
are told apart by a 128-bit one and named anew.  A class's first document
stands for it.  The earliest document (by id) keeps a passage.

Defined cases: null, empty and shorter texts have no passages; of equal texts
of ``min_words`` words or more, all but the first are one passage each; null
ids come last in order; repeated rows count as one document with one id;
repetition inside one document is not reported; long texts are worked on whole,
in word hashes and cut-outs; an empty table has no passages.  Further columns
may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import prepare, written
from .textkit import as_batch, concat_ranges, ngrams, rows_of, words

K = 5
WINDOW = 4
MIN_WORDS = 50
IDENTITY = 0.8
GAP = 40                  # words between two matches of a chain, at most
GAP_COST = 0.1            # per word of gap in either text
MARGIN_BYTES = 1024       # text fetched beyond a chain on either side at first
CUT_BYTES = 1 << 21       # of cut-out texts handed to Python at once, but for longer ones
WORD_BYTES = 1 << 20      # of cut-out texts whose words are found at once
CROWD = 500_000
LONG_WINDOW = 17          # successive long grams, of which one is a seed
STRONG = 1 << 62          # marks a place that was matched by a long gram
SOLID = 8                 # successive equal words that are never trimmed from a passage
DEALT = 1 << 17           # seeds of a kind that a task deals out to buckets at once
COMMON = 2048             # of them, from how many of one seed on it is matched by ranges
CROWDED = 1 << 20         # rows of a bucket that are held before its most frequent seeds are passed on
PIECE = 1 << 16           # rows of common seeds in one piece
BUCKETS = 4               # per shuffle partition
SENT = 50_000             # chains whose places are sent to all executors at once, at most
CHAIN_ROWS = 1000         # texts whose matches are chained at once
BATCH_ROWS = 64           # texts, or pieces of a bucket, that a task is given at once
SHORT, LONG, TEXTS = 0, 1, 4   # kinds of rows that are dealt out; SPREAD + kind: common seeds
SPREAD = 2
MARK = -1                 # in the place of a seed's place: it is common elsewhere

_MATCHES = pa.schema([("s", pa.int64()), ("ord", pa.int64()), ("x", pa.int64()), ("px", pa.int64()),
                      ("y", pa.int64()), ("py", pa.int64())])
_MET = pa.schema([("kind", pa.int32()), *_MATCHES])
_MET_DDL = "kind int, s long, ord long, x long, px long, y long, py long"
_BLOBS = pa.schema([("bucket", pa.int32()), ("rows", pa.binary())])
_LAST = (1 << 63) - 1
FIRST = -(1 << 63)        # kinds of matches, in the place of an order
BEFORE = FIRST + 1


def _leftmost(h: np.ndarray, window: int) -> np.ndarray:
    """Place of the leftmost minimum of the ``window`` hashes from each on."""
    best, width = np.arange(len(h)), 1
    while width < window:
        step = min(width, window - width)
        n = len(h) - step
        less = h[step:] < h[:n]
        h, best = np.where(less, h[step:], h[:n]), np.where(less, best[step:], best[:n])
        width += step
    return best


def minimizers(h: np.ndarray, window: int) -> np.ndarray:
    """Positions of the leftmost minimum of every ``window`` successive hashes
    (of all, if there are fewer)."""
    return _thinned(h, np.zeros(1, np.int64), np.array([len(h)]), window)


def _thinned(h: np.ndarray, first: np.ndarray, end: np.ndarray, window: int) -> np.ndarray:
    """``minimizers`` of many texts, whose hashes are those from ``first`` to
    before ``end``."""
    n = end - first
    long = n > window
    out = []
    if long.any():
        best = _leftmost(h, window)[concat_ranges(first[long], n[long] - window + 1)]
        out.append(best[np.append(True, best[1:] != best[:-1])])
    few = np.flatnonzero((n > 0) & ~long)
    out.append(np.array([a + int(h[a:b].argmin()) for a, b in zip(first[few].tolist(), end[few].tolist())], np.int64))
    return np.sort(np.concatenate(out))


def _told_apart(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Word hashes in which a word that repeats at once counts its repeats, so
    that the seeds inside such a run differ and ascend in every text."""
    if not len(h):
        return h
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[bounds[:-1][bounds[:-1] < len(h)]] = True
    start = np.flatnonzero(new)
    nth = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
    return h + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _seeds(k: int, window: int, n: int, around: int):
    """From rows (doc_id, ord, cls, text): rows of each text with its number of
    words, its seeds of ``k`` words and its long ones of ``n`` words."""
    def run(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids = batch.column(0)
        known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        ords, classes = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for lo, hi, data, offs in rows_of(batch):
            h, begin, _, bounds = words(data, offs)
            first, end = bounds[:-1], bounds[1:]
            yield TEXTS, known[lo:hi], ids[lo:hi], classes[lo:hi], end - first
            if not len(h):
                continue
            for kind, grams, size, step in ((SHORT, ngrams(_told_apart(h, bounds), k), k, window),
                                            (LONG, _long_grams(h, bounds, n), n, around)):
                m = _thinned(grams, first, end - size + 1, step)
                of = np.searchsorted(end, m, side="right")
                yield (kind, grams[m].view(np.int64), ords[lo + of], classes[lo + of],
                       ((m - first[of]) << 32) | (begin[m] - offs[of]))
    return run


def _long_grams(h: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on; those of one repeated word
    are told apart and the greatest, so that others are seeds before them."""
    told = _told_apart(h, bounds)
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[1:] != h[:-1]
    start = np.flatnonzero(fresh)
    left = np.repeat(np.append(start[1:], len(h)), np.diff(np.append(start, len(h)))) - np.arange(len(h))
    return np.where(left >= n, ngrams(told, n) | np.uint64(1 << 63), ngrams(h, n) >> np.uint64(1))


def _windows(n: int, around: int):
    """Seeds of all ``n``-word windows that begin at a given word or up to
    ``around`` - 1 words before it; from rows (ord, cls, places, text)."""
    def run(batch: pa.RecordBatch) -> Iterator[tuple]:
        ords, classes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for lo, hi, data, offs in rows_of(batch):
            h, begin, _, bounds = words(data, offs)
            if not len(h):
                continue
            grams = _long_grams(h, bounds, n)
            for i in range(hi - lo):
                a, b = int(bounds[i]), int(bounds[i + 1])
                at = np.asarray(batch.column(2)[lo + i].values.to_numpy())
                m = np.unique((at[:, None] - np.arange(around)).ravel())
                m = m[(m >= 0) & (m <= b - a - n)]
                if len(m):
                    yield (SHORT, grams[a + m].view(np.int64), np.full(len(m), ords[lo + i]),
                           np.full(len(m), classes[lo + i]), (m << 32) | (begin[a + m] - offs[i]))
    return run


def _dealt(seeds, buckets: int):
    """From texts: pieces (bucket, rows) of their seeds, each bucket of which
    holds all that are equal; of a seed that is common among those at hand
    only a mark, and its rows in pieces spread over all buckets."""
    def pieces(bucket: np.ndarray, rows: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        raw = [None, pa.py_buffer((cuts * 32).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))]
        return as_batch(_BLOBS, bucket, pa.Array.from_buffers(pa.binary(), len(cuts) - 1, raw))

    def spread(kind: int, rows: np.ndarray, turn: int) -> pa.RecordBatch:
        cuts = np.append(np.arange(0, len(rows), PIECE), len(rows))
        return pieces(kind * buckets + (turn + np.arange(len(cuts) - 1)) % buckets, rows, cuts)

    def deal(kind: int, rows: np.ndarray, turn: int) -> Iterator[pa.RecordBatch]:
        if kind == TEXTS:
            yield spread(kind, rows, turn)
            return
        # minimizers are small hashes: their leading bits say little
        key = rows[:, 0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        rows, common = _frequent(rows[np.argsort(key)], COMMON)
        if len(common):
            yield spread(SPREAD + kind, common, turn)
        key = rows[:, 0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        yield pieces(kind * buckets + bucket[first].astype(np.int64), rows, np.append(first, len(rows)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        sizes: dict[int, int] = {}
        turn = 0
        for batch in it:
            for kind, *cols in seeds(batch):
                held.setdefault(kind, []).append(np.stack(cols, 1, dtype=np.int64))
                sizes[kind] = sizes.get(kind, 0) + len(cols[0])
                if sizes[kind] >= DEALT:
                    turn += 1
                    yield from deal(kind, np.concatenate(held.pop(kind)), turn)
                    sizes[kind] = 0
        for kind, rows in held.items():
            if sizes[kind]:
                yield from deal(kind, np.concatenate(rows), int(rows[0][0, 2]) if len(rows[0]) else turn)
    return run


def _frequent(rows: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by seed, with a mark in place of those that come ``least``
    times, and these."""
    start = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
    times = np.diff(np.append(start, len(rows)))
    common = times >= least
    out = np.repeat(common, times)
    gone = rows[out]
    out[start[common]] = False
    rows[start[common], 3] = MARK
    return rows[~out], gone[gone[:, 3] != MARK]


def _settled(buckets: int, open_over: int | None):
    """From pieces sorted by bucket: ``_MET`` rows.  Seeds that are common in
    some task's texts are passed on as they are, with ``MARK`` in y."""
    def whole(bucket: int, held: list) -> Iterator[pa.RecordBatch]:
        kind = bucket // buckets
        rows = np.concatenate([np.frombuffer(x, np.int64) for x in held]).reshape(-1, 4)
        none = lambda n: pa.nulls(n, pa.int64())
        if kind == TEXTS:
            n = len(rows)
            yield as_batch(_MET, np.full(n, kind), none(n), none(n), rows[:, 2], rows[:, 3],
                           pa.array(rows[:, 1], mask=rows[:, 0] == 0), none(n))
            return
        if kind < SPREAD:
            rows = rows[np.argsort(rows[:, 0])]
            same = rows[1:, 0] == rows[:-1, 0]
            rows = rows[np.append(False, same) | np.append(same, False)]
            if not len(rows):
                return
            s, o, c, at = (np.ascontiguousarray(x) for x in rows.T)
            order = np.lexsort((at, c, o, s))
            s, o, c, at = s[order], o[order], c[order], at[order]
            start = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            marked = np.repeat(np.logical_or.reduceat(at == MARK, start), np.diff(np.append(start, len(s))))
            cols = [x[~marked] for x in (s, o, c, at)]
            if len(cols[0]):
                for part in _settle(cols, False, open_over if kind == LONG else None):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, kind, np.int32)), *part.columns],
                                                     schema=_MET)
            marked &= at != MARK
            rows = np.stack([s[marked], o[marked], c[marked], at[marked]], 1)
        if len(rows):
            n = len(rows)
            yield as_batch(_MET, np.full(n, kind % SPREAD), *(rows[:, i] for i in range(4)), np.full(n, MARK), none(n))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        now, size, most = None, 0, CROWDED
        for batch in it:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                if held and (bucket != now or now // buckets not in (SHORT, LONG) and size >= CROWDED):
                    yield from whole(now, held)
                    held, size, most = [], 0, CROWDED
                now = bucket
                held.append(batch.column(1)[i].as_buffer())
                size += len(held[-1]) // 32
                if size >= most and now // buckets in (SHORT, LONG):
                    rows = np.concatenate([np.frombuffer(x, np.int64) for x in held]).reshape(-1, 4)
                    held.clear()
                    rows, out = _frequent(rows[np.argsort(rows[:, 0])], CROWDED // 8)
                    if len(out):
                        yield from whole(now + SPREAD * buckets, [out.tobytes()])
                    held, size = [rows.tobytes()], len(rows)
                    most = max(CROWDED, 2 * size)
        if held:
            yield from whole(now, held)
    return run


def _settle(cols: list[np.ndarray], edge: bool, open_over: int | None) -> Iterator[pa.RecordBatch]:
    """Matches of sorted seeds; ``edge``: one seed that may go on elsewhere."""
    s, o, c, at = cols
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    start = np.flatnonzero(new)
    head = np.repeat(start, np.diff(np.append(start, len(s))))
    before = np.arange(len(s)) - 1
    none = lambda n: pa.nulls(n, pa.int64())
    if edge:
        # one seed; its first occurrence may be elsewhere, and what stands
        # before the first row here: y marks the first and the last row
        ends = np.zeros(len(s), np.int64)
        ends[0] |= 1
        ends[-1] |= 2
        yield as_batch(_MATCHES, s, o, c, at, ends, none(len(s)))
        rows = c != c[before]
        rows[0] = False
        if rows.any():
            # the first occurrence's class is settled with the seed's head
            yield as_batch(_MATCHES, s[rows], np.full(int(rows.sum()), BEFORE), c[rows], at[rows], c[before[rows]],
                           at[before[rows]])
        return
    to_first = c != c[head]
    if open_over is not None:
        times = np.diff(np.append(start, len(s)))
        many = np.repeat(times > open_over, times)
        if many.any():
            yield as_batch(_MATCHES, s[many], o[many], c[many], at[many], none(int(many.sum())), none(int(many.sum())))
        to_first &= ~many
    # the one before, where it is another text than both
    to_before = to_first & (c != c[before]) & (c[before] != c[head])
    for rows, other, kind in ((to_first, head, FIRST), (to_before, before, BEFORE)):
        if rows.any():
            n = int(rows.sum())
            yield as_batch(_MATCHES, none(n), np.full(n, kind), c[rows], at[rows], c[other[rows]], at[other[rows]])


def _matches(open_over: int | None = None):
    """``_matched``; seeds of over ``open_over`` occurrences are passed on too."""
    return lambda it: _matched(it, open_over)


def _matched(it: Iterator[pa.RecordBatch], open_over: int | None) -> Iterator[pa.RecordBatch]:
    """From seeds sorted by (s, ord, cls, at): matches (null, kind, x, px, y,
    py).  Seeds that may go on in other partitions are passed on, with their
    hash and order, to be matched afterwards, beside their matches with the
    one before."""
    held: list[tuple] = []
    first = None

    def flush(edge: bool) -> Iterator[pa.RecordBatch]:
        yield from _settle([np.concatenate(x) for x in zip(*held)], edge, open_over)
        held.clear()

    for batch in it:
        cols = [batch.column(i).to_numpy() for i in range(4)]
        s = cols[0]
        if not len(s):
            continue
        if first is None:
            first = s[0]
        cut = int(np.searchsorted(s, s[-1]))
        if cut or (held and held[0][0][0] != s[0]):
            # what is held and what comes before the batch's last seed is whole
            head = [c[:cut] for c in cols]
            if held and (not cut or held[0][0][0] != head[0][0]):
                yield from flush(held[0][0][0] == first)
            if cut:
                if held:
                    head = [np.concatenate([*h, c]) for h, c in zip(zip(*held), head)]
                    held.clear()
                lead = int(np.searchsorted(head[0], first, side="right")) if head[0][0] == first else 0
                if lead:
                    yield from _settle([c[:lead] for c in head], True, open_over)
                if lead < len(head[0]):
                    yield from _settle([c[lead:] for c in head], False, open_over)
        held.append(tuple(c[cut:] for c in cols))
        if sum(len(h[0]) for h in held) > CROWD:     # a very common seed goes out as it comes
            first = held[0][0][0]
            yield from flush(True)
    if held:
        yield from flush(True)


# ------------------------------------------------------------------- chaining

def chain(x: np.ndarray, y: np.ndarray, gain: float, cost: float = GAP_COST, gap: int = GAP) -> list[np.ndarray]:
    """Chains (indices of matches at positions x, y, sorted by x then y) of
    best score: ``gain`` for each match, ``cost`` for each word of gap."""
    out = []
    left = np.arange(len(x))
    while len(left):
        px, py = x[left], y[left]
        dx, dy = np.diff(px), np.diff(py)
        if (dx > 0).all() and (dy > 0).all() and (cost * (dx + dy) < gain).all():
            best = np.arange(len(left))              # every match improves the chain
        else:
            best = _best_chain(px, py, gain, cost)
        cuts = np.flatnonzero((np.diff(px[best]) > gap) | (np.diff(py[best]) > gap)) + 1
        for part in np.split(best, cuts):
            if len(part):
                out.append(left[part])
        left = np.delete(left, best)
    return out


def _best_chain(x: np.ndarray, y: np.ndarray, gain: float, cost: float) -> np.ndarray:
    """One best chain.  A predecessor at (x', y') is worth its score less
    cost * ((x - x') + (y - y')), so score + cost * (x' + y') decides, and the
    maximum over smaller y' comes from a Fenwick tree, over smaller x' from
    the order of insertion."""
    ys = np.unique(y)
    rank = (np.searchsorted(ys, y) + 1).tolist()
    n = len(ys)
    tree = [(-np.inf, -1)] * (n + 1)
    score, back = [0.0] * len(x), [-1] * len(x)
    xs, yl = x.tolist(), y.tolist()
    waiting: list[int] = []
    for i in range(len(xs)):
        if waiting and xs[waiting[0]] < xs[i]:
            for j in waiting:                        # now at a smaller x
                worth = (score[j] + cost * (xs[j] + yl[j]), j)
                r = rank[j]
                while r <= n:
                    if worth > tree[r]:
                        tree[r] = worth
                    r += r & -r
            waiting = []
        top = (-np.inf, -1)
        r = rank[i] - 1
        while r:
            if tree[r] > top:
                top = tree[r]
            r -= r & -r
        from_there = top[0] - cost * (xs[i] + yl[i])
        score[i] = gain + max(0.0, from_there)
        back[i] = top[1] if from_there > 0 else -1
        waiting.append(i)
    i = int(np.argmax(score))
    path = []
    while i >= 0:
        path.append(i)
        i = back[i]
    return np.array(path[::-1])


_CHAINS = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("bx", pa.int64()), ("ex", pa.int64()), ("by", pa.int64()),
                     ("ey", pa.int64()), ("ax", pa.list_(pa.int64())), ("ay", pa.list_(pa.int64()))])
_CHAINS_DDL = "x long, y long, bx long, ex long, by long, ey long, ax array<long>, ay array<long>"


def _own(x: np.ndarray, y: np.ndarray, strong: np.ndarray, parts: list[np.ndarray], min_words: int) -> list[np.ndarray]:
    """Chains of the matches of long grams that lie on one diagonal, but for
    those that are in one of ``parts`` which stays on it there."""
    at = np.flatnonzero(strong)
    if not len(at):
        return []
    at = at[np.lexsort((x[at], y[at] - x[at]))]
    cuts = np.flatnonzero((np.diff(y[at] - x[at]) != 0) | (np.diff(x[at]) > min_words)) + 1
    part_of = np.full(len(x), -1)
    for i, p in enumerate(parts):
        part_of[p] = i
    out = []
    for group in np.split(at, cuts):
        p = parts[part_of[group[0]]]                 # a strong match is in some part
        near = p[(x[p] > x[group[0]] - min_words) & (x[p] < x[group[-1]] + min_words)]
        if (part_of[group] != part_of[group[0]]).any() or (y[near] - x[near] != y[group[0]] - x[group[0]]).any():
            out.append(group)
    return out


def _chains(k: int, min_words: int, put_off: bool):
    """From all matches of a text: its chains.  Where many places of it match
    few of another's, as in runs of a few words that come again and again, one
    of each ``min_words`` words is chained first.  All go out again without
    ends: ``put_off`` until it is known which words passages cover."""
    low = (1 << 32) - 1

    def of_pair(x: int, y: int, a: np.ndarray, b: np.ndarray, strong: np.ndarray) -> Iterator[tuple]:
        if put_off and len(a) >= 32 and len(a) >= 4 * len(np.unique(b)):
            order = np.lexsort((a, b))               # a few places in the other text
            word, to = a[order] >> 32, b[order]
            start = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            part = (word - np.repeat(word[start], np.diff(np.append(start, len(to))))) // min_words
            keep = np.zeros(len(a), bool)
            keep[order[np.append(True, (to[1:] != to[:-1]) | (part[1:] != part[:-1]))]] = True
            yield x, y, None, None, None, None, a | np.where(strong, STRONG, 0), b
            a, b, strong = a[keep], b[keep], strong[keep]
        parts = [p for p in chain(a >> 32, b >> 32, float(k)) if len(p) > 1 or strong[p].any()]
        for part in parts + _own(a >> 32, b >> 32, strong, parts, min_words):
            ca, cb = a[part], b[part]
            yield x, y, ca[0] & low, ca[-1] & low, cb[0] & low, cb[-1] & low, ca, cb

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            xs, lists = batch.column(0).to_pylist(), batch.column(1)
            y, a, b = (lists.flatten().field(i).to_numpy() for i in range(3))
            row = np.repeat(np.arange(len(xs)), lists.value_lengths().to_numpy())
            strong = a >= STRONG
            a = a & (STRONG - 1)
            order = np.lexsort((~strong, b, a, y, row))
            row, y, a, b, strong = (c[order] for c in (row, y, a, b, strong))
            pair = np.append(True, (row[1:] != row[:-1]) | (y[1:] != y[:-1]))
            new = pair | np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            row, y, a, b, strong, pair = (c[new] for c in (row, y, a, b, strong, pair))
            start = np.flatnonzero(pair)
            times = np.diff(np.append(start, len(a)))
            # one match of a short seed alone is no chain
            good = np.flatnonzero((times > 1) | np.logical_or.reduceat(strong, start)) if len(a) else start
            out: list[tuple] = []
            for lo, n in zip(start[good].tolist(), times[good].tolist()):
                out += of_pair(xs[row[lo]], int(y[lo]), a[lo:lo + n], b[lo:lo + n], strong[lo:lo + n])
            if out:
                yield as_batch(_CHAINS, *map(list, zip(*out)))
    return run


# ------------------------------------------------------------------ alignment

_NOWHERE = np.zeros(0, np.int64)


def _blocks(hx: np.ndarray, hy: np.ndarray, ax: np.ndarray, ay: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(x, y, words) of the equal runs that a chain's matches make up: those
    on one diagonal between which all words are equal are one run."""
    cuts = np.flatnonzero(np.diff(ax) != np.diff(ay)) + 1
    out = []
    for g in np.split(np.arange(len(ax)), cuts):
        x, y = int(ax[g[0]]), int(ay[g[0]])
        n = int(ax[g[-1]]) + k - x
        differ = np.concatenate([[0], np.cumsum(hx[x:x + n] != hy[y:y + n])])
        at = ax[g] - x
        # words between a match's end and the next match that differ
        new = np.flatnonzero(differ[at[1:]] > differ[np.minimum(at[:-1] + k, at[1:])]) + 1
        first = np.concatenate([[0], new])
        last = np.concatenate([new - 1, [len(g) - 1]])
        out += [(x + a, y + a, b + k - a) for a, b in zip(at[first].tolist(), at[last].tolist())]
    return out


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of a longest common subsequence."""
    m = min(len(a), len(b))
    if not m:
        return _NOWHERE, _NOWHERE
    differ = np.flatnonzero(a[:m] != b[:m])
    head = int(differ[0]) if len(differ) else m      # equal ends always belong to one
    ra, rb = a[head:][::-1], b[head:][::-1]
    m = min(len(ra), len(rb))
    differ = np.flatnonzero(ra[:m] != rb[:m])
    tail = int(differ[0]) if len(differ) else m
    u, v = a[head:len(a) - tail], b[head:len(b) - tail]
    rows = [np.zeros(len(v) + 1, np.int64)]
    for w in u.tolist():
        row = rows[-1].copy()
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (v == np.uint64(w))))
        rows.append(row)
    i, j = len(u), len(v)
    x, y = [], []
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            x.append(head + i)
            y.append(head + j)
    ends = np.arange(tail)
    return (np.concatenate([np.arange(head), np.array(x[::-1], np.int64), len(a) - tail + ends]),
            np.concatenate([np.arange(head), np.array(y[::-1], np.int64), len(b) - tail + ends]))


def _before_drop(equal: np.ndarray, drop: int = 8) -> int:
    """Words until an ungapped extension is given up."""
    score = np.cumsum(np.where(equal, 1, -2))
    over = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > drop)
    return int(over[0]) if len(over) else len(equal)


def _reach(equal: np.ndarray) -> tuple[int, int]:
    """(words, equal words) of the best ungapped extension."""
    score = np.cumsum(np.where(equal[:_before_drop(equal)], 1, -2))
    if not len(score) or score.max() <= 0:
        return 0, 0
    n = int(score.argmax()) + 1
    return n, int(equal[:n].sum())


def _aligned(hx: np.ndarray, hy: np.ndarray, ax: np.ndarray, ay: np.ndarray, k: int
             ) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Places in x and in y of the equal words around a chain of matches of
    ``k`` words at word positions ax, ay, as far as the extensions went; and
    the first and the last of them within the best extensions."""
    i, j = int(ax[0]), int(ay[0])                    # aligned up to here
    a, b = i, j
    n = min(a, b)
    equal = (hx[a - n:a] == hy[b - n:b])[::-1]
    left = np.flatnonzero(equal[:_before_drop(equal)])[::-1] + 1
    first = len(left) - _reach(equal)[1]
    xs, ys = [a - left], [b - left]
    for a, b, n in _blocks(hx, hy, ax, ay, k):
        step = max(i - a, j - b, 0)                  # this run may overlap the last one
        if step >= n:
            continue
        a, b, n = a + step, b + step, n - step
        u, v = _common(hx[i:a], hy[j:b])
        xs += [i + u, np.arange(a, a + n)]
        ys += [j + v, np.arange(b, b + n)]
        i, j = a + n, b + n
    n = min(len(hx) - i, len(hy) - j)
    equal = hx[i:i + n] == hy[j:j + n]
    right = np.flatnonzero(equal[:_before_drop(equal)])
    x, y = np.concatenate([*xs, i + right]), np.concatenate([*ys, j + right])
    return x, y, first, len(x) - 1 - (len(right) - _reach(equal)[1])


def align(hx: np.ndarray, hy: np.ndarray, ax: np.ndarray, ay: np.ndarray, k: int) -> tuple[int, int, int, int, int]:
    """(first x, end x, first y, end y, equal words) of the passage around a
    chain of matches of ``k`` words at word positions ax, ay."""
    x, y, a, b = _aligned(hx, hy, ax, ay, k)
    return int(x[a]), int(x[b]) + 1, int(y[a]), int(y[b]) + 1, b - a + 1


def stretches(x: np.ndarray, y: np.ndarray, min_words: int, identity: float, k: int = SOLID,
              core: tuple[int, int] | None = None) -> list[tuple[int, int]]:
    """(first, last) of the equal words at places x, y between which a passage
    lies: ``core`` (or all of them) if that is one, else stretches of at least ``min_words``
    words in both texts with ``identity``, in which every longest such stretch
    is covered.  What follows the last (precedes the first) ``k`` successive
    equal words of a stretch ends as an extension does."""
    def good(a, b):
        nx, ny = x[b] - x[a] + 1, y[b] - y[a] + 1
        return (np.minimum(nx, ny) >= min_words) & (b - a + 1 >= identity * np.maximum(nx, ny))

    n = len(x)
    core = core or (0, n - 1)
    if good(*core):
        return [core]
    if n < identity * min_words:
        return []
    cols = np.concatenate([[0], np.cumsum(np.maximum(np.diff(x), np.diff(y)))])
    worth = np.arange(n) - identity * cols
    # the furthest end of each start: the best worth from there on suffices
    after = np.maximum.accumulate(worth[::-1])       # over the last 1, 2, ... words
    last = n - 1 - np.searchsorted(after, worth - (1 - identity) - 1e-9)
    longest = np.ones(n, bool)
    longest[1:] = last[1:] > np.maximum.accumulate(last)[:-1]
    first = np.flatnonzero(longest)
    last = last[first]
    fits = good(first, last)
    step = np.diff(cols) == 1
    found = sorted({_trimmed(cols, step, a, b, k, lambda a, b: bool(good(a, b)))
                    for a, b in zip(first[fits].tolist(), last[fits].tolist())})
    out: list[tuple[int, int]] = []
    at = 0
    while at < len(found):
        reach = out[-1][1] if out else -1
        # of those that go on from the last one, the one that ends last
        start = max(reach + 1, found[at][0])
        best = (0, reach)
        while at < len(found) and found[at][0] <= start:
            best = max(best, found[at], key=lambda f: f[1])
            at += 1
        if best[1] > reach:
            out.append(best)
    return out


def _trimmed(cols: np.ndarray, step: np.ndarray, a: int, b: int, k: int, good) -> tuple[int, int]:
    """The stretch a..b without ends of fewer than two equal words in three."""
    run = np.convolve(step[a:b], np.ones(k - 1, np.int64), "valid") == k - 1 if b - a >= k - 1 else np.zeros(0, bool)
    solid = np.flatnonzero(run)
    if not len(solid):
        return a, b
    lo, hi = a + int(solid[0]), a + int(solid[-1]) + k - 1
    score = 3 * np.arange(len(cols)) - 2 * cols      # +1 an equal word, -2 another
    end = hi + int(np.argmax(score[hi:b + 1]))
    start = a + int(np.argmin(score[a:lo + 1]))
    return (start, end) if good(start, end) else (a, b)


_SPANS = pa.schema([(n, pa.int64()) for n in ("x", "y", "x_word", "x_words", "x_byte", "x_bytes",
                                              "y_word", "y_words", "y_byte", "y_bytes")]
                   + [("identity", pa.float64()), ("chain", pa.int64())])
_SPANS_DDL = ("x long, y long, x_word long, x_words long, x_byte long, x_bytes long, y_word long, y_words long, "
              "y_byte long, y_bytes long, identity double, chain long")


def _align(k: int, min_words: int, identity: float):
    def sides(column: pa.Array):
        """Word hashes and byte ranges of the cut-outs of a batch, in one go;
        then of one of them, and the places of its matches."""
        raw = column.cast(pa.large_binary())
        offs = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2], np.uint8)[offs[0]:offs[-1]] if offs[-1] else np.zeros(0, np.uint8)
        offs = offs - offs[0]
        hashes, begins, ends, bounds = words(data, offs)
        offs, bounds = offs.tolist(), bounds.tolist()

        def side(r: int, lo: int, whole: bool, at: np.ndarray) -> tuple:
            i, j, size = bounds[r], bounds[r + 1], offs[r + 1] - offs[r]
            # a word at a cut may have been cut
            i += int(lo > 0 and j > i and begins[i] == offs[r])
            j -= int(not whole and j > i and ends[j - 1] == offs[r] + size)
            begin = begins[i:j] + (lo - offs[r])
            return hashes[i:j], begin, ends[i:j] + (lo - offs[r]), np.searchsorted(begin, at & ((1 << 32) - 1))

        return side

    def open_end(hx: np.ndarray, hy: np.ndarray, i: int, j: int, x_whole: bool, y_whole: bool) -> bool:
        """Do the cut-outs end before the extension from i, j does?"""
        m, n = len(hx) - i, len(hy) - j
        if (x_whole and m <= n) or (y_whole and n <= m):
            return False
        m = min(m, n)
        return m < 0 or _before_drop(hx[i:i + m] == hy[j:j + m]) == m

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = []
            if not batch.num_rows:
                continue
            plain = list(zip(*(batch.column(i).to_pylist() for i in range(7))))
            at_x, at_y = (batch.column(i).flatten().to_numpy() for i in (7, 8))
            cuts = np.concatenate([[0], np.cumsum(batch.column(7).value_lengths().to_numpy())]).tolist()
            size = np.cumsum(sum(pc.binary_length(batch.column(i)).to_numpy().astype(np.int64) for i in (9, 10)))
            upto = 0
            for r, (name, x, y, lx, ly, x_whole, y_whole) in enumerate(plain):
                if r == upto:                        # the next rows of at most WORD_BYTES
                    lo = r
                    upto = max(r + 1, int(np.searchsorted(size, (size[r - 1] if r else 0) + WORD_BYTES, side="right")))
                    side_x, side_y = (sides(batch.column(i).slice(lo, upto - lo)) for i in (9, 10))
                ax, ay = at_x[cuts[r]:cuts[r + 1]], at_y[cuts[r]:cuts[r + 1]]
                hx, bx, ex, px = side_x(r - lo, lx, x_whole, ax)
                hy, by, ey, py = side_y(r - lo, ly, y_whole, ay)
                if (open_end(hx, hy, int(px[-1]) + k, int(py[-1]) + k, x_whole, y_whole)
                        or open_end(hx[::-1], hy[::-1], len(hx) - int(px[0]), len(hy) - int(py[0]), lx == 0, ly == 0)):
                    out.append((None,) * 11 + (name,))
                    continue
                u, v, *core = _aligned(hx, hy, px, py, k)
                for a, b in stretches(u, v, min_words, identity, core=tuple(core)):
                    fx, tx, fy, ty = int(u[a]), int(u[b]) + 1, int(v[a]), int(v[b]) + 1
                    wx, wy = int(ax[0] >> 32) - int(px[0]) + fx, int(ay[0] >> 32) - int(py[0]) + fy
                    out.append((x, y, wx, tx - fx, bx[fx], ex[tx - 1] - bx[fx], wy, ty - fy, by[fy],
                                ey[ty - 1] - by[fy], (b - a + 1) / max(tx - fx, ty - fy), None))
            if out:
                yield as_batch(_SPANS, *map(list, zip(*out)))
    return run


# ------------------------------------------------------------------ the search

def _named(df: DataFrame, text_col: str, name: str = "cls", hash_of=F.xxhash64) -> DataFrame:
    """``df`` with the class of its text: a 64-bit hash.  Of unequal texts of
    one hash, found by their 128-bit hashes, one keeps it and the others are
    named by a hash of the longer one; there are next to none at any size."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    both = df.select(hash_of(text).alias("__h"), F.md5(text.cast("binary")).alias("__m"))
    clash = written(both.groupBy("__h").agg(F.min("__m").alias("__one"), F.max("__m").alias("__other"))
                    .filter("__one <> __other").select("__h", "__one"), "clashes")
    if clash.isEmpty():
        return df.withColumn(name, hash_of(text))
    keyed = df.withColumns({"__h2": hash_of(text), "__m": F.md5(text.cast("binary"))})
    keyed = keyed.join(clash, keyed["__h2"] == clash["__h"], "left")
    other = F.col("__one").isNotNull() & (F.col("__one") != F.col("__m"))
    return keyed.withColumn(name, F.when(other, F.xxhash64("__m", F.lit("again"))).otherwise(F.col("__h2"))).drop(
        "__h", "__h2", "__m", "__one")


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, cls of documents with ``__cls``."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), F.col("__cls").alias("cls"))


def _met(rows: DataFrame, seeds, name: str, kinds: tuple[int, ...], open_over: int | None = None
         ) -> tuple[DataFrame, dict[int, DataFrame]]:
    """All ``_MET`` rows, and by kind (s, ord, x, px, y, py) of the seeds that
    met or were passed on.  Equal seeds meet in a bucket, and those that are
    common by sort order, cut over several tasks."""
    buckets = BUCKETS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = written(rows.mapInArrow(_dealt(seeds, buckets), "bucket int, rows binary")
                  .repartition("bucket").sortWithinPartitions("bucket")
                  .mapInArrow(_settled(buckets, open_over), _MET_DDL), name, batch_rows=BATCH_ROWS)
    out = {}
    for kind in kinds:
        own = met.filter(F.col("kind") == kind).drop("kind")
        common = own.filter((F.col("y") == MARK) & F.col("s").isNotNull()).select(
            "s", "ord", F.col("x").alias("cls"), F.col("px").alias("at"))
        out[kind] = own.filter("s IS NULL OR y IS NULL")
        if not common.isEmpty():
            keys = ["s", "ord", "cls", "at"]
            out[kind] = out[kind].unionByName(written(
                common.repartitionByRange(*keys).sortWithinPartitions(*keys)
                .mapInArrow(_matches(open_over if kind == LONG else None),
                            "s long, ord long, x long, px long, y long, py long"), f"{name}-common"))
    return met, out


_MATCH = ["x", "px", "y", "py"]


def _passed_on(met: DataFrame) -> DataFrame:
    return met.filter(F.col("s").isNotNull() & (F.col("ord") > BEFORE))


def _firsts(met: DataFrame) -> DataFrame:
    """Matches with the first occurrence, also of seeds that were passed on."""
    rest = _passed_on(met).select("s", "ord", "x", "px")
    heads = rest.groupBy("s").agg(F.min(F.struct("ord", "x", "px")).alias("head"))
    late = (rest.join(heads, "s").filter(F.col("x") != F.col("head.x"))
            .select("x", "px", F.col("head.x").alias("y"), F.col("head.px").alias("py")))
    return met.filter(F.col("s").isNull() & (F.col("ord") == FIRST)).select(*_MATCH).unionByName(late)


def _befores(met: DataFrame) -> DataFrame:
    """Matches with the occurrence before, where it is of another text than
    the first.  At the cuts of the sort it is the last row of the piece
    before; a piece is a partition's, or ``CROWD`` rows."""
    rest = _passed_on(met)
    heads = rest.groupBy("s").agg(F.min(F.struct("ord", "x", "px")).alias("head")).select("s", F.col("head.x").alias("hx"))
    w = Window.partitionBy("s").orderBy("ord", "x", "px", F.desc("y"))
    ends = rest.filter("y > 0").select("s", "x", "px", F.col("y").alias("end"), F.lag("x").over(w).alias("y"),
                                       F.lag("px").over(w).alias("py"))
    over_cuts = ends.filter("(end & 1) = 1 AND y IS NOT NULL AND x <> y").select("s", *_MATCH)
    inside = met.filter(F.col("s").isNotNull() & (F.col("ord") == BEFORE)).select("s", *_MATCH)
    late = (over_cuts.unionByName(inside).join(heads, "s").filter("x <> hx AND y <> hx").select(*_MATCH))
    return met.filter(F.col("s").isNull() & (F.col("ord") == BEFORE)).select(*_MATCH).unionByName(late)


def _spans(d: DataFrame, *, k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS,
           identity: float = IDENTITY) -> tuple[DataFrame, DataFrame]:
    """One row per passage that two distinct texts share: x and y (the texts'
    hashes, y the one of the earlier document), the words and bytes that it
    covers in each, and the share of equal words.  Then doc_id, cls, n_words
    of every document."""
    order = F.coalesce("doc_id", F.lit(_LAST)).alias("ord")
    # exact repeats: long grams, and whole windows where those are common
    around = max(1, min(LONG_WINDOW, min_words // 3))
    sown, met = _met(d.select("doc_id", order, "cls", "text"), _seeds(k, window, min_words - around + 1, around),
                     "matches", (SHORT, LONG), 2)
    classes = written(sown.filter(F.col("kind") == TEXTS).select(
        F.col("y").alias("doc_id"), F.col("x").alias("cls"), F.col("px").alias("n_words")), "texts")
    places = _passed_on(met[LONG]).groupBy("x").agg(F.collect_set(F.shiftright("px", 32)).alias("places"))
    one = classes.groupBy("cls").agg(F.min("doc_id").alias("one")).withColumnRenamed("cls", "name")
    crowded = (places.join(one, places["x"] == one["name"])
               .join(d, (F.col("name") == d["cls"]) & F.col("one").eqNullSafe(d["doc_id"]))
               .select(order, "cls", "places", "text"))
    exact = _met(crowded, _windows(min_words, around), "windows", (SHORT,))[1][SHORT]
    strong = (met[LONG].filter(F.col("s").isNull() & (F.col("ord") == FIRST)).select(*_MATCH).unionByName(_firsts(exact))
              .withColumn("px", F.col("px").bitwiseOR(F.lit(STRONG))))

    def found(matches: DataFrame, put_off: bool) -> tuple[DataFrame, DataFrame]:
        by_text = matches.groupBy("x").agg(F.collect_set(F.struct("y", "px", "py")).alias("at"))
        made = written(by_text.mapInArrow(_chains(k, min_words, put_off), _CHAINS_DDL)
                       .withColumn("chain", F.monotonically_increasing_id()), "chains", batch_rows=CHAIN_ROWS)
        chains = made.filter("bx IS NOT NULL")
        later = made.filter("bx IS NULL").select("x", "y", "ax", "ay")
        # where an extension outruns the cut-outs, longer ones are taken
        out, todo, margin, few = None, chains, MARGIN_BYTES, SENT + 1
        while True:
            part = written(_cut_out(d, classes, todo, margin, few <= SENT).mapInArrow(_align(k, min_words, identity), _SPANS_DDL),
                           "passages", batch_rows=max(1, min(256, CUT_BYTES // margin)))
            good = part.filter("chain IS NULL").drop("chain")
            out = good if out is None else out.unionByName(good)
            again = part.filter("chain IS NOT NULL").select("chain")
            few = again.count()
            if not few:
                return out, later
            todo, margin = chains.join(again, "chain"), 64 * margin

    first, later = found(_firsts(met[SHORT]).unionByName(strong), True)
    rest = _uncovered(_befores(met[SHORT]), later, first, classes, k, min_words)
    return first.unionByName(found(rest, False)[0]), classes


def _uncovered(matches: DataFrame, later: DataFrame, spans: DataFrame, classes: DataFrame, k: int, min_words: int
               ) -> DataFrame:
    """The matches, and those in the lists of ``later``, whose words in x are
    in no passage that x has from an earlier text."""
    least = classes.groupBy("cls").agg(F.min("doc_id").alias("least"))
    covered = (spans.select("x", "y", "x_word", "x_words")
               .join(least.select(F.col("cls").alias("x"), F.col("least").alias("x_id")), "x")
               .join(least.select(F.col("cls").alias("y"), F.col("least").alias("y_id")), "y").filter(_later())
               .groupBy(F.col("x").alias("cx")).agg(F.collect_set(F.struct("x_word", "x_words")).alias("covered")))

    def free(px: Column) -> Column:
        at = F.shiftright(px.bitwiseAND(F.lit(STRONG - 1)), 32)
        n = F.when(px >= STRONG, min_words).otherwise(k)
        inside = F.exists("covered", lambda c: (c["x_word"] <= at) & (at + n <= c["x_word"] + c["x_words"]))
        return F.col("covered").isNull() | ~inside

    lists = later.join(covered, later["x"] == covered["cx"], "left").select(
        "x", "y", F.filter(F.arrays_zip("ax", "ay"), lambda p: free(p["ax"])).alias("left"))
    return (matches.join(covered, matches["x"] == covered["cx"], "left").filter(free(F.col("px"))).select(*_MATCH)
            .unionByName(lists.filter(F.size("left") > 0).select("x", "y", F.explode("left").alias("p"))
                         .select("x", F.col("p.ax").alias("px"), "y", F.col("p.ay").alias("py"))))


def _cut_out(d: DataFrame, classes: DataFrame, chains: DataFrame, margin: int, few: bool) -> DataFrame:
    """Both cut-outs of a chain, from one pass over the texts; to those the
    places of ``few`` chains are sent, else both are shuffled."""
    lo, hi = F.greatest(F.col("b") - margin, F.lit(0)), F.col("e") + margin
    wanted = chains.select("chain", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("x").alias("of"), F.col("bx").alias("b"), F.col("ex").alias("e")),
        F.struct(F.lit(1).alias("side"), F.col("y").alias("of"), F.col("by").alias("b"), F.col("ey").alias("e")),
    )).alias("w")).select("chain", "w.*").select("chain", "side", "of", lo.alias("lo"), hi.alias("hi"))
    # the text of a class is that of its first document
    one = classes.groupBy("cls").agg(F.min("doc_id").alias("one")).withColumnRenamed("cls", "name")
    wanted = wanted.join(one, wanted["of"] == one["name"])
    wanted = F.broadcast(wanted) if few else wanted
    texts = d.select("doc_id", "cls", F.col("text").cast("binary").alias("raw"))
    cut = (wanted.join(texts, (wanted["of"] == texts["cls"]) & wanted["one"].eqNullSafe(texts["doc_id"]))
           .select("chain", "side", "lo", (F.col("hi") >= F.length("raw")).alias("whole"),
                   F.substring("raw", (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int")).alias("raw")))
    both = cut.groupBy("chain").agg(*[F.max(F.when(F.col("side") == i, F.struct("lo", "whole", "raw"))).alias(n)
                                      for i, n in enumerate("uv")])
    return chains.select("chain", "x", "y", "ax", "ay").join(both, "chain").select(
        "chain", "x", "y", F.col("u.lo").alias("lx"), F.col("v.lo").alias("ly"), F.col("u.whole").alias("x_whole"),
        F.col("v.whole").alias("y_whole"), "ax", "ay", F.col("u.raw").alias("rx"), F.col("v.raw").alias("ry"))


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
            hash_of=F.xxhash64, **options) -> DataFrame:
    """doc_id, src_doc_id, start, n_words, src_start, src_words, identity: the
    passages (in words) that a document has from an earlier one.  A text that
    several documents have is reported for its first document; each further
    one is a copy of that as a whole."""
    prepare(docs)
    d = _identified(_named(docs, text_col, "__cls", hash_of), id_col, text_col)
    found, texts = _spans(d, min_words=min_words, **options)
    least = texts.groupBy("cls").agg(F.min("doc_id").alias("least"), F.min("n_words").alias("n"))
    first = found.join(least.select(F.col("cls").alias("x"), F.col("least").alias("x_id")), "x").join(
        least.select(F.col("cls").alias("y"), F.col("least").alias("y_id")), "y")
    later = _later()
    pick = lambda a, b: F.when(later, F.col(a)).otherwise(F.col(b))
    shared = first.select(
        pick("x_id", "y_id").alias("doc_id"), pick("y_id", "x_id").alias("src_doc_id"),
        pick("x_word", "y_word").alias("start"), pick("x_words", "y_words").alias("n_words"),
        pick("y_word", "x_word").alias("src_start"), pick("y_words", "x_words").alias("src_words"), "identity")
    whole = (texts.filter(F.col("n_words") >= min_words).join(least, "cls")
             .filter("NOT (doc_id <=> least)")
             .select("doc_id", F.col("least").alias("src_doc_id"), F.lit(0).cast("long").alias("start"), "n_words",
                     F.lit(0).cast("long").alias("src_start"), F.col("n_words").alias("src_words"),
                     F.lit(1.0).alias("identity")))
    return shared.unionByName(whole)


def _later() -> Column:
    """Does x come after y?  By the first ids, null last, then by text hash."""
    return F.struct(F.coalesce("x_id", F.lit(_LAST)), "x") > F.struct(F.coalesce("y_id", F.lit(_LAST)), "y")


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                    hash_of=F.xxhash64, **options) -> DataFrame:
    """``docs`` with every passage left in its earliest document only.  A
    document of which nothing but white space is left goes, and so do equal
    texts of ``min_words`` words or more after the first."""
    prepare(docs)
    named = _named(docs, text_col, "__cls", hash_of)
    d = _identified(named, id_col, text_col)
    found, texts = _spans(d, min_words=min_words, **options)
    least = texts.groupBy("cls").agg(F.min("doc_id").alias("least"), F.min("n_words").alias("n"),
                                     F.count("*").alias("docs"))
    placed = found.join(least.select(F.col("cls").alias("x"), F.col("least").alias("x_id")), "x").join(
        least.select(F.col("cls").alias("y"), F.col("least").alias("y_id")), "y")
    later = _later()
    drop = (placed.select(F.when(later, F.col("x")).otherwise(F.col("y")).alias("cls"),
                          F.when(later, F.struct(F.col("x_byte").alias("at"), F.col("x_bytes").alias("n")))
                          .otherwise(F.struct(F.col("y_byte").alias("at"), F.col("y_bytes").alias("n"))).alias("p"))
            .groupBy("cls").agg(F.sort_array(F.collect_set("p")).alias("passages")))
    plan = (least.join(drop, "cls", "left").filter((F.col("docs") > 1) | F.col("passages").isNotNull())
            .select(F.col("cls").alias("__of"), F.col("least").alias("__least"), F.col("n").alias("__n"),
                    F.col("passages").alias("__passages")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = named.withColumn("__text", text).join(plan, F.col("__cls") == F.col("__of"), "left")
    copy = (F.col("__n") >= min_words) & ~F.col(id_col).eqNullSafe(F.col("__least"))
    kept = keyed.filter(~F.coalesce(copy, F.lit(False))).withColumn("__new", _cut(F.col("__text"), F.col("__passages")))
    whole = F.col("__passages").isNull()
    out = kept.filter(whole | (F.length(F.trim(F.regexp_replace("__new", r"\s+", " "))) > 0))
    fresh = {text_col: F.when(whole, F.col(text_col)).otherwise(F.col("__new"))}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(whole, F.col("n_chars")).otherwise(
            F.char_length("__new")).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(fresh).select(*docs.columns)


def _cut(text: Column, passages: Column) -> Column:
    """The text without the byte ranges of ``passages`` (sorted by start);
    null, and no work, where there are none."""
    raw = text.cast("binary")
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<binary>").alias("parts"))

    def keep(done: Column, p: Column) -> Column:
        before = F.substring(raw, (done["at"] + 1).cast("int"), F.greatest(p["at"] - done["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(done["at"], p["at"] + p["n"]).alias("at"), F.concat(done["parts"], F.array(before)).alias("parts"))

    def whole(done: Column) -> Column:
        rest = F.substring(raw, (done["at"] + 1).cast("int"), F.length(raw))
        joined = F.aggregate(F.concat(done["parts"], F.array(rest)), F.lit("").cast("binary"), lambda a, b: F.concat(a, b))
        return joined.cast("string")

    return F.when(passages.isNotNull(), F.aggregate(passages, nothing, keep, whole))
