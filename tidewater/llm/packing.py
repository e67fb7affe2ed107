"""Best-fit packing of token pieces by the linear grouping scheme.

Every document is tokenised whole, followed by one end id, and cut only if it
is longer than a sequence: into pieces of ``capacity``, of which the first
may be shorter.  The number of pieces of each length (at most ``capacity``
numbers, whatever the corpus) is all the plan needs:

1. lengths above ``capacity // small_part`` are large; sorted, they are cut
   into ``groups`` groups of equal cardinality and rounded up to the longest
   of their group;
2. the few rounded sizes are a cutting-stock problem: its linear relaxation
   is solved by column generation (a knapsack prices new configurations) and
   each configuration is used the whole number of times it has;
3. the actual pieces take the rounded places, in order of length, but for
   the shortest place of each configuration, whose piece joins the rest;
4. the rest, the small ones above all, go longest first to the sequence with
   the least room that still fits, all pieces of one length at a time.

The plan is a list of runs "these pieces of this length start in these
sequences at this offset", a few thousand rows independent of the corpus,
which is broadcast; each piece finds its place by its rank among the pieces
of its length.  Ranks are counted per partition and offset by a prefix sum,
so no length, however common, meets in one task.

Defined cases: a null or empty text is a piece of the end id alone; repeated
and null ids are separate documents in input order; an empty table has no
sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import prepare, written
from .textkit import as_batch
from .tokens import default_path, encoded

CAPACITY = 2048
END_ID = 0
GROUPS = 80
SMALL_PART = 6

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())])
_PLACED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    first = length % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length in its
    partition."""
    prepare(docs)
    path = tokenizer or default_path()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in it:
            ids_of = batch.column(0).to_pylist()
            for lo, hi, ids, at in encoded(batch, path, end_id=end_id):
                raw = memoryview(ids.astype("<u4").tobytes())
                out: list[tuple] = []
                for i in range(hi - lo):
                    base = int(at[i])
                    for k, (s, n) in enumerate(cut(int(at[i + 1]) - base, capacity)):
                        a = 4 * (base + s)
                        out.append((ids_of[lo + i], k, s, n, zlib.crc32(raw[a:a + 4 * n]), part, int(seen[n])))
                        seen[n] += 1
                yield as_batch(_PIECES, *[list(c) for c in zip(*out)])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


# ------------------------------------------------------------------- the plan

def _best_configuration(sizes: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """Most valuable multiset of sizes that fits (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for c in range(int(sizes.min()), capacity + 1):
        ok = np.flatnonzero(sizes <= c)
        gain = best[c - sizes[ok]] + value[ok]
        k = int(gain.argmax())
        best[c] = best[c - 1]
        if gain[k] > best[c] + 1e-12:
            best[c], choice[c] = gain[k], ok[k]
    used = np.zeros(len(sizes))
    c = capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            used[choice[c]] += 1
            c -= int(sizes[choice[c]])
    return used


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 1500
                   ) -> list[tuple[np.ndarray, int]]:
    """(configuration, times) from the linear relaxation, rounded down."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(k))
        new = _best_configuration(sizes, np.maximum(price, 0), capacity)
        if price @ new <= 1 + 1e-7:
            break
        amount = np.linalg.solve(basis, demand.astype(float))
        change = np.linalg.solve(basis, new)
        ratio = np.where(change > 1e-9, np.maximum(amount, 0) / np.maximum(change, 1e-9), np.inf)
        basis[:, int(ratio.argmin())] = new
    amount = np.linalg.solve(basis, demand.astype(float))
    return [(basis[:, j].astype(int), int(np.floor(x + 1e-6))) for j, x in enumerate(amount) if x >= 1 - 1e-6]


def plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS, small_part: int = SMALL_PART,
         free: int = 1) -> np.ndarray:
    """Runs (length, first rank, number, first sequence, offset) that place
    ``counts[n]`` pieces of each length n."""
    runs: list[tuple[int, int, int, int, int]] = []
    left = counts.astype(np.int64).copy()
    taken = np.zeros(capacity + 1, np.int64)
    room: dict[int, list[tuple[int, int]]] = {}     # room left -> ranges of sequences
    bins = 0

    def place(n: int, number: int, first: int, offset: int) -> None:
        runs.append((n, int(taken[n]), number, first, offset))
        taken[n] += number
        left[n] -= number

    if left[capacity]:
        full = int(left[capacity])
        place(capacity, full, 0, 0)
        bins += full

    large = np.arange(capacity - 1, capacity // small_part, -1)
    large = large[left[large] > 0]
    if len(large):
        total = int(left[large].sum())
        edge = np.cumsum(left[large])
        # group of a piece: its rank among the large ones, longest first
        cuts = [round(total * g / groups) for g in range(groups + 1)]
        members: list[list[list[int]]] = []          # group -> [length, number], longest first
        at = 0
        for g in range(groups):
            need, group = cuts[g + 1] - cuts[g], []
            while need:
                done = cuts[g + 1] - need
                while edge[at] <= done:
                    at += 1
                t = min(need, int(edge[at]) - done)
                group.append([int(large[at]), t])
                need -= t
            if group:
                members.append(group)
        sizes = np.array([g[0][0] for g in members])
        demand = np.array([sum(t for _, t in g) for g in members])
        same: dict[int, list[int]] = {}
        for i, s in enumerate(sizes):
            same.setdefault(int(s), []).append(i)    # groups may round to one size
        uniq = np.array(sorted(same, reverse=True))
        stock = [[list(p) for i in same[int(s)] for p in members[i]] for s in uniq]
        for config, times in configurations(uniq, np.array([sum(int(demand[i]) for i in same[int(s)]) for s in uniq]),
                                            capacity):
            spots = [j for j, a in enumerate(config) for _ in range(a)]
            if len(spots) > free:
                spots = spots[:len(spots) - free]    # the shortest compete by best fit instead
            have = np.array([sum(t for _, t in s) for s in stock])
            times = min([times, *(int(have[j]) // int(a) for j, a in enumerate(config) if a)])
            if not spots or times <= 0:
                continue
            # each spot takes `times` pieces of its group, longest first
            lines = []
            for j in spots:
                line, need = [], times
                while need:
                    n, t = stock[j][0]
                    u = min(t, need)
                    line.append((n, u))
                    need -= u
                    stock[j][0][1] -= u
                    if not stock[j][0][1]:
                        stock[j].pop(0)
                lines.append(line)
            done = 0
            heads = [[0, line[0][1]] for line in lines]
            while done < times:
                step = min(h[1] for h in heads)
                offset = 0
                for line, h in zip(lines, heads):
                    n = line[h[0]][0]
                    place(n, step, bins + done, offset)
                    offset += n
                    h[1] -= step
                    if not h[1] and done + step < times:
                        h[0] += 1
                        h[1] = line[h[0]][1]
                room.setdefault(capacity - offset, []).append((bins + done, step))
                done += step
            bins += times

    for n in range(capacity, 0, -1):
        r = n
        while left[n]:
            while r <= capacity and not room.get(r):
                r += 1
            if r > capacity:                         # open what these pieces fill
                per = capacity // n
                number = -(-int(left[n]) // per)
                room.setdefault(capacity, []).append((bins, number))
                bins += number
                r = n
                continue
            first, number = room[r].pop()
            use = min(number, int(left[n]))
            place(n, use, first, capacity - r)
            room.setdefault(r - n, []).append((first, use))
            if number > use:
                room[r].append((first + use, number - use))
            if r - n >= n:
                r = n                                # the room that is left may be the best fit now
    out = np.array(runs, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


# --------------------------------------------------------------- placing them

def pack(docs: DataFrame, *, capacity: int = CAPACITY, groups: int = GROUPS, small_part: int = SMALL_PART,
         **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    spark = prepare(docs)
    cutted = written(pieces(docs, capacity=capacity, **options), "pieces")
    number = cutted.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in number.groupBy("length").agg(F.sum("n").alias("n")).collect():   # at most `capacity` rows
        counts[r["length"]] = r["n"]
    sent = spark.sparkContext.broadcast((plan(counts, capacity, groups, small_part), int(counts.max()) + 1))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = number.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cutted.join(base, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, span = sent.value
        key = runs[:, 0] * span + runs[:, 1]
        for batch in it:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            at = np.searchsorted(key, length * span + rank, side="right") - 1
            yield as_batch(_PLACED, *[batch.column(i) for i in range(5)],
                           runs[at, 3] + rank - runs[at, 1], runs[at, 4])

    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
            .mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                               "sequence_id long, offset long"))


def sequences(docs: DataFrame, placed: DataFrame, *, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """(sequence_id, ids) with the token ids of every sequence, for documents
    with distinct ids; a sequence holds at most ``capacity`` ids."""
    prepare(docs)
    path = tokenizer or default_path()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
        for batch in it:
            for lo, hi, ids, at in encoded(batch, path, end_id=end_id):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
                yield as_batch(schema, batch.column(0).slice(lo, hi - lo), lists)

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")
    part = F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    return (placed.join(whole, "doc_id").groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", part.alias("ids")))).alias("p"))
            .select("sequence_id", F.flatten(F.col("p.ids")).alias("ids")))
