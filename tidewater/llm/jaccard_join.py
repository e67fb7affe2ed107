"""Exact Jaccard self-join of word-shingle sets as a metric-space join.

Jaccard distance is a metric, so pivots cut the space into Voronoi regions
and the triangle inequality bounds what must be compared across them:
d(x, y) <= r needs |d(x, p) - d(y, p)| <= r for every pivot p.  Documents as
pivots alone do not separate a corpus, since unrelated texts are all at
distance 1 of each other; the first level therefore takes one-shingle sets as
pivots, and documents become pivots inside the regions, where they do
separate.

Level 1.  d(x, {s}) < 1 just for the shingles s of x, so x lies in the regions
of its own shingles.  In any fixed order of the shingles, sets with
|x & y| >= o share at least l of the first |x| - o + l of x and |y| - o + l
of y.  So x is copied to the regions of its first
    p(x) = |x| - ceil(t |x|) + l(x),   l(x) = max(1, floor(|x| / 10))
shingles by hash.  A set that shares fewer than g(x) = l(ceil(t |x|)) of them
with any other set has no partner and goes.  Regions are joined into
candidate components through one representative each; each set may ignore its
weakest ties of up to (g(x) - 1) // 2 shingles, since two partners share
l >= g shingles and so keep a common tie.  Partners thus always meet in one
component, while texts that merely share a passage do not.

Level 2.  A component of at most ``region_shingles`` is joined in one task:
some of its documents are pivots, whose distances to all link most of it; the
documents outside the main cluster are then compared with all those that
windows on pivot distances, sizes and rare shingles leave.

In a large corpus the regions of common shingles run together: texts tied by
chance make one component that grows faster than the corpus.  A component
larger than that is therefore sieved by all shingles of its sets.  A set with
more than |x| - ceil(t |x|) shingles that no other set of the component holds
has no partner.  Of the rest, in the order from rare to common, partners share
one of the first |x| - ceil(t |x|) + 1, so ties by these alone cut it into
components anew.  One that is still too large is joined by the same means
across tasks: distances to pivots (broadcast, bounded), home region of the
nearest pivot, direct links; the documents that the pivots do not connect with
the main cluster are copied to every region that their window touches, block
by block.

Only links that connect something new are written (a spanning forest), never
all pairs of a group.  Equal sets are one class throughout.

Defined cases: a null, empty or wordless text has no shingles and is alone; a
text of fewer than five words has one; null ids stand for no one, a component
of null ids only has a null component_id; repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .keyfilter import maybe_in
from .tables import prepare, written
from .textkit import as_batch, concat_ranges, mix64, rows_of, shingle_sets

PERCENT = 80
#: Shingles of a component that one task joins (8 bytes each, 16 MB; some
#: copies of that are made).
REGION_SHINGLES = 2_000_000
PIVOTS = 16
#: Large components whose pivots are broadcast at a time.
REGIONS_AT_ONCE = 64
#: Sets that a task remembers in order to send each only once.
REMEMBERED = 200_000


def need(n: np.ndarray, percent: int) -> np.ndarray:
    """ceil(t n): the least overlap of a set of n with a partner."""
    return -((-n * percent) // 100)


def extra(n: np.ndarray) -> np.ndarray:
    return np.maximum(1, n // 10)


def digest(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    a, b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        at = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        a[full] = mix64(np.add.reduceat(mix64(flat + np.uint64(0x1F83D9ABFB41BD6B)), at))
        b[full] = mix64(np.add.reduceat(mix64(flat ^ np.uint64(0x5BE0CD19137E2179)), at))
    return a.view(np.int64), b.view(np.int64)


# ------------------------------------------------------ joining one component

class Region:
    """Sets with an inverted list for each shingle that several hold."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.size = np.array([len(s) for s in sets], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        _, self.token = np.unique(np.concatenate(sets), return_inverse=True)
        self.many = np.bincount(self.token)
        self.first = np.cumsum(self.many) - self.many
        owner = np.repeat(np.arange(len(sets)), self.size)
        self.holders = owner[np.argsort(self.token, kind="stable")]
        self.root = np.arange(len(sets))
        self.links: list[tuple[int, int]] = []

    def overlap(self, i: int) -> np.ndarray:
        """Shingles that each set has in common with set i."""
        t = self.token[self.at[i]:self.at[i + 1]]
        return np.bincount(self.holders[concat_ranges(self.first[t], self.many[t])], minlength=len(self.size))

    def linked(self, i: int, common: np.ndarray) -> np.ndarray:
        return 100 * common >= self.percent * (self.size + self.size[i] - common)

    def join(self, i: int, others: np.ndarray) -> None:
        """Record the links of i to ``others`` that connect something new."""
        for j in others.tolist():
            a, b = self.find(i), self.find(j)
            if a != b:
                self.root[max(a, b)] = min(a, b)
                self.links.append((i, j))

    def find(self, i: int) -> int:
        """The least set that is known to be in i's cluster."""
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]                     # the path gets shorter as it is walked
            i = int(root[i])
        return i

    def clusters(self, sets: np.ndarray | None = None) -> np.ndarray:
        """``find`` of many sets (all, if none are given)."""
        at = self.root if sets is None else self.root[sets]
        while True:
            up = self.root[at]
            if (up == at).all():
                return at
            at = up

    def candidates(self, i: int, distances: list[np.ndarray], among: np.ndarray) -> np.ndarray:
        """The sets of ``among`` in other clusters that may be partners of i."""
        t = self.token[self.at[i]:self.at[i + 1]]
        n = len(t)
        rare = t[np.argsort(self.many[t], kind="stable")][:n - int(need(np.int64(n), self.percent)) + 1]
        c = np.unique(self.holders[concat_ranges(self.first[rare], self.many[rare])])
        c = c[among[c] & (self.clusters(c) != self.find(i)) & (100 * np.minimum(self.size[c], n)
                                                          >= self.percent * np.maximum(self.size[c], n))]
        r = 1 - self.percent / 100 + 1e-9
        for d in distances:
            c = c[np.abs(d[c] - d[i]) <= r]
        return c

    def verify(self, i: int, c: np.ndarray) -> None:
        if len(c):
            common = self.overlap(i)
            self.join(i, c[self.linked(i, common)[c]])

    def solve(self, pivots: int) -> list[tuple[int, int]]:
        """Links that span the components of the region."""
        m = len(self.size)
        distances = []
        order = np.argsort(self.size, kind="stable")
        for i in order[np.unique(np.linspace(0, m - 1, min(m, pivots + 1)).astype(int))].tolist():
            common = self.overlap(i)
            self.join(i, np.flatnonzero(self.linked(i, common)))
            distances.append(1 - common / (self.size + self.size[i] - common))
        everything = np.ones(m, bool)
        root = self.clusters()
        main = np.bincount(root).argmax()
        for i in np.flatnonzero(root != main).tolist():
            self.verify(i, self.candidates(i, distances, everything))
        return self.links

    def solve_for(self, active: np.ndarray) -> list[tuple[int, int]]:
        """Links of the sets marked ``active`` with any set."""
        everything = np.ones(len(self.size), bool)
        for i in np.flatnonzero(active).tolist():
            self.verify(i, self.candidates(i, [], everything))
        return self.links


# ------------------------------------------------------------------- level 1

_SETS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
_TOKENS = pa.schema([("h", pa.int64()), ("a", pa.int64())])
_ALL_TOKENS = pa.schema([("region", pa.int64()), ("h", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
_TIES = pa.schema([("h", pa.int64()), ("a", pa.int64()), ("center", pa.int64())])
_LINKS = pa.schema([(x, pa.int64()) for x in ("a1", "b1", "a2", "b2")])
_LINKS_DDL = "a1 long, b1 long, a2 long, b2 long"


def _sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for lo, hi, data, offs in rows_of(batch):
            sets = shingle_sets(data, offs)
            yield as_batch(_SETS, batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                           [len(s) for s in sets], *digest(sets))


def _tokens(percent: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in it:
            for _, _, data, offs in rows_of(batch):
                sets = shingle_sets(data, offs)
                hs, owners = [], []
                for s, (c, rest) in zip(sets, zip(*(x.tolist() for x in digest(sets)))):
                    if len(s) and (c, rest) not in sent:
                        sent.add((c, rest))
                        n = len(s)
                        hs.append(s[:n - int(need(np.int64(n), percent)) + int(extra(np.int64(n)))])
                        owners.append(np.full(len(hs[-1]), c))
                if len(sent) > REMEMBERED:
                    sent.clear()
                if hs:
                    yield as_batch(_TOKENS, np.concatenate(hs).view(np.int64), np.concatenate(owners))
    return run


def _ties(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (h, a): (null, a, representative) of every set in a
    region of several.  The first and the last region of a partition may go on
    in the next ones; their rows keep h and are settled afterwards."""
    first_h = None
    held: list[tuple[np.ndarray, np.ndarray]] = []      # the region that is not known to be over

    def out(h: np.ndarray, a: np.ndarray, edge: bool) -> pa.RecordBatch | None:
        """Ties of whole regions (a boundary region by itself, with its h)."""
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (a[1:] != a[:-1])
        h, a = h[new], a[new]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        many = np.diff(np.append(start, len(h)))
        center = np.repeat(a[start], many)
        if edge:
            return as_batch(_TIES, h, a, center)
        some = np.repeat(many, many) > 1
        if not some.any():
            return None
        return as_batch(_TIES, pa.nulls(int(some.sum()), pa.int64()), a[some], center[some])

    for batch in it:
        h, a = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(h):
            continue
        if first_h is None:
            first_h = h[0]
        if held and held[0][0][0] != h[0]:
            done = out(*(np.concatenate(x) for x in zip(*held)), held[0][0][0] == first_h)
            held = []
            if done is not None:
                yield done
        cut = int(np.searchsorted(h, h[-1]))          # the last region of the batch starts here
        if cut:
            hh, aa = h[:cut], a[:cut]
            if held:
                hh, aa = (np.concatenate([*x, y]) for x, y in zip(zip(*held), (hh, aa)))
                held = []
            lead = int(np.searchsorted(hh, first_h, side="right")) if hh[0] == first_h else 0
            for part in ((out(hh[:lead], aa[:lead], True) if lead else None),
                         (out(hh[lead:], aa[lead:], False) if lead < len(hh) else None)):
                if part is not None:
                    yield part
        held.append((h[cut:], a[cut:]))
        if sum(len(x) for x, _ in held) > 1_000_000:  # a crowded region: its rows go out as they come
            hh, aa = (np.concatenate(x) for x in zip(*held))
            yield out(hh, aa, True)
            held = [(hh[:1], aa[:1])]
            first_h = hh[0]
    if held:
        yield out(*(np.concatenate(x) for x in zip(*held)), True)


def _components(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(region, a) of the sets that level 1 leaves, by candidate component."""
    tokens = docs.select("text").mapInArrow(_tokens(percent), "h long, a long")
    ties = written(tokens.repartitionByRange("h", "a").sortWithinPartitions("h", "a")
                   .mapInArrow(_ties, "h long, a long, center long"), "ties")
    # regions at partition boundaries: at most a few for each partition
    at_edge = ties.filter("h IS NOT NULL")
    whole = at_edge.groupBy("h").agg(F.min("center").alias("to"), F.max("a").alias("last")).filter("to <> last")
    settled = at_edge.join(whole, "h").select("a", F.col("to").alias("center"), "h").distinct().drop("h")
    share = (ties.filter("h IS NULL").select("a", "center").unionByName(settled)
             .groupBy("a", "center").agg(F.count("*").alias("shared")))
    size = sets.groupBy("a").agg(F.max("n").alias("n"))
    g = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / 10))
    all_of = Window.partitionBy("a")
    weakest = all_of.orderBy("shared", "center").rowsBetween(Window.unboundedPreceding, 0)
    kept = (share.join(size, "a").withColumn("g", g)
            .withColumn("all", F.sum("shared").over(all_of)).filter(F.col("all") >= F.col("g"))
            .withColumn("up_to", F.sum("shared").over(weakest))
            .filter(F.col("up_to") > F.floor((F.col("g") - 1) / 2)).select("a", "center"))
    kept = written(kept, "kept-ties")
    member = kept.select("a").distinct()
    part = connected_components(kept, "a", "center")
    found = member.join(part, F.col("a") == F.col("node")).select(F.col("component").alias("region"), "a")
    alone = found.groupBy("region").agg(F.count("*").alias("members")).filter("members > 1").select("region")
    return found.join(alone, "region")


# ------------------------------------------------------------------- level 2

def _by_group(it: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Groups of consecutive rows that agree in the first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in it:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy() for i in range(keys)], 1)
        cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
        for lo, hi in zip(cut[:-1], cut[1:]):
            now = tuple(key[lo].tolist())
            if held and now != name:
                yield held
                held = []
            name = now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held


def _sets_of(group: list[pa.RecordBatch]) -> tuple[list[np.ndarray], list[tuple[int, int]], list[int]]:
    """(sets, digests, row numbers) of a group's texts, each distinct set once."""
    sets, names, rows = [], [], []
    seen: set[tuple[int, int]] = set()
    row = 0
    for part in group:
        for lo, hi, data, offs in rows_of(part):
            some = shingle_sets(data, offs)
            for i, (s, name) in enumerate(zip(some, zip(*(x.tolist() for x in digest(some))))):
                if len(s) and name not in seen:
                    seen.add(name)
                    sets.append(s)
                    names.append(name)
                    rows.append(row + lo + i)
        row += part.num_rows
    return sets, names, rows


def _link_batch(links: list[tuple[int, int]], names: list[tuple[int, int]]) -> pa.RecordBatch:
    return as_batch(_LINKS, *map(list, zip(*[(*names[i], *names[j]) for i, j in links])))


def _join_regions(members: DataFrame, percent: int) -> DataFrame:
    """Links of components that fit a task each: members are (region, text)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_group(it, 1):
            sets, names, _ = _sets_of(group)
            links = Region(sets, percent).solve(PIVOTS) if len(sets) > 1 else []
            if links:
                yield _link_batch(links, names)

    return (members.select("region", "text").repartition("region").sortWithinPartitions("region")
            .mapInArrow(run, _LINKS_DDL))


def _all_tokens(members: DataFrame) -> DataFrame:
    """(region, h, a, b, n) of every shingle h of every set of the members."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            regions = batch.column(0).to_numpy()
            for lo, hi, data, offs in rows_of(batch):
                sets = shingle_sets(data, offs)
                n = np.array([len(s) for s in sets], np.int64)
                if n.any():
                    a, b = digest(sets)
                    yield as_batch(_ALL_TOKENS, np.repeat(regions[lo:hi], n), np.concatenate(sets).view(np.int64),
                                   *(np.repeat(x, n) for x in (a, b, n)))

    return members.select("region", "text").mapInArrow(run, "region long, h long, a long, b long, n long")


def _sieved(members: DataFrame, percent: int) -> DataFrame:
    """The members that may have partners, by smaller candidate components."""
    need_n = F.ceil(F.col("n") * percent / 100)
    whose = F.struct("a", "b")
    by_shingle = (F.min(whose).alias("one"), F.max(whose).alias("other"), F.max("n").alias("n"))
    lonely = (_all_tokens(members).groupBy("region", "h").agg(*by_shingle).filter("one = other")
              .groupBy("region", "one", "n").agg(F.count("*").alias("own"))
              .filter(F.col("own") > F.col("n") - need_n).select("region", "one.a", "one.b"))
    left = written(members.join(lonely, ["region", "a", "b"], "left_anti"), "sieved")
    tokens = _all_tokens(left)
    common = (tokens.groupBy("region", "h").agg(*by_shingle, F.count("*").alias("holders"))
              .filter("one <> other").select("region", "h", "holders"))
    # all but the need - 1 most common shingles; a repeated row repeats its ranks
    most_common = Window.partitionBy("region", "a", "b").orderBy(F.desc("holders"), "h")
    rare = written(tokens.join(common, ["region", "h"]).withColumn("rank", F.dense_rank().over(most_common))
                   .filter(F.col("rank") >= need_n).select("region", "h", "a").distinct(), "rare-shingles")
    center = rare.groupBy("region", "h").agg(F.min("a").alias("center"))
    part = connected_components(rare.join(center, ["region", "h"]).select("a", "center"), "a", "center")
    found = left.drop("region", "shingles").join(part, left["a"] == part["node"])
    weigh = part.join(left.select("a", "b", "n").distinct(), part["node"] == F.col("a")).groupBy("component").agg(
        F.sum("n").alias("shingles"))
    return (found.join(weigh, "component")
            .select(F.col("component").alias("region"), "a", "b", "n", "shingles", "text"))


def _join_large(members: DataFrame, percent: int, region_shingles: int) -> DataFrame:
    """Links of components of any size: members are (region, a, n, text)."""
    spark = members.sparkSession
    few = Window.partitionBy("region").orderBy("pick", "a")
    pivots = (members.withColumn("pick", F.xxhash64("a", F.lit(5))).withColumn("nth", F.row_number().over(few))
              .filter(F.col("nth") <= PIVOTS).orderBy("region", "nth").select("region", "text").collect())
    by_region: dict[int, list[str]] = {}
    for p in pivots:
        by_region.setdefault(p["region"], []).append(p["text"])
    sets = {}
    for region, texts in by_region.items():
        batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
        sets[region] = _sets_of([batch])[:2]
    sent = spark.sparkContext.broadcast(sets)
    seen = pa.schema([("region", pa.int64()), ("a", pa.int64()), ("n", pa.int64()), ("home", pa.int32()),
                      ("mask", pa.int64()), ("far", pa.list_(pa.float64())), *_LINKS])

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            regions = batch.column(0).to_numpy()
            for lo, hi, data, offs in rows_of(batch):
                some = shingle_sets(data, offs)
                names = list(zip(*(x.tolist() for x in digest(some))))
                out = []
                for i, s in enumerate(some):
                    region = int(regions[lo + i])
                    pivot_sets, pivot_names = sent.value[region]
                    far, mask, link = [], 0, None
                    for k, p in enumerate(pivot_sets):
                        at = np.searchsorted(p, s)
                        at[at == len(p)] = 0
                        common = int((p[at] == s).sum())
                        union = len(p) + len(s) - common
                        far.append(1 - common / union)
                        if 100 * common >= percent * union:
                            mask |= 1 << k
                    home = int(np.argmin(far))
                    # ties to all its pivots: the first by this row, the rest by the mask's groups
                    first = (mask & -mask).bit_length() - 1
                    link = (*names[i], *pivot_names[first]) if mask else (*names[i], *names[i])
                    out.append((region, names[i][0], len(s), home, mask, far, *link))
                yield as_batch(seen, *map(list, zip(*out)))

    placed = written(members.select("region", "text").mapInArrow(
        measure, "region long, a long, n long, home int, mask long, far array<double>, " + _LINKS_DDL), "placed", batch_rows=256)
    links = placed.filter("mask <> 0").select(*_LINKS.names)
    # masks of a region tell which pivots its documents connect
    root: dict[int, list[int]] = {r: list(range(len(v[0]))) for r, v in sets.items()}
    weight: dict[int, dict[int, int]] = {}
    pivot_links = []
    for row in placed.filter("mask <> 0").groupBy("region", "mask").agg(F.count("*").alias("n")).toLocalIterator():
        top = root[row["region"]]
        ks = [k for k in range(PIVOTS) if row["mask"] >> k & 1]
        for k in ks[1:]:
            if top[k] != top[ks[0]]:
                lost, kept = max(top[k], top[ks[0]]), min(top[k], top[ks[0]])
                root[row["region"]] = top = [kept if x == lost else x for x in top]
                names = sets[row["region"]][1]
                pivot_links.append((*names[ks[0]], *names[k]))
        weight.setdefault(row["region"], {})
        weight[row["region"]][ks[0]] = weight[row["region"]].get(ks[0], 0) + row["n"]
    mains = []
    for region, top in root.items():
        total: dict[int, int] = {}
        for k, n in weight.get(region, {}).items():
            total[top[k]] = total.get(top[k], 0) + n
        main = max(total, key=lambda x: (total[x], -x)) if total else -1
        mains.append((region, sum(1 << k for k in range(len(top)) if top[k] == main)))
    if pivot_links:
        links = links.unionByName(spark.createDataFrame(pivot_links, _LINKS_DDL))
    main = F.broadcast(spark.createDataFrame(mains, "region long, main long"))
    placed = placed.join(main, "region").withColumn("active", F.col("mask").bitwiseAND(F.col("main")) == 0)

    # Voronoi cells, in blocks that fit a task; the window of a cell is what
    # its distances from the pivot allow
    r = 1 - percent / 100 + 1e-9
    cells = placed.groupBy("region", "home").agg(
        F.sum("n").alias("cell"), F.min(F.element_at("far", F.col("home") + 1)).alias("near"),
        F.max(F.element_at("far", F.col("home") + 1)).alias("wide"))
    half = max(1, region_shingles // 2)
    cells = cells.withColumn("blocks", F.ceil(F.col("cell") / half)).withColumnRenamed("home", "at")
    crowd = placed.filter("active").groupBy("region").agg(F.ceil(F.sum("n") / half).alias("chunks"))
    active = (placed.filter("active").join(F.broadcast(crowd), "region")
              .withColumn("chunk", F.pmod(F.xxhash64("a", F.lit(7)), F.col("chunks")))
              .join(F.broadcast(cells.withColumnRenamed("region", "of")), F.col("region") == F.col("of"))
              .filter((F.element_at("far", F.col("at") + 1) <= F.col("wide") + r)
                      & (F.element_at("far", F.col("at") + 1) >= F.col("near") - r))
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    guests = active.select("region", "at", "block", "chunk", F.lit(1).alias("guest"), "a")
    hosts = (placed.join(F.broadcast(crowd), "region")
             .join(F.broadcast(cells.select("region", F.col("at").alias("home"), "blocks")), ["region", "home"])
             .withColumn("block", F.pmod(F.xxhash64("a", F.lit(9)), F.col("blocks")))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .select("region", F.col("home").alias("at"), "block", "chunk", F.lit(0).alias("guest"), "a"))
    keys = ["region", "at", "block", "chunk"]
    texts = members.select("a", "text")
    meeting = (guests.unionByName(hosts).join(texts, "a").select(*keys, "guest", "text")
               .repartition(*keys).sortWithinPartitions(*keys, F.desc("guest")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_group(it, 4):
            guest = np.concatenate([g.column(4).to_numpy() for g in group])
            if not guest.any():
                continue
            some, names, rows = _sets_of(group)     # a guest at home is met as guest
            found = Region(some, percent).solve_for(guest[rows] == 1)
            if found:
                yield _link_batch(found, names)

    return links.unionByName(meeting.mapInArrow(run, _LINKS_DDL))


# ----------------------------------------------------------------- the join

def components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return _labelled(docs, **options).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _labelled(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
              region_shingles: int = REGION_SHINGLES) -> DataFrame:
    prepare(docs)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = written(d.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
                   .mapInArrow(_sets, "doc_id long, text_hash long, n long, a long, b long"), "shingle-sets")
    kinds = (sets.filter("n > 0").groupBy("n", "a", "b")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one")))
    regions = written(_components(d, sets, percent), "regions")
    wanted = (kinds.join(regions, "a").select("region", "a", "b", "n", F.col("one.doc_id").alias("one_id"),
                                              F.col("one.text_hash").alias("one_hash")))
    weigh = wanted.groupBy("region").agg(F.sum("n").alias("shingles"))
    wanted = written(wanted.join(weigh, "region"), "wanted")
    may_want = maybe_in(wanted, "one_hash", "one_id")
    texts = d.withColumn("text_hash", F.xxhash64("text")).filter(may_want(F.col("text_hash"), F.col("doc_id")))
    members = (texts.join(wanted, (texts["text_hash"] == wanted["one_hash"]) & texts["doc_id"].eqNullSafe(wanted["one_id"]))
               .select("region", "a", "b", "n", "shingles", "text"))
    members = written(members, "members", batch_rows=1024)       # a part of the texts, which both ways below read
    fits = F.col("shingles") <= region_shingles
    small = members.filter(fits)
    if not wanted.filter(~fits).isEmpty():
        sieved = written(_sieved(members.filter(~fits), percent), "sieved-members")
        small = small.unionByName(sieved.filter(fits))
        large = [r["region"] for r in sieved.filter(~fits).select("region").distinct().toLocalIterator()]
    else:
        large = []
    links = _join_regions(small, percent)
    for lo in range(0, len(large), REGIONS_AT_ONCE):
        part = written(sieved.filter(F.col("region").isin(large[lo:lo + REGIONS_AT_ONCE]))
                       .dropDuplicates(["region", "a", "n", "text"]), "large-regions")
        links = links.unionByName(_join_large(part, percent, region_shingles))
    links = written(links, "links", batch_rows=256)
    edges = links.select(F.struct(F.col("a1").alias("a"), F.col("b1").alias("b")).alias("x"),
                         F.struct(F.col("a2").alias("a"), F.col("b2").alias("b")).alias("y"))
    part = connected_components(edges, "x", "y").select("node.a", "node.b", "component")
    of_class = sets.filter("n > 0").groupBy("n", "a", "b").agg(F.min("doc_id").alias("least"))
    grouped = of_class.join(part, ["a", "b"])
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    moved = grouped.join(least, "component").select("n", "a", "b", "component_id")
    label = (of_class.join(moved, ["n", "a", "b"], "left")
             .select("n", "a", "b", F.coalesce("component_id", "least").alias("component_id")))
    return (sets.join(label, ["n", "a", "b"], "left")
            .select("doc_id", "text_hash", "n",
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component: that with the smallest id (once, where
    the row repeats).  Documents without shingles all stay, and so do those of
    a component that has null ids only; other null ids yield to an id."""
    c = _labelled(docs, id_col=id_col, text_col=text_col, **options)
    # the rows that go or come again: most texts are not among them and stay where they are
    marked = (c.groupBy("doc_id", "text_hash")
              .agg(F.max(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("__stays"),
                   (F.count(F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), 1)) > 1).alias("__again"))
              .filter("NOT __stays OR __again").withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"}))
    marked = written(marked, "marked")
    row_id, row_hash = docs[id_col].cast("long"), F.xxhash64(docs[text_col])
    may_be_marked = maybe_in(marked, "__id", "__hash")(row_id, row_hash)
    looked_up = docs.filter(may_be_marked).join(
        marked, row_id.eqNullSafe(marked["__id"]) & row_hash.eqNullSafe(marked["__hash"]), "left")
    kept = docs.filter(~may_be_marked).unionByName(
        looked_up.filter("__stays IS NULL").select(*docs.columns))
    if marked.filter("__stays").isEmpty():
        return kept
    once = looked_up.filter("__stays").dropDuplicates([id_col, text_col])
    return kept.unionByName(once.select(*docs.columns))
