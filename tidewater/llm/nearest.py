"""Approximate nearest neighbours by cross-polytope hashing.

Each of ``tables`` hash tables rotates the vectors pseudo-randomly (three
rounds of random signs and a fast Hadamard transform) and assigns each to the
nearest of the 2d signed axes; a second rotation, cut to a few dimensions
chosen from the number of vectors, refines the buckets.  A query looks in the
``probes`` buckets of least loss in each table, and the union is ranked
exactly, by the inner product in double precision on the original vectors.

Largest inner product is made largest cosine: data vectors get one more
coordinate that brings them to the largest norm, queries a zero (left out
where all norms agree).

Scale.  Equal vectors are one class (with its ``top + 1`` smallest ids, which
is all that an answer can hold).  Rows meet by (table, first axis); a crowded
group is cut into blocks, each with the queries of the group.  Tasks keep
only the best of each query.  A query with too few candidates in all its
buckets is searched exactly, over all vectors.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do null ids; rows repeated in id and vector
count once; vectors of different lengths do not meet; ties go to the smaller
id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import prepare, written
from .textkit import as_batch

TABLES = 16
PROBES = 100
TOP = 20
QUERY_EVERY = 20
BLOCK_ROWS = 20_000
#: Query classes searched exactly at a time, where buckets gave too few.
EXACT_BLOCK = 1000
#: Entries that a task holds before it passes its best on.
HELD = 200_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised fast Hadamard transform of the rows (a power of two long)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


class Hashes:
    """The rotations of all tables for vectors of one dimension."""

    def __init__(self, dim: int, tables: int, fine: int, extra: bool, top_norm: float, seed: int = 11):
        self.dim, self.tables, self.extra, self.top_norm = dim, tables, extra, top_norm
        self.size = 1 << max(0, (dim + extra - 1)).bit_length()
        self.fine = min(fine, self.size)
        self.signs = np.random.default_rng([seed, dim]).choice([-1.0, 1.0], (tables, 2, 3, self.size))

    def _lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.size))
        norm = np.sqrt((x * x).sum(1))
        out[:, :self.dim] = x / norm[:, None] if query else x / self.top_norm
        if self.extra and not query:
            out[:, self.dim] = np.sqrt(np.maximum(0, 1 - (norm / self.top_norm) ** 2))
        return out

    def _axes(self, x: np.ndarray, table: int, which: int, size: int) -> np.ndarray:
        for s in self.signs[table, which]:
            x = hadamard(x * s)
        x = x[:, :size]
        return np.concatenate([x, -x], 1)

    def data(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first axis, finer axis) of each vector, for each table."""
        x = self._lift(x, False)
        for t in range(self.tables):
            first = self._axes(x, t, 0, self.size).argmax(1)
            yield first, self._axes(x, t, 1, self.fine).argmax(1) if self.fine else np.zeros(len(x), np.int64)

    def queries(self, x: np.ndarray, probes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(first axes, finer axes), ``probes`` of each for each vector, by table."""
        x = self._lift(x, True)
        for t in range(self.tables):
            loss = self._loss(self._axes(x, t, 0, self.size))
            wide = 1
            if self.fine:
                second = self._loss(self._axes(x, t, 1, self.fine))
                wide = second.shape[1]
                loss = (loss[:, :, None] + second[:, None, :]).reshape(len(x), -1)
            k = min(probes, loss.shape[1])
            best = np.argpartition(loss, k - 1, axis=1)[:, :k]
            yield best // wide, best % wide

    @staticmethod
    def _loss(side: np.ndarray) -> np.ndarray:
        return (side.max(1, keepdims=True) - side) ** 2


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values one after another, offsets) of a list column without nulls."""
    offs = np.asarray(column.offsets, np.int64)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64), offs - offs[0]


_ROWS = pa.schema([("dim", pa.int32()), ("grp", pa.int32()), ("side", pa.int32()), ("cls", pa.int64()),
                   ("fine", pa.list_(pa.int32())), ("vec", pa.list_(pa.float64()))])
_ROWS_DDL = "dim int, grp int, side int, cls long, fine array<int>, vec array<double>"
_HITS = pa.schema([("qcls", pa.int64()), ("cls", pa.int64()), ("score", pa.float64())])
_HITS_DDL = "qcls long, cls long, score double"


class _Best:
    """The best ``keep`` classes of each query in a task so far."""

    def __init__(self, keep: int):
        self.keep, self.parts, self.n = keep, [], 0

    def add(self, q: np.ndarray, c: np.ndarray, s: np.ndarray) -> None:
        if len(q):
            self.parts.append((q, c, s))
            self.n += len(q)

    def shrink(self) -> None:
        if not self.parts:
            return
        q, c, s = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((c, -s, q))
        q, c, s = q[order], c[order], s[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])     # equal pairs have equal scores
        q, c, s = q[new], c[new], s[new]
        start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
        good = rank < self.keep
        self.parts, self.n = [(q[good], c[good], s[good])], int(good.sum())

    def take(self) -> Iterator[pa.RecordBatch]:
        self.shrink()
        for q, c, s in self.parts:
            for lo in range(0, len(q), 50_000):
                yield as_batch(_HITS, q[lo:lo + 50_000], c[lo:lo + 50_000], s[lo:lo + 50_000])
        self.parts, self.n = [], 0


def _rank(best: _Best, data: np.ndarray, data_cls: np.ndarray, query: np.ndarray, query_cls: np.ndarray) -> None:
    """Exact scores of all pairs; the best of each query are kept."""
    step = max(1, 2_000_000 // max(1, len(data)))
    for lo in range(0, len(query), step):
        q = query[lo:lo + step]
        s = q @ data.T
        k = min(best.keep, len(data))
        least = np.partition(s, len(data) - k, axis=1)[:, len(data) - k]
        # all that may tie with the cut, by the error of the product
        slack = 4 * (q.shape[1] + 2) * np.finfo(float).eps * np.abs(q).sum(1) * np.abs(data).max()
        rows, cols = np.nonzero(s >= (least - slack)[:, None])
        # one order of summation whatever the block, so that ties stay ties
        part = max(1, 4_000_000 // q.shape[1])
        exact = np.concatenate([(q[rows[i:i + part]] * data[cols[i:i + part]]).sum(1) for i in range(0, len(rows), part)])
        order = np.lexsort((data_cls[cols], -exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        good = nth < best.keep
        best.add(query_cls[lo + rows[good]], data_cls[cols[good]], exact[good])


def _classes(vectors: DataFrame, id_col: str, vec_col: str, every: int, top: int) -> DataFrame:
    """One row per distinct vector: cls, vec, members (its smallest ids), asks.
    Classes ascend with their smallest ids, so the lesser class wins a tie."""
    v = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
         .filter("id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
         .filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
         .filter(F.exists("vec", lambda x: x != 0)))
    asks = F.pmod("id", F.lit(every)) == 0
    w = Window.partitionBy("vec", "asks").orderBy("id")
    few = v.withColumn("asks", asks).withColumn("rn", F.dense_rank().over(w)).filter(F.col("rn") <= top + 1)
    return (few.groupBy("vec").agg(F.slice(F.sort_array(F.collect_set("id")), 1, top + 1).alias("members"),
                                   F.max("asks").alias("asks"))
            .orderBy(F.col("members")[0])
            .select(F.monotonically_increasing_id().alias("cls"), "vec", "members", "asks"))


def search(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", query_every: int = QUERY_EVERY,
           top: int = TOP, tables: int = TABLES, probes: int = PROBES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of every row
    whose id is divisible by ``query_every``, among all other rows."""
    spark = prepare(vectors)
    classes = written(_classes(vectors, id_col, vec_col, query_every, top), "vector-classes")
    norms = classes.select(F.size("vec").alias("dim"), F.sqrt(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))
    kinds = norms.groupBy("dim").agg(F.max("norm").alias("hi"), F.min("norm").alias("lo"), F.count("*").alias("n")).collect()
    hashes = {}
    for k in kinds:     # one row per vector length
        # about a thousandth of the vectors, at most, in a bucket of one table
        fine = 0 if k["n"] < 4096 else 1 << int(np.log2(k["n"] / 2048))
        hashes[k["dim"]] = Hashes(k["dim"], tables, fine, k["hi"] - k["lo"] > 1e-3 * k["hi"], k["hi"])
    sent = spark.sparkContext.broadcast((hashes, probes))

    def spread(query: bool):
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by_dim, n_probes = sent.value
            for batch in it:
                for lo in range(0, batch.num_rows, 256):
                    part = batch.slice(lo, 256)
                    cls = part.column(0).to_numpy()
                    flat, offs = _vectors(part.column(1))
                    dims = np.diff(offs)
                    for dim in np.unique(dims).tolist():
                        rows = np.flatnonzero(dims == dim)
                        x = flat[offs[rows][:, None] + np.arange(dim)]
                        h = by_dim[dim]
                        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dim).cast(pa.list_(pa.float64()))
                        for t, (first, fine) in enumerate(h.queries(x, n_probes) if query else h.data(x)):
                            if not query:
                                yield as_batch(_ROWS, np.full(len(rows), dim), t * 2 * h.size + first,
                                               np.zeros(len(rows), np.int32), cls[rows], fine[:, None].tolist(), lists)
                                continue
                            # one row for each first axis, with the finer axes that are probed there
                            r = np.repeat(np.arange(len(rows)), first.shape[1])
                            order = np.lexsort((fine.ravel(), first.ravel(), r))
                            r, a, f = r[order], first.ravel()[order], fine.ravel()[order]
                            new = np.ones(len(r), bool)
                            new[1:] = (r[1:] != r[:-1]) | (a[1:] != a[:-1])
                            at = np.flatnonzero(new)
                            fines = pa.ListArray.from_arrays(pa.array(np.append(at, len(r)), pa.int32()),
                                                             pa.array(f, pa.int32()))
                            yield as_batch(_ROWS, np.full(len(at), dim), t * 2 * h.size + a[at],
                                           np.ones(len(at), np.int32), cls[rows[r[at]]], fines,
                                           lists.take(pa.array(r[at])))
        return run

    data = classes.select("cls", "vec").mapInArrow(spread(False), _ROWS_DDL)
    asked = classes.filter("asks").select("cls", "vec").mapInArrow(spread(True), _ROWS_DDL)
    # at most tables * 2 * dimensions numbers, whatever the table
    crowd = {(r["dim"], r["grp"]): -(-r["n"] // block_rows)
             for r in data.groupBy("dim", "grp").agg(F.count("*").alias("n")).collect() if r["n"] > block_rows}
    blocks = F.lit(1)
    if crowd:
        table = F.create_map(*[F.lit(x) for (d, g), n in crowd.items() for x in (f"{d}/{g}", n)])
        blocks = F.coalesce(table[F.concat_ws("/", "dim", "grp")], F.lit(1))
    data = data.withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    keys = ["dim", "grp", "block"]
    together = (data.unionByName(asked).repartition(*keys)
                .sortWithinPartitions(*keys, "side").select(*keys, "side", "cls", "fine", "vec"))

    def rank(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(top + 1)
        group = None
        parts: list[tuple] = []
        built = None
        for batch in it:
            key = np.stack([batch.column(i).to_numpy() for i in range(4)], 1)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(key)]):
                name, side = tuple(key[lo, :3].tolist()), key[lo, 3]
                if name != group:
                    group, parts, built = name, [], None
                part = batch.slice(lo, hi - lo)
                cls = part.column(4).to_numpy()
                flat, offs = _vectors(part.column(6))
                x = flat.reshape(hi - lo, -1)
                fines, fine_offs = _vectors(part.column(5))
                if side == 0:
                    parts.append((cls, x, fines.astype(np.int64)))
                    continue
                if not parts:
                    continue
                if built is None:
                    c, v, f = (np.concatenate(p) for p in zip(*parts))
                    order = np.argsort(f, kind="stable")
                    built = c[order], v[order], f[order]
                c, v, f = built
                owner = np.repeat(np.arange(hi - lo), np.diff(fine_offs))
                order = np.argsort(fines, kind="stable")
                owner, wanted = owner[order], fines[order].astype(np.int64)
                for value in np.unique(wanted).tolist():
                    a, b = np.searchsorted(f, [value, value + 1])
                    if a < b:
                        p, q = np.searchsorted(wanted, [value, value + 1])
                        _rank(best, v[a:b], c[a:b], x[owner[p:q]], cls[owner[p:q]])
                        if best.n > HELD:
                            best.shrink()
                            if best.n > HELD // 2:
                                yield from best.take()
        yield from best.take()

    hits = written(_merge(together.mapInArrow(rank, _HITS_DDL), top), "nearest")
    size = classes.groupBy(F.size("vec").alias("dim")).agg(F.sum(F.size("members")).alias("all"))
    found = hits.join(classes.select("cls", "members"), "cls").groupBy("qcls").agg(F.sum(F.size("members")).alias("got"))
    # with `top` + 1 ids a query has its answer whatever its own id is
    short = (classes.filter("asks").withColumn("dim", F.size("vec")).join(F.broadcast(size), "dim")
             .join(found, F.col("cls") == F.col("qcls"), "left")
             .filter(F.coalesce("got", F.lit(0)) < F.least(F.col("all"), F.lit(top + 1))).select("cls", "vec"))
    extra = _exact(classes, short, top)
    if extra is not None:
        hits = _merge(hits.unionByName(extra), top)

    near = hits.join(classes.select("cls", "members"), "cls")
    per_query = near.groupBy("qcls").agg(F.sort_array(F.flatten(F.collect_list(F.transform(
        "members", lambda m: F.struct((-F.col("score")).alias("less"), m.alias("vec_id")))))).alias("near"))
    ids = (vectors.select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).cast("array<double>").alias("vec"))
           .filter(F.pmod("query_id", F.lit(query_every)) == 0).distinct())
    answers = (ids.join(classes.filter("asks").select("vec", F.col("cls").alias("qcls")), "vec")
               .select("query_id", "qcls").join(per_query, "qcls"))
    mine = F.slice(F.filter("near", lambda n: n["vec_id"] != F.col("query_id")), 1, top)
    return (answers.select("query_id", F.posexplode(mine).alias("pos", "n"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"),
                    (-F.col("n.less")).alias("score")))


def _merge(hits: DataFrame, top: int) -> DataFrame:
    """The best classes of each query over all tables."""
    w = Window.partitionBy("qcls").orderBy(F.desc("score"), "cls")
    return (hits.groupBy("qcls", "cls").agg(F.max("score").alias("score"))
            .withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top + 1).drop("rn"))


def _exact(classes: DataFrame, queries: DataFrame, top: int) -> DataFrame | None:
    """Exact search of ``queries`` over all classes, a block of them at a time."""
    spark = classes.sparkSession
    out = None
    block: list = []

    def scan(rows: list) -> DataFrame:
        by_dim: dict[int, list] = {}
        for r in rows:
            by_dim.setdefault(len(r["vec"]), []).append(r)
        sent = spark.sparkContext.broadcast({d: (np.array([r["vec"] for r in rs]), np.array([r["cls"] for r in rs]))
                                             for d, rs in by_dim.items()})

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _Best(top + 1)
            for batch in it:
                cls = batch.column(0).to_numpy()
                flat, offs = _vectors(batch.column(1))
                dims = np.diff(offs)
                for dim, (q, qc) in sent.value.items():
                    rows_here = np.flatnonzero(dims == dim)
                    if len(rows_here):
                        _rank(best, flat[offs[rows_here][:, None] + np.arange(dim)], cls[rows_here], q, qc)
                if best.n > HELD:
                    best.shrink()
            yield from best.take()

        return classes.select("cls", "vec").mapInArrow(run, _HITS_DDL)

    for r in queries.toLocalIterator():
        block.append(r)
        if len(block) == EXACT_BLOCK:
            part = scan(block)
            out, block = part if out is None else out.unionByName(part), []
    if block:
        part = scan(block)
        out = part if out is None else out.unionByName(part)
    return out
