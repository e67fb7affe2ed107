"""Toxicity by a factorization machine over hashed terms.

score(x) = w0 + sum_i w_i x_i + 1/2 * sum_f [(sum_i v_if u_i)^2 - sum_i (v_if u_i)^2]

The terms of a text are its distinct lower-case words, stripped of ASCII
punctuation, and their prefixes of 4 to 6 bytes, hashed into ``2**bits``
slots.  Linear weights see each term (x_i = 1); the pairwise part, with
u_i = 1 / sqrt(number of terms), learns that terms which are harmless alone
are toxic together (an insult with a group mention).  Terms in fewer than
``min_docs`` training documents take no part.

Bounded parameter: at most ``per_class`` labelled documents of each class
are fitted on; the model (2**bits * (factors + 1) floats, 9 MB) is broadcast.

Defined cases: a null text is the empty text; an empty text has only w0; with
labels of one class or none the score is that class's smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, training_rows
from .tables import prepare
from .textkit import _BYTE, _LOWER, as_batch, concat_ranges, mix64, powers, rows_of, words

PER_CLASS = 2500
BITS = 18
FACTORS = 8
MIN_DOCS = 3
EPOCHS = 8
PREFIXES = (4, 5, 6)

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def term_slots(data: np.ndarray, offs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct slots of each text one after another, offsets)."""
    _, begin, end, bounds = words(data, offs)
    begin, end = begin.copy(), end.copy()
    for _ in range(3):                       # up to three marks on either side
        live = begin < end
        begin[live] += _PUNCT[data[begin[live]]]
        live = begin < end
        end[live] -= _PUNCT[data[end[live] - 1]]
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(bounds))
    keep = end > begin
    begin, end, doc = begin[keep], end[keep], doc[keep]
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    terms, owner = [], []
    lens = end - begin
    for kind, limit in enumerate((0, *PREFIXES)):
        if limit:
            some = lens > limit
            b, n, d = begin[some], np.full(int(some.sum()), limit), doc[some]
        else:
            b, n, d = begin, lens, doc
        if not len(b):
            continue
        at = np.cumsum(n) - n
        body = _LOWER[data[concat_ranges(b, n)]]
        within = np.arange(len(body)) - np.repeat(at, n)
        h = np.add.reduceat(_BYTE[body] * powers(int(n.max()))[within], at)
        terms.append(mix64(h + np.uint64(kind)) >> np.uint64(64 - bits))
        owner.append(d)
    key = np.unique((np.concatenate(owner).astype(np.uint64) << np.uint64(bits)) | np.concatenate(terms))
    slots = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    return slots, np.searchsorted(key >> np.uint64(bits), np.arange(len(offs))).astype(np.int64)


class Machine:
    """The fitted model."""

    def __init__(self, bits: int, factors: int):
        self.bits = bits
        self.w0 = 0.0
        self.w = np.zeros(1 << bits, np.float32)
        self.v = np.zeros((1 << bits, factors), np.float32)
        self.used = np.zeros(1 << bits, bool)

    def restrict(self, slots: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = self.used[slots]
        return slots[keep], np.concatenate([[0], np.cumsum(keep)])[offs]

    def forward(self, slots: np.ndarray, offs: np.ndarray) -> tuple:
        n = np.diff(offs)
        scale = 1 / np.sqrt(np.maximum(n, 1))
        linear = _sums(self.w[slots], offs)
        rows = self.v[slots]
        total = _sums(rows, offs) * scale[:, None]
        square = _sums((rows * rows).sum(1), offs) * scale * scale
        return self.w0 + linear + 0.5 * ((total * total).sum(1) - square), rows, total, scale

    def probability(self, slots: np.ndarray, offs: np.ndarray) -> np.ndarray:
        z = self.forward(*self.restrict(slots, offs))[0]
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))

    def fit(self, slots: np.ndarray, offs: np.ndarray, y: np.ndarray, weight: np.ndarray, *,
            min_docs: int, epochs: int, rate: float = 0.2, l2: float = 1e-5, batch: int = 64, seed: int = 7,
            evidence: float = 12.0) -> None:
        """Minibatch AdaGrad on the weighted logistic loss.  Linear weights
        go to the terms whose class shares differ (chi-square of at least
        ``evidence``), factors also to those in 2 % of the documents, which
        can matter in pairs though they are harmless alone."""
        rng = np.random.default_rng(seed)
        n, size = len(y), len(self.w)
        seen = np.bincount(slots, minlength=size).astype(float)
        positive = np.bincount(slots, np.repeat(y, np.diff(offs)), size)
        share = y.mean()
        chi2 = (positive - seen * share) ** 2 / np.maximum(seen * share * (1 - share) * (1 - seen / (n + 1)), 1e-9)
        alone = (seen >= min_docs) & (chi2 >= evidence)
        self.used = alone | ((seen >= min_docs) & (seen >= 0.02 * n))
        slots, offs = self.restrict(slots, offs)
        self.v = (rng.standard_normal(self.v.shape) * 0.05).astype(np.float32) * self.used[:, None]
        prior = float((y * weight).sum() / weight.sum())
        self.w0 = float(np.log(prior / (1 - prior)))
        gw, gv = np.full(self.w.shape, 1e-6, np.float32), np.full(self.v.shape, 1e-6, np.float32)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for lo in range(0, len(y), batch):
                take = order[lo:lo + batch]
                n = offs[take + 1] - offs[take]
                at = concat_ranges(offs[take], n)
                if not len(at):
                    continue
                s = slots[at]
                o = np.concatenate([[0], np.cumsum(n)])
                z, rows, total, scale = self.forward(s, o)
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                g = ((p - y[take]) * weight[take] / len(take)).astype(np.float32)
                each = np.repeat(g, n)
                u = np.repeat(scale, n)[:, None].astype(np.float32)
                dv = each[:, None] * (np.repeat(total, n, axis=0) * u - rows * u * u)
                uniq, back = np.unique(s, return_inverse=True)
                dw = np.bincount(back, each, len(uniq)).astype(np.float32) + l2 * self.w[uniq]
                dvs = np.stack([np.bincount(back, dv[:, f], len(uniq)) for f in range(dv.shape[1])], 1)
                dvs = dvs.astype(np.float32) + l2 * self.v[uniq]
                gw[uniq] += dw * dw
                gv[uniq] += dvs * dvs
                self.w[uniq] -= rate * dw / np.sqrt(gw[uniq]) * alone[uniq]
                self.v[uniq] -= 0.3 * rate * dvs / np.sqrt(gv[uniq])


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums over the ranges of ``offs``; an empty range has 0."""
    pad = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)])
    out = np.add.reduceat(pad, offs[:-1], axis=0) if len(offs) > 1 else pad[:0]
    out[np.diff(offs) == 0] = 0
    return out


_TERMS = pa.schema([("y", pa.int32()), ("pick", pa.int64()), ("slots", pa.list_(pa.int32()))])
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def train(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS, bits: int = BITS,
          factors: int = FACTORS, min_docs: int = MIN_DOCS, epochs: int = EPOCHS) -> Machine | float:
    """The fitted machine, or the smoothed share of label 1 if only one class is labelled."""
    prepare(docs)
    rows, counts = training_rows(docs, labels, "toxic", per_class)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)

    def hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for lo, hi, data, offs in rows_of(batch):
                slots, at = term_slots(data, offs, bits)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(slots, pa.int32()))
                yield as_batch(_TERMS, batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), lists)

    fit = [] if not n0 or not n1 else sorted(
        rows.select("y", "pick", "text").mapInArrow(hashed, "y int, pick long, slots array<int>").collect(),
        key=lambda r: (r["pick"], r["y"], len(r["slots"])))
    y = np.array([r["y"] for r in fit], float)
    if len(set(y.tolist())) < 2:
        return (n1 + 1) / (n0 + n1 + 2)
    machine = Machine(bits, factors)
    share = np.where(y == 1, n1 / (n0 + n1), n0 / (n0 + n1))
    weight = share / np.where(y == 1, (y == 1).sum(), (y == 0).sum()) * len(y)
    machine.fit(np.concatenate([np.array(r["slots"], np.int64) for r in fit]),
                np.concatenate([[0], np.cumsum([len(r["slots"]) for r in fit])]), y, weight,
                min_docs=min(min_docs, max(1, len(y) // 50)), epochs=epochs)
    return machine


def score(docs: DataFrame, model: Machine | float) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not isinstance(model, Machine):
        return d.select("doc_id", F.lit(float(model)).alias("score"))
    sent = prepare(docs).sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for lo, hi, data, offs in rows_of(batch):
                p = sent.value.probability(*term_slots(data, offs, sent.value.bits))
                yield as_batch(_SCORES, batch.column(0).slice(lo, hi - lo), p)

    return d.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return (score(docs, train(docs, labels, **options))
            .withColumn("held_out", fold(F.col("doc_id")) == 0)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .select("doc_id", "held_out", "score", "predicted"))
