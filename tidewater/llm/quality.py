"""Quality classifier by compression with class dictionaries.

Two zstandard dictionaries are trained, on good and on bad labelled text.  A
text that resembles the good class compresses better with the good
dictionary.  The feature is the normalised compressed-size difference
d = (C_good - C_bad) / max(C_good, C_bad); a logistic calibration, fitted on
labelled rows that no dictionary saw, turns it into the probability of label 1.
The calibration may bend with the compression rate, the mean of the two sizes
that d compares over the text's own: where d is near 0 the text resembles
neither class, and the rate tells repetitive text from random characters.

Bounded parameter: ``per_class`` labelled documents of each class, of which
the whole texts are used, the dictionaries' in pieces of ``piece_bytes``.
Everything fitted is broadcast (two dictionaries of ``dict_bytes`` and a few
coefficients).

Defined cases: a null text is scored as the empty text; with labels of only
one class, or none, the score is that class's smoothed share for every row;
null ids and repeated rows are scored as any row; a long text is compressed
whole; an empty table gives no rows.  ``score`` and ``keep_good`` carry all
further columns along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fold, training_rows
from .tables import prepare, written
from .textkit import rows_of

PER_CLASS = 2000
THRESHOLD = 0.3
LEVEL = 3
DICT_BYTES = 32 << 10
PIECE_BYTES = 1 << 10
SLICE_BYTES = 1 << 20


def _pieces(raw: bytes, piece_bytes: int) -> list[bytes]:
    return [raw[i:i + piece_bytes] for i in range(0, len(raw), piece_bytes)]


class Sizes:
    """Compressed sizes with the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes, level: int):
        self.by_class = []
        for content in (good, bad):
            d = zstandard.ZstdCompressionDict(content)
            d.precompute_compress(level)
            self.by_class.append(zstandard.ZstdCompressor(
                level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def of(self, raw) -> tuple[int, int, int]:
        """(with the good dictionary, with the bad one, plain) of any buffer."""
        return *(len(c.compress(raw)) for c in self.by_class), len(raw)


def features(sizes: np.ndarray) -> np.ndarray:
    """Of rows of the three sizes."""
    good, bad, plain = sizes.astype(np.float64).T
    d = (good - bad) / np.maximum(good, bad)
    rate = np.log((good + bad) / 2 / (plain + 8))
    near = np.exp(-d * d / 0.002)
    return np.stack([np.ones_like(d), d, np.tanh(d / 0.03), rate, rate * rate, near, near * rate], axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple:
    """Ridge logistic regression by Newton steps on standardised features."""
    mean, scale = x.mean(0), x.std(0)
    mean[0], scale[0] = 0.0, 1.0
    scale[scale == 0] = 1.0
    z = (x - mean) / scale
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(y))
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + penalty * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def train(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS, dict_bytes: int = DICT_BYTES,
          piece_bytes: int = PIECE_BYTES, level: int = LEVEL) -> dict:
    """The model: two dictionaries and the calibration.  Even picks train the
    dictionaries, odd picks the calibration."""
    spark = prepare(docs)
    rows, counts = training_rows(docs, labels, "quality", per_class)
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    prior = {"prior": (n1 + 1) / (n0 + n1 + 2)}
    if not n0 or not n1:
        return prior
    rows = written(rows, "quality-training")        # the documents are read once
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    parts = rows.filter("pick % 2 = 0").select("y", "pick", F.col("text").cast("binary").alias("raw")).collect()
    for r in sorted(parts, key=lambda r: (r["pick"], bytes(r["raw"]))):
        samples[r["y"]].extend(_pieces(bytes(r["raw"]), piece_bytes))
    dictionaries = []
    for y in (1, 0):
        try:
            d = zstandard.train_dictionary(dict_bytes, samples[y], level=level).as_bytes()
        except zstandard.ZstdError:     # too few samples to train on: their tail is the dictionary
            d = b"".join(samples[y])[-dict_bytes:]
        dictionaries.append(d or b"\0" * 8)
    sent = spark.sparkContext.broadcast((*dictionaries, level))

    def measure(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(*sent.value)
        for batch in it:
            for lo, hi, x in _sizes(batch, sizes):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *map(pa.array, x.T)],
                                                 ["y", "good", "bad", "plain"])

    fit = rows.filter("pick % 2 <> 0").select("y", "text").mapInArrow(
        measure, "y int, good long, bad long, plain long").collect()
    y = np.array([r["y"] for r in fit], float)
    if len(set(y.tolist())) < 2:
        return prior
    x = features(np.array([r[1:] for r in fit]))
    share = np.where(y == 1, n1 / (n0 + n1), n0 / (n0 + n1))
    weight = share / np.where(y == 1, (y == 1).sum(), (y == 0).sum()) * len(y)
    order = np.lexsort((*x.T, y))        # the sums don't depend on row order
    return prior | {"dictionaries": dictionaries, "level": level,
                    "fit": _fit_logistic(x[order], y[order], weight[order])}


def _sizes(batch: pa.RecordBatch, sizes: Sizes) -> Iterator[tuple[int, int, np.ndarray]]:
    for lo, hi, data, offs in rows_of(batch, "text", SLICE_BYTES):
        at = offs.tolist()
        yield lo, hi, np.array([sizes.of(data[a:b]) for a, b in zip(at, at[1:])], np.int64)


def probability(sizes: np.ndarray, fit: tuple) -> np.ndarray:
    w, mean, scale = fit
    return 1 / (1 + np.exp(-np.clip((features(sizes) - mean) / scale @ w, -30, 30)))


def score(docs: DataFrame, model: dict, name: str = "quality_score", at_least: float = 0.0,
          carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all, if none are given) and ``name``:
    the probability of label 1, of the rows that reach ``at_least``."""
    spark = prepare(docs)
    kept = docs.columns if carry is None else carry
    if "fit" not in model:
        return docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(model["prior"]).alias(name)).filter(
            F.col(f"`{name}`") >= at_least)
    sent = spark.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        sizes = Sizes(*m["dictionaries"], m["level"])
        for batch in it:
            for lo, hi, x in _sizes(batch, sizes):
                p = pa.array(probability(x, m["fit"]))
                part = batch.slice(lo, hi - lo)
                out = pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [p], [*kept, name])
                yield out.filter(pa.array(np.asarray(p) >= at_least)) if at_least > 0 else out

    given = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, "text"])])
    ddl = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + [f"`{name}` double"])
    return given.mapInArrow(run, ddl)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    d = docs.select("doc_id", "text")
    out = score(d, train(docs, labels, **options), carry=["doc_id"])
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"),
                      F.col("quality_score").alias("score"),
                      (F.col("quality_score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    return score(docs, train(docs, labels, **options), "__quality", threshold).drop("__quality")
