"""A small filter of keys that rows pass before they are shuffled for a join.

Joining whole texts with a narrow table of keys moves every text, also those
that no key asks for.  ``maybe_in`` gives a test that is true for every row
with one of the keys and false for nearly all others (a Bloom filter, of
bounded size, whose four bits of a key lie in one 64-bit word), so the exact
join that follows moves the rows that it needs and few more.  With more keys
than the filter is meant for it lets more rows pass; it never stops a key.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import prepare

#: Keys that share a word: under 1 % of the other rows pass.
KEYS_A_WORD = 4
#: Words at most: 8 MB, sent to the driver once and from there to the executors.
MOST_WORDS = 1 << 20
_BITS = (40, 46, 52, 58)


def maybe_in(keys: DataFrame, *names: str) -> Callable[..., Column]:
    """A function of as many columns as ``names``: may they be a row of ``keys``?

    ``keys`` is read twice; the columns have to be of the types of the named ones."""
    spark = prepare(keys)
    words = 1 << min(keys.count() // KEYS_A_WORD, MOST_WORDS - 1).bit_length()
    h = F.xxhash64(*names)
    mask = F.lit(0).cast("long")
    for at in _BITS:
        mask = mask.bitwiseOR(F.expr(f"shiftleft(1L, CAST(shiftright(h, {at}) & 63 AS INT))"))
    found = (keys.select(h.alias("h")).select(F.col("h").bitwiseAND(F.lit(words - 1)).alias("word"), mask.alias("mask"))
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow())
    table = np.zeros(words, np.uint64)
    table[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def passes(key: pd.Series) -> pd.Series:
        k = key.to_numpy().astype(np.int64).view(np.uint64)
        word = sent.value[(k & np.uint64(words - 1)).astype(np.int64)]
        ok = np.ones(len(k), bool)
        for at in _BITS:
            ok &= (word >> ((k >> np.uint64(at)) & np.uint64(63))) & np.uint64(1) == 1
        return pd.Series(ok)

    return lambda *cols: passes(F.xxhash64(*cols))
