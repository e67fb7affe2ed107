"""Names of known persons masked in free text (Q7).

The sensitive columns of the customers are first and last names, e-mails and
phones; the last two have patterns (``functions.text``), names don't: they are
looked up.  A name matches whatever the case of A-Z, not inside a longer word
(no ASCII letter or digit before or after), and of overlapping matches the one
that begins first counts, of those the longest: ``Ann Lee Smith`` is one match
although ``Ann`` and ``Lee`` are names too.

A text is read as tokens: runs of ASCII letters and digits, and every other
character by itself.  A match is then a run of whole tokens, and a name can
only be found where its first token stands and as the run of as many tokens as
it has.  So a text is scanned once, however many names there are: every run
whose length some name has is looked up in a bitmap of the names' CRC-32
(``block_bytes`` at most, whatever their number), and what passes is joined
with the names themselves, which settles it exactly.  A fuller bitmap lets more
through to the join; it never loses a match.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

BLOCK_BYTES = 32 << 20        
BITS_PER_NAME = 16
NAME_MASK = "<NAME>"
_LOWER = {c: c + 32 for c in range(65, 91)}
_TOKEN = r"[a-z0-9]+|[^a-z0-9]"
_PAGE = 32768                    # bits of one row of the bitmap, as Spark's bitmap functions have it
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_SPANS_DDL = "array<struct<start: int, end: int>>"


def name_list(people: DataFrame, *columns: str, full: bool = True) -> DataFrame:
    """(name) of every distinct value of the columns, and of all of them in a
    row, joined by a space; trimmed, A-Z in lower case, never empty."""
    parts = [F.trim(F.col(f"`{c}`").cast("string")) for c in columns]
    every = [*parts, F.concat_ws(" ", *parts)] if full and len(parts) > 1 else parts
    low = F.translate("name", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return people.select(F.explode(F.array(*every)).alias("name")).where("name <> ''").select(low.alias("name")).distinct()


class Known:
    """What a scan knows of the names: their CRC-32 and that of their first
    tokens as bits, their lengths in tokens, the longest in characters."""

    def __init__(self, bits: bytes, lengths: list[int], longest: int):
        self.bits, self.size, self.lengths, self.longest = bits, 8 * len(bits), sorted(lengths), longest
        self.token = re.compile(_TOKEN)
        self._heads: dict[str, bool] = {}

    def may_be(self, raw: bytes, start: int = 0) -> bool:
        at = zlib.crc32(raw, start) % self.size
        return bool(self.bits[at >> 3] >> (at & 7) & 1)

    def heads(self, token: str) -> bool:
        """May a name begin with this token?  (Most tokens are common words.)"""
        known = self._heads.get(token)
        if known is None:
            if len(self._heads) >= 1 << 16:
                self._heads.clear()
            known = self._heads[token] = self.may_be(token.encode("utf-8", "surrogatepass"), _HEAD)
        return known

    def spans(self, text: str | None) -> dict[str, list[tuple[int, int]]]:
        """Possible name -> (start, end) in characters of its places: every
        name's, and some of what is no name."""
        out: dict[str, list[tuple[int, int]]] = {}
        if not self.lengths or not text:
            return out
        low = text.translate(_LOWER)
        ends = [0, *(m.end() for m in self.token.finditer(low))]
        last = len(ends) - 1
        for i in range(last):
            a = ends[i]
            if not self.heads(low[a:ends[i + 1]]):
                continue
            for n in self.lengths:
                if i + n > last or ends[i + n] - a > self.longest:
                    break
                part = low[a:ends[i + n]]
                if self.may_be(part.encode("utf-8", "surrogatepass")):
                    out.setdefault(part, []).append((a, ends[i + n]))
        return out


_HEAD_MARK = b"\x00"             # sets first tokens apart from whole names
_HEAD = zlib.crc32(_HEAD_MARK)


def settle(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Leftmost, then longest, without overlaps."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans), key=lambda s: (s[0], -s[1])):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def _found(known):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.binary()), ("name", pa.string()), ("spans", _SPANS)])
        for batch in it:
            hashes, parts, spans = [], [], []
            for h, t in zip(batch.column(0), batch.column(1)):       # one text at a time as a string
                for part, at in known.value.spans(t.as_py()).items():
                    hashes.append(h.as_py())
                    parts.append(part)
                    spans.append([{"start": a, "end": b} for a, b in at])
            if hashes:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((hashes, parts, spans), schema)], schema=schema)
    return run


def _known(names: DataFrame, block_bytes: int) -> Known:
    """The bitmap, in pages put together by Spark, and the lengths.  At most
    ``block_bytes`` reach the driver, and a number per length."""
    tokens = F.regexp_count("name", F.lit(_TOKEN))
    sizes = (names.select(tokens.alias("n"), F.length("name").alias("longest")).groupBy("n")
             .agg(F.count(F.lit(1)).alias("names"), F.max("longest").alias("longest")).collect())
    if not sizes:
        return Known(b"", [], 0)
    wanted = BITS_PER_NAME * sum(r.names for r in sizes) // 8
    size = 8 * min(block_bytes, max(1024, 1 << wanted.bit_length()))
    head = F.concat(F.lit(_HEAD_MARK), F.regexp_extract("name", f"^(?:{_TOKEN})", 0).cast("binary"))
    crcs = names.select(F.explode(F.array(F.crc32(F.col("name").cast("binary")), F.crc32(head))).alias("crc"))
    at = crcs.select((F.col("crc") % size).alias("at")).select(F.expr(f"at div {_PAGE}").alias("page"), (F.col("at") % _PAGE).alias("bit"))
    # bit 0 of a page is position 1 to Spark's function
    pages = at.groupBy("page").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits")).collect()
    bits = bytearray(-(-size // _PAGE) * _PAGE // 8)
    for r in pages:
        bits[r.page * _PAGE // 8:(r.page + 1) * _PAGE // 8] = r.bits
    return Known(bytes(bits[:size // 8]), [r.n for r in sizes], max(r.longest for r in sizes))


def mask_names(df: DataFrame, text: str, names: DataFrame, masked: str = "masked_text", count: str = "n_names",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with the names (a frame with column ``name``, see ``name_list``)
    in ``text`` replaced by a mask, and their number.  Null stays null.

    One scan of the texts finds what may be a name, as a narrow table; joined
    with the names it is the matches of each distinct text, and the text itself
    is joined with them once."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "names")
    names.select("name").where("name <> ''").distinct().write.parquet(path)
    kept = spark.read.schema("name string").parquet(path)
    known = spark.sparkContext.broadcast(_known(kept, block_bytes))
    h = F.unhex(F.sha2(F.col(f"`{text}`").cast("binary"), 256))
    texts = df.where(F.col(f"`{text}`").isNotNull()).select(h.alias("h"), F.col(f"`{text}`").alias("t"))
    found = texts.mapInArrow(_found(known), f"h binary, name string, spans {_SPANS_DDL}").join(kept, "name", "left_semi")
    # equal texts find the same
    matches = found.groupBy("h").agg(F.flatten(F.collect_set("spans")).alias("_spans")).withColumnRenamed("h", "_h")
    spans = _settled(F.col("_spans"))
    out = df.withColumn("_th", h).join(matches, F.col("_th") == F.col("_h"), "left").withColumn("_spans", spans)
    t = F.col(f"`{text}`")
    return (out.withColumn(masked, F.when(F.col("_spans").isNull(), t).otherwise(_masked(t, F.col("_spans"))))
            .withColumn(count, F.when(F.col("_spans").isNotNull(), F.size("_spans")).when(t.isNotNull(), F.lit(0)))
            .drop("_th", "_h", "_spans"))


def _settled(spans: Column) -> Column:
    """``settle`` as an expression over the spans of all blocks."""
    order = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    none = F.array().cast(_SPANS_DDL)
    free = lambda done, s: (F.size(done) == 0) | (s["start"] >= F.element_at(done, -1)["end"])
    return F.when(spans.isNotNull(), F.aggregate(order, none, lambda done, s: F.when(
        F.size(done) == 0, F.array(s)).when(free(done, s), F.concat(done, F.array(s))).otherwise(done)))


def _masked(text: Column, spans: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    step = lambda done, s: F.struct(s["end"].alias("at"), F.concat(
        done["parts"], F.array(F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(NAME_MASK))).alias("parts"))
    return F.aggregate(spans, start, step, lambda done: F.concat(
        F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))))
