"""Large multi-line JSON files read by many tasks (A3).

Spark reads a multi-line JSON file in one task, whatever its size.  Here a file
is read in splits like any text (the text source, with ``}`` as its line
separator: no line breaks are needed), and its structure is found in two scans:

1. Each split computes what it does to the state of the scan: whether it ends
   inside a string and how the depth changes, for either way it may begin
   (inside a string or not), and where its last open record begins.  These
   transitions, a row per split, are composed in the order of the file, which
   gives every split its true state at the start.
2. Each split cuts its own records.  A record that crosses a cut comes as
   pieces, at most two from each split, which are put together in file order.

A record is an object of the file's array, or an object of its own where the
file is no array (one document, or several one after another).  Braces,
quotes and escapes inside strings are text.  An empty file has no records.

What reaches the driver, and the tasks of the second scan, is one row of some
hundred bytes per split (128 MB by default): a millionth of the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path, ship_package

_TRANSITION = "path string, at long, first string, quotes int, open0 long, open1 long"
_CUT = "path string, at long, begins boolean, ends boolean, value string"
CHUNK = 4 << 20


def _split_rows(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes, bool]]:
    """(path, start of the split, text, last) of successive chunks of each
    split: its lines, each with the separator again."""
    key, held, size = None, [], 0
    for batch in it:
        paths, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for path, at, value in zip(paths, starts, batch.column(2)):
            if (path, at) != key:
                if key is not None:
                    yield *key, b"".join(held), True
                key, held, size = (path, at), [], 0
            raw = value.as_py().encode() + b"}"
            held.append(raw)
            size += len(raw)
            if size > CHUNK:
                yield *key, b"".join(held), False
                held, size = [], 0
    if key is not None:
        yield *key, b"".join(held), True


def _quotes(b: np.ndarray) -> np.ndarray:
    """The quotes that begin or end a string.  A chunk ends after a ``}``,
    which nothing in JSON escapes, so no escape crosses a chunk."""
    back = b == 0x5C
    if not back.any():
        return b == 0x22
    # a character is escaped if an odd run of backslashes stands before it
    n = np.arange(len(b))
    last_other = np.maximum.accumulate(np.where(back, -1, n))
    run = np.zeros(len(b), np.int64)
    run[1:] = n[:-1] - last_other[:-1]
    return (b == 0x22) & (run % 2 == 0)


def _steps(b: np.ndarray, inside: int) -> np.ndarray:
    """Change of depth at each byte, if the chunk begins inside a string or not."""
    q = np.cumsum(_quotes(b)) + inside
    step = ((b == 0x7B) | (b == 0x5B)).astype(np.int64) - ((b == 0x7D) | (b == 0x5D))
    return np.where(q % 2 == 0, step, 0)


def _transitions(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For either start: the depth at the end, relative to the start."""
    now: dict = {}
    for path, at, raw, last in _split_rows(it):
        s = now.setdefault((path, at), {"first": "", "quotes": 0, "open": [0, 0]})
        b = np.frombuffer(raw, np.uint8)
        if not s["first"]:
            s["first"] = raw.lstrip()[:1].decode("utf-8", "replace") if raw.strip() else ""
        for start in (0, 1):
            s["open"][start] += int(_steps(b, (start + s["quotes"]) % 2).sum())
        s["quotes"] = (s["quotes"] + int(_quotes(b).sum())) % 2
        if last:
            s = now.pop((path, at))
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (path, at, s["first"])] + [
                pa.array([s["quotes"]], pa.int32()), pa.array([s["open"][0]], pa.int64()), pa.array([s["open"][1]], pa.int64())],
                names=["path", "at", "first", "quotes", "open0", "open1"])


def _states(rows: list) -> dict[tuple[str, int], tuple[int, int, int]]:
    """(path, split) -> (inside a string, depth, depth of the records' outside)
    at the split's start, by composing the transitions in file order."""
    out, path, state = {}, None, (0, 0, 0)
    for r in sorted(rows, key=lambda r: (r["path"], r["at"])):
        if r["path"] != path:
            path, state = r["path"], (0, 0, 1 if r["first"] == "[" else 0)
        out[path, r["at"]] = state
        inside, depth, base = state
        state = ((inside + r["quotes"]) % 2, depth + (r["open1"] if inside else r["open0"]), base)
    return out


def _cut(states):
    """The records of each split: ``begins`` and ``ends`` say whether they do
    so in the split."""
    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("begins", pa.bool_()), ("ends", pa.bool_()),
                        ("value", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for path, at, raw, last in _split_rows(it):
            if now is None:
                inside, depth, base = states.value[path, at]
                rest, here = b"", depth <= base         # of the open record; did it begin in this split?
            b = np.frombuffer(raw, np.uint8)
            steps = _steps(b, inside)
            level = depth + np.cumsum(steps)
            # records begin and end in turn; one may be open at the start
            begin = np.flatnonzero((b == 0x7B) & (steps > 0) & (level == base + 1)).tolist()
            end = (np.flatnonzero((b == 0x7D) & (steps < 0) & (level == base)) + 1).tolist()
            if depth > base:
                begin.insert(0, 0)
            out = []
            for x, y in zip(begin, end):
                out.append((here, True, rest + raw[x:y]))
                rest, here = b"", True
            if len(begin) > len(end):
                rest += raw[begin[len(end)]:]
            inside, depth = (inside + int(_quotes(b).sum())) % 2, int(level[-1])
            now = (path, at)
            if last:
                if rest:
                    out.append((here, False, rest))
                now = None
            if out:
                columns = ([path] * len(out), [at] * len(out), [o[0] for o in out], [o[1] for o in out],
                           [o[2].decode() for o in out])      # cut at ASCII characters: whole text
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def json_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, value): the text of every record of the files."""
    return _records(spark, paths)[0]


def _records(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``json_records``, and the files."""
    ship_package(spark)
    lines = (spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(list(paths))
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value"))
    rows = lines.mapInArrow(_transitions, _TRANSITION).collect()
    states = spark.sparkContext.broadcast(_states(rows))
    files = sorted({r["path"] for r in rows})
    cut = lines.mapInArrow(_cut(states), _CUT)
    whole = cut.where("begins AND ends").select("path", "value")
    # what crosses cuts: a beginning, splits wholly inside the record, an end
    # (none where the file breaks off: kept, as a record that does not parse)
    w = Window.partitionBy("path").orderBy("at", F.col("begins").cast("int"))
    pieces = cut.where("NOT (begins AND ends)").withColumn("nth", F.sum(F.col("begins").cast("int")).over(w))
    joined = pieces.groupBy("path", "nth").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("p"))
    crossing = joined.select("path", F.array_join(F.transform("p", lambda p: p["value"]), "").alias("value"))
    return whole.unionByName(crossing), files


def read_json_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The records of the files with every column that they have, as text as it
    is written (``1.50`` stays so), and each one's file as ``_source_path``.

    The records are written a line each, which Spark's reader takes in any
    splits, for the types as for the rows."""
    records, files = _records(spark, paths)
    number = F.broadcast(spark.createDataFrame([(f, i) for i, f in enumerate(files)], "path string, _file int"))
    path = scratch_path(spark, "json-lines")
    # a line break in a record is white space
    (records.join(number, "path").select(F.translate("value", "\n\r", "  ").alias("value"), "_file")
     .write.partitionBy("_file").option("compression", "gzip").text(path))
    read = spark.read.option("primitivesAsString", True).json(path)
    if "_file" not in read.columns:               # no record at all
        return records.select(F.col("path").alias("_source_path"))
    named = number.select(F.col("path").alias("_source_path"), F.col("_file").alias("_no"))
    return read.join(named, read["_file"] == named["_no"]).drop("_file", "_no")


def read_json_split(spark: SparkSession, paths: Sequence[str], schema: str | StructType) -> DataFrame:
    """The records of the files as columns; one that does not parse is a row
    of nulls, as in Spark's permissive reading."""
    records = json_records(spark, paths)
    return records.select(F.from_json("value", schema).alias("r")).select("r.*")
