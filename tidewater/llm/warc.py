"""WARC archives with a two-level capture index.

Writing.  Each page becomes a record, gzip-compressed on its own; of pages
with equal payloads of at least ``min_bytes`` the smallest page_id gets a
``response`` record and the others ``revisit`` records that refer to it.
Files hold up to ``FILE_CHUNKS`` chunks of about a megabyte of records.

Index, level one: a line per record (key, date, JSON with file, offset and
length), sorted by the reversed-host URL key and cut into gzip blocks of
``BLOCK_LINES`` lines.  Level two: a sparse directory with one row per block
(first and last key, file, offset, length).

Look-up.  Keys find their index file and then their blocks by binary search
in the directory; only those blocks and then only the records that they name
are decompressed, each by its byte range.

All files go through Spark's writers and readers, so any file system works.
The last byte of a gzip member below 16 MB is always zero; that byte is the
text sink's separator, so the files are exactly concatenated gzip members.

Defined cases: a null html is the empty payload; a null url has the key "-";
null page_ids never represent others, a group with only null ids has only
responses; rows that repeat the smallest page_id are all responses.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import prepare, written
from .textfile import files, write_frames
from .textkit import as_batch

DATE = "2024-01-01T00:00:00Z"
CHUNK_BYTES = 1 << 20
FILE_CHUNKS = 8
BLOCK_LINES = 1000
BLOCKS_PER_FILE = 256
MEMBER_BYTES = (1 << 24) - 1       # uncompressed bytes of a gzip member with a zero last byte
#: Index files whose key ranges are sent to the executors at a time (each
#: stands for a quarter of a million captures); more are searched in blocks.
DIRECTORY_FILES = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort key of a URL: its host reversed, then path and query."""
    if url is None:
        return "-"
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)([^#]*)", url)
    if not m:
        return url.split("#")[0].replace("\n", "%0A").replace(" ", "%20")
    host = m.group(1).rpartition("@")[2].lower()
    host = re.sub(r":(80|443)?$", "", host)
    name, colon, port = host.partition(":")
    key = ",".join(reversed(name.split("."))) + colon + port + ")" + (m.group(2) or "/")
    return re.sub(r"\s", lambda c: f"%{ord(c.group()):02X}", key)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(m.group(1)) if m else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC/1.1 response or revisit record with an HTTP block."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", "", url))
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record; the block is cut by Content-Length."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) for line in lines[1:])
    return head, raw[end + 4:end + 4 + int(head["Content-Length"])]


def members(raw: bytes, level: int = 4) -> bytes:
    """Gzip members of ``raw``, each short enough to end with a zero byte."""
    out = []
    for lo in range(0, len(raw), MEMBER_BYTES):
        c = zlib.compressobj(level, wbits=31)
        out.append(c.compress(raw[lo:lo + MEMBER_BYTES]) + c.flush())
    return b"".join(out)


def member_at(data: memoryview, at: int) -> tuple[bytes, int]:
    """(content, length) of the gzip member that begins at byte ``at``."""
    d = zlib.decompressobj(wbits=31)
    out, p = [], at
    while not d.eof:
        part = data[p:p + (1 << 16)]
        if not part:
            raise ValueError("a gzip member is cut off")
        out.append(d.decompress(part))
        p += len(part)
    return b"".join(out), p - len(d.unused_data) - at


def records_of(content) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of all records of a file; a record longer
    than a member goes on in the next ones."""
    data = memoryview(content)
    at = 0
    while at < len(data):
        raw, n = member_at(data, at)
        size = n
        if len(raw) == MEMBER_BYTES:
            need = raw.index(b"\r\n\r\n") + 8 + int(re.search(rb"\r\nContent-Length: (\d+)\r\n\r\n", raw).group(1))
            parts = [raw]
            while sum(map(len, parts)) < need:
                raw, n = member_at(data, at + size)
                parts.append(raw)
                size += n
            raw = b"".join(parts)
        yield at, size, raw
        at += size


def read_range(content, offset: int, length: int) -> bytes:
    """Uncompressed bytes of the members in a byte range of a file."""
    data = memoryview(content)[offset:offset + length]
    out, at = [], 0
    while at < len(data):
        raw, n = member_at(data, at)
        out.append(raw)
        at += n
    return b"".join(out)


def ranges(reads: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges (offset, length) of reads, in order; those that follow one
    another without a gap are one range, and one that comes twice is two."""
    out: list[tuple[int, int]] = []
    for offset, length in sorted(reads):
        if out and sum(out[-1]) == offset:
            out[-1] = (out[-1][0], out[-1][1] + length)
        else:
            out.append((offset, length))
    return out


# ------------------------------------------------------------------- writing

def write(pages: DataFrame, path: str, *, min_bytes: int = 0) -> None:
    """Write a record for every row of (page_id, url, html)."""
    prepare(pages)
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("same", F.sha2("payload", 256))
    # copies meet as narrow rows; payloads join by page and hash, so the pages
    # of a payload that many share stay spread
    ids = p.select("page_id", "same").distinct()
    first = (ids.groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
             .filter("pages > 1 AND first IS NOT NULL").select(F.col("same").alias("of"), "first"))
    later = (ids.join(first, ids["same"] == first["of"]).filter(~F.col("page_id").eqNullSafe(F.col("first")))
             .select(F.col("page_id").alias("copy"), "of", "first"))
    joined = (p.join(later, (p["same"] == later["of"]) & p["page_id"].eqNullSafe(later["copy"]), "left")
              .select("page_id", "url", "payload", "first"))
    schema = pa.schema([("chunk", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in it:
            for page_id, url, payload, first_id in zip(*(c.to_pylist() for c in batch.columns)):
                revisit = first_id is not None and len(payload) >= min_bytes
                held.append(members(record(page_id, url, payload, first_id, revisit)))
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield as_batch(schema, [b"".join(held)[:-1]])
                    held, size = [], 0
        if held:
            yield as_batch(schema, [b"".join(held)[:-1]])

    write_frames(joined.mapInArrow(run, "chunk binary"), "chunk", path, "\0", FILE_CHUNKS)


# ------------------------------------------------------------------- indexing

def _named(spark: SparkSession, path: str) -> DataFrame:
    return files(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


#: Files that a look-up opens by name; where it needs more, it reads the folder.
FILES_BY_NAME = 1000


def _with_content(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (file, reads) with the files' contents.  Only files that a row
    names are opened, as long as their names are few enough to be listed."""
    spark = rows.sparkSession
    rows = written(rows, "warc-reads")
    names = [r.file for r in rows.select("file").distinct().limit(FILES_BY_NAME + 1).collect()]
    if not names:
        content = spark.createDataFrame([], "file string, content binary")
    elif len(names) <= FILES_BY_NAME:
        content = (spark.read.format("binaryFile").load([f"{path}/{n}" for n in names])
                   .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))
    else:
        content = _named(spark, path)
    return rows.join(content, "file").select("reads", "content")


def index(spark: SparkSession, archive: str, path: str) -> None:
    """Write both levels of the index of the files in ``archive``: blocks to
    ``path``/blocks and the directory to ``path``/directory."""
    line = pa.schema([("key", pa.string()), ("page", pa.int64()), ("line", pa.string())])

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                keys, ids, lines = [], [], []
                for offset, length, raw in records_of(batch.column(1)[i].as_buffer()):
                    head, _ = parse_record(raw)
                    url = head.get("WARC-Target-URI")
                    keys.append(url_key(url))
                    ids.append(_page_id(head["WARC-Record-ID"]))
                    lines.append(json.dumps({"url": url, "mime": "text/html" if head["WARC-Type"] == "response"
                                             else "warc/revisit", "digest": head["WARC-Payload-Digest"],
                                             "filename": name, "offset": offset, "length": length},
                                            ensure_ascii=False))
                yield as_batch(line, keys, ids, lines)

    block = pa.schema([("block", pa.binary())])

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        date = re.sub(r"\D", "", DATE)
        for batch in it:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(f"{key} {date} {text}\n")
                if len(held) == BLOCK_LINES:
                    yield as_batch(block, [_block(held)])
                    held = []
        if held:
            yield as_batch(block, [_block(held)])

    entries = written(_named(spark, archive).mapInArrow(scan, "key string, page long, line string"), "captures")
    # the sort reaches beyond the key, so that a key of many captures is cut
    order = ["key", "page", F.xxhash64("line")]
    blocks = entries.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "line")
    write_frames(blocks.mapInArrow(pack, "block binary"), "block", f"{path}/blocks", "\0", BLOCKS_PER_FILE)

    entry = pa.schema([("file", pa.string()), ("first", pa.string()), ("last", pa.string()),
                       ("offset", pa.int64()), ("length", pa.int64())])

    def outline(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                name, data = batch.column(0)[i].as_py(), memoryview(batch.column(1)[i].as_buffer())
                at = 0
                while at < len(data):
                    raw, n = member_at(data, at)
                    first, last = (raw[lo:raw.index(b" ", lo)].decode() for lo in (0, raw.rfind(b"\n", 0, -1) + 1))
                    yield as_batch(entry, [name], [first], [last], [at], [n])
                    at += n

    _named(spark, f"{path}/blocks").mapInArrow(
        outline, "file string, first string, last string, offset long, length long").write.parquet(f"{path}/directory")


def _block(lines: list[str]) -> bytes:
    raw = "".join(lines).encode()
    c = zlib.compressobj(6, wbits=31)
    return (c.compress(raw) + c.flush())[:-1]


# -------------------------------------------------------------------- look-up

def _find(firsts: list[str], lasts: list[str], key: str) -> range:
    """The consecutive entries whose key ranges hold ``key``, by binary search."""
    return range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key))


def lookup(keys: DataFrame, archive: str, path: str) -> DataFrame:
    """(key, filename, offset, length) of every capture of the keys in the
    column ``key`` (each distinct key once)."""
    spark = prepare(keys)
    directory = spark.read.parquet(f"{path}/directory")
    ranges = directory.groupBy("file").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    wanted = keys.select("key").distinct()
    routed = None
    held: list = []

    def route(part: list) -> DataFrame:
        part = sorted(part, key=lambda r: (r["first"], r["last"]))
        sent = spark.sparkContext.broadcast(([r["first"] for r in part], [r["last"] for r in part],
                                             [r["file"] for r in part]))

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("key", pa.string()), ("file", pa.string())])
            firsts, lasts, names = sent.value
            for batch in it:
                hits = [(k, names[j]) for k in batch.column(0).to_pylist() for j in _find(firsts, lasts, k)]
                if hits:
                    yield as_batch(schema, *map(list, zip(*hits)))

        return wanted.mapInArrow(run, "key string, file string")

    for r in ranges.toLocalIterator():
        held.append(r)
        if len(held) == DIRECTORY_FILES:
            routed = route(held) if routed is None else routed.unionByName(route(held))
            held = []
    if held or routed is None:
        routed = route(held) if routed is None else routed.unionByName(route(held))

    # the directory of one index file is one row: its blocks, in key order
    by_file = directory.groupBy("file").agg(F.sort_array(F.collect_list(F.struct(
        "first", "last", "offset", "length"))).alias("blocks"))
    schema = pa.schema([("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in it:
            blocks = batch.column(2)
            hits = []
            for i, (key, name) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if name not in known:
                    rows = blocks[i].as_py()
                    known = {name: ([b["first"] for b in rows], [b["last"] for b in rows], rows)}
                firsts, lasts, rows = known[name]
                hits += [(key, name, rows[j]["offset"], rows[j]["length"]) for j in _find(firsts, lasts, key)]
            if hits:
                yield as_batch(schema, *map(list, zip(*hits)))

    # keys of one index file meet its directory row once for each file, not
    # once for each key: they are grouped by file and by a share of its keys
    shares = (routed.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(64)))
              .groupBy("file", "share").agg(F.collect_list("key").alias("keys")))
    at = shares.join(by_file, "file").select(F.explode("keys").alias("key"), "file", "blocks")
    blocks = at.mapInArrow(search, "key string, file string, offset long, length long")
    reads = blocks.groupBy("file", "offset", "length").agg(F.collect_list("key").alias("keys"))
    per_file = reads.groupBy("file").agg(F.collect_list(F.struct("offset", "length", "keys")).alias("reads"))
    found = pa.schema([("key", pa.string()), ("filename", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def captures(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                content = batch.column(1)[i].as_buffer()
                for r in batch.column(0)[i].as_py():
                    keys_here = set(r["keys"])
                    rows = []
                    for text in read_range(content, r["offset"], r["length"]).decode().split("\n")[:-1]:
                        key, _, body = text.split(" ", 2)
                        if key in keys_here:
                            c = json.loads(body)
                            rows.append((key, c["filename"], c["offset"], c["length"]))
                    if rows:
                        yield as_batch(found, *map(list, zip(*rows)))

    return (_with_content(per_file, f"{path}/blocks")
            .mapInArrow(captures, "key string, filename string, offset long, length long"))


_PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def fetch(captures: DataFrame, archive: str) -> DataFrame:
    """The records at (filename, offset, length): page_id, url, payload_bytes,
    payload_digest, record_type, refers_to.  A response's digest and size are
    taken from its payload and must equal its header's."""
    spark = prepare(captures)
    per_file = (captures.groupBy("filename").agg(F.collect_list(F.struct("offset", "length")).alias("reads"))
                .withColumnRenamed("filename", "file"))
    reads = pa.schema([("file", pa.string()), ("reads", pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())])))])

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield as_batch(reads, batch.column(0), [
                [{"offset": a, "length": n} for a, n in ranges((r["offset"], r["length"]) for r in rows.as_py())]
                for rows in batch.column(1)])

    # records that follow one another are one range: rows so short that they
    # are sent to the files, whose contents are not shuffled
    per_file = per_file.mapInArrow(merge, "file string, reads array<struct<offset: bigint, length: bigint>>")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                content = memoryview(batch.column(1)[i].as_buffer())
                rows = []
                for raw in (raw for r in batch.column(0)[i].as_py()
                            for _, _, raw in records_of(content[r["offset"]:r["offset"] + r["length"]])):
                    head, block = parse_record(raw)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
                    stated = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = head["WARC-Type"]
                    if kind == "response" and (len(payload) != size or digest_of(payload) != stated):
                        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
                    rows.append((_page_id(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), size, stated, kind,
                                 _page_id(head.get("WARC-Refers-To"))))
                yield as_batch(_PAGES, *map(list, zip(*rows)))

    return (_with_content(per_file, archive)
            .mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, "
                             "record_type string, refers_to long"))


def keys_of(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The look-up keys of a column of URLs."""
    prepare(urls)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays(
                [pa.array([url_key(u if u is None else re.sub(r"[\r\n]", "", u)) for u in batch.column(0).to_pylist()],
                          pa.string())], ["key"])

    return urls.select(F.col(url_col).cast("string").alias("url")).distinct().mapInArrow(run, "key string")


def round_trip(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """Archive the pages, index the archive, and read every page back by its URL."""
    spark = prepare(pages)
    base = scratch_path(spark, "warc")
    write(pages, f"{base}/archive", min_bytes=min_bytes)
    index(spark, f"{base}/archive", f"{base}/index")
    return fetch(lookup(keys_of(pages), f"{base}/archive", f"{base}/index"), f"{base}/archive")
