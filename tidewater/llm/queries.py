"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, extraction, jaccard_join, merkle, nearest, packing, passages, quality, rank_bpe,
               resampling, token_files, toxicity, warc)
from .tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op9_decontamination(spark: SparkSession, root: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return decontamination.find_contained(read(spark, root, "documents"), read(spark, root, "benchmark"))


@query
def op1_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Passages of 50 words or more that a document has from an earlier one."""
    return passages.repeats(read(spark, root, "documents"))


@query
def op2_warc(spark: SparkSession, root: str) -> DataFrame:
    """Every page, archived and read back through the capture index."""
    return warc.round_trip(read(spark, root, "pages")).drop("url")


@query
def op3_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    """Shingle-set sizes and near-duplicate components of all documents."""
    return jaccard_join.components(read(spark, root, "documents"))


@query
def op4_nearest(spark: SparkSession, root: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return nearest.search(read(spark, root, "embeddings"))


@query
def op5_packing(spark: SparkSession, root: str) -> DataFrame:
    """Every document's pieces, placed in sequences of 2048 tokens."""
    return packing.pack(read(spark, root, "documents"))


@query
def op6_token_files(spark: SparkSession, root: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    return token_files.round_trip(read(spark, root, "documents"))


@query
def op7_toxicity(spark: SparkSession, root: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.classify(read(spark, root, "documents"), read(spark, root, "labels"))


@query
def op8_extraction(spark: SparkSession, root: str) -> DataFrame:
    """Main text of every page."""
    return extraction.extract(read(spark, root, "pages"))


@query
def op10_quality(spark: SparkSession, root: str) -> DataFrame:
    """Quality of every document."""
    return quality.classify(read(spark, root, "documents"), read(spark, root, "labels"))


@query
def op11_resampling(spark: SparkSession, root: str) -> DataFrame:
    """Every document's weight, score and rank in a draw that looks like the benchmark."""
    drawn = resampling.resample(read(spark, root, "documents"), read(spark, root, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_bpe(spark: SparkSession, root: str) -> DataFrame:
    """Every document encoded and decoded."""
    ids, decoded = F.col("ids"), F.col("decoded")
    return rank_bpe.round_trip(read(spark, root, "documents")).select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(ids, ","), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"))


@query
def op13_merkle(spark: SparkSession, root: str) -> DataFrame:
    """Every document's leaf, proof and verification in the Merkle manifest."""
    return merkle.audit(read(spark, root, "documents"))


#: Words and 5-word shingles as the operators define them, in DuckDB SQL.
_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')")

ORACLE["op9_decontamination"] = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
     items AS (SELECT item_id, least(5, len(w)) AS k, w FROM iw WHERE len(w) > 0),
     i AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2),
                  lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s FROM items),
     d AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2),
                  lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s
           FROM dw, (SELECT DISTINCT k FROM items) WHERE len(w) >= k),
     n AS (SELECT item_id, count(*) AS n FROM i GROUP BY 1),
     m AS (SELECT d.doc_id, i.item_id, count(*) AS shared FROM d JOIN i USING (k, s) GROUP BY 1, 2)
SELECT m.doc_id, m.item_id, n.n AS n_item_shingles, m.shared AS n_shared,
       CAST(m.shared AS DOUBLE) / n.n AS containment
FROM m JOIN n USING (item_id) WHERE m.shared >= 0.8 * n.n - 1e-9"""


ORACLE["op2_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS f FROM pages),
     h AS (SELECT *, sha1(b) AS s FROM p)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(s, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to
FROM h"""


ORACLE["op3_jaccard_join"] = f"""
WITH RECURSIVE dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     k AS (SELECT doc_id, w, least(5, len(w)) AS k FROM dw WHERE len(w) > 0),
     s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2),
                  lambda p: array_to_string(w[p:p + k - 1], ' '))) AS s FROM k),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
     o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
           GROUP BY 1, 2),
     e AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
     r AS (SELECT doc_id, doc_id AS to_id FROM documents
           UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.to_id)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.to_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes in DuckDB SQL, bit by bit."""
    bits = (f"flatten(list_transform(range(0, octet_length(encode({text}))), lambda p: "
            f"[CAST('0x' || substr(hex(encode({text})), 2 * p + 1, 2) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))")
    return (f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, e: "
            f"xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295)")


def _record(*fields: str) -> str:
    """SHA-256 of a record: null fields as -, others as bytes:value."""
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode(CAST({f} AS VARCHAR))) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


ORACLE["op13_merkle"] = f"""
WITH RECURSIVE d AS (SELECT *, CASE WHEN {_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} % 7 = 0
                              THEN n_chars + 1 ELSE n_chars END AS told FROM documents),
     b AS (SELECT doc_id, lang, {_record("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
                  {_record("doc_id", "source", "lang", "told", "text")} AS checked FROM d),
     o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM b),
     t AS (SELECT g, 0 AS lvl, i, leaf AS h, n FROM o
           UNION ALL
           SELECT g, lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
           FROM t WHERE n > 1 GROUP BY g, lvl, i // 2, n),
     s AS (SELECT g, lvl AS levels, h AS subroot FROM t WHERE n = 1),
     u AS (SELECT 0 AS lvl, g AS i, subroot AS h, (SELECT count(*) FROM s) AS n FROM s
           UNION ALL
           SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, i // 2, n),
     steps AS (SELECT o.g, o.i, t.lvl AS ord, CASE WHEN t.i < (o.i >> t.lvl) THEN -1 ELSE 1 END AS side, t.h
               FROM o JOIN t ON t.g = o.g AND t.i = xor(o.i >> t.lvl, 1)
               UNION ALL
               SELECT o.g, o.i, s.levels + u.lvl, CASE WHEN u.i < (o.g >> u.lvl) THEN -1 ELSE 1 END, u.h
               FROM o JOIN s ON s.g = o.g JOIN u ON u.i = xor(o.g >> u.lvl, 1)),
     alone AS (SELECT o.g, o.i, l.lvl AS ord FROM o JOIN (SELECT DISTINCT g, lvl, n FROM t) l
                 ON l.g = o.g AND l.n > 1 AND xor(o.i >> l.lvl, 1) >= l.n
               UNION ALL
               SELECT o.g, o.i, s.levels + l.lvl FROM o JOIN s ON s.g = o.g JOIN (SELECT DISTINCT lvl, n FROM u) l
                 ON l.n > 1 AND xor(o.g >> l.lvl, 1) >= l.n),
     p AS (SELECT g, i, list({{'side': side, 'h': h}} ORDER BY ord) AS path, string_agg(h, '' ORDER BY ord) AS digests
           FROM (SELECT * FROM steps UNION ALL SELECT g, i, ord, 0, '' FROM alone) GROUP BY g, i)
SELECT o.doc_id, o.leaf, s.subroot, r.h AS root, sha256(coalesce(p.digests, '')) AS proof_sha256, f.folded_root,
       f.folded_root = r.h AS verified
FROM o JOIN s ON s.g = o.g JOIN (SELECT h FROM u WHERE n = 1) r ON true LEFT JOIN p ON p.g = o.g AND p.i = o.i,
     LATERAL (SELECT (list_reduce(list_prepend({{'side': 0, 'h': o.checked}}, coalesce(p.path, [])), lambda a, x:
                {{'side': 0, 'h': sha256(CASE x.side WHEN -1 THEN x.h || a.h WHEN 1 THEN a.h || x.h ELSE a.h END)}})).h
              AS folded_root) f"""


_RUNS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
         "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

ORACLE["op11_resampling"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_RUNS} AS w FROM documents),
     dw AS (SELECT r, unnest(w) AS word FROM d),
     tw AS (SELECT unnest({_RUNS}) AS word FROM benchmark),
     v AS (SELECT word, {_crc32("word")} % 10000 AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM tw)),
     s AS (SELECT bucket, count(*) AS n FROM dw JOIN v USING (word) GROUP BY 1),
     t AS (SELECT bucket, count(*) AS n FROM tw JOIN v USING (word) GROUP BY 1),
     a AS (SELECT CAST((SELECT coalesce(sum(n), 0) FROM s) AS DOUBLE) AS s, CAST((SELECT coalesce(sum(n), 0) FROM t) AS DOUBLE) AS t),
     g AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (a.s + 10000) / ((s.n + 1)::DOUBLE * (a.t + 10000)))) AS gain
           FROM s LEFT JOIN t USING (bucket), a),
     m AS (SELECT r, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
           FROM dw JOIN v USING (word) JOIN g USING (bucket) GROUP BY r),
     e AS (SELECT d.doc_id, len(w) AS n_features, coalesce(m.weight, 0) AS weight,
                  CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
           FROM d LEFT JOIN m USING (r)),
     f AS (SELECT doc_id, n_features, weight,
                  CAST(weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM e),
     k AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place,
                  count(*) OVER (PARTITION BY n_features >= 20) AS n FROM f)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (10 * n) // 100 THEN place END AS rank FROM k"""
