"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib

import pytest
from llm_data import messy_documents, prose

from tidewater.llm import resampling


def runs(text, max_run):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i:i + n]) for n in range(1, max_run + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, max_run=1, buckets=10_000, percent=10, min_words=20):
    def totals(texts):
        out = [0] * buckets
        for t in texts:
            for f in runs(t, max_run)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = totals([x for _, x in rows]), totals(target)
    gain = [math.floor(1000 * math.log((b + 1.0) * (sum(s) + buckets) / ((a + 1.0) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in rows:
        n, features = runs(text, max_run)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n, len(features), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("max_run,head,percent", [(1, 1 << 16, 10), (1, 0, 50), (1, 7, 100), (2, 50, 30), (3, 40, 30), (2, 0, 30)])
def test_against_a_plain_version(spark, messy, max_run, head, percent):
    """The head's size changes nothing, from no head to all words."""
    rng = random.Random(2)
    target = [prose(rng, 50) for _ in range(5)] + [messy_documents()[0][1], None, "", "a b A-b 7x É"]
    t = spark.createDataFrame([(x, "c") for x in target], "text string, doc_id string")
    got = resampling.resample(messy, t, max_run=max_run, head_words=head, head_pairs=head, percent=percent, buckets=500)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(messy_documents(), target, max_run, 500, percent)


def test_ties_and_empty_tables(spark):
    rows = [(i % 4, "the same words " * 10) for i in range(40)] + [(None, "the same words " * 10)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    t = spark.createDataFrame([("other words",)], "text string")
    want = plain(rows, ["other words"], percent=50)
    assert sorted(map(tuple, resampling.resample(df, t, percent=50).collect()), key=repr) == want
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(none, t).collect() == []
    assert sorted(map(tuple, resampling.resample(df, none).collect()), key=repr) == plain(rows, [])


def test_the_head_holds_the_most_frequent_words(spark):
    long = "x" * (resampling.HEAD_BYTES + 1)
    df = spark.createDataFrame([(f"b a a {long} {long} {long} c b",), ("a d",), (None,)], "text string")
    assert resampling.frequent_words(df, 2) == resampling.frequent_words(df, 3) == [b"a", b"b"]
    assert resampling.frequent_words(df, 4) == [b"a", b"b", b"c", b"d"] and resampling.frequent_words(df, 1) == []
    assert resampling.frequent_pairs(df, [b"a", b"b"], 5) == [(b"a", b"a"), (b"b", b"a")]
