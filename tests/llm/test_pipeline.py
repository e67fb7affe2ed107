"""The corpus pipeline, stage by stage against plain versions, and as a whole."""

import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from llm_data import messy_documents, prose, shingles_of, words_of
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tidewater.llm import quality, tokens  # noqa: E402

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    rows = messy_documents(seed=21)
    junk = [(500 + i, " ".join(rng.choice(["$$$", "!!!", "buy", "now", "xx"]) for _ in range(80))) for i in range(40)]
    items = [prose(rng, 25) for _ in range(4)]
    leaks = [(600 + i, f"{prose(rng, 60)} {items[i % 4]} {prose(rng, 60)}") for i in range(8)]
    rows = rows + junk + leaks
    root = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in rows], DDL).repartition(4)
    docs.write.parquet(f"{root}/documents.parquet")
    labels = [(i, int(not 500 <= i < 540), 0) for i, t in rows if i is not None and (t or "").strip()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, items


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def best_of_components(rows):
    sets = [shingles_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append((d is None, d or 0))
    kept = set()
    for i, (d, t) in enumerate(rows):
        if not sets[i] or (d is None, d or 0) == min(least[find(i)]):
            kept.add((d, t))
    return kept


def test_stages_and_the_whole(spark, corpus):
    root, items = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, root)
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = corpus_pipeline.written(docs, f"test-{name}")
        out[name] = docs
    given = rows_of(spark.read.parquet(f"{root}/documents.parquet"))

    # 1: what the classifier scores below its threshold goes; junk does, prose stays
    scores = quality.classify(spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet"))
    bad = Counter(r.doc_id for r in scores.filter("predicted = 0").collect())
    good = rows_of(out["quality_classifier"])
    assert Counter(d for d, _ in good) == Counter(d for d, _ in given) - bad
    assert sum(1 for d, _ in good if d is not None and 500 <= d < 540) <= 4
    assert {600 + i for i in range(8)} <= {d for d, _ in good}

    # 2: the least id of each component of near copies
    one = rows_of(out["ngram_jaccard_join"])
    want = best_of_components(good)
    assert {r for r in one if shingles_of(r[1])} == {r for r in want if shingles_of(r[1])}
    assert len(one) == len(set(one)) or len([r for r in one if not shingles_of(r[1])]) > 1

    # 3: no 50 words in two documents, and nothing but repeats is lost
    left = rows_of(out["substring_dedup"])
    seen = defaultdict(set)
    for d, t in left:
        w = words_of(t)
        for i in range(len(w) - 49):
            seen[tuple(w[i:i + 50])].add(d)
    assert not [k for k, v in seen.items() if len(v) > 1 and len(set(k)) > 1]
    before = defaultdict(set)
    for d, t in one:
        before[d] |= set(words_of(t))
    assert all(set(words_of(t)) <= before[d] for d, t in left)

    # 4: documents that hold four fifths of an item's shingles
    clean = rows_of(out["benchmark_decontamination"])
    sets = [shingles_of(t) for t in items]
    holds = lambda t: any(len(s & shingles_of(t)) >= 0.8 * len(s) for s in sets)
    assert Counter(clean) == Counter(r for r in left if not holds(r[1]))
    assert not {600 + i for i in range(8)} & {d for d, _ in clean}

    # 5: every id of every document once, in sequences of at most 2048
    library = Tokenizer.from_file(tokens.default_path())
    pieces = out["best_fit_packing"].collect()
    ids = defaultdict(list)                         # an id may stand for several texts
    for d, t in clean:
        ids[d].append(library.encode(t or "", add_special_tokens=False).ids + [0])
    by = defaultdict(list)
    for r in pieces:
        by[r.doc_id].append(r)
    assert set(by) == set(ids)
    room = defaultdict(list)
    for d, rs in by.items():
        for r in rs:
            parts = [x[r.start:r.start + r.length] for x in ids[d]]
            assert r.ids_crc32 in [zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)) for part in parts]
            room[r.sequence_id].append((r.offset, r.length))
        assert sum(r.length for r in rs) == sum(map(len, ids[d]))
    for places in room.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048

    whole = corpus_pipeline.run(spark, root)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, pieces))


def test_an_empty_corpus(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([], DDL).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    assert corpus_pipeline.run(spark, root).count() == 0
