"""The operators on messy small tables, against brute force."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import CLASHING, edited, messy_documents, prose, shingles_of, words_of
from pyspark.sql import functions as F

from tidewater.llm import (decontamination, extraction, jaccard_join, nearest, packing, passages, quality, token_files,
                           tokens, toxicity, warc)
from tidewater.llm.components import connected_components
from tidewater.session import scratch_path

DOCS = messy_documents()


def union_find(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(edges)
    assert got == {k: v for k, v in want.items() if any(a != b and k in (a, b) for a, b in edges)}


# ------------------------------------------------------------ op3, near copies

def true_components(rows):
    sets = [shingles_of(t) for _, t in rows]
    pairs = [(i, i) for i in range(len(rows))]
    pairs += [(i, j) for i in range(len(rows)) for j in range(i)
              if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = union_find(pairs)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root[i]].append(d)
    return [(d, len(s), d if not s else min(least[root[i]], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("region_shingles", [2_000_000, 400])
def test_jaccard_components(spark, messy, region_shingles):
    """Also with a bound that sends every larger component across tasks."""
    got = jaccard_join.components(messy, region_shingles=region_shingles).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(true_components(DOCS))


def test_clusters_of_a_region():
    """Union-find against relabelling; links span the clusters."""
    rng = random.Random(6)
    region = jaccard_join.Region([np.array([i], np.uint64) for i in range(400)], 80)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(350)]
    for i, j in pairs:
        region.join(i, np.array([j]))
    want = union_find([(i, i) for i in range(400)] + pairs)
    assert region.clusters().tolist() == [want[i] for i in range(400)] == [region.find(i) for i in range(400)]
    assert len(region.links) == 400 - len(set(want.values()))


def test_one_large_component_with_outliers(spark):
    rng = random.Random(9)
    base = prose(rng, 120)
    chain = [base]
    for _ in range(25):
        chain.append(edited(rng, chain[-1], 0.02))      # the ends are no near copies
    rows = list(enumerate(chain + [edited(rng, base, 0.01) for _ in range(60)] + [edited(rng, base, 0.2) for _ in range(20)]))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_join.components(df, region_shingles=1500).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(true_components(rows))


def test_one_of_each_group_stays(spark, messy):
    got = jaccard_join.keep_one(messy)
    assert got.columns == messy.columns
    rows = Counter((r.doc_id, r.text) for r in got.collect())
    want = set()
    for (d, t), (_, n, c) in zip(DOCS, true_components(DOCS)):
        if d == c:
            want.add((d, t))
    assert rows == Counter(want)


# ------------------------------------------------------- op1, shared passages

def test_shared_passages(spark):
    rng = random.Random(4)
    passage = prose(rng, 70)
    fuzzy = passage.split()
    for i in (20, 45):
        fuzzy[i] = "changed"
    rows = [(i, prose(rng, 100)) for i in range(20)]                              # clean
    rows += [(100 + i, f"{prose(rng, 30)} {passage} {prose(rng, 10 + i)}") for i in range(30)]
    rows += [(200, f"{prose(rng, 40)} {' '.join(fuzzy)} {prose(rng, 40)}"), (201, prose(rng, 20) + " " + " ".join(passage.split()[:30]))]
    rows += [(300, rows[0][1]), (301, None), (302, ""), (303, "be " * 200), (304, "be " * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = passages.repeats(df).collect()
    first = 100
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert set(by) == {*range(101, 130), 200, 300, 304}
    text = dict(rows)
    for d in [*range(101, 130), 200]:
        r = max((r for r in by[d] if r.src_doc_id == first), key=lambda r: r.n_words)
        assert r.n_words >= 70 and r.identity >= 0.9
        assert " ".join(words_of(text[d])[r.start:r.start + r.n_words]).find(" ".join(passage.split()[:20])) >= 0
    assert by[300][0].src_doc_id == 0 and by[300][0].n_words == 100
    left = {r.doc_id: r.text for r in passages.without_repeats(df).collect()}
    assert left[100] == text[100] and passage not in left[101] and 300 not in left
    for d in range(20):
        assert left[d] == text[d]
    assert left[301] is None and left[302] == "" and left[201] == text[201]
    assert len(words_of(left[200])) <= 81


def test_passages_of_messy_rows(spark, messy):
    out = passages.without_repeats(messy)
    assert out.columns == messy.columns
    rows = out.collect()
    assert all(r.n_chars == len(r.text or "") for r in rows)
    # no 50 words are left in two documents, but for what repeats in place
    seen = defaultdict(set)
    for r in rows:
        w = words_of(r.text)
        for i in range(len(w) - 49):
            seen[tuple(w[i:i + 50])].add(r.doc_id)
    assert not [k for k, v in seen.items() if len(v) > 1 and len(set(k)) > 1]
    assert passages.repeats(spark.createDataFrame([], messy.schema)).count() == 0


def test_rare_passage_of_common_parts(spark):
    rng = random.Random(13)
    own = lambda n: prose(rng, n).split()
    rows, want = [], []
    for base, n in ((0, 52), (1000, 60)):
        passage = own(n)
        # every 45 words of the passage stand in other texts, before, between and after
        for i in range(0, n - 44):
            rows += [(base + j + i, " ".join(own(20) + passage[i:i + 45] + own(20))) for j in (0, 100, 200)]
        rows += [(base + 50, " ".join(own(15) + passage + own(15))), (base + 150, " ".join(own(35) + passage + own(15)))]
        want.append((base + 150, base + 50, 35, n))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.src_doc_id, r.start, r.n_words) for r in passages.repeats(df).collect()]
    for doc, src, start, n in want:
        assert any(g[:2] == (doc, src) and g[2] <= start and g[2] + g[3] >= start + n for g in got)


def test_passages_of_long_words(spark):
    rng = random.Random(12)
    fresh = lambda n, size: [f"{rng.getrandbits(60):x}".ljust(size, "x") for _ in range(n)]
    rows = []
    for i, size in enumerate((50, 200, 3000)):       # bytes of a word
        shared = fresh(56, size)
        rows += [(10 * i + j, " ".join(fresh(30, 9) + shared + fresh(30, 9))) for j in range(2)]
    shared = ["漢字" * 20 + str(n) for n in range(60)]
    rows += [(100, " ".join(shared)), (101, " ".join(shared + fresh(20, 9)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.src_doc_id, r.start, r.n_words) for r in passages.repeats(df).collect()}
    assert got == {(1, 0, 30, 56), (11, 10, 30, 56), (21, 20, 30, 56), (101, 100, 0, 60)}


# ------------------------------------------------------ op9, benchmark items

def test_contained_items(spark, messy):
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate((3, 8, 25, 60, 300))] + [(5, None), (6, " "), (2, prose(rng, 12))]
    items.append((7, items[3][1].upper().replace("ß", "ß")))
    rows = list(DOCS)
    for i, (_, t) in enumerate(items):
        if t:
            rows.append((500 + i, prose(rng, 200) + "\n" + t + " " + prose(rng, 30)))
            rows.append((600 + i, prose(rng, 10) + " " + edited(rng, t, 0.03)))
    docs = spark.createDataFrame([(d, t, *CLASHING) for d, t in rows],
                                 "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for d, t in rows:
        w = words_of(t)
        for i, q in items:
            s = shingles_of(q)
            k = min(5, len(words_of(q)))
            if k:
                n = len(s & {tuple(w[p:p + k]) for p in range(len(w) - k + 1)})
                if n >= 0.8 * len(s):
                    want[(d, i, len(s), n)] += 1
    for block in (1_000_000, 10):
        got = decontamination.find_contained(docs, bench, block_shingles=block).collect()
        assert Counter((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got) == want
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    bad = {d for d, *_ in want}
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in rows if d not in bad)
    assert decontamination.find_contained(docs, bench.limit(0)).count() == 0


# ------------------------------------------------------------ op5, op6, tokens

def true_ids(text, end):
    t = tokens.encoder(tokens.default_path()).tokenizer
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_packing(spark, messy):
    got = packing.pack(messy, groups=10).collect()
    want = Counter()
    total = 0
    for d, t in DOCS:
        ids = true_ids(t, 0)
        total += len(ids)
        for k, (s, n) in enumerate(packing.cut(len(ids), 2048)):
            want[(d, k, s, n, zlib.crc32(ids[s:s + n].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for spots in bins.values():
        end = 0
        for o, n in sorted(spots):
            assert o == end
            end += n
        assert end <= 2048
    assert len(bins) <= -(-total // 2048) + 1
    assert packing.pack(spark.createDataFrame([], messy.schema)).count() == 0


def test_sequences_hold_the_tokens(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(0, 1500))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    placed = packing.pack(docs)
    seq = {r.sequence_id: r.ids for r in packing.sequences(docs, placed).collect()}
    for r in placed.collect():
        ids = true_ids(rows[r.doc_id][1], 0)[r.start:r.start + r.length]
        assert seq[r.sequence_id][r.offset:r.offset + r.length] == ids.tolist()


def test_token_files(spark, messy):
    path = scratch_path(spark, "test-tokens")
    token_files.write(messy, path, frame_ids=500, frames_per_file=3)
    got = token_files.read(spark, path).collect()
    assert token_files.files(spark, path).count() > 5
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in DOCS), key=lambda d: (d is not None, d or 0))
    want = Counter((d, len(i := true_ids(t, 2)), zlib.crc32(i.tobytes())) for d, t in DOCS)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert token_files.round_trip(spark.createDataFrame([], messy.schema)).count() == 0


# -------------------------------------------------------------- op2, archives

def test_warc_round_trip(spark, monkeypatch):
    rng = random.Random(3)
    body = [prose(rng, 40) for _ in range(5)]
    rows = [(i, f"http://H{i % 3}.example.com/{i % 11}?q={i}", rng.choice(body)) for i in range(60)]
    rows += [(60, None, None), (61, "", ""), (62, "http://a/ b\r\nX: y", "WARC/1.0\r\n\r\n\r\n\r\nWARC/1.0\r\n"),
             (63, "http://a/big", "ü" * 300_000), (None, "http://n/", body[0]), (None, "http://n/", "only nulls"),
             (5, "http://again/", rows[5][2]), (64, "http://a/\x00", "\x00\x1f")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                  "page_id long, url string, html string, same string, first string").repartition(6)
    least = {}
    for p, _, h in rows:
        if p is not None:
            least[h or ""] = min(p, least.get(h or "", p))
    want = Counter()
    for p, _, h in rows:
        raw = (h or "").encode()
        first = least.get(h or "")
        revisit = first is not None and p != first
        want[(p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
              "revisit" if revisit else "response", first if revisit else None)] += 1
    monkeypatch.setattr(warc, "DIRECTORY_FILES", 2)
    got = warc.round_trip(pages).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert {r.url for r in got if r.page_id in (7, 60)} == {rows[7][1], None}
    assert warc.round_trip(spark.createDataFrame([], pages.schema)).count() == 0


def test_one_capture_is_found_by_its_key(spark, monkeypatch):
    """And of the archive and the blocks only the files that hold it are opened."""
    monkeypatch.setattr(warc, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(warc, "FILE_CHUNKS", 2)
    pages = spark.createDataFrame([(i, f"http://a{i % 40}.example/{i}", f"<p>{i}</p>") for i in range(3000)],
                                  "page_id long, url string, html string")
    base = scratch_path(spark, "test-warc")
    warc.write(pages, f"{base}/a")
    warc.index(spark, f"{base}/a", f"{base}/i")
    assert spark.read.parquet(f"{base}/i/directory").count() >= 3
    keys = warc.keys_of(spark.createDataFrame([("http://a7.example/47",), ("http://none.example/",)], "url string"))
    captures = warc.lookup(keys, f"{base}/a", f"{base}/i")
    found = warc.fetch(captures, f"{base}/a")
    all_files = [r.path for r in warc.files(spark, f"{base}/a").select("path").collect()]
    opened = [f for f in found.inputFiles() if "/a/" in f]
    assert len(opened) == 1 and len(all_files) > 3
    assert len([f for f in captures.inputFiles() if "/i/blocks/" in f]) == 1
    got = found.collect()
    assert [(r.page_id, r.url, r.payload_bytes) for r in got] == [(47, "http://a7.example/47", len("<p>47</p>"))]


def test_archives_read_whole_are_sent_few_ranges(spark, monkeypatch):
    """What is sent to the files does not grow with their records; a capture that is asked for twice comes twice."""
    assert warc.ranges([(8, 2), (0, 5), (5, 3), (20, 4), (20, 4)]) == [(0, 10), (20, 4), (20, 4)]
    pages = spark.createDataFrame([(i, f"http://a{i % 7}.example/{i}", f"<p>{i}</p>") for i in range(300)],
                                  "page_id long, url string, html string").repartition(2)
    base = scratch_path(spark, "test-warc")
    warc.write(pages, f"{base}/a")
    warc.index(spark, f"{base}/a", f"{base}/i")
    captures = warc.lookup(warc.keys_of(pages), f"{base}/a", f"{base}/i")
    sent = []
    joined = warc._with_content
    monkeypatch.setattr(warc, "_with_content", lambda rows, path: sent.append(rows.collect()) or joined(rows, path))
    assert sorted(r.page_id for r in warc.fetch(captures, f"{base}/a").collect()) == list(range(300))
    assert sent and all(len(r.reads) == 1 for r in sent[-1])
    twice = warc.fetch(captures.filter("offset = 0").unionByName(captures.filter("offset = 0")), f"{base}/a").collect()
    assert len(twice) == 2 * len({r.page_id for r in twice}) > 0


def test_urls_with_unicode_line_ends(spark):
    urls = [f"{head}x{c}y" for head in ("http://a.example/", "a.example/") for c in "\u2028\u2029\x85\x0b\x0c\x1c"]
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    assert {r.page_id: r.url for r in warc.round_trip(pages).collect()} == dict(enumerate(urls))


# --------------------------------------------------------------- op4, vectors

def test_nearest_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 12)).astype(np.float32)
    x[100:400] = x[100]                                  # a crowd of equal vectors
    x[500:] *= 3                                         # norms differ
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1020, [0.0] * 12), (1040, [1.0, None] + [0.0] * 10), (1060, [float("nan")] * 12),
             (1080, [float("inf")] * 12), (1100, []), (None, x[0].tolist()), (1120, [1.0, 2.0]), (1140, [2.0, 1.0]), rows[7]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, cls string, dim int").repartition(5)
    got = defaultdict(list)
    for r in nearest.search(df, block_rows=64).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    hits = total = 0
    for q in (i for i in good if i % 20 == 0):
        near = sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q])))[:20]
        mine = sorted(got.pop(q))
        assert [k for k, _, _ in mine] == list(range(1, len(near) + 1))
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        for _, i, s in mine:
            assert s == pytest.approx(float(good[q] @ good[i]), rel=1e-12)
        hits += len({i for _, i in near} & {i for _, i, _ in mine})
        total += len(near)
    assert not got and hits >= 0.9 * total
    assert nearest.search(spark.createDataFrame([], df.schema)).count() == 0


def test_ties_of_different_vectors_go_to_the_smaller_ids(spark):
    rng = np.random.default_rng(8)
    codes = rng.choice(np.arange(1, 4096), 900, replace=False)
    ids = rng.permutation(2000)[:900]
    x = {int(i): ((c >> np.arange(12)) & 1).astype(float) for i, c in zip(ids, codes)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], "vec_id long, embedding array<double>").repartition(7)
    got = defaultdict(list)
    for r in nearest.search(df, block_rows=64).collect():
        got[r.query_id].append((r["rank"], r.vec_id))
    for q in (i for i in x if i % 20 == 0):
        near = sorted((-float(x[q] @ v), i) for i, v in x.items() if i != q)[:20]
        assert [i for _, i in sorted(got[q])] == [i for _, i in near]


def test_exact_way_for_poor_buckets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 16)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(r.query_id for r in nearest.search(df, tables=1, probes=1).collect())
    assert got == Counter({q: 20 for q in range(0, 300, 20)})


# ------------------------------------------------------- op7, op10, classifiers

def labelled(spark, bad, seed):
    rng = random.Random(seed)
    vocabulary = [w for w in prose(rng, 400).split() if len(w) > 2]      # words that texts share
    rows, labels = [], []
    for i in range(700):
        t = [rng.choice(vocabulary) for _ in range(rng.randint(5, 150))]
        y = i % 4 == 0
        rows.append((i, bad(rng, t) if y else " ".join(t)))
        labels.append((i, int(not y), int(y)))
    rows += [(900, None), (901, ""), (None, "x"), (902, "word " * 20_000), rows[3]]
    labels += [(3, labels[3][1], labels[3][2]), (5, None, None), (None, 1, 1), (9999, 0, 1)]
    docs = spark.createDataFrame([(*r, 7, "z") for r in rows], "doc_id long, text string, y int, pick string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(rows)


def accuracy(rows, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect() if r.doc_id is not None and r[column] is not None}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    return sum(p == y for p, y in held) / len(held)


def test_quality(spark):
    docs, labels, _ = labelled(spark, lambda rng, t: " ".join(w.upper() + rng.choice(["%%%", "&&&", "!!"]) for w in t), 1)
    got = quality.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert accuracy(got, labels, "quality") >= 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.predicted)


def test_toxicity(spark):
    docs, labels, _ = labelled(spark, lambda rng, t: " ".join([*t, rng.choice(["scum", "moron,", "lowei" + "xyz"[rng.randrange(3)]])]), 2)
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert accuracy(got, labels, "toxic") >= 0.95


@pytest.mark.parametrize("module", [quality, toxicity])
def test_labels_of_one_class_or_none(spark, module):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    for labels, share in (([], 0.5), ([(i, 1, 1) for i in range(1, 40)], None)):
        df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        scores = {r.score for r in module.classify(docs, df).collect()}
        assert len(scores) == 1 and (share is None or scores == {share}) and 0 < min(scores) < 1
    assert module.classify(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# ---------------------------------------------------------------- op8, pages

def test_extraction(spark):
    rng = random.Random(6)
    p = [prose(rng, 40).capitalize() + "." for _ in range(4)]
    page = ("<html><head><title>t</title><script>x='<p>'</script></head><body><nav><ul><li><a href=/a>home</a><li><a href=/b>more</a></ul></nav>"
            f"<div class=cookie-notice>We use cookies.</div><article><h1>A  head</h1><p>{p[0]}<p>{p[1]} &amp;\n more</article>"
            "<div id=comments><p>nice</p><div class=comment><p>I do not agree with this at all, friends.</p></div></div>"
            "<footer>&copy; 2024 <a href=/i>imprint</a></footer>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<<<"), (1, "u", page), (None, "u", page[:300]),
            (5, "u", "<article>" + "".join(f"<p>{q}</p>" for q in p * 300) + "</article>")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = extraction.extract(df, training_pages=150).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[1] == f"A head\n{p[0]}\n{p[1]} & more"
    assert by[2] == "" and by[3] == "" and by[5] == "\n".join(p * 300)
    assert extraction.extract(df.limit(0), training_pages=50).count() == 0


# -------------------------------------------- op1, ties, cuts and collisions

def _near_copies(rng, n):
    base = prose(rng, 150)
    rows = [(i, edited(rng, base, 0.04)) for i in range(n)]
    rows += [(1000 + i, prose(rng, 60) + " " + edited(rng, " ".join(base.split()[40:110]), 0.1)) for i in range(10)]
    return rows + [(2000, prose(rng, 200)), (2001, base), (2002, base)]


def test_passages_do_not_depend_on_partitions(spark):
    rows = _near_copies(random.Random(12), 25)
    got = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (3, 7, 50):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
            got.append(sorted(map(tuple, passages.repeats(df).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got[0] == got[1] == got[2] and {r[0] for r in got[0]} >= {*range(1, 25), *range(1000, 1010), 2001, 2002}


def test_unequal_texts_of_one_hash_are_kept_apart(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 60 + i)) for i in range(30)] + [(40, ""), (41, None), (42, "a"), (43, "b"), (44, "a")]
    rows += [(50 + i, rows[i][1]) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(5)).cast("long")
    left = {r.doc_id: r.text for r in passages.without_repeats(df, hash_of=weak).collect()}
    assert left == dict(rows[:35])
    want = sorted(map(tuple, passages.repeats(df).collect()))
    assert sorted(map(tuple, passages.repeats(df, hash_of=weak).collect())) == want and len(want) == 3
    named = passages._named(df, "text", "cls", weak).groupBy("cls").agg(F.count_distinct(F.coalesce("text", F.lit(""))).alias("n"))
    assert named.filter("n > 1").count() == 0


def test_cutting_ranges(spark):
    rows = [("aé漢b c", [(0, 1), (3, 3)]), ("abc", None), ("abc def", [(0, 7)]), ("abcdef", [(1, 3), (2, 1), (4, 1)]), (None, None)]
    df = spark.createDataFrame(rows, "t string, p array<struct<at: long, n: long>>")
    got = [r[0] for r in df.select(passages._cut(F.coalesce("t", F.lit("")), F.col("p"))).collect()]
    assert got == ["éb c", None, "", "af", None]


@pytest.mark.parametrize("share,least", [(0.1, 0.97), (0.15, 0.95), (0.2, 0.75)])
def test_recall_of_fuzzy_passages(spark, share, least):
    """Through the query: passages of 60 words with scattered changes, each shared by two documents."""
    rng = random.Random(int(share * 100))
    rows, n = [], 60
    for i in range(n):
        passage = prose(rng, 60).split()
        other = list(passage)
        for j in rng.sample(range(60), round(60 * share)):
            other[j] = "X" + prose(rng, 1)
        rows += [(i, prose(rng, 80) + " " + " ".join(passage) + " " + prose(rng, 50)),
                 (1000 + i, prose(rng, 40) + " " + " ".join(other) + " " + prose(rng, 90))]
    found = {r.doc_id for r in passages.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert found <= {1000 + i for i in range(n)} and len(found) >= least * n


def test_passages_of_runs_that_come_again_and_again(spark):
    """Two words in turn, 400 of them, after and before other words: every document's run is covered, by a few
    passages, not by one for each place of the run."""
    run = " ".join(["der", "und"] * 200)
    df = spark.createDataFrame([(i, " ".join([f"vor{i}a{j}" for j in range(i)] + [run] + [f"nach{i}a{j}" for j in range(5)]))
                                for i in range(6)], "doc_id long, text string")
    got = passages.repeats(df).collect()
    for i in range(1, 6):
        own = [r for r in got if r.doc_id == i]
        covered = set().union(*(range(r.start, r.start + r.n_words) for r in own))
        assert set(range(i, i + 400)) <= covered and len(own) <= 20, (i, len(own))
    left = {r.doc_id: r.text.split() for r in passages.without_repeats(df).collect()}
    assert len(left[0]) == 405 and all("und" not in left[i] for i in range(1, 6))
