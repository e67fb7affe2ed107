"""Task-side kernels against plain Python, without Spark."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import edited, prose, shingles_of, words_of

from tidewater.llm import dom, extraction, jaccard_join, nearest, packing, passages, token_files, tokens, toxicity, warc
from tidewater.llm.decontamination import ItemIndex
from tidewater.llm.labelled_pages import MAIN, OTHER, labelled_page
from tidewater.llm.textkit import shingle_sets, text_slices, words

TEXT = st.text(alphabet="ab é\t\nAßZ　 .,'|<>", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT | st.none(), max_size=12), st.integers(1, 80))
def test_words_and_shingles_equal_plain_python(texts, max_bytes):
    seen = {}
    row = 0
    for lo, hi, data, offs in text_slices(pa.array(texts, pa.string()), max_bytes):
        assert lo == row
        row = hi
        h, begin, end, bounds = words(data, offs)
        for i, (t, s) in enumerate(zip(texts[lo:hi], shingle_sets(data, offs))):
            w = words_of(t)
            assert bounds[i + 1] - bounds[i] == len(w)
            for x, y in zip(w, h[bounds[i]:bounds[i + 1]].tolist()):
                assert seen.setdefault(x, y) == y
            assert len(s) == len(shingles_of(t)) and (np.diff(s.astype(object)) > 0).all()
    assert row == len(texts) and len(set(seen.values())) == len(seen)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab é　 \t\n\r'’sD1²½.!<|>endoftxÿ×ß中", max_size=40), max_size=8))
def test_encoder_equals_the_library(texts):
    enc = tokens.encoder(tokens.default_path())
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = []
    for _, _, data, offs in text_slices(pa.array(texts, pa.string())):
        ids, at = enc.encode(data, offs)
        got += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    assert got == want


def test_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    enc = tokens.Encoder(tokens.default_path())
    for n in range(4):
        text = prose(random.Random(n), 30) + " <|endoftext|>"
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = enc.encode(data, np.array([0, len(data)]))
        assert ids.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("high", [1, 2, 300, 50257, 2 ** 32 - 1])
def test_frames_round_trip(n, high):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n).astype(np.uint32)
    if n:
        ids[rng.integers(0, n, max(1, n // 30))] = high - 1
    raw = token_files.frame([None, -5], np.array([n // 2, n - n // 2]), ids)
    two = list(token_files.frames_of(raw + b"\n" + raw + b"\n"))
    assert len(two) == 2 and two[0].size == len(raw) and two[1].doc_ids == [None, -5]
    assert (two[1].ids() == ids).all()
    for lo, hi in ((0, n), (3, 9), (100, 400), (max(0, n - 1), n)):
        assert (two[0].read_range(lo, hi) == ids[lo:hi]).all()


def test_outliers_become_exceptions():
    ids = np.full(128, 7, np.uint32)
    ids[[5, 90]] = 4_000_000_000
    start, area = token_files.encode_blocks(ids)
    assert area[4] == 0 and area[5] == 2 and len(area) == 6 + 2 * 5
    assert (token_files.decode_blocks(area, start) == ids).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300), st.integers(1, 12))
def test_plan_places_every_piece_once(lengths, groups):
    counts = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
    runs = packing.plan(counts, 64, groups, 4)
    placed = np.zeros(65, int)
    bins = {}
    ranks = {}
    for n, first, number, bin_, offset in runs.tolist():
        placed[n] += number
        for i in range(number):
            bins.setdefault(bin_ + i, []).append((offset, n))
            assert ranks.setdefault((n, first + i), True)
    assert (placed == counts).all() and len(ranks) == counts.sum()
    for spots in bins.values():
        end = 0
        for offset, n in sorted(spots):
            assert offset == end
            end += n
        assert end <= 64


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(0)
    for lengths in (np.clip(rng.lognormal(6.5, 1, 50_000), 1, 2048).astype(int), rng.integers(300, 1500, 50_000)):
        counts = np.bincount(lengths, minlength=2049)
        runs = packing.plan(counts)
        used = int((runs[:, 3] + runs[:, 2]).max())
        assert used <= 1.01 * -(-lengths.sum() // 2048)


def test_cut_leaves_the_short_piece_first():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def brute_chain(x, y, gain, cost):
    best = [gain] * len(x)
    for i in range(len(x)):
        for j in range(len(x)):
            if x[j] < x[i] and y[j] < y[i]:
                best[i] = max(best[i], gain + best[j] - cost * (x[i] - x[j] + y[i] - y[j]))
    return max(best)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=25, unique=True))
def test_chain_is_the_best_one(points):
    points.sort()
    x, y = (np.array(c) for c in zip(*points))
    path = passages._best_chain(x, y, 8.0, 0.3)
    px, py = x[path], y[path]
    assert (np.diff(px) > 0).all() and (np.diff(py) > 0).all()
    worth = 8.0 * len(path) - 0.3 * (px[-1] - px[0] + py[-1] - py[0])
    assert worth == pytest.approx(brute_chain(x.tolist(), y.tolist(), 8.0, 0.3))


def test_every_window_has_its_minimum():
    rng = np.random.default_rng(3)
    for n in (1, 5, 17, 18, 200):
        h = rng.integers(0, 30, n).astype(np.uint64)
        m = passages.minimizers(h, 17)
        want = {i + int(h[i:i + 17].argmin()) for i in range(max(1, n - 16))}
        assert set(m.tolist()) == want


def test_alignment_finds_the_whole_passage():
    a = np.arange(1000, 1100).astype(np.uint64)
    x = np.concatenate([np.arange(20), a]).astype(np.uint64)
    y = np.concatenate([np.arange(500, 505), a, np.arange(700, 720)]).astype(np.uint64)
    y[60] = 9                                            # one word differs
    got = passages.align(x, y, np.array([30, 100]), np.array([15, 85]), 8)
    assert got == (20, 120, 5, 105, 99)


def test_an_exact_passage_survives_a_bad_neighbour():
    rng = np.random.default_rng(6)
    for before, gap, after in ((55, 20, 12), (12, 25, 58), (60, 30, 70), (52, 16, 8)):
        own = rng.integers(1 << 40, 1 << 60, 2 * (gap + 30)).astype(np.uint64)
        shared = rng.integers(1, 1 << 30, before + after).astype(np.uint64)
        x = np.concatenate([own[:15], shared[:before], own[30:30 + gap], shared[before:]])
        y = np.concatenate([own[15:30], shared[:before], own[30 + gap:30 + 2 * gap], shared[before:]])
        at = np.array([15, 15 + before - 8, 15 + before + gap])
        u, v, *core = passages._aligned(x, y, at, at, 8)
        got = [(int(u[a]), int(u[b]) + 1) for a, b in passages.stretches(u, v, 50, 0.8, core=tuple(core))]
        whole = [(15, 15 + before)] * (before >= 50) + [(15 + before + gap, 15 + before + gap + after)] * (after >= 50)
        if (before + after) >= 0.8 * (before + gap + after):
            whole = [(15, 15 + before + gap + after)]
        assert got == whole


def test_seeds_find_fuzzy_passages():
    rng = np.random.default_rng(9)
    for share, least in ((0.1, 1.0), (0.15, 0.98), (0.2, 0.93)):
        hits = 0
        for _ in range(300):
            a = rng.integers(1, 1 << 60, 50).astype(np.uint64)
            b = a.copy()
            at = rng.choice(50, round(50 * share), replace=False)
            b[at] = rng.integers(1, 1 << 60, len(at))
            s = [passages.ngrams(np.concatenate([rng.integers(1, 1 << 60, 20).astype(np.uint64), h]), passages.K) for h in (a, b)]
            s = [g[:len(g) - passages.K + 1] for g in s]
            x, y = (set(g[passages.minimizers(g, passages.WINDOW)].tolist()) for g in s)
            hits += len(x & y) >= 2
        assert hits >= least * 300


@settings(max_examples=60, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=60))
def test_stretches_are_good_and_cover_exact_runs(equal):
    x = np.flatnonzero(equal)
    if not len(x):
        return
    found = passages.stretches(x, x, 10, 0.8, 4)
    for a, b in found:
        assert x[b] - x[a] + 1 >= 10 and b - a + 1 >= 0.8 * (x[b] - x[a] + 1)
    covered = {w for a, b in found for w in range(x[a], x[b] + 1)}
    for i in range(len(equal) - 9):
        if all(equal[i:i + 10]):
            assert covered >= set(range(i, i + 10))


def test_region_links_span_the_true_components():
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = prose(rng, 60)
        texts += [base] + [edited(rng, base, rng.choice([0.01, 0.03, 0.06])) for _ in range(rng.randint(0, 12))]
    plain = [shingles_of(t) for t in texts]
    code = {}
    sets = [np.array(sorted(code.setdefault(s, len(code)) for s in p), np.uint64) for p in plain]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    got = list(range(len(texts)))

    def top(i):
        while got[i] != i:
            i = got[i]
        return i

    everything = np.ones(len(texts), bool)
    for links in (jaccard_join.Region(sets, 80).solve(3), jaccard_join.Region(sets, 80).solve_for(everything)):
        got[:] = range(len(texts))
        for i, j in links:
            assert 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j]) and top(i) != top(j)
            got[max(top(i), top(j))] = min(top(i), top(j))
        assert [top(i) for i in range(len(texts))] == [find(i) for i in range(len(texts))]


def test_items_inside_documents():
    rng = random.Random(2)
    items = [prose(rng, n) for n in (3, 9, 30, 200)] + ["", "w"]
    docs = [prose(rng, 4000) for _ in range(30)]
    for i in range(0, 30, 3):
        item = items[i % 4].split()
        docs[i] = docs[i] + " " + " ".join(item) + " " + prose(rng, 50)
    data = [np.frombuffer(t.encode(), np.uint8) for t in items]
    sets = [shingle_sets(d, np.array([0, len(d)]))[0] for d in data]
    index = ItemIndex(list(range(len(items))), [len(words_of(t)) for t in items], sets, 0.8, 1e-6)
    flat = np.frombuffer("".join(docs).encode(), np.uint8)
    offs = np.cumsum([0, *(len(t.encode()) for t in docs)])
    doc_sets = {5: shingle_sets(flat, offs)}
    from tidewater.llm.textkit import ngrams
    h, _, _, bounds = words(flat, offs)
    for w in (1, 3):
        doc_sets[w] = [np.unique(ngrams(h, w)[a:max(a, b - w + 1)]) for a, b in zip(bounds, bounds[1:])]
    got = {(d, i) for d, i, _ in index.search(doc_sets)}
    want = set()
    for d, t in enumerate(docs):
        w = words_of(t)
        for i, item in enumerate(items):
            q = words_of(item)
            k = min(5, len(q))
            if k:
                grams = {tuple(w[p:p + k]) for p in range(len(w) - k + 1)}
                s = shingles_of(item)
                if len(s & grams) >= 0.8 * len(s):
                    want.add((d, i))
    assert got == want and len(want) >= 10


def test_rotations_keep_lengths_and_angles():
    h = nearest.Hashes(6, 2, 4, True, 2.0)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 6))
    x *= 2.0 / np.sqrt((x * x).sum(1)).max()
    a, b = h._lift(x, False), h._lift(x, True)
    assert np.allclose((a * a).sum(1), 1) and np.allclose((b * b).sum(1), 1)
    assert np.allclose(b @ a.T, (x / np.sqrt((x * x).sum(1))[:, None]) @ x.T / 2.0)
    y = nearest.hadamard(a)
    assert np.allclose(y @ y.T, a @ a.T)


def test_url_keys_sort_by_reversed_host():
    assert warc.url_key("HTTPS://User@Www.Example.COM:443/a?b=c#d") == "com,example,www)/a?b=c"
    assert warc.url_key("http://example.com") == "com,example)/"
    assert warc.url_key("//example.com:8080/x y") == "com,example:8080)/x%20y"
    assert warc.url_key(None) == "-"


def test_records_longer_than_a_member():
    payload = bytes(range(256)) * 70_000               # 17.9 MB
    small = warc.record(2, "http://x/", b"", 1, True)
    raw = warc.record(1, "http://x/\r\n", payload, None, False)
    file = warc.members(raw) + warc.members(small)
    assert file[-1] == 0
    got = list(warc.records_of(file))
    assert [r for _, _, r in got] == [raw, small]
    head, block = warc.parse_record(warc.read_range(file, got[0][0], got[0][1]))
    assert block.partition(b"\r\n\r\n")[2] == payload and head["WARC-Target-URI"] == "http://x/"


def test_parser_repairs_markup():
    p = dom.parse("<div class=x id='y z'>a &amp; b <p>one<br>two<b>bold<p>three</b><ul><li>x<li><a href=q>yy</a></ul>"
                  "<table><tr><td>1<td>2<tr><td>3</table><script>if (a<b) '</p>'</script>tail</div>after<!-- c --")
    assert [t for t in p.text if t] == ["a & b", "one twobold", "three", "x", "yy", "1", "2", "3", "tail", "after"]
    assert p.names[1] == "x y z" and max(p.linked) == 2
    for broken in ("", "<", "<p", "</", "<a href='", "<!--", "<script>", "a<b>c</p></div>", "<" * 3000):
        dom.parse(broken)


def test_messages_equal_enumeration():
    pages = [dom.parse("<div><p>a</p><ul><li>b</li></ul></div>"), dom.parse("x")]
    f = extraction.Forest(pages)
    rng = np.random.default_rng(1)
    node, edge = rng.normal(size=(len(f.parent), 2)), rng.normal(size=(2, 2, 2))
    belief, pair, total = f.messages(node, edge)
    n = len(f.parent)
    weights, marginal = [], np.zeros((n, 2))
    for bits in range(1 << n):
        s = [(bits >> i) & 1 for i in range(n)]
        e = sum(node[i, s[i]] for i in range(n)) + sum(edge[int(f.leaf[i]), s[f.parent[i]], s[i]]
                                                       for i in range(n) if f.parent[i] >= 0)
        weights.append(np.exp(e))
        for i in range(n):
            marginal[i, s[i]] += np.exp(e)
    assert np.allclose(np.exp(belief), marginal / sum(weights)) and np.isclose(total, np.log(sum(weights)))


def test_page_model_on_unseen_layouts():
    model = extraction.train(extraction.training_set(250), steps=150)
    wrong = runs = 0
    for seed in range(50_000, 50_100):
        page = dom.parse(labelled_page(seed))
        truth = [t.startswith(MAIN) for t in page.text]
        page.text = [t.replace(MAIN, "").replace(OTHER, "") for t in page.text]
        f = extraction.Forest([page])
        belief, _, _ = f.messages(extraction._node_potential(f.x, model[0]), model[1])
        keep = f.leaf & (belief[:, 1] >= np.log(0.5))
        wrong += sum(int(truth[i] != keep[i]) for i in np.flatnonzero(f.leaf))
        runs += int(f.leaf.sum())
    assert wrong <= 0.01 * runs


def test_machine_learns_pairs():
    """Two terms that are harmless alone and toxic together."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        rows.append(sorted({i for i, there in enumerate((a, b)) if there} | set(rng.integers(10, 60, 3).tolist())))
        y.append(float(a and b))
    m = toxicity.Machine(6, 8)
    offs = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    m.fit(np.concatenate(rows), offs, np.array(y), np.ones(len(y)), min_docs=3, epochs=20)
    p = m.probability(np.array([0, 1, 0, 1]), np.array([0, 2, 3, 4]))
    assert p[0] > 0.8 and p[1] < 0.5 and p[2] < 0.5


def test_crc_of_unsigned_little_endian():
    ids = np.array([1, 50256], np.uint32)
    assert zlib.crc32(ids.astype("<u4").tobytes()) == zlib.crc32(b"\x01\0\0\0\x50\xc4\0\0")


@pytest.mark.parametrize("common,crowded", [(2, 1 << 20), (5, 1 << 20), (1 << 30, 1 << 20), (1 << 30, 24)])
def test_seeds_meet_whatever_is_common(monkeypatch, common, crowded):
    """Matches with the first holder are the same however seeds are dealt out."""
    monkeypatch.setattr(passages, "COMMON", common)
    monkeypatch.setattr(passages, "CROWDED", crowded)
    monkeypatch.setattr(passages, "DEALT", 100)
    rng = np.random.default_rng(3)
    rows = np.stack([rng.integers(0, 40, 600), rng.integers(0, 90, 600), np.zeros(600, np.int64), np.arange(600)], 1)
    rows[:, 2] = rows[:, 1] + 1000                   # a text of each document
    parts = np.split(rows, [150, 290, 291, 500])
    sown = [b for p in (parts[:2], parts[2:]) for b in
            passages._dealt(lambda part: iter([(passages.SHORT, *part.T)]), 7)(iter(p))]
    table = pa.Table.from_batches(sown).sort_by("bucket")
    met = pa.Table.from_batches(list(passages._settled(7, None)(iter(table.to_batches(max_chunksize=3)))))
    got = {tuple(r[c] for c in ("x", "px", "y", "py")) for r in met.to_pylist() if r["ord"] == passages.FIRST}
    raw = [r for r in met.to_pylist() if r["s"] is not None]
    assert all(r["y"] == passages.MARK for r in raw) and bool(raw) == (common < 6 or crowded < 30)
    late = np.array(sorted((r["s"], r["ord"], r["x"], r["px"]) for r in raw), np.int64).reshape(-1, 4)
    for s in np.unique(late[:, 0]):
        of = late[late[:, 0] == s]
        got |= {(c, at, int(of[0, 2]), int(of[0, 3])) for _, _, c, at in of.tolist() if c != of[0, 2]}
    want = set()
    for s in np.unique(rows[:, 0]):
        of = sorted(map(tuple, rows[rows[:, 0] == s][:, 1:].tolist()))
        want |= {(c, at, of[0][1], of[0][2]) for _, c, at in of if c != of[0][1]}
    assert got == want
