"""Rank-array BPE against the tokenizers library."""

import hashlib
import random

import pyarrow as pa
import pytest
from llm_data import messy_documents
from tokenizers import Tokenizer

from tidewater.llm import rank_bpe, textkit
from tidewater.llm.queries import QUERIES

PARTS = ["a", "b", "Z", "é", "ß", "×", "1", "²", " ", "  ", "\n", "\t", " ", " ", "'s", "'ll", "'", ".", ",", "!",
         "<|endoftext|>", "<|endof", "漢", "字", "😀", "́", "\x00", "\x1c", "\x85", "\xa0", "٣", "Ⅷ", "the", "ing",
         "|", ">", "֋", "ſ", "_", "-", "\r", "\x0b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(rank_bpe.default_path())


def encoded(enc, texts):
    out = []
    for lo, hi, data, offs in textkit.text_slices(pa.array(texts, pa.string())):
        ids, at = enc.encode(data, offs)
        assert enc.decode(ids, at) == [t or "" for t in texts[lo:hi]]
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    return out


def test_ids_equal_the_library(library, monkeypatch):
    monkeypatch.setattr(rank_bpe, "REMEMBERED", 500)        # also after forgetting
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(40, 90))) for _ in range(200)]
    texts += ["x" * 5000, "ab" * 3000, "漢字" * 2000, " " * 500 + "a", "\n" * 300, "aaab" * 40 + "!" * 200, "", None,
              "<|endoftext|>", "<|endoftext|> <|endoftext|>  ", "".join(map(chr, range(0x20, 0x3000)))]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoded(rank_bpe.Encoder(rank_bpe.default_path()), texts) == want


def test_scans_and_heap_merge_alike():
    v = rank_bpe.encoder(rank_bpe.default_path()).vocabulary
    rng = random.Random(8)
    words = [bytes(rng.choice(b" abcdeinorst") for _ in range(rng.randint(1, rank_bpe.SHORT))) for _ in range(500)]
    assert [list(memoryview(x).cast("i")) for x in rank_bpe.merge_words(v, words)] == [rank_bpe.merge_long(v, w) for w in words]


def test_decoding_any_ids(spark, library):
    rng = random.Random(4)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 40))] for _ in range(300)] + [[50256, 0], [], [10**6, 5, -3]]
    rows = spark.createDataFrame([*enumerate(lists), (None, None)], "doc_id long, ids array<int>").repartition(4)
    got = {r.doc_id: r.text for r in rank_bpe.decode(rows).collect()}
    want = {i: library.decode([x for x in ids if 0 <= x < 50257], skip_special_tokens=False) for i, ids in enumerate(lists)}
    assert got == {**want, None: ""}


def test_query_on_messy_rows(spark, messy, tmp, library):
    messy.write.parquet(f"{tmp}/documents.parquet")
    got = QUERIES["op12_bpe"](spark, tmp).collect()
    want = []
    for doc_id, text in messy_documents():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert rank_bpe.encode(spark.createDataFrame([], messy.schema)).count() == 0
