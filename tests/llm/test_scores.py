"""Scores against plain versions; elements inside running text."""

import math
import random

import numpy as np
import pytest
import zstandard
from llm_data import messy_documents, prose
from pyspark.sql import functions as F

from tidewater.llm import dom, extraction, quality


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(20, 80)) if i % 2 else " ".join(rng.choice(["buy", "now!!", "cheap", "###"]) for _ in range(60)))
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    return docs, labels


def test_quality_score_is_the_compressed_difference(spark, labelled, messy):
    """Every row, clashing columns and all, against zstandard called row by row."""
    model = quality.train(*labelled)
    by = []
    for content in model["dictionaries"]:
        d = zstandard.ZstdCompressionDict(content)
        by.append(zstandard.ZstdCompressor(level=model["level"], dict_data=d, write_content_size=False, write_checksum=False,
                                           write_dict_id=False))
    w, mean, scale = model["fit"]

    def plain(text):
        good, bad = (len(c.compress((text or "").encode())) for c in by)
        d = (good - bad) / max(good, bad)
        rate, near = math.log((good + bad) / 2 / (len((text or "").encode()) + 8)), math.exp(-d * d / 0.002)
        x = np.array([1.0, d, math.tanh(d / 0.03), rate, rate * rate, near, near * rate])
        return 1 / (1 + math.exp(-float(np.clip((x - mean) / scale @ w, -30, 30))))

    got = quality.score(messy, model, "__quality")
    assert got.columns == [*messy.columns, "__quality"]
    rows = got.collect()
    assert len(rows) == len(messy_documents())
    for r in rows:
        assert r["__quality"] == pytest.approx(plain(r.text), abs=1e-12)
        assert r.n_chars == len(r.text or "") and r.quality_score == "quality_score"
    kept = quality.score(messy, model, "__quality", at_least=0.5)
    assert sorted(kept.select("doc_id", "text").collect(), key=repr) == sorted(
        got.filter("__quality >= 0.5").select("doc_id", "text").collect(), key=repr)


def test_training_uses_whole_texts():
    raw = bytes(range(256)) * 20
    assert b"".join(quality._pieces(raw, 1000)) == raw and quality._pieces(b"", 1000) == []


@pytest.mark.parametrize("inside,want", [
    ("<math><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow></math>", "E=m"),
    ("<math><semantics><mi>E</mi><annotation encoding='x'>\\E</annotation></semantics></math>", "E"),
    ("<svg viewBox='0'><title>t</title><g><text>no</text></g></svg>", ""),
    ("<svg><foreignObject><div>no</div></foreignObject></svg>", ""),
    ("<button type=button>Copy</button>", ""), ("<script>var p = '<p>';</script>", ""), ("<style>p {}</style>", ""),
    ("<select><option>a<option>b</select>", ""), ("<noscript><p>no</p></noscript>", ""), ("<textarea><b>no</textarea>", ""),
])
def test_elements_inside_running_text_do_not_end_it(inside, want):
    p = dom.parse(f"<div><p>The energy is {inside} for all bodies.</p><p>Next.</p></div>")
    middle = f" {want} " if want else " "
    assert [t for t in p.text if t] == [f"The energy is{middle}for all bodies.", "Next."]


def test_formulas_stay_in_the_article(spark):
    rng = random.Random(3)
    lines = [f"{prose(rng, 40)} {inside} {prose(rng, 40)}." for inside in ("<math><mi>E</mi></math>", "<svg><path d='M0'/></svg>",
                                                                        "<button>x</button>", "plain")]
    html = ("<html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav>"
            "<article><h1>Energy of bodies</h1>" + "".join(f"<p>{t}</p>" for t in lines) + "</article>"
            "<footer><a href=/c>Contact</a></footer></body></html>")
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    text = extraction.extract(pages).select(F.col("text")).first()[0].split("\n")
    for inside, t in zip(("E ", "", "", "plain "), lines):
        words = t.split("<")[0] + inside if "<" in t else t
        assert [x for x in text if x.startswith(words)]
    assert len([x for x in text if len(x) > 100]) == 4
