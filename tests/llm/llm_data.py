"""Small tables and brute-force versions for the operator tests."""

import random
import re

import pytest


def word(rng):
    return "".join(rng.choice("abcdefghiklmnoprstuvwéß") for _ in range(rng.randint(2, 8)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def words_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles_of(text, k=5):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}


def edited(rng, text, share):
    return " ".join(word(rng) if rng.random() < share else w for w in text.split(" "))


def messy_documents(seed=1, n=60):
    """(doc_id, text) rows with nulls, empty and very long texts, ties,
    repeated rows, exact and near copies, and shared passages."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 200)) for _ in range(8)]
    passage = prose(rng, 80)
    rows = []
    for i in range(n):
        kind = i % 6
        t = rng.choice(base)
        if kind == 0:
            t = prose(rng, rng.randint(1, 150))
        elif kind == 1:
            t = edited(rng, t, 0.02)
        elif kind == 2:
            t = prose(rng, 40) + " " + passage + "\n" + prose(rng, rng.randint(5, 60))
        elif kind == 3:
            t = edited(rng, t, 0.3)
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, " \t\n "), (103, "one two"), (104, "ONE two"), (105, "be " * 300),
             (106, prose(rng, 30_000)), (107, "word"), (None, base[0]), (None, None), rows[4], rows[4],
             (3, prose(rng, 20)), (108, "x" * 100_000), (109, "a b c d e"), (110, "A B\x0bC d e")]
    return rows


CLASHING = ("cls", "n", "least", "docs", "region", "a", "h", "quality_score", "part", "rank", "s", "base", "file")


@pytest.fixture(scope="session")
def messy(spark):
    rows = messy_documents()
    ddl = "doc_id long, text string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, len(t or ""), *CLASHING) for i, t in rows], ddl).repartition(5)
