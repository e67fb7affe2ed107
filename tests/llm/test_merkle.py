"""The Merkle manifest against a plain tree in memory."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_data import CLASHING, prose
from pyspark.sql import functions as F

from tidewater.llm import merkle

DDL = "doc_id long, source string, lang string, n_chars long, text string, " + ", ".join(
    f"{c} string" for c in (*CLASHING, "grp", "idx", "size", "digest", "leaf", "root", "proof", "__k0", "checked"))


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row):
    return digest(*[field(v) for v in row])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([digest(*at[i:i + 2]) for i in range(0, len(at), 2)])
    return levels


def plain(rows):
    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        hit = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 0
        told = n_chars + 1 if hit and n_chars is not None else n_chars
        groups[lang].append((doc_id, leaf_of((doc_id, source, lang, n_chars, text)),
                             leaf_of((doc_id, source, lang, told, text))))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: tree([r[1] for r in groups[g]]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for gi, g in enumerate(langs):
        for i, (doc_id, leaf, node) in enumerate(groups[g]):
            path = []
            for levels, at in ((trees[g], i), (top, gi)):
                for level in levels[:-1]:
                    j = at ^ 1
                    if j < len(level):
                        path.append(level[j])
                        node = digest(level[j], node) if j < at else digest(node, level[j])
                    else:
                        node = digest(node)
                    at >>= 1
            out.append((doc_id, leaf, trees[g][-1][0], top[-1][0], digest(*path), node, node == top[-1][0]))
    return Counter(out)


def documents(seed=5, n=300):
    rng = random.Random(seed)
    langs = ["en"] * 6 + ["de", "", None, "zh", "é", "Z", "a"]
    rows = [(i, rng.choice(["web", None]), rng.choice(langs), rng.choice([None, i, 5]), prose(rng, rng.randint(0, 30)))
            for i in range(n)]
    rows += [rows[3], rows[3], (None, None, None, None, None), (7, "b", "en", 1, "x"), (7, "a", "en", 1, "x"),
             (900, "web", "lone", 3, "漢字 é"), (901, "", "pair", 0, ""), (902, "", "pair", 0, "y" * 200_000)]
    return rows


@pytest.mark.parametrize("every,parts", [(1, 3), (3, 7), (10, 1)])
def test_audit(spark, every, parts):
    rows = documents()
    df = spark.createDataFrame([(*r, *[None] * (len(CLASHING) + 9)) for r in rows], DDL).repartition(parts)
    got = merkle.audit(df, every=every).collect()
    assert Counter(tuple(r) for r in got) == plain(rows)
    bad = {r.doc_id for r in got if not r.verified}
    assert bad == {r[0] for r in rows if r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 1, "t")], [(1, "s", "en", 1, "t"), (2, "s", None, 1, "t")],
                                  [(i, "s", "en", i, "t") for i in range(17)]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(tuple(r) for r in merkle.audit(df, every=2).collect()) == plain(rows)


def test_only_every_few_levels_are_stored(spark, tmp):
    """64 leaves in one group, levels 3 and 6 stored, and proofs as arrays."""
    rows = [(i, "g", digest(str(i))) for i in range(64)]
    df = spark.createDataFrame(rows, "id long, group string, leaf string").repartition(5)
    m = merkle.build(df, every=3, path=f"{tmp}/m")
    assert [x.count() for x in m.levels] == [8, 1]
    levels = tree([leaf for _, _, leaf in rows])
    assert [r.digest for r in m.levels[0].orderBy("idx").collect()] == levels[3] and m.root == levels[6][0]
    assert [(r.group, r.subroot) for r in m.subroots().collect()] == [("g", m.root)]
    proofs = m.proofs()
    for r in proofs.collect():
        assert [s.digest for s in r.proof] == [levels[k][(r.id >> k) ^ 1] for k in range(6)]
        assert [s.side for s in r.proof] == [-1 if r.id >> k & 1 else 1 for k in range(6)]
    assert proofs.filter(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
