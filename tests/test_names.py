"""Names in free text against every name tried at every place."""

import random
import re

import pytest

from tidewater.operators import names


def plain(text, known):
    if text is None:
        return None, None
    low = text.translate({c: c + 32 for c in range(65, 91)})
    word = re.compile("[a-z0-9]")
    out, at, n = [], 0, 0
    while at < len(low):
        best = 0
        for name in known:
            end = at + len(name)
            if low.startswith(name, at) and not (at and word.match(low[at - 1]) and word.match(low[at])) and not (
                    end < len(low) and word.match(low[end]) and word.match(low[end - 1])):
                best = max(best, len(name))
        if best:
            out.append(names.NAME_MASK)
            n += 1
        out.append("" if best else text[at])
        at += best or 1
    return "".join(out), n


@pytest.mark.parametrize("block_bytes", [1 << 20, 40, 8])
def test_masks_equal_a_plain_search(spark, block_bytes):
    rng = random.Random(block_bytes)
    people = [("Ann", "Lee"), ("Lee", "Smith"), ("Ann Lee", "Smith"), (" Zoë ", None), ("", "O'Neil"), ("#7", "A"), ("ß", "b")]
    parts = ["Ann", "ann", "LEE", "Smith", "Zoë", "zoË", "o'neil", "Annx", "7", "#7", "a", "A.", " ", " ", " ", "é", "ß", "b", "😀", "-", "Lee Smith"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    texts += [None, "", "Ann Lee Smith", "Ann Lee Smith", "x" * 50_000 + " ann", "Ann" * 3]
    people_df = spark.createDataFrame(people, "f string, l string")
    known = names.name_list(people_df, "f", "l")
    listed = {r.name for r in known.collect()}
    assert {"ann", "lee", "ann lee", "ann lee smith", "zoë", "o'neil", "#7 a"} <= listed and "" not in listed
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id long, t string, _c string").repartition(4)
    got = names.mask_names(df, "t", known, block_bytes=block_bytes)
    assert got.columns == ["id", "t", "_c", "masked_text", "n_names"]
    for r in got.collect():
        assert r.t == texts[r.id] and (r.masked_text, r.n_names) == plain(texts[r.id], listed)


def test_no_names_and_no_texts(spark):
    none = spark.createDataFrame([], "name string")
    df = spark.createDataFrame([("a", )], "t string")
    assert tuple(names.mask_names(df, "t", none).first()) == ("a", "a", 0)
    assert names.mask_names(df.limit(0), "t", spark.createDataFrame([("a",)], "name string")).count() == 0


def test_texts_are_scanned_once_whatever_the_names(spark):
    """Many times the bitmap's bytes in names: one scan of the texts."""
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    people = spark.range(3000).selectExpr("'Name' || id AS f", "'Family' || id % 9 AS l")
    df = spark.createDataFrame([(i, f"to name{7 * i} family{i % 9}, name{i}x") for i in range(40)], "id long, t string").repartition(3)
    got = names.mask_names(df.mapInArrow(counted, df.schema), "t", names.name_list(people, "f", "l"), block_bytes=64)
    rows = got.collect()
    assert all(r.n_names == (2 if 7 * r.id % 9 != r.id % 9 else 1) for r in rows) and len(rows) == 40
    assert scans.value <= 2 * 40                       # the scan, and the texts themselves
