"""What the near-copy join moves: no texts that it can do without."""

import random
from collections import Counter

from llm_data import edited, prose
from pyspark.sql import functions as F
from test_operators import true_components

from tidewater.llm import jaccard_join, keyfilter


def test_texts_tied_by_chance_are_not_copied_to_every_region(spark, monkeypatch):
    """Short texts that share a line make one large component, nearly all of
    whose texts are unrelated; only near copies come to the join of regions."""
    rng = random.Random(12)
    lines = [prose(rng, 9) for _ in range(12)]
    rows = [(i, f"{lines[i % 12]} {prose(rng, 25)} {lines[(i + 1) % 12]}") for i in range(150)]
    rows += [(1000 + i, edited(rng, rows[i][1], 0.02)) for i in range(0, 20, 2)]
    rows += [rows[3], (None, rows[5][1]), (2000, None)]
    joined = []
    regions, large = jaccard_join._join_regions, jaccard_join._join_large
    monkeypatch.setattr(jaccard_join, "_join_regions",
                        lambda members, *a: joined.append(members.count()) or regions(members, *a))
    monkeypatch.setattr(jaccard_join, "_join_large",
                        lambda members, *a: joined.append(members.count()) or large(members, *a))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_join.components(df, region_shingles=800).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(true_components(rows))
    assert sum(joined) <= 45


def test_only_marked_texts_are_shuffled_to_leave_one(spark):
    """Texts that stay are read through; the join moves those that may go."""
    rng = random.Random(13)
    rows = [(i, prose(rng, 30)) for i in range(300)] + [(900 + i, "the same text in two rows or more") for i in range(3)]
    rows += [rows[0], rows[0], (None, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = jaccard_join.keep_one(docs)
    assert Counter(map(tuple, kept.collect())) == Counter(rows[:301])
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    straight = plan.split("\n:- ")[1]
    assert plan.startswith("Union") and "Join" not in straight and "passes" in straight


def test_key_filter_never_stops_a_key(spark, monkeypatch):
    keys = spark.range(2000).select((F.col("id") * 7).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("j"))
    others = spark.range(20_000).select((F.col("id") + 1_000_000).alias("k"), F.col("id").alias("j"))
    for words, most in ((1 << 20, 400), (4, 20_000)):
        monkeypatch.setattr(keyfilter, "MOST_WORDS", words)
        may = keyfilter.maybe_in(keys, "k", "j")
        assert keys.filter(may("k", "j")).count() == 2000
        assert others.filter(may("k", "j")).count() <= most
    may = keyfilter.maybe_in(keys.limit(0), "k", "j")
    assert keys.filter(may("k", "j")).count() == 0
