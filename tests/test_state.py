"""State by delivery: pair sums with retractions, distinct counts, buckets."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.operators.bucket_state import BucketState
from tidewater.operators.distinct_state import DistinctState
from tidewater.operators.pair_state import PairState

SIDE = "id string, version string, grp string, k string, amount bigint"


def delivery(rng, version, ids, groups=("a", "b", None), keys=("x", "y", "z", None)):
    return [(f"i{rng.randrange(ids)}" if rng.random() > 0.05 else None, version, rng.choice(groups), rng.choice(keys),
             rng.choice([None, rng.randrange(1, 9)])) for _ in range(ids)]


def latest(deliveries):
    rows = {}
    for rows_of_one in deliveries:
        for row in sorted((r for r in rows_of_one if r[0] is not None),
                          key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "",
                                         r[4] is not None, r[4] or 0)):
            if row[0] not in rows or row[1] >= rows[row[0]][1]:
                rows[row[0]] = row
    return list(rows.values())


def pairs(left, right):
    out = defaultdict(lambda: [0, 0, 0, set(), 0])
    for _, _, grp, k, x in left:
        t = out[grp]
        t[4] += 1
        if k is not None:
            t[3].add(k)
        for _, _, _, rk, y in right:
            if k is not None and rk == k:
                t[0] += x or 0
                t[1] += y or 0
                t[2] += 1
    return {g: (a, b, n, len(keys), rows) for g, (a, b, n, keys, rows) in out.items()}


@pytest.mark.parametrize("seed", [1])
def test_pair_sums_equal_the_join(spark, tmp, seed):
    """Random deliveries of both sides, repeated, late and superseding."""
    rng = random.Random(seed)
    state = PairState(spark, f"{tmp}/s", buckets=4)
    left, right = [], []
    frame = lambda rows: spark.createDataFrame(rows, SIDE).repartition(3)
    for run, version in enumerate(["1", "3", "3", "2", "4"], 1):
        one = delivery(rng, version, 25) if run != 3 else left[-1]
        other = delivery(rng, version, 15, groups=(None,)) if run != 4 else []
        left.append(one)
        right.append(other)
        state.fold(run, frame(one), frame(other).drop("grp") if run != 4 else None)
        got = {r.grp: tuple(int(x) for x in r[1:]) for r in state.totals().collect()}
        assert got == pairs(latest(left), latest(right))
    before = sorted(map(str, state.totals().collect()))
    state.fold(5, frame([("i1", "9", "a", "x", 1)]))           # a completed run is not repeated
    assert sorted(map(str, state.totals().collect())) == before


def test_a_failed_run_is_repeated(spark, tmp):
    """All state of a run is there but its totals: folding again gives the same."""
    rng = random.Random(7)
    rows = [delivery(rng, str(v), 30) for v in range(2)]
    state = PairState(spark, f"{tmp}/s", buckets=4)
    frame = lambda r: spark.createDataFrame(r, SIDE)
    state.fold(1, frame(rows[0]), frame(rows[0]).drop("grp"))
    state.fold(2, frame(rows[1]), None)
    want = sorted(map(str, state.totals().collect()))
    target = spark._jvm.org.apache.hadoop.fs.Path(state.runs.folder(2) + "/_SUCCESS")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, False)
    assert state.runs.runs() == [1]
    state.fold(2, frame(rows[1]), None)
    assert sorted(map(str, state.totals().collect())) == want


def test_only_touched_buckets_are_rewritten(spark, tmp):
    state = PairState(spark, f"{tmp}/s", buckets=32)
    many = spark.range(2000).select(F.col("id").cast("string"), F.lit("1").alias("version"), F.lit("g").alias("grp"),
                                    (F.col("id") % 500).cast("string").alias("k"), F.lit(2).alias("amount"))
    state.fold(1, many, many.drop("grp"))
    assert len(state.sums["left"].touched(1)) == len(state.rows["left"].touched(1)) == 32
    one = many.where("id = '17'").withColumn("version", F.lit("2")).withColumn("amount", F.lit(5))
    state.fold(2, one)
    assert len(state.rows["left"].touched(2)) == len(state.sums["left"].touched(2)) == len(state.sums["right"].touched(2)) == 1
    assert state.rows["right"].touched(2) == []
    t = state.totals().first()
    assert (int(t.left_over_pairs), int(t.right_over_pairs), int(t.pairs)) == (500 * 4 * 2 * 4 + 3 * 4, 500 * 4 * 2 * 4, 8000)


def test_bucket_versions(spark, tmp):
    s = BucketState(spark, f"{tmp}/b", "id bigint, v string", 4)
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "id bigint, v string").withColumn(
        "bucket", F.col("id").cast("int") % 4)
    assert s.read().count() == 0 and s.runs() == []
    s.write(rows(range(8), "a"), 1)
    s.write(rows([1, 5], "b"), 2)
    now = lambda **k: sorted((r.id, r.v) for r in s.read(**k).collect())
    assert now() == [(i, "b" if i % 4 == 1 else "a") for i in range(8)]
    assert now(before=2) == [(i, "a") for i in range(8)] and now(buckets=[1]) == [(1, "b"), (5, "b")]
    assert s.touched(2) == [1] and s.versions() == {0: 1, 1: 2, 2: 1, 3: 1}
    assert s.vacuum() == 1 and now() == [(i, "b" if i % 4 == 1 else "a") for i in range(8)]
    s.compact(3)
    assert s.versions() == dict.fromkeys(range(4), 3) and now() == [(i, "b" if i % 4 == 1 else "a") for i in range(8)]


@pytest.mark.parametrize("moving", [False, True])
def test_distinct_counts(spark, tmp, moving):
    rng = random.Random(4)
    state = DistinctState(spark, f"{tmp}/d", moving=moving, buckets=4)
    member, sets = {}, defaultdict(set)
    for run, version in enumerate(["1", "2", "2", "1"], 1):
        rows = [(f"k{rng.randrange(60)}" if rng.random() > 0.1 else None, rng.choice(["a", "b", "c", None]), version)
                for _ in range(50)]
        rows = list({k: (k, g, v) for k, g, v in rows}.values()) + rows[:0]     # one group a key and delivery
        state.fold(run, spark.createDataFrame(rows, "key string, grp string, version string").repartition(3))
        for k, g, v in rows:
            if k is not None and (k not in member or v >= member[k][1]):
                member[k] = (g, v)
            if k is not None:
                sets[g].add(k)
    if moving:
        sets = defaultdict(set)
        for k, (g, _) in member.items():
            sets[g].add(k)
    assert {r.grp: r["keys"] for r in state.counts().collect()} == {g: len(s) for g, s in sets.items()}
    total = state.counts(F.lit("all")).first()["keys"]
    assert total == len(set().union(*sets.values()))


def test_dictionary_numbers_stay(spark, tmp):
    state = DistinctState(spark, f"{tmp}/d", buckets=2)
    keys = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("key"), F.lit("g").alias("grp"))
    state.fold(1, keys(0, 100))
    first = {(r.bucket, r.n): r.key for r in state.keys.read().collect()}
    state.fold(2, keys(50, 40_000))
    second = {(r.bucket, r.n): r.key for r in state.keys.read().collect()}
    assert len(second) == 40_000 and first.items() <= second.items()
    per = defaultdict(list)
    for b, n in second:
        per[b].append(n)
    assert all(sorted(ns) == list(range(1, len(ns) + 1)) for ns in per.values())
    assert state.counts().first()["keys"] == 40_000
