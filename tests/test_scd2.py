import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewater.operators import scd2

SCHEMA = "CustomerID bigint, City string, SnapshotDate date"
D = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2024, 4, 1)]


def _build(spark, rows):
    return scd2.build(spark.createDataFrame(rows, SCHEMA), "CustomerID", ["City"],
                      "SnapshotDate", "CustomerKey")


def test_change_rules(spark):
    rows = [
        (1, "A", D[0]), (1, "A", D[1]),                      # unchanged
        (2, "A", D[0]), (2, "B", D[1]),                      # changed
        (3, "A", D[0]), (3, "B", D[1]), (3, "A", D[2]),      # changed back
        (4, None, D[0]), (4, None, D[1]), (4, "C", D[2]),    # NULL attribute
        (5, "N", D[2]),                                      # new key
        (6, "V", D[0]),                                      # vanished key
    ]
    out = _build(spark, rows)
    got = {}
    for r in out.collect():
        got.setdefault(r["CustomerID"], []).append((r["City"], r["EffectiveFrom"], r["EffectiveTo"], r["IsCurrent"]))
    assert sorted(got[1]) == [("A", D[0], None, True)]
    assert sorted(got[2]) == [("A", D[0], D[1], False), ("B", D[1], None, True)]
    assert len(got[3]) == 3
    assert len(got[4]) == 2
    assert got[5] == [("N", D[2], None, True)]
    assert got[6] == [("V", D[0], None, True)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["x", "y", None]), st.integers(0, 3)),
                min_size=1, max_size=25, unique_by=lambda t: (t[0], t[2])))
def test_properties_and_increment(spark, data):
    rows = [(k, c, D[d]) for k, c, d in data]
    full = _build(spark, rows)
    recs = full.collect()
    # exactly one current version per key, intervals disjoint and ordered
    by_key = {}
    for r in recs:
        by_key.setdefault(r["CustomerID"], []).append(r)
    for vs in by_key.values():
        assert sum(v["IsCurrent"] for v in vs) == 1
        vs.sort(key=lambda v: v["EffectiveFrom"])
        for a, b in zip(vs, vs[1:]):
            assert a["EffectiveTo"] == b["EffectiveFrom"]
    # merging snapshots one at a time equals the rebuild
    df = spark.createDataFrame(rows, SCHEMA)
    dates = sorted({r[2] for r in rows})
    dim = scd2.build(df.where(F.col("SnapshotDate") == dates[0]), "CustomerID", ["City"],
                     "SnapshotDate", "CustomerKey")
    for d in dates[1:]:
        dim = scd2.apply_snapshot(dim, df.where(F.col("SnapshotDate") == d), "CustomerID",
                                  ["City"], "SnapshotDate", "CustomerKey")
    cols = ["CustomerKey", "CustomerID", "City", "EffectiveFrom", "EffectiveTo", "IsCurrent"]
    assert sorted(dim.select(*cols).collect()) == sorted(full.select(*cols).collect())


def test_point_in_time(spark):
    dim = _build(spark, [(1, "A", D[0]), (1, "B", D[2])])
    facts = spark.createDataFrame([(10, 1, D[1]), (11, 1, D[2]), (12, 1, dt.date(2023, 1, 1)), (13, 2, D[1])],
                                  "fid int, CustomerID bigint, At date")
    j = scd2.as_of_join(facts, dim, "CustomerID", "CustomerID", "At")
    got = {r[0]: r[1] for r in j.select("_f.fid", "_d.City").collect()}
    assert got == {10: "A", 11: "B", 12: None, 13: None}


def test_late_snapshots(spark):
    rows = [(1, "A", D[0]), (1, "B", D[1]), (1, "A", D[2]), (2, "X", D[1])]
    df = spark.createDataFrame(rows, SCHEMA)
    day = lambda d: df.where(F.col("SnapshotDate") == d)
    cols = ["CustomerKey", "CustomerID", "City", "EffectiveFrom", "EffectiveTo", "IsCurrent"]
    args = ("CustomerID", ["City"], "SnapshotDate", "CustomerKey")
    first = scd2.build(day(D[2]), *args)
    with pytest.raises(Exception):
        scd2.apply_snapshot(first, day(D[0]), *args).collect()
    dim, seen = first, day(D[2])
    for d in (D[0], D[1]):
        dim = scd2.apply_snapshot(dim, day(d), *args, history=seen)
        seen = seen.unionByName(day(d))
    assert sorted(dim.select(*cols).collect()) == sorted(_build(spark, rows).select(*cols).collect())


def test_text_keys_and_distant_dates(spark):
    rows = [("C-1", "A", dt.date(1900, 1, 1)), ("1", "A", dt.date(2243, 10, 18)), ("2", "A", dt.date(1970, 1, 2))]
    df = spark.createDataFrame(rows, "CustomerID string, City string, SnapshotDate date")
    keys = [r["CustomerKey"] for r in scd2.build(df, "CustomerID", ["City"], "SnapshotDate", "CustomerKey").collect()]
    assert len(set(keys)) == 3 and None not in keys
