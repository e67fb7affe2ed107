"""Types, sketches and audits by delivery; bucket merges; replaced tables."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidewater.functions import text
from tidewater.operators import inference, observed, scd2, sketches, variants, versioned
from tidewater.operators.bucket_state import BucketState
from tidewater.operators.scd2_buckets import BucketDimension, rekey
from tidewater.sources.files import read_csv


# ------------------------------------------------------------ inferred types

@pytest.mark.parametrize("values,kind", [
    ([], "string"), ([None, ""], "string"), (["1", "-2", None], "bigint"), (["1", "2.50"], "decimal(3,2)"),
    (["12345678901234567890", "1"], "decimal(20,0)"), (["9" * 39], "double"), (["1", "2e5"], "double"),
    (["020111"], "string"), (["+91"], "string"), (["1", "x"], "string"), (["true", "FALSE", ""], "boolean"),
    (["true", "1"], "string"), (["2024-01-05"], "date"), (["2024-01-05", "2024-13-05"], "string"),
    (["2024-01-05", "2024-01-05 10:00"], "timestamp"), (["2024-01-05T10:00:00.5"], "timestamp"), (["-0.125"], "decimal(4,3)"),
    (["2024-01-05", "5"], "string"), ([" 1"], "string"), (["0"], "bigint"), (["0.5", "10"], "decimal(3,1)")])
def test_least_type(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(2)
    facts = inference.column_facts(df)
    assert inference.column_types(facts).get("c", "string") == kind
    typed = inference.typed_frame(df, {"c": kind}).collect()
    assert sum(r.c is not None for r in typed) == sum(v not in (None, "") if kind != "string" else v is not None for v in values)


def test_types_only_widen(spark, tmp):
    """Earlier deliveries count, one that comes again is not counted twice."""
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "c string")
    path = f"{tmp}/facts"
    first = inference.scan_inferred(spark, {"a": frame("1", "2")}, path)
    assert first.schema["c"].dataType.simpleString() == "bigint"
    second = inference.scan_inferred(spark, {"b": frame("1.5")}, path)
    assert second.schema["c"].dataType.simpleString() == "decimal(2,1)"
    again = inference.scan_inferred(spark, {"a": frame("1", "2")}, path)
    assert again.schema["c"].dataType.simpleString() == "decimal(2,1)" and [float(r.c) for r in again.collect()] == [1.0, 2.0]
    assert spark.read.parquet(path).agg(F.sum("present")).first()[0] == 3


# ------------------------------------------------------------------ profile

def test_profile_of_merged_sketches(spark, tmp):
    rng = random.Random(1)
    rows = [(str(i % 3), f"v{rng.randrange(5000)}", rng.choice(["hot"] * 5 + [None, f"rare{i}"]), str(rng.gauss(0, 100)), None)
            for i in range(20_000)]
    df = spark.createDataFrame(rows, "day string, id string, mix string, num string, nothing string").repartition(5)
    path = f"{tmp}/p"
    cols = ["id", "mix", "num", "nothing"]
    for day in ("0", "1", "2", "1"):
        sketches.fold(sketches.profile_state(df.where(F.col("day") == day), "day", cols, ["num"]), path)
    got = {r.column_name: r for r in sketches.merged(spark, path).collect()}
    values = {c: [r[i + 1] for r in rows if r[i + 1] is not None] for i, c in enumerate(cols)}
    assert set(got) == set(cols)
    for c, r in got.items():
        assert (r.row_count, r.null_count) == (20_000, 20_000 - len(values[c]))
        assert abs(r.distinct_count - len(set(values[c]))) <= sketches.DISTINCT_ERROR * len(set(values[c])) + 1
    numbers = sorted(map(float, values["num"]))
    for q, x in zip((0.05, 0.5, 0.95), got["num"].quantiles):
        assert abs(sum(v <= x for v in numbers) / len(numbers) - q) <= sketches.RANK_ERROR
    assert got["id"].quantiles is None and got["mix"].frequent[0]["item"] == "hot"
    assert got["nothing"].frequent == [] and got["nothing"].distinct_count == 0


# ------------------------------------------------------------------- audits

def test_counts_come_from_the_write(spark, tmp):
    """Two stages of one job are counted; no further job runs."""
    spark.range(1000).write.parquet(f"{tmp}/in")
    source = spark.read.parquet(f"{tmp}/in")
    counted = observed.Counted()
    seen = counted.watch(source, "in", {"odd": F.sum(F.col("id") % 2)})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted-write", "")
    n = observed.write_counted(seen.where("id < 100"), lambda d: d.write.parquet(f"{tmp}/out"), counted)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n == {"in": {"rows": 1000, "odd": 500}, "rows_out": {"rows": 100}}
    assert len(tracker.getJobIdsForGroup("counted-write")) == 1
    for run in ("a", "b", "a"):
        observed.record(spark, f"{tmp}/audit", run, "silver", "t", {"rows": 5 if run == "a" else 7, "sum": 1.25})
    got = {(r.run, r.metric): float(r.value) for r in observed.recorded(spark, f"{tmp}/audit").collect()}
    assert got == {("a", "rows"): 5, ("a", "sum"): 1.25, ("b", "rows"): 7, ("b", "sum"): 1.25}


def test_streams_report_their_counts(spark, tmp):
    spark.range(500).repartition(4).write.parquet(f"{tmp}/in")
    audit = observed.StreamAudit()
    spark.streams.addListener(audit)
    try:
        df = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
        df = df.observe("landed", F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))
        q = (df.writeStream.format("parquet").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True)
             .start(f"{tmp}/out"))
        q.awaitTermination()
        for _ in range(50):
            if audit.totals(str(q.id)).get("landed", {}).get("rows") == 500:
                break
            time.sleep(0.2)
        assert audit.totals(str(q.id)) == {"landed": {"rows": 500, "ids": sum(range(500))}}
    finally:
        spark.streams.removeListener(audit)


# ---------------------------------------------------------- dimension buckets

def test_only_changed_buckets_are_written(spark, tmp):
    dim = BucketDimension(spark, f"{tmp}/d", "id", ["city"], "k", buckets=32)
    day = lambda d, changed: spark.range(300).select(
        "id", F.when(F.col("id").isin(*changed), F.lit("moved")).otherwise("home").alias("city"),
        F.lit(d).cast("date").alias("day"))
    snapshots = [day("2024-01-01", []), day("2024-02-01", [7, 8]), day("2024-02-01", [7, 8]), day("2024-03-01", [7, 8])]
    for run, s in enumerate(snapshots, 1):
        dim.merge(run, s, "day")
    assert len(dim.rows.touched(1)) == 32 and len(dim.rows.touched(2)) in (1, 2) and dim.rows.touched(3) == dim.rows.touched(4) == []
    rebuilt = scd2.build(snapshots[0].union(snapshots[1]).union(snapshots[3]), "id", ["city"], "day", "k")
    cols = ["k", "id", "city", "EffectiveFrom", "EffectiveTo", "IsCurrent"]
    assert sorted(dim.read().select(*cols).collect(), key=str) == sorted(rebuilt.select(*cols).collect(), key=str)
    feed = dim.changes.read_run(2).collect()
    assert sorted(r.id for r in feed) == [7, 8] and all(r.old_key != r.new_key and r.old_key for r in feed)

    # facts of the changed keys only, a hot key among them
    facts = BucketState(spark, f"{tmp}/f", "n bigint, id bigint, k bigint", 32)
    new = spark.range(3000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 300).alias("id"))
    first = dim.changes.read_run(1).select("id", F.col("new_key").alias("k"))
    rekey(facts, dim.changes.read_run(1).limit(0), 1, "id", "k", new_facts=new.join(first, "id"),
          spread=[F.pmod("n", F.lit(4))])
    rekey(facts, dim.changes.read_run(2), 2, "id", "k", spread=[F.pmod("n", F.lit(4))])
    assert set(facts.touched(2)) == set(dim.rows.touched(2))
    current = {r.id: r.k for r in dim.read().where("IsCurrent").collect()}
    got = facts.read().collect()
    assert len(got) == 3000 and all(r.k == current[r.id] for r in got)


def test_a_late_snapshot_is_an_error(spark, tmp):
    dim = BucketDimension(spark, f"{tmp}/d", "id", ["city"], "k", buckets=2)
    day = lambda d, c: spark.createDataFrame([(1, c, d)], "id bigint, city string, day string").withColumn(
        "day", F.col("day").cast("date"))
    dim.merge(1, day("2024-02-01", "a"), "day")
    with pytest.raises(Exception, match="older than the current version"):
        dim.merge(2, day("2024-01-01", "b"), "day")


# ---------------------------------------------------------- replaced tables

def test_readers_keep_their_version(spark, tmp):
    path = f"{tmp}/t"
    with pytest.raises(FileNotFoundError):
        versioned.current(spark, path)
    versioned.replace(spark.range(3), path)
    reader = versioned.current(spark, path)
    versioned.replace(versioned.current(spark, path).union(spark.range(10, 12)), path)     # reads what it replaces
    assert reader.count() == 3 and versioned.current(spark, path).count() == 5
    with pytest.raises(Exception):
        versioned.replace(spark.range(1).select(F.raise_error(F.lit("broken"))), path)
    assert versioned.current(spark, path).count() == 5 and versioned.versions(spark, path) == [1, 2]
    versioned.replace(spark.range(1), path)
    assert versioned.vacuum(spark, path, keep=1) == 2 and versioned.current(spark, path).count() == 1


# ------------------------------------------------------------ masked texts

def test_e_mails_in_one_pass_are_the_same(spark):
    rng = random.Random(9)
    rows = ["".join(rng.choice("ab.-_@+1 <EMAIL>c") for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    rows += ["a@b.com-x@d.org", "a@b.com@c.org", "x<EMAIL>a@b.co <PHONE> +91 (020) 12345", "", None, "a@a@a.bc.de1"]
    df = spark.createDataFrame([(t,) for t in rows], "t string").repartition(4)
    plain = F.regexp_replace("t", text.EMAIL_PATTERN, text.EMAIL_MASK)
    got = df.select("t", text.mask_emails("t").alias("m"), plain.alias("p"), text.count_emails("t").alias("n"),
                    F.regexp_count("t", F.lit(text.EMAIL_PATTERN)).alias("q"), text.count_phones("t").alias("f"),
                    F.regexp_count(plain, F.lit(text.PHONE_PATTERN)).alias("g")).collect()
    assert [r for r in got if (r.m, r.n, r.f) != (r.p, r.q, r.g)] == []


def test_long_words_are_masked_in_linear_time(spark):
    words = ["a" * 1_000_000, "a" * 500_000 + "@" + "b" * 500_000, "a@" * 300_000, "x." * 300_000 + "@y.com", "1" * 400_000]
    df = spark.createDataFrame([(w,) for w in words], "t string").repartition(1)
    start = time.time()
    got = [r[0] for r in text.with_masked(df, "t").select("n_emails").collect()]
    assert sorted(got) == [0, 0, 0, 0, 1] and time.time() - start < 20


def test_csv_columns_read_once_more_as_types(spark, tmp):
    spark.createDataFrame([("1", "007")], "a string, b string").write.option("header", True).csv(f"{tmp}/x.csv")
    df = inference.scan_inferred(spark, {"x": read_csv(spark, [f"{tmp}/x.csv"])}, f"{tmp}/facts")
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [("a", "bigint"), ("b", "string")]
    assert tuple(df.first()) == (1, "007")


# ------------------------------------------------------------ changing records

def test_shapes_of_changing_records(spark, tmp):
    land = lambda day, *v: variants.append_records(
        spark.createDataFrame([(x,) for x in v], "value string"), f"{tmp}/v", "India", day, f"f_{day}.json")
    land("2024-01-01", '{"a": 1, "b": "x"}', '{"a": 2}')
    land("2024-02-01", '{"a": {"c": [1, {"d": true}]}}', "no json", None, "7")
    land("2024-02-01", '{"a": {"c": [1, {"d": true}]}}', "no json", None)
    rows = variants.read_records(spark, f"{tmp}/v")
    assert rows.count() == 5
    shape = {r.SnapshotDate: r.shape for r in variants.shapes(rows, "SnapshotDate").collect()}
    assert shape["2024-01-01"] == "OBJECT<a: BIGINT, b: STRING>" and "c: ARRAY<VARIANT>" in shape["2024-02-01"]
    assert "a: VARIANT" in variants.shapes(rows).first().shape
    got = variants.fields(rows, {"n": ("$.a", "bigint"), "d": ("$.a.c[1].d", "boolean")}, "unparsed").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 1, None), (None, 2, None), (None, None, True), ("no json", None, None), (None, None, None)], key=str)
