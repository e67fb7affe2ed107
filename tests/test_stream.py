import os

from tidewater.streaming import jobs


def test_file_stream_exactly_once(spark, tmp):
    land = f"{tmp}/land"
    os.makedirs(land)
    with open(f"{land}/e_2024-01-01.csv", "w") as f:
        f.write("id,v\n1,a\n2,b\n")
    with open(f"{land}/empty_2024-01-02.csv", "w") as f:
        f.write("id,v\n")
    for _ in range(2):
        jobs.ingest_stream(spark, land, f"{tmp}/sink", f"{tmp}/ckpt", "id int, v string", "x",
                           archive_dir=f"{tmp}/archive")
    assert spark.read.parquet(f"{tmp}/sink").count() == 2


def test_late_event_dropped(spark, tmp):
    land = f"{tmp}/land"
    os.makedirs(land)
    with open(f"{land}/a.csv", "w") as f:
        f.write("ts,k,v\n2024-01-01T05:00:00,a,1\n2024-01-01T06:30:00,a,2\n")
    jobs.windowed_totals_stream(spark, land, f"{tmp}/sink", f"{tmp}/ckpt",
                                "ts timestamp_ntz, k string, v double", "ts", "k", "v")
    with open(f"{land}/b.csv", "w") as f:   # 5h old: behind the watermark
        f.write("ts,k,v\n2024-01-01T01:00:00,a,100\n2024-01-01T09:00:00,a,3\n")
    jobs.windowed_totals_stream(spark, land, f"{tmp}/sink", f"{tmp}/ckpt",
                                "ts timestamp_ntz, k string, v double", "ts", "k", "v")
    rows = sorted((str(r["window_start"]), r["total_value"]) for r in jobs.read_windows(spark, f"{tmp}/sink", "k").collect())
    assert rows == [("2024-01-01 05:00:00", 1.0), ("2024-01-01 06:00:00", 2.0), ("2024-01-01 09:00:00", 3.0)]


def test_latest_state_stream_replays_nothing_twice(spark, tmp):
    from pyspark.sql import functions as F
    land = f"{tmp}/land"
    os.makedirs(f"{land}/d1")
    os.makedirs(f"{land}/d2")
    with open(f"{land}/d1/a.csv", "w") as f:
        f.write("k,v,s\n1,old,2024-01-01\n2,x,2024-01-01\n")
    with open(f"{land}/d2/b.csv", "w") as f:
        f.write("k,v,s\n1,new,2024-02-01\n1,older,2023-12-01\n")
    for _ in range(2):   # second run: no new files, no new batch
        jobs.latest_state_stream(spark, land, f"{tmp}/log", f"{tmp}/ckpt", "k int, v string, s string",
                                 "k", [F.to_date("s")], max_files=1)
    got = sorted((r["k"], r["v"]) for r in jobs.read_latest(spark, f"{tmp}/log", "k").collect())
    assert got == [(1, "new"), (2, "x")]
    assert spark.read.parquet(f"{tmp}/log").select("batch_id").distinct().count() == 2


def test_change_log_compaction(spark, tmp):
    from pyspark.sql import functions as F
    land = f"{tmp}/land"
    schema = "k int, v string, s string"
    os.makedirs(f"{land}/d1")
    with open(f"{land}/d1/a.csv", "w") as f:
        f.write("k,v,s\n1,a,2024-01-01\n2,b,2024-01-01\n")
    run = lambda: jobs.latest_state_stream(spark, land, f"{tmp}/log", f"{tmp}/ckpt", schema,
                                           "k", [F.to_date("s")], max_files=1)
    run()
    jobs.compact(spark, f"{tmp}/log", "k", f"{tmp}/base1")
    os.makedirs(f"{land}/d2")
    with open(f"{land}/d2/b.csv", "w") as f:
        f.write("k,v,s\n2,c,2024-02-01\n3,d,2024-02-01\n")
    run()
    want = [(1, "a"), (2, "c"), (3, "d")]
    got = sorted((r["k"], r["v"]) for r in jobs.read_latest(spark, f"{tmp}/log", "k", base=f"{tmp}/base1").collect())
    assert got == want
    jobs.compact(spark, f"{tmp}/log", "k", f"{tmp}/base2", previous_base=f"{tmp}/base1")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{tmp}/base2").collect()) == want
