import glob
import os

from pyspark.sql import functions as F

from tidewater.streaming import jobs

HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def test_latest_state_is_kept_on_disk_in_any_session(spark, tmp):
    """Also where the session keeps state in the executors' heaps; its own
    settings are as they were afterwards."""
    land = f"{tmp}/land"
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, HEAP)
    try:
        for d, rows in (("d1", "1,a,2024-01-01\n2,b,2024-01-01\n"), ("d2", "1,c,2024-02-01\n2,z,2023-01-01\n,n,2024-03-01\n")):
            os.makedirs(f"{land}/{d}")
            with open(f"{land}/{d}/x.csv", "w") as f:
                f.write("k,v,s\n" + rows)
            jobs.latest_state_stream(spark, land, f"{tmp}/log", f"{tmp}/ckpt", "k int, v string, s string", "k", [F.to_date("s")])
        assert spark.conf.get(PROVIDER) == HEAP
        assert all(spark.conf.get(k, None) is None for k in jobs.STATE_CONF if k != PROVIDER)
    finally:
        spark.conf.set(PROVIDER, before)
    assert sorted((r["k"], r["v"]) for r in jobs.read_latest(spark, f"{tmp}/log", "k").collect()) == [(1, "c"), (2, "b")]
    with open(sorted(glob.glob(f"{tmp}/ckpt/offsets/[0-9]*"))[-1]) as f:
        assert "RocksDBStateStoreProvider" in f.read()
