"""A fold deals a bucket to several tasks: no task has a whole one."""

import glob

from tidewater.operators.pair_state import PairState


def test_a_bucket_is_written_by_several_tasks(spark, tmp):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        state = PairState(spark, f"{tmp}/s", buckets=1)
        rows = lambda n, x: spark.range(n).selectExpr(
            "'i' || id AS id", f"'{x}' AS version", "'g' AS grp", "'k' || id % 50 AS k", f"{x} AS amount")
        state.fold(1, rows(400, 1), rows(100, 1))
        state.fold(2, rows(200, 2), None)
    finally:
        spark.conf.set(key, before)
    for run in (1, 2):
        assert len(glob.glob(f"{tmp}/s/left_rows/run={run}/bucket=0/*.parquet")) > 1
        assert len(glob.glob(f"{tmp}/s/left_sums/run={run}/bucket=0/*.parquet")) > 1
    # every key has 8 rows on the left and 2 on the right
    t = state.totals().first()
    assert (t.grp, int(t.left_over_pairs), int(t.right_over_pairs), int(t.pairs), t["keys"], t.left_rows) == (
        "g", 2 * (200 + 2 * 200), 8 * 100, 800, 50, 400)
