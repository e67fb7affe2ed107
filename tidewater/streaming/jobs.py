"""Structured Streaming versions of the ingest and silver steps (ST1-ST3).

The reference ingests one file per notebook run, appends, then moves the
file -- a crash between the two re-ingests it.  Here the file source and a
checkpoint make each landed file count exactly once, and ``cleanSource``
archives files the stream has committed (during a later micro-batch).

All jobs use ``trigger(availableNow=True)``: process what has landed, then
stop -- the daily-batch cadence of the reference, with streaming's
bookkeeping.  Checkpoints live in the shared work folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.protect import protect_columns
from ..functions.text import country_name
from ..operators.dedup import row_fingerprint
from ..operators.provenance import snapshot_from_name, stamp


#: State of any number of keys: on the executors' disks, not in their heaps,
#: all stores of an executor share one bounded cache, and a batch adds its
#: changes to the checkpoint, not the files that it rewrote.
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",
    f"{_ROCKSDB}.maxMemoryUsageMB": "256",
    f"{_ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{_ROCKSDB}.compression": "zstd",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A query started in this block keeps its state as ``STATE_CONF`` says,
    whatever the session has; it takes its settings when it starts.  (A
    checkpoint that began otherwise goes on as it began.)"""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def file_stream(spark: SparkSession, landing: str, schema: str, fmt: str = "csv",
                archive_dir: str | None = None, max_files: int | None = None,
                recursive: bool = False) -> DataFrame:
    """A file stream; ``recursive`` for deliveries that are folders of part
    files (plain ``key=value`` partition folders are found without it)."""
    r = spark.readStream.format(fmt).schema(schema)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if fmt == "csv":
        r = r.option("header", True)
    if fmt == "json":
        r = r.option("multiLine", True)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(landing)


def ingest_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                  schema: str, country: str, key: str | None = None,
                  sensitive: Sequence[str] = (), fmt: str = "csv",
                  archive_dir: str | None = None, run_date: str | None = None) -> None:
    """ST1: landed files -> protected, stamped parquet, exactly once per file."""
    df = file_stream(spark, landing, schema, fmt, archive_dir)
    if key and sensitive:
        df = protect_columns(df, sensitive, key)
    df = stamp(df, country_name(F.lit(country)),
               snapshot_from_name(F.col("_metadata.file_path"), run_date),
               F.col("_metadata.file_name"))
    q = (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy("SnapshotDate").trigger(availableNow=True).start(sink))
    q.awaitTermination()


def latest_state_stream(spark: SparkSession, landing: str, changelog: str, checkpoint: str,
                        schema: str, key: str, order: Sequence[Column],
                        fmt: str = "csv", max_files: int | None = None,
                        enrich=None) -> None:
    """ST2: latest row per key, maintained incrementally.

    ``row_number`` is not allowed on a stream, so the state is a streaming
    aggregation: per key, the max of ``struct(order..., row hash, row)``
    (same winner as the batch dedup; give ``order`` ascending -- the max
    wins, and NULL sorts lowest so it never wins).  The state store holds one row per
    key, spread over the shuffle partitions, on disk (RocksDB) in any session.  Each micro-batch emits only
    the keys it changed (update mode); ``foreachBatch`` writes them to
    ``changelog/batch_id=N`` with partition overwrite, so a replayed batch
    rewrites its own partition -- idempotent, hence exactly once.  Readers
    take the latest row per key over the change log (``read_latest``).
    """
    src = file_stream(spark, landing, schema, fmt, max_files=max_files, recursive=True)
    if enrich is not None:
        src = enrich(src)
    payload = [c for c in src.columns]
    ranked = src.select(
        F.col(key).alias("_key"),
        F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                 row_fingerprint(src).alias("_h"),
                 F.struct(*payload).alias("row")).alias("_best"))
    latest = ranked.where(F.col("_key").isNotNull()).groupBy("_key").agg(
        F.max("_best").alias("_best"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.select("_best.row.*").withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(changelog))

    with _state_on_disk(spark):
        q = (latest.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(write_batch).trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, changelog: str, key: str,
                base: str | None = None) -> DataFrame:
    """Merge-on-read of the ST2 change log: a key's row from its latest
    batch is its current state (one row per key per batch).

    With ``base`` (written by ``compact``) only batches newer than the base
    are read from the log, so reads stop growing with the log's history.
    Old ``batch_id`` partitions then expire by the storage's lifecycle
    rules -- no job deletes files here."""
    from ..operators.dedup import latest_per_key
    log = spark.read.parquet(changelog)
    if base is not None:
        b = spark.read.parquet(base)
        newer = log.where(F.col("batch_id") > b.select(F.max("batch_id")).scalar())
        log = b.unionByName(newer)
    return latest_per_key(log, [key], [F.col("batch_id").desc()], tiebreak=False).drop("batch_id")


def compact(spark: SparkSession, changelog: str, key: str, base: str,
            previous_base: str | None = None) -> None:
    """Fold the change log (and an earlier base) into a new base folder:
    one row per key, stamped with the newest batch it covers.  Write each
    compaction to a fresh folder and switch readers to it."""
    from ..operators.dedup import latest_per_key
    log = spark.read.parquet(changelog)
    if previous_base is not None:
        prev = spark.read.parquet(previous_base)
        log = prev.unionByName(
            log.where(F.col("batch_id") > prev.select(F.max("batch_id")).scalar()))
    merged = latest_per_key(log, [key], [F.col("batch_id").desc()], tiebreak=False)
    merged.write.mode("overwrite").parquet(base)


def windowed_totals_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                           schema: str, time_col: str, group: str, amount: str,
                           window: str = "1 hour", delay: str = "10 minutes",
                           fmt: str = "csv") -> None:
    """ST3: tumbling-window counts and exact sums with a watermark.

    Update mode: every micro-batch publishes the windows that it changed,
    open ones too, to ``sink/batch_id=N`` with partition overwrite, so a
    replayed batch rewrites its own partition.  ``read_windows`` takes the
    latest figures of each window: after all input they equal the batch
    answer.  The watermark (latest event time seen minus ``delay``) drops
    older events and bounds the state to the open windows."""
    src = file_stream(spark, landing, schema, fmt)
    # watermarks need TIMESTAMP (with zone); NTZ input is read as UTC-free
    # wall time, so go through the session zone and come back at the end
    src = src.withColumn(time_col, F.col(time_col).cast("timestamp"))
    agg = (src.withWatermark(time_col, delay)
              .groupBy(F.window(time_col, window).alias("w"), group)
              .agg(F.count(F.lit(1)).alias("events"),
                   F.sum(F.col(amount).cast("decimal(18,2)")).alias("_total")))
    out = agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                     group, "events", F.col("_total").cast("double").alias("total_value"))

    def publish(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink))

    q = (out.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(publish).trigger(availableNow=True).start())
    q.awaitTermination()


def read_windows(spark: SparkSession, sink: str, group: str) -> DataFrame:
    """The latest published figures of every window and group."""
    from ..operators.dedup import latest_per_key
    return latest_per_key(spark.read.parquet(sink), ["window_start", group],
                          [F.col("batch_id").desc()], tiebreak=False).drop("batch_id")
