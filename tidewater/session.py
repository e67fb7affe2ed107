"""Session helpers: one place for the runtime settings every job relies on.

Nothing here hides Spark: these are the same builder calls a user writes,
kept together so tests, the bench and the entry points agree.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# What an AES call with a literal key looks like in a plan's text
SECRETS = r"aes_(en|de)crypt\([^)]*\)|hmac[^)]*\)"

# Runtime SQL settings the jobs are designed around.  They are all
# session-level (settable on a running session) and safe on a cluster.
RUNTIME_CONF = {
    # dates in the test tables are TIMESTAMP_NTZ; pin the zone anyway so
    # any LTZ value renders the same on every executor
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed join partitions,
    # turn sort-merge joins into broadcast joins when a side is measured small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # the facts share a partitioning on purpose: a hot key's partition is
    # still split, at the price of a further exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # streaming state (the latest row of every key in ST2) lives off-heap in
    # RocksDB, checkpointed with the query, instead of in executor memory
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20,
                 shuffled_share: float = 0.2) -> dict[str, str]:
    """Settings sized to the data, for a cluster run (pass as ``extra``).

    * scan splits of ~256 MB keep a task's input well inside executor
      memory and give ``input_bytes / 256 MB`` scan tasks (100 TB -> ~400k);
    * the shuffle is sized from what is shuffled (``shuffled_share`` of the
      input: columns are pruned and aggregates combined before it), four
      splits to a partition and at least three waves over the cores: 100 TB
      give ~20k partitions.  One per split would make blocks of under a
      kilobyte and a map-status table that no driver holds;
    * AQE coalesces small partitions and splits skewed ones (> 5x median and
      > 1 GB) for joins, also where that costs a further exchange;
    * the broadcast threshold stays small and fixed: a dimension is
      broadcast only when AQE *measures* it under 64 MB at run time.
    """
    shuffled = int(input_bytes * shuffled_share)
    shuffle = max(3 * total_cores, shuffled // (4 * target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(16 << 20),
        # keys are literals of plans: keep them out of plans, logs and events
        "spark.sql.redaction.string.regex": SECRETS,
    }


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` defaults to ``local[$BENCH_CPUS]`` / ``local[*]`` only when
    no master is configured (spark-submit on a cluster sets it).
    """
    builder = SparkSession.builder.appName(app)
    if master is None and not os.environ.get("SPARK_MASTER") and "PYSPARK_SUBMIT_ARGS" not in os.environ:
        cpus = os.environ.get("BENCH_CPUS")
        master = f"local[{cpus}]" if cpus else "local[*]"
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and stream checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (a
    shared file system every executor sees).  Only when the session has none
    -- local tests -- do we create one and register it, so ``checkpoint()``
    works too.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir() returns a per-application sub-folder; its
        # parent is the configured shared folder
        return current.rstrip("/").rsplit("/", 1)[0]
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a temp folder on the driver is invisible to executors
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared work dir for one run."""
    return f"{work_dir(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewater`` importable in executor Python workers.

    Code that runs inside tasks (``mapInPandas`` functions) refers to this
    package by module path.  ``spark-submit --py-files`` is the usual way to
    ship it; this does the same at run time, once per SparkContext: the
    package's sources are zipped on the driver and registered with
    ``addPyFile``, which Spark distributes to every executor."""
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    sc.addPyFile(str(package_archive()))
    _SHIPPED.add(id(sc))


def package_archive() -> Path:
    """Zip of the package's sources, laid out for ``sys.path`` import."""
    pkg = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidewater-pyfiles-")) / "tidewater.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(pkg.rglob("*.py")):
            z.write(f, f.relative_to(pkg.parent).as_posix())
    return archive
