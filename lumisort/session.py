"""Session helpers: building a session, the shared checkpoint folder, size checks.

Nothing here tunes the engine beyond what a Spark user sets in a job: AQE on,
UI off, Arrow on.  On a cluster the checkpoint folder must come from the
cluster's ``spark.checkpoint.dir``; only a local master may fall back to a
scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Own configuration keys (read from the session, so a job can override them).
CONF_WINDOW_MAX_GROUP_ROWS = "lumisort.window.maxGroupRows"
CONF_BROADCAST_MAX_ROWS = "lumisort.broadcast.maxRows"
CONF_RANGE_ROWS_PER_PARTITION = "lumisort.range.rowsPerPartition"
CONF_SMALL_INPUT_BYTES = "lumisort.small.inputBytes"

DEFAULT_WINDOW_MAX_GROUP_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_ROWS = 200_000
DEFAULT_RANGE_ROWS_PER_PARTITION = 2_000_000
DEFAULT_SMALL_INPUT_BYTES = 32 << 20


def build_session(master: str | None = None, app_name: str = "lumisort",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings the library expects (AQE on, UI off)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # checkpoints go when nothing refers to them any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # concurrent fits of a grid share the cluster
        "spark.scheduler.mode": "FAIR",
        # bound the Arrow batches handed to Python workers (decoded images are big)
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    v = spark.conf.get(key, None)
    return int(v) if v not in (None, "") else default


def is_small(df: DataFrame) -> bool:
    """All that the plan reads is at most ``lumisort.small.inputBytes`` (known from file sizes,
    without a job).  Then group counts, row counts and size checks are not worth their jobs."""
    limit = conf_int(df.sparkSession, CONF_SMALL_INPUT_BYTES, DEFAULT_SMALL_INPUT_BYTES)
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    try:
        return sum(leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size())) <= limit
    except ValueError:  # estimates of joins multiply; Python refuses to read numbers of thousands of digits
        return False


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def _on_one_machine(spark: SparkSession, path: str) -> bool:
    """A ``file:`` path, or one without a scheme that Hadoop resolves to the local file system."""
    scheme, colon, _ = path.partition(":")
    if colon and "/" not in scheme:
        return scheme == "file"
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from the running context or ``spark.checkpoint.dir``; a local master
    without one gets a scratch folder (tests).  A cluster without one is an error:
    a machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; it is needed to cut lineage")
        d = tempfile.mkdtemp(prefix="lumisort-ckpt-")
    if not is_local(spark) and _on_one_machine(spark, d):
        raise RuntimeError(f"{d} is a folder of one machine; set spark.checkpoint.dir to a shared one")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def remove_scratch(spark: SparkSession, path: str) -> bool:
    """Delete a table this library wrote under the checkpoint folder (refuses
    anything outside it)."""
    root = checkpoint_root(spark).rstrip("/")
    if not path.startswith(root + "/"):
        raise ValueError(f"{path} is not under the checkpoint folder {root}")
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True))


def durable(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared folder): cuts lineage and
    survives executor loss.  Meant for small/narrow tables.  Unless all that it
    reads is small, the table is persisted for the duration, so that writing the
    checkpoint does not compute the plan a second time."""
    from pyspark import StorageLevel
    checkpoint_root(df.sparkSession)
    if is_small(df):
        return df.checkpoint(eager=True)
    d = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return d.checkpoint(eager=True)
    finally:
        d.unpersist()
