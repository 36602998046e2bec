"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort._compat import ship_by_value
from lumisort.operators.ranking import small_side
from lumisort.session import checkpoint_root, remove_scratch, scratch_path

#: Words of a text: maximal runs of anything but the six ASCII blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD_PATTERN)

CONF_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_arrow(spark: SparkSession, n_bytes: int = ARROW_BYTES) -> None:
    """Arrow batches are bounded by bytes, so a batch of long texts stays small
    in the Python workers; a smaller bound that the session sets is kept."""
    now = spark.conf.get(CONF_ARROW_BYTES, None)
    if not (now and now.strip("-").isdigit() and 0 < int(now) <= n_bytes):
        spark.conf.set(CONF_ARROW_BYTES, str(n_bytes))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read
    back: later readers neither recompute it nor depend on one executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def drop_stored(*tables: DataFrame | None) -> None:
    """Removes tables made by ``stored`` that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_stored_at", None)
        if path:
            remove_scratch(t.sparkSession, path)
            t._stored_at = None


def release(spark: SparkSession) -> None:
    """Lets the driver go of what nothing refers to any more: Spark frees shuffle files, broadcasts and
    checkpoints of plans only when the driver's garbage is collected, and the heap grows until it is."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def packed(value) -> bytes:
    """``value`` for a broadcast; unpacked by ``pickle.loads`` in workers that lack this package."""
    from pyspark import cloudpickle
    return cloudpickle.dumps(value)


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (cuts an iterative lineage)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: A group is hot from 1/HOT_SHARE of all rows on, so there are HOT_SHARE hot groups at most.
HOT_SHARE = 2_000


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: str) -> DataFrame:
    """``rows`` with the columns of ``groups`` (stored; one row a key, ``size`` its number of
    rows) by the binary ``key``, nulls where there is no group.

    Few groups are broadcast.  Beyond ``lumisort.broadcast.maxRows`` only the hot ones are,
    which are ``HOT_SHARE`` at most whatever the input, and their rows take a key of their own
    (``spread``, a unique number) through the join by key, so no task gets a hot group.
    The result is the same either way."""
    n = groups.count()
    few = small_side(groups, n)
    if few is not groups:
        return rows.join(few, key, "left")
    total = groups.agg(F.sum(size)).first()[0]
    hot_from = max(2, -(-total // HOT_SHARE))
    names = [c for c in groups.columns if c != key]
    value = F.struct(*names)
    hot = groups.where(F.col(size) >= hot_from).select(F.col(key).alias("_ag_hot"), value.alias("_ag_h"))
    rest = groups.where(F.col(size) < hot_from).select(F.col(key).alias("_ag_key"), value.alias("_ag_r"))
    own = F.concat(key, F.unhex(F.lpad(F.hex(spread), 16, "0")))
    out = rows.join(F.broadcast(hot), rows[key] == hot["_ag_hot"], "left")
    out = out.withColumn("_ag_at", F.when(F.col("_ag_h").isNull(), F.col(key)).otherwise(own))
    at = (out["_ag_at"] == rest["_ag_key"]) & out["_ag_h"].isNull()
    out = out.join(rest, at, "left").withColumn("_ag_v", F.coalesce("_ag_h", "_ag_r"))
    return out.select(*rows.columns, *[F.col(f"_ag_v.{c}").alias(c) for c in names])


def file_bytes(path: str) -> bytes:
    """A vocabulary file of the installed tokenizers, read on the driver and sent
    to the workers, which then need no file of their own."""
    with open(path, "rb") as f:
        return f.read()


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a fold over nothing; unlike
    ``transform`` it doesn't copy the value)."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def ascii_lower(c):
    """Lower-cases A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# The functions of this subpackage go to the workers by value: executors need no copy.
for _name in ("lumisort.llm", "lumisort._compat"):
    ship_by_value(_name)
