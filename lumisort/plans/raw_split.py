"""First pass over raw image archives: label each member from its name, split
every class positionally, and lay the images out by split and class.

The reference extracts the archive and moves files into
``{train,test}/<label>/`` folders; here the layout is the ``partitionBy`` of a
table of (name, bytes), and "moving" is the ``split`` column.  Archives are
unpacked once, into a staged Parquet table in the shared folder: counts and
boundaries read its narrow columns, the layout its bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort.functions.naming import basename
from lumisort.operators.split import rebalance, split_positional
from lumisort.session import remove_scratch, scratch_path
from lumisort.sources.files import read_archives

ORDERS = {"archive": ("archive", "place"), "name": ("file_name",)}


def stage_archives(spark: SparkSession, path: str, glob: str = "*.tar.gz", partitions: int | None = None) -> str:
    """Unpack all archives once; the path of the staged table."""
    staged = scratch_path(spark, "archive-members")
    read_archives(spark, path, glob, partitions).write.parquet(staged)
    return staged


def archive_problems(members: DataFrame) -> DataFrame:
    """(archive, member, reason): unreadable archives, and members without a root folder."""
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("name") == "", F.lit("no root folder"))
    return members.select("archive", "member", reason.alias("reason")).where(F.col("reason").isNotNull())


def split_archives(spark: SparkSession, path: str, cutoff: float | None = None, out_path: str | None = None,
                   rebalance_to: float | None = None, seed: int | str = 1, glob: str = "*.tar.gz",
                   partitions: int | None = None, problems_path: str | None = None, order: str = "archive") -> DataFrame:
    """Archives -> file_name, label_name, split, content (first pass: the first
    ``ceil(cutoff * N)`` files of each class are train, in ``order``: 'archive', as the
    archives list them, one archive after the other by path, or 'name').  ``rebalance_to``
    moves rows to a new cutoff afterwards (the second-run branch of the
    reference).  With ``out_path`` the table is written partitioned by split
    and class and the written table returned; else the result reads the staged
    table.  ``problems_path``: where to write ``archive_problems`` as JSON lines."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {tuple(ORDERS)}")
    staged = stage_archives(spark, path, glob, partitions)
    members = spark.read.parquet(staged)
    if problems_path:
        archive_problems(members).write.mode("overwrite").json(problems_path)
    imgs = (members.where(F.col("error").isNull() & (F.col("name") != ""))
            .select(basename(F.col("name")).alias("file_name"), "label_name", "content", "archive", "place"))
    out = split_positional(imgs, cutoff, order_by=ORDERS[order]).drop("archive", "place")
    if rebalance_to is not None:
        out = rebalance(out, rebalance_to, seed)
    if not out_path:
        return out
    (out.hint("rebalance", "split", "label_name").write.mode("overwrite").partitionBy("split", "label_name")
     .parquet(out_path))
    remove_scratch(spark, staged)
    return spark.read.parquet(out_path).select(*out.columns)
