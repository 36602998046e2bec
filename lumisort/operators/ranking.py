"""Exact ranks within groups that stay exact when one group holds a third of the data.

Every split and sampling operator of the library reduces to one of two questions
about a group (a class, or a class and split) in a stated order:

* which rows are among the first ``k`` (``flag_first_k``), and
* what is each row's position (``row_positions``).

A window partitioned by the group answers both, but puts a whole group in one
task.  That is fine for small groups and wrong for a hot one, so both functions
first run one cheap aggregate (group count, largest group, total rows) and pick (inputs
of a few files, by ``session.is_small``, take the window without asking):

* **window**: every group fits a task (``lumisort.window.maxGroupRows``);
* **range**: range-partition the *narrow* key columns on (group, order) -- a hot
  group is spread over many partitions -- sort within partitions, count rows per
  (partition, group), and turn the per-partition counts (at most partitions +
  groups rows) into running offsets.  A row's position is its offset inside its
  partition plus the rows of the group in earlier partitions.

``flag_first_k`` never shuffles the wide rows: it finds each group's boundary key
(the key of its k-th row, one row per group) on the narrow keys and joins that
small table back, so the result is "key <= boundary key" -- identical to
``rank() <= k``, ties at the boundary included.  Tables are hinted for broadcast
only when their row count (known from an aggregate or counted on a stored copy) is
under ``lumisort.broadcast.maxRows``; above it the join is left to the planner.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumisort.session import (
    CONF_BROADCAST_MAX_ROWS,
    CONF_RANGE_ROWS_PER_PARTITION,
    CONF_WINDOW_MAX_GROUP_ROWS,
    DEFAULT_BROADCAST_MAX_ROWS,
    DEFAULT_RANGE_ROWS_PER_PARTITION,
    DEFAULT_WINDOW_MAX_GROUP_ROWS,
    conf_int,
    durable,
    is_small,
)

STRATEGIES = ("auto", "window", "range")


@dataclass(frozen=True)
class GroupStats:
    groups: int
    largest: int
    rows: int


def group_stats(df: DataFrame, group_cols: Sequence[str]) -> GroupStats:
    """Number of groups, largest group and total rows (one partial-aggregated job)."""
    r = (df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
         .agg(F.count(F.lit(1)).alias("g"), F.max("_n").alias("m"), F.sum("_n").alias("t"))
         .first())
    return GroupStats(int(r["g"] or 0), int(r["m"] or 0), int(r["t"] or 0))


def sized(df: DataFrame) -> tuple[DataFrame, int]:
    """A reliable copy of a narrow table and its row count.  The copy carries a
    broadcast hint when the count is within ``lumisort.broadcast.maxRows``; beyond
    it joins with the copy stay distributed.  Rows are the same either way."""
    copy = durable(df)
    n = copy.count()
    return small_side(copy, n), n


def looked_up(df: DataFrame) -> DataFrame:
    """A reliable copy of a narrow table to look rows up in: broadcast if all that it was made
    from is small, or if it is counted within the limit (``sized``)."""
    return F.broadcast(durable(df)) if is_small(df) else sized(df)[0]


def small_side(df: DataFrame, row_bound: int) -> DataFrame:
    """Broadcast hint only behind a proven row bound; otherwise let the planner choose."""
    limit = conf_int(df.sparkSession, CONF_BROADCAST_MAX_ROWS, DEFAULT_BROADCAST_MAX_ROWS)
    return F.broadcast(df) if row_bound <= limit else df


def _choose(df: DataFrame, group_cols, strategy: str, stats: GroupStats | None = None) -> tuple[str, GroupStats]:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if stats is None:
        if strategy == "window" or (strategy == "auto" and is_small(df)):
            return "window", GroupStats(0, 0, 0)  # no size is asked of a window
        stats = group_stats(df, group_cols)
    if strategy == "auto":
        limit = conf_int(df.sparkSession, CONF_WINDOW_MAX_GROUP_ROWS, DEFAULT_WINDOW_MAX_GROUP_ROWS)
        strategy = "window" if stats.largest <= limit else "range"
    return strategy, stats


def _range_partitions(df: DataFrame, stats: GroupStats) -> int:
    spark = df.sparkSession
    per = conf_int(spark, CONF_RANGE_ROWS_PER_PARTITION, DEFAULT_RANGE_ROWS_PER_PARTITION)
    base = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    return max(base, math.ceil(stats.rows / max(per, 1)))


def _ranged(df: DataFrame, group_cols, order_cols, parts: int) -> DataFrame:
    """Range-partitioned and sorted copy with partition id and a per-partition
    increasing id (ids follow the sort order inside a partition)."""
    keys = [*group_cols, *order_cols]
    return (df.repartitionByRange(parts, *keys)
            .sortWithinPartitions(*keys)
            .withColumn("_pid", F.spark_partition_id())
            .withColumn("_mid", F.monotonically_increasing_id()))


def _offsets(ranged: DataFrame, group_cols, extra_aggs=()) -> DataFrame:
    """Per (partition, group): first id, row count, rows of the group in earlier partitions."""
    w_before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.groupBy("_pid", *group_cols)
            .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"), *extra_aggs)
            .withColumn("_before", F.coalesce(F.sum("_n").over(w_before), F.lit(0))))


def _null_safe_on(left: DataFrame, right: DataFrame, left_cols, right_cols) -> Column:
    cond = None
    for lc, rc in zip(left_cols, right_cols):
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return cond


def _lex_le(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Lexicographic ``left <= right`` over column tuples."""
    a = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(left)])
    b = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(right)])
    return a <= b


def boundary_keys(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], k: Column,
                  strategy: str = "auto", stats: GroupStats | None = None) -> tuple[DataFrame, GroupStats]:
    """One row per group with ``k >= 1``: the group keys and the order keys of the
    group's ``min(k, n)``-th row (``_b0``, ``_b1``...).  ``k`` must be constant in a group."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    narrow = df.select(*group_cols, *order_cols, k.cast("long").alias("_k"))
    strategy, stats = _choose(narrow, group_cols, strategy, stats)
    bcols = [F.col(c).alias(f"_b{i}") for i, c in enumerate(order_cols)]
    if strategy == "window":
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        wn = Window.partitionBy(*group_cols)
        b = (narrow.withColumn("_rn", F.row_number().over(w))
             .withColumn("_gn", F.count(F.lit(1)).over(wn))
             .where(F.col("_rn") == F.least(F.col("_k"), F.col("_gn")))
             .select(*group_cols, *bcols))
        return b, stats
    # Written once to the shared checkpoint folder: the offsets and the boundary
    # lookup read the same stored row ids, whatever the session's settings.
    ranged = durable(_ranged(narrow, group_cols, order_cols, _range_partitions(narrow, stats)))
    off = _offsets(ranged, group_cols, [F.max("_k").alias("_k")])
    off = off.withColumn("_total", F.sum("_n").over(Window.partitionBy(*group_cols)))
    kk = F.least(F.col("_k"), F.col("_total"))
    target = (off.where((kk >= 1) & (F.col("_before") < kk) & (kk <= F.col("_before") + F.col("_n")))
              .select((F.col("_first") + kk - F.col("_before") - 1).alias("_mid")))
    b = ranged.join(small_side(target, stats.groups), "_mid").select(*group_cols, *bcols, "_k")
    return b, stats


def flag_first_k(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], k: Column,
                 out_col: str, strategy: str = "auto", stats: GroupStats | None = None) -> DataFrame:
    """Add boolean ``out_col``: the row is among the first ``k`` of its group in
    ``order_cols`` order (``rank() <= k``).  Wide columns of ``df`` are never shuffled."""
    b, stats = boundary_keys(df, group_cols, order_cols, k, strategy, stats)
    return flag_by_boundary(df, b, group_cols, order_cols, out_col, stats.groups)


def flag_by_boundary(df: DataFrame, boundaries: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                     out_col: str, n_groups: int) -> DataFrame:
    """``df`` with ``out_col``: its order keys are not after its group's boundary keys (``boundary_keys``).
    ``n_groups``: groups at most, 0 for those of a small input."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    # The boundary table has at most one row per group and is exact whatever the
    # partitioning: store it so the caller's lineage stays one scan plus a small
    # join, even over chained calls.
    b = durable(boundaries)
    gnames = [f"_g{i}" for i in range(len(group_cols))]
    b = b.select(*[F.col(c).alias(g) for c, g in zip(group_cols, gnames)],
                 *[F.col(f"_b{i}") for i in range(len(order_cols))], F.lit(True).alias("_has"))
    b = small_side(b, n_groups)
    joined = df.join(b, _null_safe_on(df, b, group_cols, gnames), "left")
    le = _lex_le([df[c] for c in order_cols], [F.col(f"_b{i}") for i in range(len(order_cols))])
    flag = F.coalesce(F.col("_has") & le, F.lit(False))
    return joined.withColumn(out_col, flag).drop(*gnames, "_has", *[f"_b{i}" for i in range(len(order_cols))])


def row_positions(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], out_col: str,
                  strategy: str = "auto", stats: GroupStats | None = None) -> DataFrame:
    """Add ``out_col``: 1-based position of the row in its group (``row_number``).

    Order keys should be unique within a group for a deterministic answer.  The
    range path range-partitions the rows it is given, so call it on the narrow
    key table (names, labels, split) and attach wide columns afterwards."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    strategy, stats = _choose(df.select(*group_cols), group_cols, strategy, stats)
    if strategy == "window":
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return df.withColumn(out_col, F.row_number().over(w))
    parts = _range_partitions(df, stats)
    # Written once to the shared checkpoint folder: partition ids and row ids
    # become stored values, so the offsets and the rows can never disagree, and
    # the lineage is cut.
    ranged = durable(_ranged(df, group_cols, order_cols, parts))
    off = _offsets(ranged, group_cols)
    gnames = [f"_g{i}" for i in range(len(group_cols))]
    off = off.select(F.col("_pid").alias("_opid"), *[F.col(c).alias(g) for c, g in zip(group_cols, gnames)],
                     "_first", "_before")
    off = small_side(off, parts + stats.groups)
    cond = (ranged["_pid"] == off["_opid"]) & _null_safe_on(ranged, off, group_cols, gnames)
    return (ranged.join(off, cond)
            .withColumn(out_col, (F.col("_mid") - F.col("_first") + F.col("_before") + 1).cast("int"))
            .drop("_pid", "_mid", "_opid", "_first", "_before", *gnames))
