"""Train/test assignment per class: positional split, rebalance, samples.

The split is a column (``split in {'train','test'}``), not a folder: moving a
file between splits is a new value of that column.  All operators are
``DataFrame -> DataFrame`` and keep every row; ranks come from
``lumisort.operators.ranking`` so no task ever holds a whole class.

Cutoff arithmetic is IEEE double, as in the reference (``0.29 * 100`` is
``28.999999999999996``): the positional pass keeps rows with 0-based position
``i < cutoff * N`` (so ``ceil``: 29), the rebalance targets ``floor(cutoff * N)`` (28).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumisort.operators.ranking import (
    GroupStats,
    boundary_keys,
    flag_by_boundary,
    flag_first_k,
    looked_up,
    row_positions,
    sized,
    small_side,
)
from lumisort.session import durable, is_small

DEFAULT_CUTOFF = 0.8
TRAIN, TEST = "train", "test"


def resolve_cutoff(cutoff: float | None) -> float:
    """``None`` -> 0.8; otherwise a float in [0, 1]."""
    c = DEFAULT_CUTOFF if cutoff is None else float(cutoff)
    if not 0.0 <= c <= 1.0:
        raise ValueError(f"cutoff must be within [0, 1], got {cutoff!r}")
    return c


def sampling_key(name_col: str = "file_name", seed: int | str = 1) -> Column:
    """Deterministic pseudo-random order: ``md5('<seed>:<name>')`` (same text in any SQL engine)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(name_col)))


def _with_class_counts(df: DataFrame, label_col: str, split_col: str | None):
    """Attach per-class ``_n`` (and ``_ntrain``) and return the group statistics
    of the (class) and (class, split) groups, from one small stored aggregate (one
    row per class)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if split_col:
        aggs.append(F.count_if(F.col(split_col) == TRAIN).alias("_ntrain"))
    counts = durable(df.groupBy(label_col).agg(*aggs).withColumnRenamed(label_col, "_lbl"))
    ntrain = F.col("_ntrain") if split_col else F.lit(0)
    r = counts.agg(F.count(F.lit(1)).alias("g"), F.max("_n").alias("m"), F.sum("_n").alias("t"),
                   F.max(F.greatest(ntrain, F.col("_n") - ntrain)).alias("ms")).first()
    g, m, t, ms = (int(r[x] or 0) for x in ("g", "m", "t", "ms"))
    counts = small_side(counts, g)
    by_class = GroupStats(g, m, t)
    by_class_split = GroupStats(2 * g, ms, t)
    joined = df.join(counts, df[label_col].eqNullSafe(counts["_lbl"]), "left").drop("_lbl")
    return joined, by_class, by_class_split


def _flag_first(df: DataFrame, label_col: str, split_col: str | None, order_cols: Sequence[str], k: Column,
                out_col: str, strategy: str) -> DataFrame:
    """``out_col``: among the first ``k`` rows of the class (with ``split_col``: of the class and split).
    ``k`` may use the class's row counts ``_n`` and ``_ntrain``."""
    group = [label_col, split_col] if split_col else [label_col]
    if strategy == "auto" and is_small(df):
        # counts, ranks and boundaries in one pass over the narrow columns
        of_class = Window.partitionBy(label_col)
        narrow = df.select(*group, *order_cols).withColumn("_n", F.count(F.lit(1)).over(of_class))
        if split_col:
            narrow = narrow.withColumn("_ntrain", F.count_if(F.col(split_col) == TRAIN).over(of_class))
        b, _ = boundary_keys(narrow, group, order_cols, k, "window")
        return flag_by_boundary(df, b, group, order_cols, out_col, 0)
    d, by_class, by_class_split = _with_class_counts(df, label_col, split_col)
    out = flag_first_k(d, group, list(order_cols), k, out_col, strategy, by_class_split if split_col else by_class)
    return out.drop("_n", "_ntrain")


def split_positional(df: DataFrame, cutoff: float | None = None, label_col: str = "label_name",
                     order_by: Sequence[str] = ("file_name",), split_col: str = "split",
                     strategy: str = "auto") -> DataFrame:
    """First pass: in each class the first ``ceil(cutoff * N)`` rows in ``order_by``
    order are ``train``, the rest ``test``."""
    c = resolve_cutoff(cutoff)
    k = F.least(F.ceil(F.lit(c) * F.col("_n")), F.col("_n"))
    out = _flag_first(df, label_col, None, list(order_by), k, "_first", strategy)
    return out.withColumn(split_col, F.when(F.col("_first"), F.lit(TRAIN)).otherwise(F.lit(TEST))).drop("_first")


def rebalance(df: DataFrame, cutoff: float | None = None, seed: int | str = 1, label_col: str = "label_name",
              name_col: str = "file_name", split_col: str = "split", strategy: str = "auto",
              skip_existing_at_destination: bool = False) -> DataFrame:
    """Move the fewest rows so each class has ``floor(cutoff * N)`` train rows.

    Too few train rows: the first ``target - n_train`` test rows in sampling-key
    order become train; too many: the first ``n_train - target`` train rows become
    test.  Other rows keep their split, so applying it twice equals applying it once.

    ``skip_existing_at_destination``: a chosen row whose name already exists in
    the other split of its class stays where it is (the reference's move skips
    a file that exists at the destination, so fewer rows move).  Only tables
    holding one name in both splits are affected; the names in both are found
    on the narrow key columns.
    """
    c = resolve_cutoff(cutoff)
    target = F.floor(F.lit(c) * F.col("_n"))
    k = (F.when(F.col(split_col) == TRAIN, F.greatest(F.col("_ntrain") - target, F.lit(0)))
         .when(F.col(split_col) == TEST, F.greatest(target - F.col("_ntrain"), F.lit(0)))
         .otherwise(F.lit(0)))
    d = df.withColumn("_skey", sampling_key(name_col, seed))
    out = _flag_first(d, label_col, split_col, ["_skey", name_col], k, "_move", strategy)
    if skip_existing_at_destination:
        both = (df.select(label_col, name_col, split_col).groupBy(label_col, name_col)
                .agg(F.countDistinct(split_col).alias("_ns")).where(F.col("_ns") > 1)
                .select(F.col(label_col).alias("_dl"), F.col(name_col).alias("_dn")))
        both = sized(both)[0].withColumn("_dup", F.lit(True))
        cond = out[label_col].eqNullSafe(both["_dl"]) & (out[name_col] == both["_dn"])
        out = (out.join(both, cond, "left")
               .withColumn("_move", F.col("_move") & F.col("_dup").isNull())
               .drop("_dl", "_dn", "_dup"))
    flipped = F.when(F.col(split_col) == TRAIN, F.lit(TEST)).otherwise(F.lit(TRAIN))
    return (out.withColumn(split_col, F.when(F.col("_move"), flipped).otherwise(F.col(split_col)))
            .drop("_move", "_skey"))


def chained_rebalance(df: DataFrame, cutoffs: Sequence[float], seed: int | str = 1, label_col: str = "label_name",
                      name_col: str = "file_name", split_col: str = "split", strategy: str = "auto") -> DataFrame:
    """``df`` (narrow) with a column ``split_<i>`` per cutoff, each the assignment after ``rebalance`` to it from
    the one before, and ``split_col`` set to the last.  One ranking serves all cutoffs.

    A step moves the first k rows of a split in sampling-key order, so afterwards the first
    b rows of the class are all in one split and the rest is as before: a class's state is a list of
    uniform rank intervals, then a tail as it was at first.  In the tail the j-th row of a split
    is k rows on once j counts what earlier steps moved, and that is known from the class's row
    counts alone.  So the boundary ranks of all steps are looked up in one aggregate over the
    ranked rows, and the intervals are worked out per class.  Names are unique in a class and split.

    Rows in neither split keep their value and are not ranked."""
    ranked = F.coalesce(F.col(split_col).isin(TRAIN, TEST), F.lit(False))
    is_train = F.coalesce(F.col(split_col) == TRAIN, F.lit(False))
    counts = [F.count(F.lit(1)).alias("_n"), F.count_if(is_train).alias("_ntrain"), F.count_if(ranked).alias("_m")]
    # rows in neither split come last and never count
    d = df.withColumn("_skey", F.when(ranked, sampling_key(name_col, seed))).withColumn("_other", ~ranked)
    order = ["_other", "_skey", name_col, split_col]
    small = is_small(df)
    if strategy == "window" or (strategy == "auto" and small):
        of_class = Window.partitionBy(label_col)
        by_key = of_class.orderBy(*order)
        before = F.count_if(is_train).over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        d = d.withColumn("_rank", F.row_number().over(by_key)).withColumn("_own", before)
        d = d.withColumn("_own", F.when(is_train, F.col("_own")).otherwise(F.col("_rank") - F.col("_own")))
        d = durable(d.select("*", F.count(F.lit(1)).over(of_class).alias("_n"), F.count_if(is_train).over(of_class).alias("_ntrain"),
                             F.count_if(ranked).over(of_class).alias("_m")).drop("_skey"))
        counted = d
    else:
        d = row_positions(d, [label_col], order, "_rank", strategy)
        d = durable(row_positions(d, [label_col, split_col], ["_skey", name_col], "_own", strategy).drop("_skey"))
        of_class = looked_up(d.groupBy(label_col).agg(*counts).withColumnRenamed(label_col, "_lbl"))
        counted = d.join(of_class, d[label_col].eqNullSafe(of_class["_lbl"])).drop("_lbl")

    # per class the rank of each step's last row, if that lies in the tail
    steps = _steps(cutoffs)
    ends = [F.max(F.when(~F.col("_other") & (up != is_train) & (F.col("_own") == j), F.col("_rank"))).cast("long").alias(f"_e{i}")
            for i, (up, _, j) in enumerate(steps)]
    state = counted.groupBy(F.col(label_col).alias("_lbl")).agg(*[F.max(c).alias(c) for c in ("_n", "_ntrain", "_m")], *ends)
    segments = F.array().cast("array<struct<a:bigint,b:bigint,up:boolean>>")
    for i, (up, moved, _) in enumerate(steps):
        segments = _after_step(segments, up, moved, F.coalesce(F.col(f"_e{i}"), F.col("_m")))
        state = state.withColumn(f"_s{i}", segments)
        segments = F.col(f"_s{i}")
    state = state.select("_lbl", *[f"_s{i}" for i in range(len(steps))])
    state = F.broadcast(state) if small else looked_up(state)

    out = d.join(state, d[label_col].eqNullSafe(state["_lbl"]), "left")
    at = F.col("_rank")
    for i in range(len(steps)):
        up = F.get(F.filter(F.col(f"_s{i}"), lambda s: (s["a"] < at) & (at <= s["b"])), F.lit(0))["up"]
        new = F.when(~F.col("_other") & up, F.lit(TRAIN)).when(~F.col("_other") & ~up, F.lit(TEST)).otherwise(F.col(split_col))
        out = out.withColumn(f"split_{i}", new)
    if steps:
        out = out.withColumn(split_col, F.col(f"split_{len(steps) - 1}"))
    return out.select(*df.columns, *[f"split_{i}" for i in range(len(steps))])


def _steps(cutoffs: Sequence[float]) -> list[tuple[Column, Column, Column]]:
    """Per cutoff from the class's counts (``_n`` rows, ``_ntrain`` train rows, ``_m`` rows in either split): whether rows
    become train, how many move, and which row of their split, counted as at first, is the last where it lies in the tail."""
    out, now = [], F.col("_ntrain")
    for c in cutoffs:
        target = F.floor(F.lit(resolve_cutoff(c)) * F.col("_n")).cast("long")
        out.append((target > now, F.abs(target - now), F.abs(target - F.col("_ntrain"))))
        now = F.least(target, F.col("_m"))  # beyond the rows of both splits: all of them
    return out


def _after_step(segments: Column, up: Column, moved: Column, tail_end: Column) -> Column:
    """Uniform rank intervals (a, b] after the first ``moved`` rows of the losing split have moved: those up to the
    boundary become one.  The boundary lies in an interval of the losing split or, if they hold too few rows, in the tail."""
    start = F.struct(moved.cast("long").alias("left"), F.lit(None).cast("long").alias("at"))

    def walk(acc: Column, s: Column) -> Column:
        size = s["b"] - s["a"]
        here = (s["up"] != up) & acc["at"].isNull()
        ends = here & (acc["left"] <= size)
        return F.struct(F.when(here & ~ends, acc["left"] - size).otherwise(acc["left"]).alias("left"),
                        F.when(ends, s["a"] + acc["left"]).otherwise(acc["at"]).alias("at"))

    end = F.coalesce(F.aggregate(segments, start, walk)["at"], tail_end)
    first = F.array(F.struct(F.lit(0).cast("long").alias("a"), end.alias("b"), up.alias("up")))
    rest = F.transform(F.filter(segments, lambda s: s["b"] > end),
                       lambda s: F.struct(F.greatest(s["a"], end).alias("a"), s["b"].alias("b"), s["up"].alias("up")))
    return F.when(moved == 0, segments).otherwise(F.concat(first, rest))


def sample_per_class(df: DataFrame, k: int, seed: int | str = 1, label_col: str = "label_name",
                     name_col: str = "file_name", strategy: str = "auto") -> DataFrame:
    """Up to ``k`` rows per class without replacement (sampling-key order)."""
    d = df.withColumn("_skey", sampling_key(name_col, seed))
    out = flag_first_k(d, [label_col], ["_skey", name_col], F.lit(int(k)), "_take", strategy)
    return out.where(F.col("_take")).drop("_take", "_skey")


def systematic_sample(df: DataFrame, k: int, partition_by: Sequence[str] = ("label_name", "split"),
                      order_by: Sequence[str] = ("file_name",), strategy: str = "auto") -> DataFrame:
    """Every ``k``-th row (positions 1, k+1, 2k+1, ...) per group in ``order_by`` order.

    Positions are computed on the key columns only; when ``df`` carries more
    (vectors, bytes) the chosen keys are semi-joined back -- broadcast when their
    stored copy counts as small -- so wide rows are not ranked or checkpointed.
    The order keys must be unique within a group (file names are)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    keys = [*partition_by, *[c for c in order_by if c not in partition_by]]
    narrow = df.select(*keys)
    chosen = (row_positions(narrow, list(partition_by), list(order_by), "_pos", strategy)
              .where((F.col("_pos") - 1) % F.lit(int(k)) == 0).drop("_pos"))
    if set(df.columns) == set(keys):
        return chosen.select(*df.columns)
    sel = chosen.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(keys)])
    sel = F.broadcast(sel) if is_small(df) else sized(sel)[0]
    cond = None
    for i, c in enumerate(keys):
        e = df[c].eqNullSafe(sel[f"_s{i}"])
        cond = e if cond is None else cond & e
    return df.join(sel, cond, "left_semi")
