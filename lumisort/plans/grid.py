"""The reference's simulation grid: cutoffs x class pairs, one fit per point.

Per cutoff the assignment is rebalanced *from the previous cutoff's
assignment* (the reference moves files and never resets them).  The chain runs on a
stored narrow table (class, name, split); its split columns are attached to the
vectors in one join.  The vector table is persisted or staged once for the whole
grid.  The SVMs of all points are fitted together: a row carries the problems it belongs
to, and one aggregate per step gives the gradients of all of them.  Other models run one
fit per point from a thread pool.  The grid's results are (cutoffs x pairs) rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import combinations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisort.functions.naming import ratio_label, ratio_text
from lumisort.operators.aggregates import accuracy_pivot
from lumisort.operators.many import MANY_SOLVERS, Problem, problem_tags, score_many, tag_rows, train_many
from lumisort.operators.models import predict
from lumisort.operators.problems import resolve_mode
from lumisort.operators.ranking import row_positions
from lumisort.operators.split import chained_rebalance
from lumisort.plans.evaluate import evaluate, resolve_samples

RESULT_SCHEMA = ("class1 string, class0 string, cutoff double, train_test string, mode string, model string, "
                 "n_train long, n_test long, tp double, tn double, accuracy double, note string")
KEY = ["label_name", "file_name"]


def chained_splits(narrow: DataFrame, cutoffs: Sequence[float], seed: int | str = 1) -> DataFrame:
    """``narrow`` (class, name, split, ...) with a column ``split_<i>`` per cutoff: the
    assignment after rebalancing to it from the one before.  The ranked rows are stored once."""
    return chained_rebalance(narrow, cutoffs, seed)


def run_grid(df: DataFrame, classes: Sequence[str], cutoffs: Sequence[float] = (0.3, 0.6, 0.9),
             mode: str = "ovo", model: str = "svm", parallelism: int = 8, seed: int | str = 1,
             iterations: int = 100, reg: float | None = None,
             match: str = "exact", materialize: bool = False, sample_every: int = 1, solver: str = "bundle") -> DataFrame:
    """Result rows: class1, class0, cutoff, train_test, mode, model, n_train, n_test, tp, tn, accuracy, note.

    ``solver`` 'bundle' or 'sgd' fits the SVMs of all points together, one aggregate over the vectors per
    step (``operators.many``); 'owlqn' and logistic regression run one fit per point, ``parallelism`` at a
    time.  ``sample_every=k`` fits and scores on every k-th file per class and split
    (the notebook's grid uses every 2nd); the rebalance itself always sees all rows.
    ``materialize``: stage the vectors by class in the shared folder instead of
    persisting them (for tables beyond the executors' memory)."""
    classes = list(dict.fromkeys(classes))
    mode = resolve_mode(mode)
    problems = list(combinations(classes, 2)) if mode == "ovo" else [(c, None) for c in classes]
    narrow = resolve_samples(df.select(*KEY, "split"))
    splits = chained_splits(narrow, cutoffs, seed).drop("split").dropDuplicates(KEY)
    for i in range(len(cutoffs)) if sample_every > 1 else ():
        splits = row_positions(splits, ["label_name", f"split_{i}"], ["file_name"], "_pos").withColumn(
            f"split_{i}", F.when((F.col("_pos") - 1) % sample_every == 0, F.col(f"split_{i}"))).drop("_pos")
    rows = resolve_samples(df).drop("split")
    rows = rows.where(F.col("label_name").isin(classes)) if mode == "ovo" else rows
    base = rows.join(splits, KEY)
    if model == "svm" and solver in MANY_SOLVERS:
        return _fit_together(base, problems, cutoffs, mode, match, iterations, reg, solver, materialize)
    return _fit_each(base, problems, cutoffs, mode, model, match, iterations, reg, parallelism, materialize,
                     [c for c in df.columns if c != "split"], sample_every == 1)


def _result(point, cutoff, mode, model, n_train, n_test, tp, tn, note) -> tuple:
    accuracy = 100.0 * (tp + tn) / n_test if note is None and n_test else None
    return (point[0], point[1] or "all", float(cutoff), ratio_text(float(cutoff)), mode, model, int(n_train), int(n_test),
            tp, tn, accuracy, note)


def _fit_together(base: DataFrame, problems, cutoffs, mode, match, iterations, reg, solver, materialize) -> DataFrame:
    """Problem number i * len(problems) + j: pair j at cutoff i.  A row carries its problems as train and as test row."""
    spark = base.sparkSession
    posed = [Problem(*p) for p in problems]

    def tags(split: str):
        return F.concat(*[F.when(F.col(f"split_{i}") == split, problem_tags(posed, match, first=i * len(posed)))
                          .otherwise(F.array().cast("array<struct<p:int,s:int>>")) for i in range(len(cutoffs))])

    if not posed or not len(cutoffs):
        return spark.createDataFrame([], RESULT_SCHEMA)
    both = tag_rows(base.withColumn("_train", tags("train")).withColumn("_test", tags("test")), F.concat("_train", "_test"),
                    keep=("label_name", "_train", "_test"))
    both, cleanup = stage_by_class(both.drop("tags"), materialize)
    try:
        train, test = (both.select("x", F.col(c).alias("tags")).where(F.size("tags") > 0) for c in ("_train", "_test"))
        k = len(posed) * len(cutoffs)
        models, sizes = train_many(train, k, iterations, 0.1 if reg is None else reg, solver, persist=False)
        scored = {r["p"]: r for r in score_many(test, models).collect()}  # one row per point of the grid
    finally:
        cleanup()
    rows = []
    for p in range(k):
        r = scored.get(p)
        n_test, tp, tn = (r["n_test"], r["tp"], r["tn"]) if r else (0, 0.0, 0.0)
        note = None if models[p] else "train set has one class"
        rows.append(_result(problems[p % len(posed)], cutoffs[p // len(posed)], mode, "svm", sizes[p].sum(), n_test,
                            None if note else tp, None if note else tn, note))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def _fit_each(base: DataFrame, problems, cutoffs, mode, model, match, iterations, reg, parallelism, materialize, cols,
              all_rows: bool) -> DataFrame:
    """One fit per point, each in a scheduler pool of its own."""
    spark = base.sparkSession
    base, cleanup = stage_by_class(base, materialize)
    try:
        # train rows per class and cutoff, from one job: which points can be fitted
        usable = F.col("features").isNotNull() & (F.size("features") > 0)
        per_class = {r["label_name"]: r for r in base
                     .groupBy("label_name").agg(*[F.count_if(usable & (F.col(f"split_{i}") == "train")).alias(f"n{i}")
                                                  for i in range(len(cutoffs))]).collect()}

        def sides(i: int, p) -> tuple[int, int] | None:
            if match != "exact" or not all_rows:
                return None
            n = {k: r[f"n{i}"] for k, r in per_class.items()}
            return n.get(p[0], 0), n.get(p[1], 0) if mode == "ovo" else sum(n.values()) - n.get(p[0], 0)

        jobs = []
        for i, c in enumerate(cutoffs):
            state = base.select(*cols, F.col(f"split_{i}").alias("split")).where(F.col("split").isNotNull())
            jobs += [(float(c), state, p, sides(i, p)) for p in problems]

        def run(job):
            cut, data, p, counts = job
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"grid-{cut}-{p[0]}-{p[1]}")
            try:
                r, _ = evaluate(data, p[0], p[1], mode, model, match, "owlqn", iterations, reg, resolve=False,
                                sides=counts)
                return p, cut, r.first()
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            rows = [_result(p, cut, r["mode"], r["model"], r["n_train"], r["n_test"], r["tp"], r["tn"], r["note"])
                    for p, cut, r in ex.map(run, jobs)]
    finally:
        cleanup()
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def stage_by_class(df: DataFrame, materialize: bool = False, label_col: str = "label_name"):
    """The grid reads the vector table once per fit.  ``materialize``: write it
    once to the shared checkpoint folder, partitioned by class -- a one-vs-one
    fit then reads only its two classes' files (partition pruning), rebalancing
    reads only the name columns, and the table survives executor loss.
    Otherwise persist it (memory and disk)."""
    if not materialize:
        d = df.persist(StorageLevel.MEMORY_AND_DISK)
        return d, d.unpersist
    from lumisort.session import remove_scratch, scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "grid-vectors")
    df.hint("rebalance", label_col).write.partitionBy(label_col).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    # the staged copy is the grid's own scratch table: removed once the fits are done
    return back.select(*df.columns), (lambda: remove_scratch(spark, path))


def score_grid(df: DataFrame, model, classes: Sequence[str], cutoffs: Sequence[float] = (0.3, 0.6, 0.9),
               mode: str = "ovo", seed: int | str = 1) -> DataFrame:
    """The grid with a given model (no fitting): per cutoff (chained rebalance)
    and class pair, accuracy of ``model`` on the pair's test rows.

    Every vector is scored once.  The stored narrow table (class, name, split,
    prediction) is rebalanced, counted by class, cutoff and prediction, and those
    few counts are dealt to the (parameter-sized) list of problems."""
    classes = list(dict.fromkeys(classes))
    mode = resolve_mode(mode)
    usable = F.col("features").isNotNull() & (F.size("features") > 0)
    scored = predict(model, df.withColumn("_usable", usable)).select(*KEY, "split", "_usable", "prediction")
    chain = chained_splits(scored, cutoffs, seed)
    states = F.array(*[F.struct(F.lit(float(c)).alias("cutoff"), F.col(f"split_{i}").alias("split"))
                       for i, c in enumerate(cutoffs)])
    counts = (chain.where("_usable").select("label_name", "prediction", F.explode(states).alias("s"))
              .where(F.col("s.split") == "test").groupBy("label_name", "prediction", F.col("s.cutoff").alias("cutoff"))
              .agg(F.count(F.lit(1)).alias("n")))
    # a few counts per class: each takes part in every problem that its class belongs to
    points = list(combinations(classes, 2)) if mode == "ovo" else [(c, "all") for c in classes]
    if not points:
        counts, points = counts.where("false"), [("", "")]
    problem = F.explode(F.array(*[F.struct(F.lit(a).alias("class1"), F.lit(b).alias("class0")) for a, b in points]))
    prob = counts.select("*", problem.alias("p")).select("*", "p.class1", "p.class0")
    if mode == "ovo":
        prob = prob.where((F.col("label_name") == F.col("class1")) | (F.col("label_name") == F.col("class0")))
    prob = prob.withColumn("label", F.when(F.col("label_name") == F.col("class1"), 1.0).otherwise(0.0))
    right = F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))
    acc = prob.groupBy("class1", "class0", "cutoff").agg(
        F.sum("n").alias("n_test"), F.coalesce(F.sum(F.when(right, F.col("n"))), F.lit(0)).alias("n_correct"))
    return (acc.withColumn("accuracy", F.lit(100.0) * F.col("n_correct") / F.col("n_test"))
            .withColumn("train_test", ratio_label(F.col("cutoff"))))


def grid_table(results: DataFrame, cutoffs: Sequence[float] = (0.3, 0.6, 0.9)) -> DataFrame:
    """The pivoted result table (rows class1, class0; one column per ratio)."""
    return accuracy_pivot(results, cutoffs)


__all__ = ["chained_splits", "run_grid", "score_grid", "grid_table", "stage_by_class"]
