"""Many linear SVM problems over one table, fitted and scored together.

A row takes part in a problem with a sign (+1: positive class, -1: the others).  ``tags``
holds the problems of a row, so one pass over the vectors serves all problems:

* all margins of a row are one matrix-vector product on the JVM (the transform of a
  Spark ML model whose coefficient rows are the problems' weights);
* hinge losses and gradients of all problems are one aggregate: rows within the margin
  are summed per (problem, sign) by ``Summarizer``, partially on the map side.

What reaches the driver is one gradient per problem and step (problems x dimension), as
in Spark ML's own solvers; the rows stay on the executors and no Python worker runs.

Solvers, both for mean hinge loss + reg / 2 * |w|^2 without intercept:

* ``bundle`` (default): cutting planes.  Every aggregate gives a plane below the loss; the next
  weights minimise the regularised maximum of all planes, which also bounds how far the
  best weights so far are from the optimum.  It stops at a gap of ``tolerance``.
* ``sgd``: full-batch subgradient steps of size step / sqrt(t), as MLlib's ``SVMWithSGD`` takes
  them with all rows in each step, including its rule to stop.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.stat import Summarizer
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisort.functions.vectors import to_ml_vector
from lumisort.operators.models import LinearModel
from lumisort.operators.problems import MATCHES

log = logging.getLogger(__name__)

MANY_SOLVERS = ("bundle", "sgd")
#: Problems per aggregate: twice as many groups, below the number at which Spark sorts instead of hashing.
BLOCK = 60


@dataclass(frozen=True)
class Problem:
    """``class1`` against ``class0`` (None: all others)."""
    class1: str
    class0: str | None = None


def problem_tags(problems: Sequence[Problem], match: str = "exact", label_col: str = "label_name",
                 name_col: str = "file_name", first: int = 0) -> Column:
    """array<struct<p, s>>: the problems a row takes part in (numbers from ``first``) and its sign there.

    As in ``select_problem``, one-vs-one rows are chosen by class even if signs follow the names."""
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    label, name = F.col(label_col), F.col(name_col)

    def tag(i: int, q: Problem) -> Column:
        hit = name.startswith(q.class1) if match == "prefix" else label == F.lit(q.class1)
        t = F.struct(F.lit(first + i).alias("p"), F.when(hit, F.lit(1)).otherwise(F.lit(-1)).alias("s"))
        return t if q.class0 is None else F.when(label.isin(q.class1, q.class0), t)

    return F.filter(F.array(*[tag(i, q) for i, q in enumerate(problems)]), lambda t: t.isNotNull())


def tag_rows(df: DataFrame, tags: Column, features_col: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """(x vector, tags, kept columns) of the rows that have a vector and a problem."""
    usable = F.col(features_col).isNotNull() & (F.size(features_col) > 0)
    return (df.where(usable).select(to_ml_vector(features_col).alias("x"), tags.alias("tags"), *keep)
            .where(F.size("tags") > 0))


def with_margins(data: DataFrame, weights: np.ndarray, out_col: str = "margins") -> DataFrame:
    """``data`` (vector column ``x``) with the margins of all problems (rows of ``weights``) as an array."""
    k, d = weights.shape
    rows = np.vstack([weights, np.zeros((1, d))]) if k < 2 else weights  # a model has two rows at least
    sc = data.sparkSession.sparkContext
    java = JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", "margins",
        _py2java(sc, DenseMatrix(len(rows), d, rows.ravel(order="F").tolist())),
        _py2java(sc, Vectors.dense([0.0] * len(rows))), len(rows), True)
    model = (LogisticRegressionModel(java).setFeaturesCol("x").setRawPredictionCol("_raw")
             .setProbabilityCol("").setPredictionCol(""))
    return model.transform(data).withColumn(out_col, vector_to_array("_raw")).drop("_raw")


def hinge_step(data: DataFrame, weights: np.ndarray, only: Sequence[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows of hinge loss and of its subgradient, per problem: one aggregate a block of problems.
    ``only``: numbers of the problems that are asked (default: all)."""
    k, d = weights.shape
    loss, grad = np.zeros(k), np.zeros((k, d))
    for b in range(0, k, BLOCK):
        asked = [p for p in (range(k) if only is None else only) if b <= p < b + BLOCK]
        if not asked:
            continue
        some = weights[b:b + BLOCK]
        # numbers only: this text is the same for every step over the same problems
        mine = f"t.p >= {b} and t.p < {b + len(some)}" if len(asked) == len(some) else f"t.p in ({', '.join(map(str, asked))})"
        active = (with_margins(data, some)
                  .selectExpr("x", "margins", f"explode(filter(tags, t -> {mine} and t.s * margins[t.p - {b}] < 1)) as t")
                  .selectExpr("x", "t.p as p", "t.s as s", f"1 - t.s * margins[t.p - {b}] as loss"))
        for r in active.groupBy("p", "s").agg(Summarizer.sum(F.col("x")).alias("x"), F.sum("loss").alias("loss")).collect():
            loss[r["p"]] += r["loss"]
            grad[r["p"]] -= r["s"] * r["x"].toArray()
    return loss, grad


def problem_sizes(data: DataFrame, k: int) -> tuple[np.ndarray, int]:
    """Rows per problem and sign (column 0 negative, column 1 positive) and the length of the vectors."""
    out, d = np.zeros((k, 2), np.int64), 0
    rows = data.select(F.explode("tags").alias("t"), F.size(vector_to_array("x")).alias("d"))
    for r in rows.groupBy("t.p", "t.s").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).collect():
        out[r["p"], int(r["s"] > 0)] = r["n"]
        d = max(d, r["d"])
    return out, d


def _simplex_qp(gram: np.ndarray, linear: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The ``a`` >= 0 with sum 1 that maximises linear . a - a . gram . a / 2, by active sets from the feasible ``a``."""
    # strictly convex, so that a plane that enters gains weight; any feasible ``a`` gives a valid bound
    gram = gram + 1e-12 * max(gram.diagonal().max(), 1e-300) * np.eye(len(gram))
    a, support = a.copy(), list(np.flatnonzero(a > 0))
    for _ in range(50 + 10 * len(a)):
        n = len(support)
        kkt = np.ones((n + 1, n + 1))
        kkt[:n, :n], kkt[n, n] = gram[np.ix_(support, support)], 0.0
        best = np.linalg.lstsq(kkt, np.append(linear[support], 1.0), rcond=None)[0]
        now, aim = a[support], best[:n]
        if (aim < -1e-13).any():  # as far as all stay positive; the first to reach zero leaves
            falls = aim < -1e-13
            part = np.min(now[falls] / (now[falls] - aim[falls]))
            a[support] = np.maximum(now + part * (aim - now), 0)
            gone = support[int(np.argmin(np.where(falls, now / np.where(falls, now - aim, 1), np.inf)))]
            a[gone] = 0.0
            support.remove(gone)
            continue
        a[support] = np.maximum(aim, 0)
        a /= a.sum()
        slope = linear - gram @ a
        i = int(np.argmax(slope))
        if i in support or slope[i] <= slope @ a + 1e-14 * max(1.0, abs(slope[i])):
            break
        support.append(i)
    return a


class _Bundle:
    """Cutting planes of one problem and the weights that minimise them."""

    def __init__(self, d: int, reg: float):
        self.reg, self.planes, self.offsets = reg, np.zeros((0, d)), np.zeros(0)
        self.dual = np.zeros(0)
        self.next, self.best, self.value, self.gap = np.zeros(d), np.zeros(d), np.inf, np.inf

    def add(self, loss: float, grad: np.ndarray) -> None:
        """The loss and a subgradient at ``self.next``."""
        value = loss + self.reg / 2 * self.next @ self.next
        if value < self.value:
            self.value, self.best = value, self.next
        self.planes = np.vstack([self.planes, grad])
        self.offsets = np.append(self.offsets, loss - grad @ self.next)
        self.dual = np.append(self.dual, 0.0 if len(self.dual) else 1.0)
        gram = self.planes @ self.planes.T / self.reg
        self.dual = _simplex_qp(gram, self.offsets, self.dual)
        self.next = -self.planes.T @ self.dual / self.reg
        self.gap = self.value - (self.offsets @ self.dual - self.reg / 2 * self.next @ self.next)


def train_many(data: DataFrame, k: int, iterations: int = 100, reg: float = 0.1, solver: str = "bundle",
               step: float = 1.0, tolerance: float | None = None,
               persist: bool = True) -> tuple[list[LinearModel | None], np.ndarray]:
    """Models of the ``k`` problems of ``data`` (``tag_rows`` of the train rows) and their row counts
    (``problem_sizes``).  A problem whose rows have one sign has no model.  ``tolerance``: gap to the optimum
    (``bundle``, 1e-9) or relative length of the last step (``sgd``, 0.001).  ``persist``: False where
    the caller keeps ``data`` already."""
    if solver not in MANY_SOLVERS:
        raise ValueError(f"solver must be one of {MANY_SOLVERS}")
    data = data.persist(StorageLevel.MEMORY_AND_DISK) if persist else data
    try:
        sizes, d = problem_sizes(data, k)
        open_ = np.flatnonzero((sizes > 0).all(axis=1))
        models: list[LinearModel | None] = [None] * k
        if not len(open_):
            return models, sizes
        fit = _fit_bundle if solver == "bundle" else _fit_sgd
        weights = fit(data, k, d, open_, sizes.sum(axis=1), iterations, reg, step, tolerance)
        for p in open_:
            models[p] = LinearModel(weights[p].tolist(), 0.0, "svm")
        return models, sizes
    finally:
        if persist:
            data.unpersist()


def _fit_bundle(data, k, d, open_, n, iterations, reg, step, tolerance) -> np.ndarray:
    bundles = {int(p): _Bundle(d, reg) for p in open_}
    left, w = list(bundles), np.zeros((k, d))
    for _ in range(iterations):
        loss, grad = hinge_step(data, w, left)
        for p in left:
            bundles[p].add(loss[p] / n[p], grad[p] / n[p])
            w[p] = bundles[p].next
        left = [p for p in left if bundles[p].gap > (1e-9 if tolerance is None else tolerance)]
        if not left:
            break
    else:
        log.warning("%d of %d problems ended after %d planes, the widest gap to the optimum %.2g", len(left), len(bundles),
                    iterations, max(bundles[p].gap for p in left))
    for p, b in bundles.items():
        w[p] = b.best
    return w


def _fit_sgd(data, k, d, open_, n, iterations, reg, step, tolerance) -> np.ndarray:
    w = np.zeros((k, d))
    left = [int(p) for p in open_]
    for t in range(1, iterations + 1):
        _, grad = hinge_step(data, w, left)
        size, done = step / np.sqrt(t), []
        for p in left:
            new = w[p] * (1 - size * reg) - size * grad[p] / n[p]
            if t > 1 and np.linalg.norm(new - w[p]) < (0.001 if tolerance is None else tolerance) * max(np.linalg.norm(new), 1):
                done.append(p)
            w[p] = new
        left = [p for p in left if p not in done]
        if not left:
            break
    return w


def weight_rows(models: Sequence[LinearModel | None]) -> np.ndarray:
    """The models' weights as rows; zeros where there is none."""
    d = max((len(m.weights) for m in models if m), default=1)
    return np.array([m.weights if m else [0.0] * d for m in models], float).reshape(len(models), d)


def score_many(data: DataFrame, models: Sequence[LinearModel | None]) -> DataFrame:
    """Per problem p of ``data`` (``tag_rows`` of the test rows): n_test, tp, tn.  Vectors of another length than the
    models' count as rows without a prediction."""
    w = weight_rows(models)
    fits = F.size(vector_to_array("x")) == w.shape[1]
    scored = with_margins(data.where(fits), w).select(F.explode("tags").alias("t"), "margins")
    hit = F.get("margins", F.col("t.p")) > 0
    part = scored.select("t.p", ((F.col("t.s") > 0) & hit).cast("double").alias("tp"),
                         ((F.col("t.s") < 0) & ~hit).cast("double").alias("tn"))
    return part.groupBy("p").agg(F.count(F.lit(1)).alias("n_test"), F.sum("tp").alias("tp"), F.sum("tn").alias("tn"))


def argmax_class(margins: Column, classes: Sequence[str]) -> Column:
    """The class with the largest margin, the first of equal ones; null where there are no margins."""
    best = F.array_position(margins, F.array_max(margins)).cast("int")
    return F.get(F.array(*[F.lit(c) for c in classes]), best - 1)


@dataclass
class OneVsRest:
    """One linear model per class; a row belongs to the class with the largest margin."""
    classes: list[str]
    weights: np.ndarray

    def predict(self, df: DataFrame, features_col: str = "features", keep_margins: bool = False) -> DataFrame:
        """``df`` with ``prediction`` (class name, null for missing vectors and those of another length)."""
        d = self.weights.shape[1]
        feats = F.col(features_col).cast("array<double>")
        usable = F.coalesce(F.size(feats) == d, F.lit(False))
        x = to_ml_vector(F.when(usable, feats).otherwise(F.array_repeat(F.lit(0.0), d)))
        out = with_margins(df.withColumn("x", x).withColumn("_usable", usable), self.weights, "margins")
        margins = F.when(F.col("_usable"), F.slice("margins", 1, len(self.classes)))
        out = out.withColumn("margins", margins).withColumn("prediction", argmax_class(F.col("margins"), self.classes))
        return out.drop("x", "_usable") if keep_margins else out.drop("x", "_usable", "margins")


def train_one_vs_rest(train: DataFrame, classes: Sequence[str] | None = None, iterations: int = 100, reg: float = 0.1,
                      solver: str = "bundle", match: str = "exact", label_col: str = "label_name",
                      name_col: str = "file_name", features_col: str = "features") -> OneVsRest:
    """One-vs-rest SVMs of all classes at once.  ``classes``: in order (default: those of the train rows, sorted); those
    without train rows are left out.  With one class only, that class is the prediction."""
    if classes is None:
        classes = sorted(r[0] for r in train.where(F.col(label_col).isNotNull()).select(label_col).distinct().collect())
    classes = list(classes)
    if not classes:
        raise ValueError("no classes to train")
    data = tag_rows(train, problem_tags([Problem(c) for c in classes], match, label_col, name_col), features_col)
    models, sizes = train_many(data, len(classes), iterations, reg, solver)
    seen = [i for i in range(len(classes)) if sizes[i, 1]]
    if not seen:
        raise ValueError("no train rows of these classes")
    if not any(models):  # one class: there is nothing to tell it from
        return OneVsRest([classes[i] for i in seen], np.zeros((len(seen), data.select(F.size(vector_to_array("x"))).first()[0])))
    return OneVsRest([classes[i] for i in seen], weight_rows([models[i] for i in seen]))
