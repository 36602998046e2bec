"""Linear SVM and logistic regression with Spark ML, plus model I/O.

``train_svm`` minimises the reference's objective (hinge loss + L2, no
intercept, no scaling): by default with cutting planes (``operators.many``: one aggregate
per step, and a bound on the distance from the optimum), with ``LinearSVC`` (``solver='owlqn'``),
or with the reference's full-batch descent (``solver='sgd'``, the steps of MLlib's
``SVMWithSGD``).  All return a model wrapped as ``LinearModel`` so prediction, scoring and persistence are the same
DataFrame code.  A ``ModelBundle`` holds a model with the names of its classes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort.functions.naming import prediction_to_class
from lumisort.functions.vectors import linear_margin, svm_prediction, to_ml_vector

SOLVERS = ("bundle", "owlqn", "sgd")


@dataclass
class LinearModel:
    """Weights of a linear classifier; ``kind`` is 'svm' or 'logreg'."""
    weights: list[float]
    intercept: float = 0.0
    kind: str = "svm"
    threshold: float = 0.0
    ml_model: object = field(default=None, repr=False)

    def margin(self, features_col: str = "features"):
        return linear_margin(F.col(features_col), self.weights, self.intercept)


def _ml_input(df: DataFrame, features_col: str, label_col: str) -> DataFrame:
    return df.select(F.col(label_col).cast("double").alias("label"), to_ml_vector(features_col).alias("features"))


def train_svm(df: DataFrame, iterations: int = 100, reg: float = 0.1, solver: str = "bundle",
              features_col: str = "features", label_col: str = "label", step: float = 1.0) -> LinearModel:
    """Hinge-loss linear SVM with L2 regularisation, no intercept, no scaling."""
    if solver not in SOLVERS:
        raise ValueError(f"solver must be one of {SOLVERS}")
    data = _ml_input(df, features_col, label_col)
    if solver == "owlqn":
        est = LinearSVC(maxIter=iterations, regParam=reg, fitIntercept=False, standardization=False)
        m = est.fit(data)
        return LinearModel(m.coefficients.toArray().tolist(), float(m.intercept), "svm", 0.0, m)
    from lumisort.operators.many import train_many
    sign = F.when(F.col(label_col) == 1.0, F.lit(1)).otherwise(F.lit(-1))
    tags = F.array(F.struct(F.lit(0).alias("p"), sign.alias("s")))
    models, sizes = train_many(df.select(to_ml_vector(features_col).alias("x"), tags.alias("tags")), 1, iterations, reg,
                               solver, step)
    m = models[0]
    if m is None:
        raise ValueError(f"train rows of both classes are needed, got {sizes[0].tolist()}")
    if solver == "bundle":
        m.ml_model = _svc_model(df.sparkSession, m.weights)
    return m


def _svc_model(spark: SparkSession, weights: list[float]) -> LinearSVCModel:
    """The Spark ML model of these weights: its transform runs on the JVM and it is saved like a fitted one."""
    sc = spark.sparkContext
    java = JavaWrapper._new_java_obj("org.apache.spark.ml.classification.LinearSVCModel", "linearsvc-bundle",
                                     _py2java(sc, Vectors.dense(weights)), 0.0)
    return LinearSVCModel(java)


def train_logreg(df: DataFrame, iterations: int = 100, reg: float = 0.01, features_col: str = "features",
                 label_col: str = "label") -> LinearModel:
    """Logistic regression (intercept and standardisation on, threshold 0.5)."""
    m = LogisticRegression(maxIter=iterations, regParam=reg).fit(_ml_input(df, features_col, label_col))
    return LinearModel(m.coefficients.toArray().tolist(), float(m.intercept), "logreg", 0.0, m)


ENGINES = ("auto", "ml", "sql")


def predict(model: LinearModel, df: DataFrame, features_col: str = "features", engine: str = "auto") -> DataFrame:
    """Add ``margin`` and ``prediction`` (1.0 when the margin is above 0); for
    logistic regression also ``probability`` of class 1.  The label stays on
    the row, so truth and prediction are aligned by row, never by position.

    ``engine``: ``ml`` runs the fitted Spark ML model's own transform (a JVM dot
    product, several times faster than SQL lambdas on wide vectors); ``sql``
    computes ``w . x + b`` with SQL array functions (works for any weights,
    e.g. an MLlib SGD model or fixed weights); ``auto`` takes ``ml`` when the
    model has one.  NULL vectors and vectors of another length give NULL margin and
    prediction either way."""
    if engine not in ENGINES:
        raise ValueError(f"engine must be one of {ENGINES}")
    has_ml = isinstance(model.ml_model, (LinearSVCModel, LogisticRegressionModel))
    if engine == "ml" and not has_ml:
        raise ValueError("this model has no Spark ML transform; use engine='sql'")
    if engine == "sql" or (engine == "auto" and not has_ml):
        m = model.margin(features_col)
        out = df.withColumn("margin", m).withColumn("prediction", svm_prediction(F.col("margin"), model.threshold))
        if model.kind == "logreg":
            out = out.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))))
        return out
    dim = len(model.weights)
    feats = F.col(features_col).cast("array<double>")
    # a vector of another length is as unusable as a missing one
    usable = F.coalesce(F.size(feats) == dim, F.lit(False))
    x = df.withColumn("_vec", to_ml_vector(F.when(usable, feats).otherwise(F.array_repeat(F.lit(0.0), dim))))
    mm = model.ml_model.copy()
    mm.setFeaturesCol("_vec").setPredictionCol("_pred").setRawPredictionCol("_raw")
    if isinstance(mm, LogisticRegressionModel):
        mm.setProbabilityCol("_prob")
    out = mm.transform(x)
    missing = ~usable
    null = F.lit(None).cast("double")
    out = (out.withColumn("margin", F.when(missing, null).otherwise(vector_to_array("_raw")[1]))
           .withColumn("prediction", F.when(missing, null).otherwise(F.col("_pred"))))
    if isinstance(mm, LogisticRegressionModel):
        out = out.withColumn("probability", F.when(missing, null).otherwise(vector_to_array("_prob")[1]))
    return out.drop("_vec", "_raw", "_pred", "_prob")


def save_model(model: LinearModel, path: str, if_absent: bool = True) -> bool:
    """Save a model; with ``if_absent`` an existing model is kept. Returns True if written."""
    if if_absent and _exists(path):
        return False
    m = model.ml_model
    if isinstance(m, (LinearSVCModel, LogisticRegressionModel)):
        (m.write() if if_absent else m.write().overwrite()).save(path)
    else:
        from pyspark.mllib.classification import SVMModel
        from pyspark.mllib.linalg import Vectors as MLlibVectors
        sc = SparkSession.getActiveSession().sparkContext
        mm = m if m is not None else SVMModel(MLlibVectors.dense(model.weights), model.intercept)
        mm.save(sc, path)
    return True


def load_model(path: str, kind: str = "svm") -> LinearModel:
    """Load a model saved by ``save_model`` (kind: 'svm', 'logreg' or 'svm_sgd')."""
    if kind == "logreg":
        m = LogisticRegressionModel.load(path)
        return LinearModel(m.coefficients.toArray().tolist(), float(m.intercept), "logreg", 0.0, m)
    if kind == "svm_sgd":
        from pyspark.mllib.classification import SVMModel
        sc = SparkSession.getActiveSession().sparkContext
        m = SVMModel.load(sc, path)
        return LinearModel(m.weights.toArray().tolist(), float(m.intercept), "svm", 0.0, m)
    m = LinearSVCModel.load(path)
    return LinearModel(m.coefficients.toArray().tolist(), float(m.intercept), "svm", 0.0, m)


@dataclass
class ModelBundle:
    """All that scoring needs: a row of weights per model, the class names and how to read them.

    ``mode`` 'ovo': one model, ``classes`` = (class for 0, class for 1).  'ova': one model, the class for 0 is
    'all'.  'ovr': one model per class, the largest margin wins."""
    classes: list[str]
    weights: list[list[float]]
    intercepts: list[float]
    mode: str = "ovo"
    kind: str = "svm"

    @property
    def dimension(self) -> int:
        return len(self.weights[0])

    @classmethod
    def of(cls, model, classes=None, mode: str = "ovo") -> "ModelBundle":
        """From a ``LinearModel`` with its two class names, or from a ``OneVsRest``."""
        if isinstance(model, LinearModel):
            if classes is None or len(classes) != 2:
                raise ValueError("a binary model needs the names of class 0 and class 1")
            return cls(list(classes), [list(model.weights)], [model.intercept], mode, model.kind)
        return cls(list(model.classes), model.weights.tolist(), [0.0] * len(model.classes), "ovr")

    def predict(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        """``df`` with ``margin`` (of the predicted class for 'ovr') and ``predicted_class``; both null for missing
        vectors and those of another length."""
        from lumisort.operators.many import OneVsRest, argmax_class
        if self.mode == "ovr":
            import numpy as np
            out = OneVsRest(self.classes, np.array(self.weights)).predict(df, features_col, keep_margins=True)
            return (out.withColumn("margin", F.array_max("margins"))
                    .withColumn("predicted_class", argmax_class(F.col("margins"), self.classes)).drop("margins", "prediction"))
        model = LinearModel(self.weights[0], self.intercepts[0], self.kind)
        out = predict(model, df.drop("prediction", "margin"), features_col, engine="sql")
        return out.withColumn("predicted_class", prediction_to_class("prediction", *self.classes)).drop("prediction", "probability")

    def save(self, spark: SparkSession, path: str, if_absent: bool = True) -> bool:
        """One JSON row.  With ``if_absent`` an existing bundle is kept.  Returns True if written."""
        if if_absent and _exists(path):
            return False
        row = (self.mode, self.kind, self.classes, self.dimension, [[float(x) for x in w] for w in self.weights],
               [float(x) for x in self.intercepts])
        spark.createDataFrame([row], BUNDLE_SCHEMA).coalesce(1).write.mode("overwrite").json(path)
        return True

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ModelBundle":
        r = spark.read.schema(BUNDLE_SCHEMA).json(path).first()
        if r is None or r["classes"] is None or any(len(w) != r["dimension"] for w in r["weights"]):
            raise ValueError(f"{path} holds no model bundle")
        return cls(list(r["classes"]), [list(w) for w in r["weights"]], list(r["intercepts"]), r["mode"], r["kind"])


BUNDLE_SCHEMA = ("mode string, kind string, classes array<string>, dimension int, weights array<array<double>>, "
                 "intercepts array<double>")


def _exists(path: str) -> bool:
    sc = SparkSession.getActiveSession().sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p))
