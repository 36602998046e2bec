"""Train one binary problem on the train split and score it on the test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisort.operators.joins import resolve_split
from lumisort.operators.models import LinearModel, predict, train_logreg, train_svm
from lumisort.operators.problems import resolve_mode, select_problem

MODEL_KINDS = ("svm", "logreg")


def resolve_samples(df: DataFrame, split_col: str = "split", key: str = "file_name",
                    valid_col: str | None = None) -> DataFrame:
    """A name in both splits counts as train only (before any vector is dropped).  ``valid_col`` (the ``readable``
    flag of ``read_feature_json``): a train copy that could not be read is dropped and leaves the name to test."""
    return resolve_split(df.where(F.col(split_col) == "train"), df.where(F.col(split_col) == "test"), key,
                         split_col, valid_col).select(*df.columns)


def fit(train: DataFrame, model: str = "svm", solver: str = "bundle", iterations: int = 100,
        reg: float | None = None) -> LinearModel:
    """Fit on the labelled rows of one problem."""
    if model not in MODEL_KINDS:
        raise ValueError(f"model must be one of {MODEL_KINDS}")
    if model == "svm":
        return train_svm(train, iterations, 0.1 if reg is None else reg, solver)
    return train_logreg(train, iterations, 0.01 if reg is None else reg)


def evaluate(df: DataFrame, class1: str, class0: str | None = None, mode: str = "ova", model: str = "svm",
             match: str = "exact", solver: str = "bundle", iterations: int = 100, reg: float | None = None,
             split_col: str = "split", resolve: bool = True, sides: tuple[int, int] | None = None,
             valid_col: str | None = None) -> tuple[DataFrame, LinearModel | None]:
    """One row: class1, class0, mode, model, n_train, n_test, tp, tn, accuracy
    (percent), note.  Names in both splits are trained on only (``resolve``), unless ``valid_col`` says that the
    train copy could not be read.  A train
    set of one class cannot be fitted: NULL tp, tn and accuracy, a note, no model.
    ``sides``: positive and negative train rows, where the caller has counted them."""
    m_mode = resolve_mode(mode)
    if model not in MODEL_KINDS:
        raise ValueError(f"model must be one of {MODEL_KINDS}")
    prob = select_problem(resolve_samples(df, split_col, valid_col=valid_col) if resolve else df, class1, class0, m_mode, match)
    train, test = (prob.where(F.col(split_col) == x) for x in ("train", "test"))
    if sides is None:
        sides = tuple(train.agg(F.count_if(F.col("label") == 1.0), F.count_if(F.col("label") != 1.0)).first())
    pos, neg = sides
    head = [F.lit(class1).alias("class1"), F.lit(class0 if m_mode == "ovo" else "all").alias("class0"),
            F.lit(m_mode).alias("mode"), F.lit(model).alias("model"),
            F.lit(int(pos + neg)).cast("long").alias("n_train")]
    if not pos or not neg:
        null = F.lit(None).cast("double")
        row = test.agg(F.count(F.lit(1)).alias("n_test")).select(
            *head, "n_test", null.alias("tp"), null.alias("tn"), null.alias("accuracy"),
            F.lit("train set has one class").alias("note"))
        return row, None
    m = fit(train, model, solver, iterations, reg)
    y, p = F.col("label").cast("double"), F.col("prediction")
    row = predict(m, test).agg(F.count(F.lit(1)).alias("n_test"), F.coalesce(F.sum(y * p), F.lit(0.0)).alias("tp"),
                               F.coalesce(F.sum((1 - y) * (1 - p)), F.lit(0.0)).alias("tn"))
    accuracy = F.lit(100.0) * (F.col("tp") + F.col("tn")) / F.nullif(F.col("n_test"), F.lit(0))
    return row.select(*head, "n_test", "tp", "tn", accuracy.alias("accuracy"),
                      F.lit(None).cast("string").alias("note")), m


__all__ = ["evaluate", "fit", "resolve_samples"]
