"""Counts, set sizes, accuracy and the accuracy pivot.

All are partial (map-side) aggregations: per-class tables have one row per
class, global ones a single row; nothing collects a class into a list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisort.functions.naming import ratio_text
from lumisort.operators.ranking import row_positions


def distinct_labels(df: DataFrame, label_col: str = "label_name", name_col: str = "file_name") -> DataFrame:
    """One row per class with its size and first name (the archive order of the
    reference is not stored; ``first_file`` is the smallest name)."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_files"), F.min(name_col).alias("first_file"))


def names_by_label(df: DataFrame, label_col: str = "label_name", name_col: str = "file_name",
                   strategy: str = "auto") -> DataFrame:
    """The reference's list of lists in long form: (class, name, 1-based position).

    A class is never gathered into one array (it may hold a third of the rows)."""
    return row_positions(df.select(label_col, name_col), [label_col], [name_col], "position", strategy)


def split_counts(df: DataFrame, label_col: str = "label_name", split_col: str = "split") -> DataFrame:
    """Per class: (n_train, n_test) -- correct per class, unlike the reference's
    reuse of the last folder."""
    return df.groupBy(label_col).agg(F.count_if(F.col(split_col) == "train").alias("n_train"),
                                     F.count_if(F.col(split_col) == "test").alias("n_test"))


def set_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Global train/test sizes and the train share in percent."""
    n_train = F.count_if(F.col(split_col) == "train")
    n_test = F.count_if(F.col(split_col) == "test")
    return df.agg(n_train.alias("n_train"), n_test.alias("n_test"), F.count(F.lit(1)).alias("n_total"),
                  (F.lit(100.0) * n_train / F.nullif(n_train + n_test, F.lit(0))).alias("train_pct"))


def tp_tn(df: DataFrame, by: Sequence[str] = (), label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """True positives and true negatives: ``sum(y*p)``, ``sum((1-y)*(1-p))``."""
    y, p = F.col(label_col).cast("double"), F.col(pred_col).cast("double")
    return df.groupBy(*by).agg(F.sum(y * p).alias("tp"), F.sum((1 - y) * (1 - p)).alias("tn"),
                               F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, by: Sequence[str] = (), label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """``(TP + TN) / n * 100`` per group; an empty set gives NULL (the reference: NaN)."""
    y, p = F.col(label_col).cast("double"), F.col(pred_col).cast("double")
    correct = F.sum(F.when(y == p, F.lit(1)).otherwise(F.lit(0)))
    n = F.count(F.lit(1))
    return df.groupBy(*by).agg(n.alias("n_test"), correct.alias("n_correct"),
                               (F.lit(100.0) * correct / n).alias("accuracy"))


def accuracy_pivot(results: DataFrame, cutoffs: Sequence[float] | None = None,
                   value_col: str = "accuracy") -> DataFrame:
    """Rows (class1, class0), one column per ratio label (``0.3/0.7`` ...), first
    value per cell, sorted by class1, class0 -- the reference's result table."""
    if cutoffs is not None:
        labels = [ratio_text(c) for c in cutoffs]
        piv = results.groupBy("class1", "class0").pivot("train_test", labels)
    else:
        piv = results.groupBy("class1", "class0").pivot("train_test")
    return piv.agg(F.first(value_col)).orderBy("class1", "class0")
