"""Posing binary problems over ``samples``: class filters, 0/1 labels, null drops.

One-vs-one keeps two classes; one-vs-all keeps every class.  The positive
class is matched exactly by default; ``match='prefix'`` reproduces the
reference's ``file_name.startswith(class1)`` (which also takes ``Siamese_mix``
rows as ``Siamese``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisort.functions.naming import is_placeholder

MODES = ("ova", "ovo")
MATCHES = ("exact", "prefix")


def resolve_mode(mode: str) -> str:
    """'ova'/'ovo', also the reference's yes/no answer ("one vs all?")."""
    m = str(mode).strip().lower()
    m = {"yes": "ova", "no": "ovo", "onevsall": "ova", "onevsone": "ovo"}.get(m, m)
    if m not in MODES:
        raise ValueError(f"mode must be one of {MODES} (or yes/no), got {mode!r}")
    return m


def binary_label(class1: str, match: str = "exact", label_col: str = "label_name",
                 name_col: str = "file_name") -> Column:
    """1.0 for the positive class, else 0.0."""
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    hit = F.col(name_col).startswith(class1) if match == "prefix" else (F.col(label_col) == F.lit(class1))
    return F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0))


def class_pair_filter(df: DataFrame, class1: str, class0: str, label_col: str = "label_name") -> DataFrame:
    """Keep the two classes of a one-vs-one problem (prunes partitions when the
    table is partitioned by ``label_col``)."""
    return df.where(F.col(label_col).isin(class1, class0))


def drop_null_features(df: DataFrame, features_col: str = "features") -> DataFrame:
    """Remove failed extractions: NULL or empty vectors."""
    return df.where(F.col(features_col).isNotNull() & (F.size(F.col(features_col)) > 0))


def drop_placeholders(df: DataFrame, key_col: str = "path") -> DataFrame:
    """Remove directory placeholder keys (empty last path component)."""
    return df.where(~is_placeholder(F.col(key_col)))


def select_problem(df: DataFrame, class1: str, class0: str | None = None, mode: str = "ova",
                   match: str = "exact", label_col: str = "label_name", name_col: str = "file_name",
                   features_col: str = "features") -> DataFrame:
    """Rows of one binary problem with a double ``label`` (1 = ``class1``).

    Null vectors are dropped here, after split resolution, as in the reference.
    """
    m = resolve_mode(mode)
    d = df
    if m == "ovo":
        if class0 is None:
            raise ValueError("one-vs-one needs class0")
        # the class filter is by class (folder) even when labels match by prefix
        d = class_pair_filter(d, class1, class0, label_col)
    d = drop_null_features(d, features_col)
    return d.withColumn("label", binary_label(class1, match, label_col, name_col))
