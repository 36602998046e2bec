"""Column functions over feature vectors stored as ``array<double>``.

Vectors stay plain arrays at rest (columnar Parquet, SQL-visible); they become
ML ``VectorUDT`` only at the model boundary (``to_ml_vector``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from lumisort._compat import col_of


def parse_vector_text(c) -> Column:
    """``'[f1, f2, ...]'`` -> ``array<double>``: strip the brackets, split on ``,``,
    trim, cast.  Text that is not a list of numbers (``null``, ``[]``, junk) -> NULL,
    never an array holding NULLs."""
    c = col_of(c)
    parts = F.split(F.trim(F.regexp_replace(F.trim(c), r"^\[|\]$", "")), ",")
    vals = F.transform(parts, lambda x: F.trim(x).try_cast("double"))
    return F.when(~F.exists(vals, lambda x: x.isNull()), vals)


def vector_to_text(c) -> Column:
    """JSON text of a vector (``null`` for a missing one, like ``json.dumps``)."""
    return F.coalesce(F.to_json(col_of(c)), F.lit("null"))


def text_to_vector(c) -> Column:
    """JSON text -> ``array<double>``; ``null`` or malformed text -> NULL."""
    return F.from_json(col_of(c), "array<double>")


def to_ml_vector(c) -> Column:
    """``array<float|double>`` -> dense ML vector (the model boundary)."""
    return array_to_vector(col_of(c).cast("array<double>"))


def from_ml_vector(c) -> Column:
    """ML vector -> ``array<double>`` (the way back from the model boundary)."""
    return vector_to_array(col_of(c), "float64")


def weights_literal(weights: Sequence[float]) -> Column:
    """A model's weights as a constant array column (folded once by Catalyst)."""
    return F.array(*[F.lit(float(w)) for w in weights])


def dot(c, w: Column) -> Column:
    """Dot product of two arrays (NULL if either is NULL or their lengths differ)."""
    prods = F.zip_with(col_of(c).cast("array<double>"), w, lambda x, y: x * y)
    total = F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(col_of(c)) == F.size(w), total)


def linear_margin(c, weights: Sequence[float] | Column, intercept: float = 0.0) -> Column:
    """``w . x + b`` for a linear model (the arithmetic inside SVM predict)."""
    w = weights if isinstance(weights, Column) else weights_literal(weights)
    return dot(c, w) + F.lit(float(intercept))


def svm_prediction(margin: Column, threshold: float = 0.0) -> Column:
    """Margin above the threshold -> 1.0 else 0.0 (NULL margin stays NULL)."""
    return F.when(margin.isNull(), F.lit(None).cast("double")).when(margin > threshold, F.lit(1.0)).otherwise(F.lit(0.0))
