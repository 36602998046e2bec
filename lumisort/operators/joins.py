"""Key lookups the reference codes by hand, as Spark joins.

No join here pairs rows within a group: split resolution and skip-existing are
anti joins on the file name, feature lookup is an equi join, and the class
pairs / grid points are built from the caller's (bounded) parameter lists,
then joined to one-row-per-class tables behind a size check.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort.functions.naming import ratio_label
from lumisort.operators.ranking import looked_up, small_side


def resolve_split(train: DataFrame, test: DataFrame, key: str = "file_name", split_col: str = "split",
                  valid_col: str | None = None) -> DataFrame:
    """One row per name, train winning: a name present in both splits counts as
    train and leaves the test side.  Apply before dropping null vectors -- a
    train row with a NULL vector still wins.  With ``valid_col`` (False = the
    train copy could not be read at all), only readable train rows win."""
    train = train.withColumn(split_col, F.lit("train"))
    test = test.withColumn(split_col, F.lit("test"))
    winners = train if valid_col is None else train.where(F.coalesce(F.col(valid_col), F.lit(False)))
    # Names in both splits, found on the narrow key columns only.  Usually few:
    # then they are broadcast and the wide test rows are filtered in place;
    # otherwise the anti join shuffles by name (names are unique, no skew).
    dups = test.select(key).join(winners.select(key), key, "left_semi").distinct()
    losers_ok = test.join(looked_up(dups), key, "left_anti")
    kept_train = train if valid_col is None else winners
    return kept_train.unionByName(losers_ok)


def skip_existing(df: DataFrame, existing: DataFrame, key: str | Sequence[str] = "file_name",
                  existing_key: str | None = None) -> DataFrame:
    """Rows whose output does not exist yet (anti join; put it before inference).
    ``key``: one column or several; ``existing_key``: the one column's name in ``existing``."""
    keys = [key] if isinstance(key, str) else list(key)
    ex = existing.select(F.col(existing_key or keys[0]).alias(keys[0]), *keys[1:])
    return df.join(ex, keys, "left_anti")


def attach_features(assignment: DataFrame, features: DataFrame, key: str = "file_name",
                    features_cols: Sequence[str] = ("features",)) -> DataFrame:
    """Name -> vector lookup as an equi join (AQE picks broadcast or sort-merge)."""
    return assignment.join(features.select(key, *features_cols), key, "inner")


def class_pairs(spark: SparkSession, classes: Sequence[str]) -> DataFrame:
    """Pairs ``(class1, class0)`` with class1 before class0 in the caller's list,
    in the reference's nested-loop order.  The list is a parameter (bounded by
    the caller), so the pairs are a literal table, not a join over data."""
    classes = list(dict.fromkeys(classes))
    rows = [(i, a, b) for i, (a, b) in enumerate(combinations(classes, 2))]
    return spark.createDataFrame(rows, "pair_idx int, class1 string, class0 string")


def grid_points(pairs: DataFrame, cutoffs: Sequence[float]) -> DataFrame:
    """Every pair at every cutoff (``explode`` of the cutoff list, no join)."""
    arr = F.array(*[F.lit(float(c)) for c in cutoffs])
    return (pairs.select("*", F.posexplode(arr).alias("cutoff_idx", "cutoff"))
            .withColumn("train_test", ratio_label(F.col("cutoff"))))


def pair_counts(pairs: DataFrame, counts: DataFrame, n_classes: int, label_col: str = "label_name") -> DataFrame:
    """Attach each side's per-class counts.  ``n_classes``: classes that the caller's
    pairs name; counts are cut down to those first, so that is their row bound too."""
    named = pairs.select(F.col("class1").alias(label_col)).union(pairs.select("class0")).distinct()
    counts = counts.join(small_side(named, n_classes), label_col, "left_semi")
    cols = [c for c in counts.columns if c != label_col]
    c1 = counts.select(F.col(label_col).alias("class1"), *[F.col(c).alias(f"class1_{c}") for c in cols])
    c0 = counts.select(F.col(label_col).alias("class0"), *[F.col(c).alias(f"class0_{c}") for c in cols])
    return (pairs.join(small_side(c1, n_classes), "class1", "left")
            .join(small_side(c0, n_classes), "class0", "left"))
