"""The canonical ``samples`` table: one row per image feature vector.

    samples: file_name string, label_name string, split string, features array<double>

``samples_from_table`` turns any (id, vector, label) table into it with column
expressions only -- no driver round trip, no inference.  ``embeddings_samples``
is the view over the test data's ``embeddings`` table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort.operators.split import split_positional

# Class names of the test-data view, indexed by the 0-based
# ``embeddings.label`` (label 0 -> first name).
CLASS_NAMES = [
    "Abyssinian", "Egyptian_Mau", "Persian", "Ragdoll", "Siamese",
    "Siamese_mix", "shiba_inu", "wheaten_terrier", "yorkshire_terrier", "yorkshire",
]

# Fixed values of the test-data view: extraction failures are simulated on the
# rows whose id is 7 modulo 50 (their features are NULL; the rows are kept).
FAILED_EXTRACTION_MOD, FAILED_EXTRACTION_REM = 50, 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def samples_from_table(df: DataFrame, id_col: str, vec_col: str, label_col: str,
                       names: Sequence[str] | None = None, failed: Column | None = None,
                       extension: str = ".json") -> DataFrame:
    """(id, vector, label) -> (file_name, label_name, features).

    ``names`` maps an integer label to a class name (0-based); without it the
    label's text is the class name.  ``failed`` marks rows whose vector counts as
    a failed extraction (NULL features).
    """
    if names is not None:
        label_name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col(label_col).cast("int") + 1)
    else:
        label_name = F.col(label_col).cast("string")
    feats = F.col(vec_col).cast("array<double>")
    if failed is not None:
        feats = F.when(failed, F.lit(None).cast("array<double>")).otherwise(feats)
    return (df.select(label_name.alias("label_name"), F.col(id_col).alias("_id"), feats.alias("features"))
            .select(F.concat(F.col("label_name"), F.lit("_"), F.col("_id").cast("string"), F.lit(extension))
                    .alias("file_name"), "label_name", "features"))


def embeddings_samples(spark: SparkSession, sf_dir: str, with_split: bool = True,
                       cutoff: float = 0.8) -> DataFrame:
    """``samples`` over ``embeddings``; ``split`` from the positional pass at ``cutoff``."""
    emb = table(spark, sf_dir, "embeddings")
    failed = (F.col("vec_id") % FAILED_EXTRACTION_MOD) == FAILED_EXTRACTION_REM
    s = samples_from_table(emb, "vec_id", "embedding", "label", CLASS_NAMES, failed)
    return split_positional(s, cutoff) if with_split else s
