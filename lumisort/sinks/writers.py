"""Sinks: feature tables, flat one-vs-all layout, predictions, run summaries,
result tables.  Every writer is a Spark write of a DataFrame; class folders
become ``partitionBy`` columns, never files moved one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisort.functions.naming import format_percent


def write_features(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                   partition_by=("split", "label_name")) -> None:
    """Features partitioned by split and class (the reference's folder tree).

    Skip work already done *before* calling this (``joins.skip_existing`` ahead
    of ``featurize``): the writer itself only appends.  ``fmt='json'`` writes JSON
    lines ``{file_name, features, ...}`` readable by ``read_feature_json(layout='lines')``.
    """
    cols = [c for c in partition_by if c in df.columns]
    # rows of a class meet in few tasks (large classes in several), so folders get few files
    w = (df.hint("rebalance", *cols) if cols else df).write.mode(mode)
    if cols:
        w = w.partitionBy(*cols)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError("fmt must be 'parquet' or 'json'")


def dedupe_names(df: DataFrame, label_col: str = "label_name") -> DataFrame:
    """One row per (split, file_name): a name found in several classes of a
    split keeps the copy of the smallest class name.  The duplicated names are
    found on the narrow key columns; when they are provably few they are
    broadcast and the wide rows are filtered in place, otherwise joined by name."""
    from lumisort.operators.ranking import sized
    dups = (df.groupBy("split", "file_name").agg(F.count(F.lit(1)).alias("_c"), F.min(label_col).alias("_keep"))
            .where(F.col("_c") > 1).select(F.col("split").alias("_ds"), F.col("file_name").alias("_dn"), "_keep"))
    dups, n = sized(dups)
    if not n:
        return df
    cond = (df["split"].eqNullSafe(dups["_ds"])) & (df["file_name"] == dups["_dn"])
    joined = df.join(dups, cond, "left")
    # unique names pass untouched; only the duplicated ones are deduplicated
    unique = joined.where(F.col("_dn").isNull())
    chosen = (joined.where(F.col("_dn").isNotNull() & (F.col(label_col) == F.col("_keep")))
              .dropDuplicates(["split", "file_name"]))
    return unique.unionByName(chosen).drop("_ds", "_dn", "_keep")


def flatten_for_ova(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> DataFrame:
    """One flat folder per split, no class level.  A name that occurs in two
    classes of one split is kept once (the reference's copy overwrote it).  Returns
    the written table."""
    flat = dedupe_names(df)
    w = flat.hint("rebalance", "split").write.mode(mode).partitionBy("split")
    (w.parquet if fmt == "parquet" else w.json)(path)
    return df.sparkSession.read.schema(flat.schema).format(fmt).load(path).select(*flat.columns)


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Predictions as JSON lines: file_name, label, prediction."""
    cols = [c for c in ("file_name", "label", "prediction") if c in df.columns]
    df.select(*cols).write.mode(mode).json(path)


def run_summary(row: DataFrame, cutoff: float) -> DataFrame:
    """Target class, train share and accuracy text of one evaluation row."""
    return row.select("class1", "class0", F.lit(float(cutoff)).alias("cutoff"),
                      (F.lit(100.0) * F.col("n_train") / (F.col("n_train") + F.col("n_test"))).alias("train_pct"),
                      format_percent(F.col("accuracy")).alias("accuracy_text"), "accuracy")


def write_run_summary(row: DataFrame, path: str, cutoff: float, mode: str = "append") -> None:
    run_summary(row, cutoff).coalesce(1).write.mode(mode).json(path)


def write_results(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The result table as CSV with a header (one small file: the table is
    cutoffs x pairs rows)."""
    df.coalesce(1).write.mode(mode).option("header", "true").csv(path)
