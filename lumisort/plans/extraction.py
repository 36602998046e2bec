"""Feature extraction as one job: list images, skip those already done,
featurise the rest, add them to the feature table.

An image is known by (split, class, name).  The folder is listed without reading
contents, the listing is anti-joined with the keys already extracted, and the
narrow todo list is stored once in the shared folder.  Its files are then read in
chunks of ``chunk_files``, each chunk a distributed job over exactly those files;
``parallel_chunks`` of them run at a time, so a chunk's last tasks don't leave the cluster
idle, and the driver holds the paths of so many chunks.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort.functions.naming import stem
from lumisort.operators.featurize import featurize, read_images
from lumisort.operators.joins import skip_existing
from lumisort.session import durable, remove_scratch, scratch_path
from lumisort.sinks.committed import CommittedTable
from lumisort.sinks.writers import write_features
from lumisort.sources.files import read_image_tree

KEY = ["split", "label_name", "file_name"]
CHUNK_FILES = 20_000
FEATURE_SCHEMA = "file_name string, label_name string, split string, features array<double>, error string"
FEATURE_COLUMNS = [c.split()[0] for c in FEATURE_SCHEMA.split(", ")]


def _feature_name(c):
    return F.concat(stem(c), F.lit(".json"))


def todo_images(spark: SparkSession, image_root: str, done: DataFrame | None, glob: str = "*") -> DataFrame:
    """(path, split, label_name, file_name) of the images whose features are not in
    ``done``, by those of the key columns that ``done`` has (``file_name`` at least)."""
    listing = (read_image_tree(spark, image_root, glob, with_content=False)
               .withColumn("file_name", _feature_name("file_name")))
    if done is None:
        return listing
    keys = [c for c in KEY if c in done.columns]
    return skip_existing(listing, done.select(*keys), keys)


def extract_committed(spark: SparkSession, image_root: str, table: CommittedTable, model_fn, run: str | None = None,
                      retry_failed: bool = False, batch_size: int = 64, image_size: int = 224, glob: str = "*",
                      chunk_files: int = CHUNK_FILES) -> bool:
    """``extract_all`` into a ``feature_table``: rows count when the run is committed, so a job that died anywhere is
    simply run again, and a ``run`` that is committed does nothing.  With ``retry_failed`` images without features
    are extracted again and replace their rows.  False if the run was committed before."""
    if run is not None and any(c["run"] == run for c in table.commits()):
        return False
    done = table.read()
    new = extract_all(spark, image_root, "", model_fn, done.where(F.col("features").isNotNull()) if retry_failed else done,
                      batch_size=batch_size, image_size=image_size, glob=glob, write=False, chunk_files=chunk_files)
    return (table.replace if retry_failed else table.append)(new, run)


def extract_all(spark: SparkSession, image_root: str, out_path: str, model_fn, existing: DataFrame | None = None,
                retry_failed: bool = False, batch_size: int = 64, image_size: int = 224, glob: str = "*",
                write: bool = True, chunk_files: int = CHUNK_FILES, parallel_chunks: int = 4) -> DataFrame:
    """Features for every image not yet extracted; returns the rows of this run as written.

    With ``retry_failed`` earlier failures (NULL features) are extracted again and
    the new rows replace them.  Without ``write`` the rows stay in a scratch table
    under the shared folder."""
    done = existing
    if existing is not None and retry_failed:
        done = existing.where(F.col("features").isNotNull())
    todo = durable(todo_images(spark, image_root, done, glob))
    chunks = max(1, math.ceil(todo.count() / max(1, chunk_files)))
    todo = todo.withColumn("_chunk", F.pmod(F.xxhash64("path"), F.lit(chunks)))
    staged = scratch_path(spark, "extracted")

    def extract(k: int) -> str | None:
        """Chunk ``k`` in a folder of its own; None if it has no files."""
        paths = [r["path"] for r in todo.where(F.col("_chunk") == k).select("path").collect()]  # one chunk
        if not paths:
            return None
        imgs = read_images(spark, paths).withColumn("file_name", _feature_name("file_name"))
        feats = featurize(imgs, model_fn, "image", batch_size, image_size=image_size)
        feats.select(*FEATURE_COLUMNS).write.parquet(f"{staged}/chunk-{k}")
        return f"{staged}/chunk-{k}"

    with ThreadPoolExecutor(max_workers=max(1, parallel_chunks)) as pool:
        folders = [f for f in pool.map(extract, range(chunks)) if f]
    new = spark.read.schema(FEATURE_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], FEATURE_SCHEMA)
    if not write:
        return new
    if existing is not None and retry_failed:
        _replace(spark, new, out_path)
    else:
        write_features(new, out_path, fmt="parquet", mode="append")
    written = spark.read.schema(new.schema).parquet(out_path).join(todo.select(*KEY), KEY, "left_semi")
    remove_scratch(spark, staged)
    return written.select(*new.columns)


def _replace(spark: SparkSession, new: DataFrame, out_path: str) -> None:
    """New rows take the place of rows with the same key; only the class folders they
    touch are written again."""
    old = spark.read.schema(new.schema).parquet(out_path)
    touched = new.select("split", "label_name").distinct()
    kept = old.join(touched, ["split", "label_name"], "left_semi").join(new.select(*KEY), KEY, "left_anti")
    merged = scratch_path(spark, "replaced")
    kept.select(*new.columns).unionByName(new).write.parquet(merged)
    (spark.read.schema(new.schema).parquet(merged).hint("rebalance", "split", "label_name")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("split", "label_name")
     .parquet(out_path))
    remove_scratch(spark, merged)
