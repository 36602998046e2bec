"""Scoring newly arriving data with Structured Streaming.

The reference scores one uploaded image per HTTP request; here arriving files
(images or feature rows) are a stream: featurise (optional), linear margin on
the JVM, class name, reply row -- stateless, so every micro-batch is
independent, and the checkpoint makes the sink exactly-once across restarts.

Names that come again: ``first_of_key`` drops repeats within a watermark's delay (bounded state),
and ``commit_stream`` writes each micro-batch as one run of a ``CommittedTable``, which skips
keys it has and batches it has seen.  So a key is answered once, over any distance and restart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lumisort.functions.naming import prediction_to_class
from lumisort.operators.featurize import featurize, read_images
from lumisort.operators.models import LinearModel, predict
from lumisort.sinks.committed import CommittedTable
from lumisort.sources.files import path_columns


def score_frame(df: DataFrame, model: LinearModel, names: tuple[str, str], features_col: str = "features",
                model_fn=None, input_col: str | None = None, batch_size: int = 64, image_size: int = 224) -> DataFrame:
    """Batch or streaming: reply rows ``success``, ``prediction`` (class name),
    ``margin``, ``error`` (NULL on success).  ``names`` = (class for 0, class for 1).
    A row succeeds if it has a prediction."""
    d = df
    if model_fn is not None:
        d = featurize(d, model_fn, input_col or "image", batch_size, output_col=features_col, image_size=image_size)
    d = predict(model, d, features_col)
    neg, pos = names
    found = F.col("prediction").isNotNull()
    size = F.size(F.col(features_col))
    why = F.when(F.col(features_col).isNull(), F.lit("features: NULL vector")).otherwise(
        F.concat(F.lit("features: length "), size.cast("string"), F.lit(f" instead of {len(model.weights)}")))
    if "error" in d.columns:
        why = F.coalesce(F.col("error"), why)
    return (d.withColumn("error", F.when(~found, why)).withColumn("success", found)
            .withColumn("prediction", prediction_to_class(F.col("prediction"), neg, pos)))


def stream_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table as a stream, be it a folder of part files or a single file."""
    reader = spark.readStream.schema(schema)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(path)
    if fs.getFileStatus(p).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())


def score_stream(stream_df: DataFrame, model: LinearModel, names: tuple[str, str], sink_path: str,
                 checkpoint: str, keep=("file_name",), fmt: str = "parquet", available_now: bool = True,
                 **kw) -> StreamingQuery:
    """Start the scoring stream into ``sink_path`` (``checkpoint`` in the shared folder)."""
    scored = score_frame(stream_df, model, names, **kw)
    cols = [c for c in keep if c in scored.columns] + ["success", "prediction", "margin", "error"]
    w = (scored.select(*cols).writeStream.format(fmt).option("checkpointLocation", checkpoint)
         .option("path", sink_path).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def first_of_key(stream_df: DataFrame, key: Sequence[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; repeats whose event time is within ``delay`` of it are dropped.  The state holds the
    keys of that span only."""
    return stream_df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def commit_stream(stream_df: DataFrame, table: CommittedTable, name: str, checkpoint: str, transform=None,
                  available_now: bool = True) -> StreamingQuery:
    """Start a stream whose micro-batch k becomes run ``<name>-<k>`` of ``table``; ``transform`` maps the batch's
    rows first.  A batch that is repeated after a failure is not written twice.  A new checkpoint needs a new ``name``,
    as it counts its batches anew."""
    def commit(batch: DataFrame, k: int) -> None:
        table.append(transform(batch) if transform else batch, f"{name}-{k}")

    w = stream_df.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


REPLY_SCHEMA = "file_name string, success boolean, prediction string, margin double, error string"


def reply_table(spark: SparkSession, path: str) -> CommittedTable:
    """Replies, one a name."""
    return CommittedTable(spark, path, ["file_name"], REPLY_SCHEMA)


def image_stream(spark: SparkSession, root: str, glob: str = "*", max_files: int = 10_000) -> DataFrame:
    """(path, modificationTime) of images as they arrive under ``root``; contents are not read.  A micro-batch has
    ``max_files`` at most."""
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files))
            .load(root).select("path", "modificationTime"))


def score_image_stream(spark: SparkSession, root: str, model_fn, model: LinearModel, names: tuple[str, str],
                       table: CommittedTable, name: str, checkpoint: str, glob: str = "*", image_size: int = 224,
                       batch_size: int = 64, max_files: int = 10_000, available_now: bool = True) -> StreamingQuery:
    """Score images as they arrive: each micro-batch's files are decoded by Spark's image source, featurised and scored,
    and the replies committed by name.  Images whose name has a reply are not read again."""
    def score(batch: DataFrame) -> DataFrame:
        rows = batch.select("path", path_columns("path")[-1])
        new = rows.join(table.keys(), "file_name", "left_anti")
        paths = [r["path"] for r in new.collect()]  # of one micro-batch: max_files at most
        if not paths:
            return spark.createDataFrame([], REPLY_SCHEMA)
        images = read_images(spark, paths)
        return score_frame(images, model, names, model_fn=model_fn, batch_size=batch_size, image_size=image_size)

    return commit_stream(image_stream(spark, root, glob, max_files), table, name, checkpoint, score, available_now)
