"""File sources: image trees, object listings, feature files, archives, results.

All are Spark readers with explicit schemas; split, class and name are
derived from the path with column expressions.  Listings never select the
``content`` column, so the binary reader does not open the files.
"""

from __future__ import annotations

import io
import tarfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisort._compat import col_of, ship_by_value
from lumisort.functions.naming import basename, label_from_name, strip_root

ship_by_value(__name__)

RESULTS_SCHEMA = "class1 string, class0 string, cutoff double, train_test string, accuracy double"


def path_of_uri(c):
    """Plain path of a file URI as ``_metadata.file_path`` and the image source give
    it: percent escapes decoded, ``+`` kept.  Listings (``binaryFile``) hold plain
    paths already and must not be decoded."""
    c = col_of(c)
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def path_columns(path) -> list:
    """``split``, ``label_name`` and ``file_name`` of a plain ``.../{split}/{label}/{file}`` path."""
    parts = F.split(col_of(path), "/")
    n = F.size(parts)
    return [F.try_element_at(parts, n - 2).alias("split"), F.try_element_at(parts, n - 1).alias("label_name"),
            F.element_at(parts, n).alias("file_name")]


def read_image_tree(spark: SparkSession, root: str, glob: str = "*.jpg", with_content: bool = True) -> DataFrame:
    """``root/{train,test}/<label>/<image>`` -> path, split, label_name, file_name[, content].

    The folder names give split and class; files elsewhere keep NULLs there."""
    r = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", glob).load(root))
    cols = [F.col("path"), *path_columns("path")]
    if with_content:
        cols.append(F.col("content"))
    return r.select(*cols)


def list_objects(spark: SparkSession, path: str, suffix: str | None = None, recursive: bool = True) -> DataFrame:
    """Keys under a directory (local, HDFS or object store): path, name, length,
    modificationTime.  Content is not read."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    r = reader.load(path).select("path", "length", "modificationTime")
    return r.withColumn("name", basename("path"))


def read_feature_json(spark: SparkSession, path: str, layout: str = "per_file") -> DataFrame:
    """Feature files -> file_name, features array<double>, readable boolean.

    ``per_file``: one bare JSON array (or ``null``) per file, named ``<stem>.json``
    (the reference's layout); ``lines``: JSON lines ``{"file_name", "features"}``
    as written by ``write_features(fmt='json')``.  Malformed text gives NULL
    features with ``readable = false``; the literal ``null`` is readable.
    """
    if layout == "lines":
        r = spark.read.schema("file_name string, features array<double>").json(path)
        return r.withColumn("readable", F.lit(True))
    if layout != "per_file":
        raise ValueError("layout must be 'per_file' or 'lines'")
    r = (spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
         .option("pathGlobFilter", "*.json").text(path)
         .select(path_of_uri("_metadata.file_path").alias("path"), F.trim(F.col("value")).alias("txt")))
    vec = F.from_json(F.col("txt"), "array<double>")
    readable = (F.col("txt") == F.lit("null")) | vec.isNotNull()
    _, folder, name = path_columns("path")
    return r.select(name, folder.alias("folder"), vec.alias("features"), readable.alias("readable"), "path")


def read_results(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read back a result table written by ``write_results`` (CSV with header)."""
    r = spark.read.option("header", "true")
    return r.schema(schema).csv(path) if schema else r.option("inferSchema", "false").csv(path)


# ------------------------------------------------------------------ archives

ARCHIVE_BATCH_ROWS = 256
ARCHIVE_BATCH_BYTES = 64 << 20


MEMBER_COLUMNS = ["archive", "place", "member", "content", "error"]


def _explode_archives(batches):
    """One output row per regular file member, streamed out in bounded batches
    (at most 256 members or 64 MB of bytes), so a big archive is never held
    whole in a pandas frame.  An archive that cannot be read to its end gives a
    row with the error after the members read so far.  ``place`` counts all members
    of the archive from 0, folders included."""
    for pdf in batches:
        for archive, content in zip(pdf["path"], pdf["content"]):
            out, size, place = [], 0, -1
            try:
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tf:
                    for place, m in enumerate(tf):
                        if not m.isfile():
                            continue
                        f = tf.extractfile(m)
                        data = f.read() if f is not None else b""
                        out.append((archive, place, m.name, data, None))
                        size += len(data)
                        if len(out) >= ARCHIVE_BATCH_ROWS or size >= ARCHIVE_BATCH_BYTES:
                            yield pd.DataFrame(out, columns=MEMBER_COLUMNS)
                            out, size = [], 0
            except (tarfile.TarError, EOFError, OSError, zlib.error) as e:
                out.append((archive, place + 1, None, None, f"archive: {type(e).__name__}: {e}"))
            if out:
                yield pd.DataFrame(out, columns=MEMBER_COLUMNS)


def read_archives(spark: SparkSession, path: str, glob: str = "*.tar.gz", partitions: int | None = None) -> DataFrame:
    """tar(.gz) archives -> archive, place (of the member in it), member, name (root part stripped),
    label_name (from the name), content, error (NULL but for unreadable archives).

    gzip streams do not split, so each archive is read by one task (a scan
    partition holds at most ``spark.sql.files.maxPartitionBytes`` of archives):
    ship data as many archive shards.  ``partitions``: spread the members evenly
    over that many partitions right after the scan (round robin), so the
    work after it (decoding, inference) is balanced."""
    arch = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path).select("path", "content"))
    members = arch.mapInPandas(_explode_archives, "archive string, place long, member string, content binary, error string")
    if partitions:
        members = members.repartition(int(partitions))
    name = strip_root(F.col("member"))
    return members.select("archive", "place", "member", name.alias("name"), label_from_name(basename(name)).alias("label_name"),
                          "content", "error")
