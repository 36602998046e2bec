"""Batch inference: images or vectors -> feature vectors, in Arrow batches.

``featurize`` is one Spark job: executors decode, resize, normalise and run the
model on whole batches (an iterator pandas UDF, so the model is built once per
Python worker and reused for every batch).  A row that cannot be processed
gets NULL features and an ``error`` message; the job goes on.

The model is a zero-argument factory returning ``fn(batch: ndarray[n, d]) ->
ndarray[n, k]`` -- plug in any network.  No deep-learning library ships here,
so the default is a fixed linear projection (deterministic, SQL-checkable).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumisort._compat import ship_by_value, worker_cache

ship_by_value(__name__)
ship_by_value("lumisort._compat")

ModelFactory = Callable[[], Callable[[np.ndarray], np.ndarray]]

# Per-channel means subtracted from BGR pixels (the "caffe"
# preprocessing of the VGG family the reference uses).
BGR_MEANS = (103.939, 116.779, 123.68)

OUT_TYPE = T.StructType([
    T.StructField("features", T.ArrayType(T.DoubleType()), True),
    T.StructField("error", T.StringType(), True),
])



def projection_model(in_dim: int, out_dim: int, weight: Callable[[int, int], float] | None = None) -> ModelFactory:
    """Factory of a fixed linear projection ``x @ W`` with ``W[i][j] = weight(i, j)``
    (default ``((7i + 13j) mod 17 - 8) / 8``)."""
    def make():
        if weight is None:
            i = np.arange(in_dim)[:, None]
            j = np.arange(out_dim)[None, :]
            mat = ((7 * i + 13 * j) % 17 - 8) / 8.0
        else:
            mat = np.array([[weight(a, b) for b in range(out_dim)] for a in range(in_dim)])
        mat = mat.astype(np.float64)

        def run(batch: np.ndarray) -> np.ndarray:
            return batch.astype(np.float64) @ mat
        return run
    make.__qualname__ = f"projection_{in_dim}x{out_dim}"
    return make


def _model(factory: ModelFactory):
    """The model of a factory, built once per Python worker process (tasks
    unpickle a fresh factory object, so the cache key is its pickled bytes)."""
    import hashlib

    from pyspark import cloudpickle
    cache = worker_cache()
    key = hashlib.sha1(cloudpickle.dumps(factory)).hexdigest()
    m = cache.get(key)
    if m is None:
        m = cache[key] = factory()
    return m


def _error(what: str, e: Exception) -> str:
    return f"{what}: {type(e).__name__}: {e}"


def _run_model(model, rows: list, batch_size: int) -> tuple[list, list]:
    """Model over the decodable rows, in chunks of ``batch_size`` rows of one shape.
    If a chunk fails its rows are tried one by one, so only rows that fail on
    their own get an error, wherever batch borders fall."""
    feats, errs = [None] * len(rows), [None] * len(rows)
    shapes: dict[tuple, list[int]] = {}
    for i, r in enumerate(rows):
        if isinstance(r, str):
            errs[i] = r
        else:
            shapes.setdefault(r.shape, []).append(i)

    def run(idx: list[int]) -> None:
        out = np.asarray(model(np.stack([rows[i] for i in idx])), dtype=np.float64)
        for k, i in enumerate(idx):
            feats[i] = out[k].tolist()

    for same in shapes.values():
        for s in range(0, len(same), max(1, batch_size)):
            idx = same[s:s + max(1, batch_size)]
            try:
                run(idx)
            except Exception:  # noqa: BLE001 - find the rows that fail
                for i in idx:
                    try:
                        run([i])
                    except Exception as e:  # noqa: BLE001 - a failed row becomes NULL features
                        feats[i], errs[i] = None, _error("model", e)
    return feats, errs


def _vector_rows(s: pd.Series) -> list:
    """Arrow batch of vectors -> per-row arrays or error texts."""
    rows = []
    for v in s:
        if v is None:
            rows.append("input: NULL vector")
        else:
            a = np.asarray(v, dtype=np.float64)
            rows.append(a if a.ndim == 1 and a.size and not np.isnan(a).any() else "input: bad vector")
    return rows


def _vector_udf(factory: ModelFactory, batch_size: int):
    @F.pandas_udf(OUT_TYPE)
    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(factory)
        for s in it:
            feats, errs = _run_model(model, _vector_rows(s), batch_size)
            yield pd.DataFrame({"features": feats, "error": errs})
    return run


def image_to_array(height, width, n_channels, data, size: int = 224, means=BGR_MEANS) -> np.ndarray | str:
    """Decoded image (BGR bytes, as Spark's image source gives them) -> 3-channel,
    nearest-neighbour resized to size x size, mean-centred, flattened float64.
    Returns an error text for an undecodable image."""
    if data is None or height is None or height <= 0 or width <= 0:
        return "decode: invalid image"
    arr = np.frombuffer(bytes(data), dtype=np.uint8)
    c = int(n_channels)
    if arr.size != height * width * c:
        return "decode: size mismatch"
    img = arr.reshape(height, width, c).astype(np.float64)
    if c == 1:
        img = np.repeat(img, 3, axis=2)
    elif c == 4:
        img = img[:, :, :3]
    elif c != 3:
        return f"decode: {c} channels"
    ri = (np.arange(size) * height // size).clip(0, height - 1)
    ci = (np.arange(size) * width // size).clip(0, width - 1)
    img = img[ri][:, ci]
    img = img - np.asarray(means, dtype=np.float64)[None, None, :]
    return img.reshape(-1)


def bytes_to_array(data, size: int = 224, means=BGR_MEANS) -> np.ndarray | str:
    """Encoded image bytes (JPEG, PNG ...) -> the same array as ``image_to_array``.
    Needs Pillow in the Python workers; without it the row gets an error text."""
    if data is None:
        return "decode: NULL bytes"
    try:
        import io

        from PIL import Image
    except ImportError:
        return "decode: no image decoder for bytes (install Pillow, or read files with the image source)"
    img = Image.open(io.BytesIO(bytes(data))).convert("RGB")
    arr = np.asarray(img, dtype=np.uint8)[:, :, ::-1]  # RGB -> BGR, as the image source gives
    h, w, _ = arr.shape
    return image_to_array(h, w, 3, arr.tobytes(), size, means)


def _bytes_udf(factory: ModelFactory, batch_size: int, size: int):
    @F.pandas_udf(OUT_TYPE)
    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(factory)
        for s in it:
            rows = []
            for d in s:
                try:
                    rows.append(bytes_to_array(d, size))
                except Exception as e:  # noqa: BLE001
                    rows.append(_error("decode", e))
            feats, errs = _run_model(model, rows, batch_size)
            yield pd.DataFrame({"features": feats, "error": errs})
    return run


def _image_udf(factory: ModelFactory, batch_size: int, size: int):
    @F.pandas_udf(OUT_TYPE)
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(factory)
        for pdf in it:
            rows = []
            for h, w, c, d in zip(pdf["height"], pdf["width"], pdf["nChannels"], pdf["data"]):
                try:
                    rows.append(image_to_array(h, w, c, d, size))
                except Exception as e:  # noqa: BLE001
                    rows.append(_error("decode", e))
            feats, errs = _run_model(model, rows, batch_size)
            yield pd.DataFrame({"features": feats, "error": errs})
    return run


def featurize(df: DataFrame, model_fn: ModelFactory, input_col: str, batch_size: int = 64,
              output_col: str = "features", error_col: str = "error", image_size: int = 224) -> DataFrame:
    """Add ``output_col`` (array<double>, NULL on failure) and ``error_col``.

    ``input_col`` is a numeric array column (vectors), the ``image`` struct of
    Spark's image source, or encoded image bytes (archive members, binary files;
    decoded with Pillow when the workers have it).  A batch of decoded images is held in a
    Python worker's memory: bound it with ``spark.sql.execution.arrow.maxBytesPerBatch``
    (``session.build_session`` sets 64 MB) or ``...maxRecordsPerBatch``."""
    dtype = df.schema[input_col].dataType
    if isinstance(dtype, T.StructType):
        udf = _image_udf(model_fn, batch_size, image_size)
        res = udf(F.struct(*[F.col(f"{input_col}.{f}") for f in ("height", "width", "nChannels", "data")]))
    elif isinstance(dtype, T.BinaryType):
        res = _bytes_udf(model_fn, batch_size, image_size)(F.col(input_col))
    else:
        res = _vector_udf(model_fn, batch_size)(F.col(input_col))
    out = df.withColumn("_fz", res)
    return (out.withColumn(output_col, F.col("_fz.features")).withColumn(error_col, F.col("_fz.error"))
            .drop("_fz"))


def escape_glob(path: str) -> str:
    """A path that Spark's readers take literally."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def read_images(spark, root, glob: str = "*") -> DataFrame:
    """Spark's image source (decodes on the JVM; invalid files kept with height -1)
    plus split / class / file name from ``root/{split}/{label}/{file}``.
    ``root`` is a folder or a list of image paths (taken as they are, not as globs)."""
    from lumisort.sources.files import path_columns, path_of_uri
    reader = spark.read.format("image").option("dropInvalid", "false")
    if isinstance(root, str):
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    else:
        root = [escape_glob(p) for p in root]
    r = reader.load(root)
    return r.select(path_of_uri("image.origin").alias("path"), "image").select(
        "path", *path_columns("path"), "image")


def failure_count(df: DataFrame, error_col: str = "error") -> DataFrame:
    """How many rows failed, by error text (reported, never hidden)."""
    return df.where(F.col(error_col).isNotNull()).groupBy(error_col).count()
