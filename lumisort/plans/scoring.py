"""Score images end to end in batch (the reference's prediction API as a job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumisort.operators.featurize import read_images
from lumisort.operators.models import LinearModel
from lumisort.streaming.score_stream import score_frame


def score_images(spark: SparkSession, root: str, model_fn, model: LinearModel, names: tuple[str, str],
                 glob: str = "*", batch_size: int = 64, image_size: int = 224) -> DataFrame:
    """Images under ``root`` -> file_name, success, prediction (class name), margin, error."""
    from lumisort.operators.featurize import featurize
    imgs = read_images(spark, root, glob)
    feats = featurize(imgs, model_fn, "image", batch_size, image_size=image_size)
    out = score_frame(feats, model, names)
    return out.select("path", "file_name", "success", "prediction", "margin", "error")
