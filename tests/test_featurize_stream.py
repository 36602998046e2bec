"""Batch inference on images and vectors; streaming equals batch."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumisort.operators.featurize import featurize, image_to_array, projection_model, read_images
from lumisort.operators.models import LinearModel
from lumisort.plans.extraction import extract_all
from lumisort.plans.scoring import score_images
from lumisort.streaming.score_stream import score_frame, score_stream

from conftest import SF_SMALL
from fixtures_files import image_tree


def test_image_to_array_channels():
    grey = image_to_array(2, 2, 1, bytes([0, 50, 100, 150]), size=4)
    assert grey.shape == (4 * 4 * 3,)
    assert image_to_array(-1, -1, 0, b"", size=4) == "decode: invalid image"


def test_featurize_images_with_failures(spark, tmp_dir):
    image_tree(tmp_dir)
    imgs = read_images(spark, tmp_dir, "*.png")
    f = featurize(imgs, projection_model(8 * 8 * 3, 4), "image", batch_size=3, image_size=8)
    rows = f.select("file_name", "features", "error").collect()
    assert len(rows) == 14
    bad = [r for r in rows if r.features is None]
    assert [r.file_name for r in bad] == ["Ragdoll_9_bad.png"] and bad[0].error.startswith("decode")
    assert all(len(r.features) == 4 for r in rows if r.features is not None)


def test_featurize_vectors_matches_numpy(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").limit(20)
    f = featurize(emb, projection_model(64, 3), "embedding", batch_size=7).collect()
    make = projection_model(64, 3)()
    for r in f:
        assert np.allclose(r.features, make(np.asarray([r.embedding], dtype=np.float64))[0])


def test_skip_existing_before_inference(spark, tmp_dir):
    img_root = os.path.join(tmp_dir, "img")
    image_tree(img_root)
    out = os.path.join(tmp_dir, "feat")
    first = extract_all(spark, img_root, out, projection_model(8 * 8 * 3, 2), image_size=8, glob="*.png")
    assert first.count() == 14
    existing = spark.read.parquet(out)
    second = extract_all(spark, img_root, out, projection_model(8 * 8 * 3, 2), existing=existing,
                         image_size=8, glob="*.png", write=False)
    assert second.count() == 0
    retry = extract_all(spark, img_root, out, projection_model(8 * 8 * 3, 2), existing=existing,
                        retry_failed=True, image_size=8, glob="*.png", write=False)
    assert [r.file_name for r in retry.collect()] == ["Ragdoll_9_bad.json"]


def test_score_images(spark, tmp_dir):
    image_tree(tmp_dir)
    model = LinearModel([1.0, -1.0], 0.0, "svm")
    out = score_images(spark, tmp_dir, projection_model(8 * 8 * 3, 2), model, ("Ragdoll", "Persian"),
                       glob="*.png", image_size=8).collect()
    assert len(out) == 14
    assert sum(1 for r in out if not r.success) == 1
    assert all(r.prediction in ("Ragdoll", "Persian") for r in out if r.success)


def test_stream_equals_batch(spark):
    from lumisort.sources.samples import CLASS_NAMES, samples_from_table
    model = LinearModel([float(np.sin(i)) for i in range(64)], 0.0, "svm")
    schema = "vec_id bigint, embedding array<float>, label int"
    src = spark.readStream.schema(schema).option("pathGlobFilter", "embeddings.parquet").parquet(SF_SMALL)
    s = samples_from_table(src, "vec_id", "embedding", "label", CLASS_NAMES)
    d = tempfile.mkdtemp(prefix="lumisort-stream-")
    q = score_stream(s, model, ("Ragdoll", "Persian"), os.path.join(d, "out"), os.path.join(d, "ckpt"))
    q.awaitTermination()
    streamed = {r.file_name: (r.success, r.prediction) for r in spark.read.parquet(os.path.join(d, "out")).collect()}
    batch_src = samples_from_table(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), "vec_id", "embedding",
                                   "label", CLASS_NAMES)
    batch = {r.file_name: (r.success, r.prediction) for r in score_frame(batch_src, model, ("Ragdoll", "Persian")).collect()}
    assert streamed == batch and len(batch) == 500


def test_todo_in_chunks(spark, tmp_dir):
    img_root = os.path.join(tmp_dir, "img")
    image_tree(img_root)
    existing = spark.createDataFrame([("Persian_0_train.json", [1.0])], "file_name string, features array<double>")
    for chunk in (3, 20_000):
        out = extract_all(spark, img_root, None, projection_model(8 * 8 * 3, 2), existing=existing,
                          image_size=8, glob="*.png", write=False, chunk_files=chunk)
        names = sorted(r.file_name for r in out.collect())
        assert len(names) == 13 and "Persian_0_train.json" not in names


def test_same_name_in_both_splits_and_odd_names(spark, tmp_dir):
    """An image is known by split, class and name; names with blanks, brackets, plus and percent."""
    import shutil
    img_root, out = os.path.join(tmp_dir, "img"), os.path.join(tmp_dir, "feats")
    image_tree(img_root)
    some = [os.path.join(d, f) for d, _, fs in os.walk(img_root) for f in fs if f.endswith(".png")]
    good = next(f for f in some if "bad" not in f.lower() and os.path.getsize(f) > 60)
    odd = ["Persian [x]_77.png", "a+b_1.png", "50%41_2.png", "q?{z}_3.png"]
    for split in ("train", "test"):
        folder = os.path.join(img_root, split, "odd class [1]")
        os.makedirs(folder)
        for name in odd:
            shutil.copy(good, os.path.join(folder, name))
    model = projection_model(8 * 8 * 3, 2)
    seen = spark.createDataFrame([("train", "odd class [1]", "Persian [x]_77.json", [1.0])],
                                 "split string, label_name string, file_name string, features array<double>")
    new = extract_all(spark, img_root, out, model, existing=seen, image_size=8, glob="*.png", chunk_files=5)
    rows = {(r.split, r.file_name) for r in new.where("label_name = 'odd class [1]'").collect()}
    want = {(s, n.replace(".png", ".json")) for s in ("train", "test") for n in odd}
    assert rows == want - {("train", "Persian [x]_77.json")}
    again = extract_all(spark, img_root, out, model, existing=spark.read.parquet(out).unionByName(
        seen.withColumn("error", F.lit(None).cast("string")), allowMissingColumns=True), image_size=8, glob="*.png")
    assert again.count() == 0


def test_retry_replaces_the_failed_row(spark, tmp_dir):
    img_root, out = os.path.join(tmp_dir, "img"), os.path.join(tmp_dir, "feats")
    image_tree(img_root)

    def failing():
        def run(batch):
            raise ValueError("no model")
        return run

    first = extract_all(spark, img_root, out, failing, image_size=8, glob="*.png")
    n = first.count()
    assert first.where("features is not null").count() == 0
    second = extract_all(spark, img_root, out, projection_model(8 * 8 * 3, 2), existing=spark.read.parquet(out),
                         retry_failed=True, image_size=8, glob="*.png")
    table = spark.read.parquet(out)
    assert second.count() == n and table.count() == n
    assert table.select("split", "label_name", "file_name").distinct().count() == n
    assert table.where("features is not null").count() >= n - 1


def test_one_bad_row_fails_alone(spark):
    rows = [(i, [float(i)] * (3 if i == 4 else 4)) for i in range(10)]
    for parts in (1, 8):
        df = spark.createDataFrame(rows, "i int, v array<double>").repartition(parts)
        for batch in (1, 64):
            got = featurize(df, projection_model(4, 2), "v", batch_size=batch).collect()
            assert [r.i for r in got if r.features is None] == [4] and all(r.error for r in got if r.i == 4)


def test_wrong_length_vectors_have_no_prediction(spark):
    from lumisort.operators.models import train_svm
    rows = [(float(i % 2), [float(i % 2), 1.0, float(i)]) for i in range(20)]
    df = spark.createDataFrame(rows, "label double, features array<double>")
    bad = spark.createDataFrame([("a", [1.0, 2.0]), ("b", None), ("c", [1.0, 2.0, 3.0])], "file_name string, features array<double>")
    for model in (train_svm(df), LinearModel([1.0, 2.0, 3.0], 0.0, "svm")):
        got = {r.file_name: r for r in score_frame(bad, model, ("no", "yes")).collect()}
        assert [got[k].success for k in "abc"] == [False, False, True]
        assert got["a"].prediction is None and "length 2" in got["a"].error and got["b"].error and got["c"].error is None


def test_stream_reads_files_and_folders(spark, tmp_dir):
    from lumisort.streaming.score_stream import stream_table
    schema = "vec_id bigint, embedding array<float>, label int"
    folder = os.path.join(tmp_dir, "embeddings.parquet")
    spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").repartition(3).write.parquet(folder)
    counts = []
    for path in (f"{SF_SMALL}/embeddings.parquet", folder):
        sink = tempfile.mkdtemp(prefix="lumisort-sink-")
        q = (stream_table(spark, path, schema).writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", tempfile.mkdtemp(prefix="lumisort-ckpt-")).trigger(availableNow=True).start())
        q.awaitTermination()
        counts.append(spark.read.schema(schema).parquet(sink).count())
    assert counts == [500, 500]
    with pytest.raises(FileNotFoundError):
        stream_table(spark, folder + "-none", schema)
