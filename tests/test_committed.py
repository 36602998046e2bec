"""The committed table and what writes to it: repeated runs, deaths at every step, streams that stop and start again."""

import os

import pytest
from pyspark.sql import functions as F

from fixtures_files import archive, image_tree
from lumisort.operators.featurize import projection_model
from lumisort.operators.models import LinearModel
from lumisort.sinks.committed import CommittedTable, feature_table
from lumisort.streaming import score_stream as ST

SCHEMA = "name string, part string, value int"


def table(spark, path, partition_by=("part",)):
    return CommittedTable(spark, path, ["name"], SCHEMA, partition_by)


def df(spark, names, value):
    return spark.createDataFrame([(n, n[:1], value) for n in names], SCHEMA)


def content(t):
    return {r.name: r.value for r in t.read().collect()}


def test_runs_repeat_and_overlap(spark, tmp_dir):
    t = table(spark, tmp_dir + "/t")
    assert t.read().columns == ["name", "part", "value"] and content(t) == {} and t.commits() == []
    assert t.append(df(spark, ["a", "b", "b"], 1), "one") and t.read().count() == 2
    assert not t.append(df(spark, ["a", "z"], 2), "one")
    assert t.append(df(spark, ["b", "c"], 3), "two")
    assert content(t) == {"a": 1, "b": 1, "c": 3}
    assert t.replace(df(spark, ["c", "d"], 4), "three") and content(t) == {"a": 1, "b": 1, "c": 4, "d": 4}
    assert t.append(df(spark, ["c", "e"], 5)) and content(t) == {"a": 1, "b": 1, "c": 4, "d": 4, "e": 5}
    again = table(spark, tmp_dir + "/t")  # another session's view
    assert again.compact() and content(t) == content(again) and again.read().count() == 5
    assert not again.append(df(spark, ["q"], 6), "two") and again.clean() == 4 and content(t)["c"] == 4
    assert again.append(df(spark, ["a", "q"], 7)) and content(t) == {"a": 1, "b": 1, "c": 4, "d": 4, "e": 5, "q": 7}
    with pytest.raises(ValueError):
        CommittedTable(spark, tmp_dir, ["nobody"], SCHEMA)


def test_null_keys_are_one_key(spark, tmp_dir):
    t = table(spark, tmp_dir + "/t", ())
    rows = spark.createDataFrame([(None, "p", 1), (None, "p", 2), ("a", None, 3)], SCHEMA)
    assert t.append(rows) and t.append(rows) and t.read().count() == 2
    assert t.replace(spark.createDataFrame([(None, "p", 9)], SCHEMA)) and content(t) == {None: 9, "a": 3}


@pytest.mark.parametrize("step", ["_write_attempt", "_commit"])
def test_a_run_that_dies_can_be_run_again(spark, tmp_dir, monkeypatch, step):
    t = table(spark, tmp_dir + "/t")
    t.append(df(spark, ["a"], 1), "one")
    real = getattr(CommittedTable, step)

    def dies(self, *args):
        if step == "_write_attempt":
            real(self, args[0].limit(1), args[1])  # a part is written
        raise RuntimeError("lost")

    monkeypatch.setattr(CommittedTable, step, dies)
    with pytest.raises(RuntimeError):
        t.append(df(spark, ["a", "b", "c"], 2), "two")
    monkeypatch.setattr(CommittedTable, step, real)
    assert content(t) == {"a": 1}
    assert t.append(df(spark, ["a", "b", "c"], 2), "two") and content(t) == {"a": 1, "b": 2, "c": 2}
    assert t.clean() == 1 and content(t) == {"a": 1, "b": 2, "c": 2}


def test_two_writers_at_once(spark, tmp_dir, monkeypatch):
    mine, other = table(spark, tmp_dir + "/t"), table(spark, tmp_dir + "/t")
    real, met = CommittedTable._write_attempt, []

    def meets(self, rows, attempt):
        real(self, rows, attempt)
        if self is mine and not met:
            met.append(other.append(df(spark, ["b", "c"], 2), "other"))

    monkeypatch.setattr(CommittedTable, "_write_attempt", meets)
    assert mine.append(df(spark, ["a", "b"], 1), "mine") and met == [True]
    assert content(mine) == {"a": 1, "b": 2, "c": 2} and mine.read().count() == 3
    assert [c["run"] for c in mine.commits()] == ["other", "mine"]


def test_extraction_runs_again(spark, tmp_dir):
    from lumisort.plans.extraction import extract_committed
    image_tree(tmp_dir + "/img")
    t, model = feature_table(spark, tmp_dir + "/features"), projection_model(8 * 8 * 3, 2)

    def failing():
        def run(batch):
            raise ValueError("no model")
        return run

    kw = {"image_size": 8, "glob": "*.png"}
    assert extract_committed(spark, tmp_dir + "/img", t, failing, "first", **kw) and t.read().count() == 14
    assert not extract_committed(spark, tmp_dir + "/img", t, model, "first", **kw)
    assert extract_committed(spark, tmp_dir + "/img", t, model, "second", **kw) and t.read().where("features is not null").count() == 0
    assert extract_committed(spark, tmp_dir + "/img", t, model, "third", retry_failed=True, **kw)
    assert t.read().count() == 14 and t.read().where("features is null").count() == 1
    assert t.keys().distinct().count() == 14


def test_stream_stops_and_starts_with_repeated_files(spark, tmp_dir):
    src, ckpt = tmp_dir + "/in", tmp_dir + "/ckpt"
    t = ST.reply_table(spark, tmp_dir + "/replies")
    model = LinearModel([1.0, -1.0], 0.0, "svm")

    def put(rows):
        spark.createDataFrame(rows, "file_name string, features array<double>").coalesce(1).write.mode("append").parquet(src)

    def run(name="s", ckpt=ckpt):
        stream = (spark.readStream.schema("file_name string, features array<double>").option("maxFilesPerTrigger", 1).parquet(src)
                  .withColumn("at", F.col("_metadata.file_modification_time")))
        stream = ST.first_of_key(stream, ["file_name"], "at")
        ST.commit_stream(ST.score_frame(stream, model, ("no", "yes")), t, name, ckpt).awaitTermination()
        return {r.file_name: (r.success, r.prediction, r.margin) for r in t.read().collect()}

    put([("a", [2.0, 1.0]), ("b", [1.0, 2.0]), ("a", [2.0, 1.0]), ("x", None)])
    want = {"a": (True, "yes", 1.0), "b": (True, "no", -1.0), "x": (False, None, None)}
    assert run() == want and t.read().count() == 3
    put([("a", [0.0, 9.0]), ("c", [3.0, 1.0])])  # a repeated name after a stop
    want["c"] = (True, "yes", 2.0)
    assert run() == want and t.read().count() == 4
    assert run("again", tmp_dir + "/ckpt2") == want and t.read().count() == 4  # from the start, state lost


def test_a_batch_that_is_repeated_is_not_written_twice(spark, tmp_dir):
    src, t = tmp_dir + "/in", ST.reply_table(spark, tmp_dir + "/replies")
    spark.createDataFrame([("a", [2.0, 1.0])], "file_name string, features array<double>").write.parquet(src)
    model, calls = LinearModel([1.0, -1.0], 0.0, "svm"), []

    def start(transform):
        stream = spark.readStream.schema("file_name string, features array<double>").parquet(src)
        return ST.commit_stream(ST.score_frame(stream, model, ("no", "yes")), t, "s", tmp_dir + "/ckpt", transform)

    def dies_after_commit(batch):
        t.append(batch, "s-0")  # the commit is made, then the job is lost before the checkpoint knows
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        start(dies_after_commit).awaitTermination()
    start(lambda b: calls.append(1) or b).awaitTermination()
    assert calls and t.read().count() == 1 and len(t.commits()) == 1


def test_images_are_scored_as_they_arrive(spark, tmp_dir):
    import shutil
    root, late = tmp_dir + "/img", tmp_dir + "/late"
    image_tree(root)
    shutil.copytree(root + "/train/Persian", late)
    shutil.rmtree(root + "/train/Persian")
    t = ST.reply_table(spark, tmp_dir + "/replies")
    model_fn, model = projection_model(8 * 8 * 3, 3), LinearModel([0.1, -0.2, 0.05], 0.0, "svm")

    def run():
        ST.score_image_stream(spark, root, model_fn, model, ("no", "yes"), t, "img", tmp_dir + "/ckpt", glob="*.png", image_size=8,
                              max_files=4).awaitTermination()
        return {r.file_name: r for r in t.read().collect()}

    first = run()
    assert len(first) == 10
    shutil.copytree(late, root + "/train/Persian")
    shutil.copytree(root + "/train/Persian", root + "/again/Persian")  # the same names in another folder
    got = run()
    assert len(got) == 14 and t.read().count() == 14 and all(got[k].margin == first[k].margin for k in first)
    assert not got["Ragdoll_9_bad.png"].success and "decode" in got["Ragdoll_9_bad.png"].error
    from lumisort.plans.scoring import score_images
    batch = {r.file_name: r.prediction for r in score_images(spark, root, model_fn, model, ("no", "yes"), glob="*.png", image_size=8).collect()}
    assert {k: r.prediction for k, r in got.items()} == batch


def test_unreadable_train_copies_leave_the_name_to_test(spark):
    from lumisort.plans.evaluate import resolve_samples
    rows = [("a", "train", [1.0], True), ("a", "test", [2.0], True), ("b", "train", None, False), ("b", "test", [3.0], True),
            ("c", "train", None, True), ("c", "test", [4.0], True), ("d", "train", None, None), ("e", "test", [5.0], False)]
    d = spark.createDataFrame(rows, "file_name string, split string, features array<double>, readable boolean")
    got = sorted((r.file_name, r.split) for r in resolve_samples(d, valid_col="readable").collect())
    assert got == [("a", "train"), ("b", "test"), ("c", "train"), ("e", "test")]
    got = sorted((r.file_name, r.split) for r in resolve_samples(d).collect())
    assert got == [("a", "train"), ("b", "train"), ("c", "train"), ("d", "train"), ("e", "test")]


def test_first_pass_in_archive_order(spark, tmp_dir):
    from lumisort.plans.raw_split import split_archives
    order = [7, 2, 9, 1, 5, 4, 3, 8, 6, 0]
    archive(os.path.join(tmp_dir, "a.tar.gz"), [f"Persian_{i}.jpg" for i in order[:6]])
    archive(os.path.join(tmp_dir, "b.tar.gz"), [f"Persian_{i}.jpg" for i in order[6:]])
    got = {r.file_name for r in split_archives(spark, tmp_dir, 0.7).where("split = 'train'").collect()}
    assert got == {f"Persian_{i}.jpg" for i in order[:7]}
    got = {r.file_name for r in split_archives(spark, tmp_dir, 0.7, order="name").where("split = 'train'").collect()}
    assert got == {f"Persian_{i}.jpg" for i in range(7)}
    with pytest.raises(ValueError):
        split_archives(spark, tmp_dir, 0.7, order="size")
