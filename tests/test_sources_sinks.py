"""Readers and writers round trip through a scratch folder."""

import os


from lumisort.sinks import writers as K
from lumisort.sources import files as SRC

from fixtures_files import archive, feature_files, image_tree


def test_archives(spark, tmp_dir):
    archive(os.path.join(tmp_dir, "a.tar.gz"), ["Abyssinian_1.jpg", "yorkshire_terrier_98.jpg"])
    archive(os.path.join(tmp_dir, "b.tar.gz"), ["Egyptian_Mau_3.jpg"])
    df = SRC.read_archives(spark, tmp_dir)
    got = sorted((r.name, r.label_name, bytes(r.content).decode()) for r in df.collect())
    assert got == [("Abyssinian_1.jpg", "Abyssinian", "Abyssinian_1.jpg"),
                   ("Egyptian_Mau_3.jpg", "Egyptian_Mau", "Egyptian_Mau_3.jpg"),
                   ("yorkshire_terrier_98.jpg", "yorkshire_terrier", "yorkshire_terrier_98.jpg")]


def test_image_tree_and_listing(spark, tmp_dir):
    image_tree(tmp_dir)
    t = SRC.read_image_tree(spark, tmp_dir, glob="*.png")
    assert t.count() == 14
    assert {(r.split, r.label_name) for r in t.collect()} == {
        ("train", "Persian"), ("train", "Ragdoll"), ("test", "Persian"), ("test", "Ragdoll")}
    lst = SRC.list_objects(spark, tmp_dir, suffix=".png")
    assert "content" not in lst.columns and lst.count() == 14


def test_feature_json_per_file(spark, tmp_dir):
    feature_files(tmp_dir, [
        ("train", "Persian", "Persian_1.json", [0.5, 1.5]),
        ("train", "Persian", "Persian_2.json", None),
        ("test", "Ragdoll", "Ragdoll_1.json", "[1.0, oops"),
    ])
    df = SRC.read_feature_json(spark, tmp_dir)
    got = sorted((r.file_name, r.folder, r.features, r.readable) for r in df.collect())
    assert got == [("Persian_1.json", "Persian", [0.5, 1.5], True), ("Persian_2.json", "Persian", None, True),
                   ("Ragdoll_1.json", "Ragdoll", None, False)]


def test_features_lines_roundtrip_and_flatten(spark, tmp_dir):
    df = spark.createDataFrame([("a.json", "x", "train", [1.0]), ("b.json", "y", "test", None),
                                ("a.json", "z", "train", [1.0])],
                               "file_name string, label_name string, split string, features array<double>")
    out = os.path.join(tmp_dir, "feat")
    K.write_features(df, out, fmt="json")
    back = SRC.read_feature_json(spark, out, layout="lines")
    assert sorted((r.file_name, r.features) for r in back.collect()) == [
        ("a.json", [1.0]), ("a.json", [1.0]), ("b.json", None)]
    flat = K.flatten_for_ova(df, os.path.join(tmp_dir, "flat"))
    assert flat.count() == 2


def test_results_roundtrip(spark, tmp_dir):
    res = spark.createDataFrame([("A", "B", 0.3, "0.3/0.7", 87.5)], SRC.RESULTS_SCHEMA)
    p = os.path.join(tmp_dir, "res")
    K.write_results(res, p)
    back = SRC.read_results(spark, p, SRC.RESULTS_SCHEMA)
    assert [tuple(r) for r in back.collect()] == [("A", "B", 0.3, "0.3/0.7", 87.5)]


def test_predictions_and_summary(spark, tmp_dir):
    pred = spark.createDataFrame([("a.json", 1.0, 0.0, 2.0)], "file_name string, label double, prediction double, x double")
    K.write_predictions(pred, os.path.join(tmp_dir, "p"))
    assert spark.read.json(os.path.join(tmp_dir, "p")).columns == ["file_name", "label", "prediction"]
    row = spark.createDataFrame([("A", "B", 6, 4, 75.0)], "class1 string, class0 string, n_train long, n_test long, accuracy double")
    s = K.run_summary(row, 0.6).first()
    assert s.train_pct == 60.0 and s.accuracy_text == "75.00"


def test_split_archives_layout(spark, tmp_dir):
    from lumisort.operators.aggregates import split_counts
    from lumisort.plans.raw_split import split_archives
    names = [f"Persian_{i}.jpg" for i in range(5)] + [f"yorkshire_terrier_{i}.jpg" for i in range(7)]
    archive(os.path.join(tmp_dir, "a.tar.gz"), names[:6])
    archive(os.path.join(tmp_dir, "b.tar.gz"), names[6:])
    out = os.path.join(tmp_dir, "layout")
    df = split_archives(spark, tmp_dir, 0.6, out_path=out)
    counts = {r.label_name: (r.n_train, r.n_test) for r in split_counts(df).collect()}
    assert counts == {"Persian": (3, 2), "yorkshire_terrier": (5, 2)}
    back = spark.read.parquet(out)
    assert back.count() == 12 and set(back.columns) >= {"split", "label_name", "file_name", "content"}
    again = split_archives(spark, tmp_dir, 0.6, rebalance_to=0.9)
    counts = {r.label_name: (r.n_train, r.n_test) for r in split_counts(again).collect()}
    assert counts == {"Persian": (4, 1), "yorkshire_terrier": (6, 1)}


def test_featurize_bytes_without_decoder(spark):
    from lumisort.operators.featurize import featurize, projection_model
    df = spark.createDataFrame([(bytearray(b"\x89PNG junk"),)], "content binary")
    r = featurize(df, projection_model(12, 2), "content", image_size=2).first()
    assert r.features is None and r.error.startswith("decode")


def test_dedupe_names_keeps_one_copy(spark):
    from lumisort.sinks.writers import dedupe_names
    df = spark.createDataFrame([("a.json", "y", "train", [1.0]), ("a.json", "x", "train", [2.0]),
                                ("a.json", "x", "train", [2.0]), ("a.json", "x", "test", [3.0]),
                                ("b.json", "x", "train", [4.0])],
                               "file_name string, label_name string, split string, features array<double>")
    got = sorted((r.split, r.file_name, r.label_name) for r in dedupe_names(df).collect())
    assert got == [("test", "a.json", "x"), ("train", "a.json", "x"), ("train", "b.json", "x")]
    clean = df.where("file_name = 'b.json'")
    assert dedupe_names(clean).count() == 1


def test_archives_are_unpacked_once_and_problems_reported(spark, tmp_dir, monkeypatch):
    import tarfile

    from lumisort.plans.raw_split import split_archives
    names = [f"Persian_{i}.jpg" for i in range(9)]
    archive(os.path.join(tmp_dir, "a.tar.gz"), names)
    with open(os.path.join(tmp_dir, "broken.tar.gz"), "wb") as f:
        f.write(b"\x1f\x8bnot a gzip stream")
    with tarfile.open(os.path.join(tmp_dir, "flat.tar.gz"), "w:gz") as tf:
        info = tarfile.TarInfo("no_root_1.jpg")
        info.size = 0
        tf.addfile(info)
    log = os.path.join(tmp_dir, "unpacked.log")
    original = SRC._explode_archives

    def counted(batches):
        def watched():
            for pdf in batches:
                with open(log, "a") as f:
                    f.writelines(f"{p}\n" for p in pdf["path"])
                yield pdf
        yield from original(watched())

    monkeypatch.setattr(SRC, "_explode_archives", counted)
    for k, again in enumerate((None, 0.3)):
        if os.path.exists(log):
            open(log, "w").close()
        out, problems = os.path.join(tmp_dir, f"layout{k}"), os.path.join(tmp_dir, f"problems{k}")
        df = split_archives(spark, tmp_dir, 0.6, out_path=out, rebalance_to=again, problems_path=problems)
        assert df.count() == 9
        seen = open(log).read().split()
        assert len(seen) == 3 and len(set(seen)) == 3
        reasons = {os.path.basename(r.archive): r.reason for r in spark.read.json(problems).collect()}
        assert set(reasons) == {"broken.tar.gz", "flat.tar.gz"} and reasons["flat.tar.gz"] == "no root folder"


def test_names_of_per_file_features(spark, tmp_dir):
    names = {"x [1]_2.json": "a b", "p+q_3.json": "c%41", "r_4.json": "plain"}
    for name, folder in names.items():
        os.makedirs(os.path.join(tmp_dir, folder))
        with open(os.path.join(tmp_dir, folder, name), "w") as f:
            f.write("[1.0, 2.0]")
    got = {r.file_name: r.folder for r in SRC.read_feature_json(spark, tmp_dir).collect()}
    assert got == names
