"""Split resolution, skip-existing, pairs, counts, accuracy and pivot."""


from lumisort.operators import aggregates as A
from lumisort.operators import joins as J


def test_train_wins_even_with_null_features(spark):
    tr = spark.createDataFrame([("a.json", None), ("b.json", [1.0])], "file_name string, features array<double>")
    te = spark.createDataFrame([("a.json", [2.0]), ("c.json", [3.0])], "file_name string, features array<double>")
    got = sorted((r.file_name, r.split, r.features) for r in J.resolve_split(tr, te).collect())
    assert got == [("a.json", "train", None), ("b.json", "train", [1.0]), ("c.json", "test", [3.0])]


def test_unreadable_train_copy_loses(spark):
    tr = spark.createDataFrame([("a.json", None, False), ("b.json", None, True)],
                               "file_name string, features array<double>, readable boolean")
    te = spark.createDataFrame([("a.json", [2.0], True), ("b.json", [3.0], True)],
                               "file_name string, features array<double>, readable boolean")
    got = sorted((r.file_name, r.split) for r in J.resolve_split(tr, te, valid_col="readable").collect())
    assert got == [("a.json", "test"), ("b.json", "train")]


def test_skip_existing(spark):
    df = spark.createDataFrame([("a.json",), ("b.json",)], "file_name string")
    ex = spark.createDataFrame([("b.json",)], "file_name string")
    assert [r[0] for r in J.skip_existing(df, ex).collect()] == ["a.json"]


def test_pairs_and_grid(spark):
    pairs = J.class_pairs(spark, ["Ragdoll", "Siamese", "Persian", "Egyptian_Mau"])
    got = [(r.class1, r.class0) for r in pairs.orderBy("pair_idx").collect()]
    assert got == [("Ragdoll", "Siamese"), ("Ragdoll", "Persian"), ("Ragdoll", "Egyptian_Mau"),
                   ("Siamese", "Persian"), ("Siamese", "Egyptian_Mau"), ("Persian", "Egyptian_Mau")]
    g = J.grid_points(pairs, [0.3, 0.6, 0.9])
    assert g.count() == 18
    assert sorted({r.train_test for r in g.collect()}) == ["0.3/0.7", "0.6/0.4", "0.9/0.1"]


def test_counts_and_sizes(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "test"), ("a", "train"), ("b", "test")],
                               "label_name string, split string")
    sc = {r.label_name: (r.n_train, r.n_test) for r in A.split_counts(df).collect()}
    assert sc == {"a": (2, 1), "b": (0, 1)}
    s = A.set_sizes(df).first()
    assert (s.n_train, s.n_test, s.n_total) == (2, 2, 4) and s.train_pct == 50.0


def test_accuracy_equals_tp_tn(spark):
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 1.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    a = A.accuracy(df).first()
    t = A.tp_tn(df).first()
    assert a.accuracy == 60.0 and (t.tp + t.tn) / t.n * 100 == a.accuracy


def test_pivot(spark):
    res = spark.createDataFrame(
        [("A", "B", "0.3/0.7", 50.0), ("A", "B", "0.6/0.4", 60.0), ("A", "C", "0.3/0.7", 70.0)],
        "class1 string, class0 string, train_test string, accuracy double")
    p = A.accuracy_pivot(res, [0.3, 0.6, 0.9])
    assert p.columns == ["class1", "class0", "0.3/0.7", "0.6/0.4", "0.9/0.1"]
    rows = [tuple(r) for r in p.collect()]
    assert rows == [("A", "B", 50.0, 60.0, None), ("A", "C", 70.0, None, None)]


def test_names_by_label_long_form(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", "c")], "label_name string, file_name string")
    got = sorted(tuple(r) for r in A.names_by_label(df).collect())
    assert got == [("x", "a", 1), ("x", "b", 2), ("y", "c", 1)]
