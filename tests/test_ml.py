"""Linear SVM / logistic regression on the embeddings problems."""

import os

from pyspark.sql import functions as F

from lumisort.operators import split as S
from lumisort.operators.models import load_model, predict, save_model, train_logreg, train_svm
from lumisort.operators.problems import select_problem
from lumisort.plans.evaluate import evaluate
from lumisort.sources.samples import embeddings_samples

from conftest import SF_SMALL


def problem(spark):
    s = S.split_positional(embeddings_samples(spark, SF_SMALL, with_split=False), 0.6)
    return select_problem(s, "Persian", "Ragdoll", "ovo").cache()


def test_solvers_agree(spark):
    p = problem(spark)
    tr = p.where(F.col("split") == "train")
    a = train_svm(tr, solver="owlqn")
    b = train_svm(tr, solver="sgd")
    pa = {r.file_name: r.prediction for r in predict(a, tr).collect()}
    pb = {r.file_name: r.prediction for r in predict(b, tr).collect()}
    same = sum(pa[k] == pb[k] for k in pa) / len(pa)
    assert same >= 0.99


def test_evaluate_row_and_accuracy(spark):
    s = S.split_positional(embeddings_samples(spark, SF_SMALL, with_split=False), 0.6)
    row, m = evaluate(s, "Persian", "Ragdoll", "ovo")
    r = row.first()
    assert r.n_test > 0 and r.accuracy == 100.0 * (r.tp + r.tn) / r.n_test
    assert 0.0 <= r.accuracy <= 100.0
    ova, _ = evaluate(s, "Persian", None, "yes", model="logreg")
    assert ova.first().class0 == "all"


def test_save_load_same_predictions(spark, tmp_dir):
    p = problem(spark)
    tr = p.where(F.col("split") == "train")
    for kind, m in (("svm", train_svm(tr)), ("logreg", train_logreg(tr)), ("svm_sgd", train_svm(tr, solver="sgd"))):
        path = os.path.join(tmp_dir, kind)
        assert save_model(m, path) is True
        assert save_model(m, path) is False  # kept: saved only if absent
        m2 = load_model(path, kind)
        a = [r.prediction for r in predict(m, p).orderBy("file_name").collect()]
        b = [r.prediction for r in predict(m2, p).orderBy("file_name").collect()]
        assert a == b


def test_prediction_engines_agree(spark):
    p = problem(spark)
    tr = p.where(F.col("split") == "train")
    for m in (train_svm(tr), train_logreg(tr)):
        a = {r.file_name: (r.prediction, round(r.margin, 9)) for r in predict(m, p, engine="sql").collect()}
        b = {r.file_name: (r.prediction, round(r.margin, 9)) for r in predict(m, p, engine="ml").collect()}
        assert a == b
    # NULL vectors: NULL margin and prediction on both engines
    s = S.split_positional(embeddings_samples(spark, SF_SMALL, with_split=False), 0.6)
    m = train_svm(tr)
    for eng in ("sql", "ml"):
        nulls = predict(m, s.where(F.col("features").isNull()), engine=eng).collect()
        assert nulls and all(r.prediction is None and r.margin is None for r in nulls)


def test_grid_both_stagings(spark):
    from lumisort.plans.grid import grid_table, run_grid
    s = S.split_positional(embeddings_samples(spark, SF_SMALL, with_split=False), 0.8)
    import glob
    from lumisort.session import checkpoint_root
    a = run_grid(s, ["Persian", "Ragdoll", "Siamese"], [0.3, 0.6], parallelism=3, materialize=True, iterations=20)
    root = checkpoint_root(spark).replace("file:", "")
    assert not glob.glob(os.path.join(root, "grid-vectors-*"))  # the staged copy is removed
    b = run_grid(s, ["Persian", "Ragdoll", "Siamese"], [0.3, 0.6], parallelism=3, materialize=False, iterations=20)
    ka = sorted((r.class1, r.class0, r.train_test, r.n_train, r.n_test) for r in a.collect())
    kb = sorted((r.class1, r.class0, r.train_test, r.n_train, r.n_test) for r in b.collect())
    assert ka == kb and len(ka) == 6
    t = grid_table(a, [0.3, 0.6])
    assert t.columns == ["class1", "class0", "0.3/0.7", "0.6/0.4"] and t.count() == 3


def test_grid_every_second_file(spark):
    from lumisort.plans.grid import run_grid
    s = S.split_positional(embeddings_samples(spark, SF_SMALL, with_split=False), 0.8)
    full = run_grid(s, ["Persian", "Ragdoll"], [0.6], iterations=10, materialize=False).first()
    half = run_grid(s, ["Persian", "Ragdoll"], [0.6], iterations=10, materialize=False, sample_every=2).first()
    assert half.n_train + half.n_test < full.n_train + full.n_test
    assert abs(2 * (half.n_train + half.n_test) - (full.n_train + full.n_test)) <= 6


def test_one_class_train_set_gives_a_row(spark):
    rows = [(f"a_{i}.json", "a", "train" if i < 6 else "test", [float(i), 1.0]) for i in range(10)]
    rows += [(f"b_{i}.json", "b", "test", [float(-i), 1.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "file_name string, label_name string, split string, features array<double>")
    row, model = evaluate(df, "a", "b", "ovo")
    r = row.first()
    assert model is None and r.accuracy is None and r.n_train == 6 and r.n_test == 8 and "one class" in r.note


def test_grid_modes(spark):
    import pytest

    from lumisort.plans.grid import score_grid
    from lumisort.operators.models import LinearModel
    rows = [(f"{c}_{i}.json", c, "train" if i % 2 else "test", [float(i), 1.0]) for c in "abc" for i in range(10)]
    df = spark.createDataFrame(rows, "file_name string, label_name string, split string, features array<double>")
    model = LinearModel([1.0, -4.0], 0.0, "svm")
    ovo = score_grid(df, model, ["a", "b"], [0.5], mode="onevsone").collect()
    assert [(r.class1, r.class0, r.n_test) for r in ovo] == [("a", "b", 10)]
    ova = score_grid(df, model, ["a", "b"], [0.5], mode="yes").collect()
    assert sorted((r.class1, r.class0, r.n_test) for r in ova) == [("a", "all", 15), ("b", "all", 15)]
    with pytest.raises(ValueError):
        score_grid(df, model, ["a", "b"], [0.5], mode="typo")


def test_score_grid_scans_vectors_once(spark, tmp_dir):
    import os

    from lumisort.operators.models import LinearModel
    from lumisort.plans.grid import score_grid
    rows = [(f"{c}_{i}.json", c, "train" if i % 2 else "test", [float(i), 1.0]) for c in "abc" for i in range(10)]
    path = os.path.join(tmp_dir, "v")
    spark.createDataFrame(rows, "file_name string, label_name string, split string, features array<double>").write.parquet(path)
    out = score_grid(spark.read.parquet(path), LinearModel([1.0, -4.0], 0.0, "svm"), ["a", "b", "c"], [0.3, 0.6, 0.9])
    assert "features" not in out._jdf.queryExecution().executedPlan().toString()
