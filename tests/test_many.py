"""Many problems at once: solvers against Spark ML and MLlib, one-vs-rest against numpy, the grid against single fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lumisort.operators import many as M
from lumisort.operators.models import ModelBundle, train_svm
from lumisort.sources.samples import embeddings_samples

SCHEMA = "file_name string, label_name string, split string, features array<double>"


def rows(n=300, d=20, seed=1, classes="abcd"):
    """Unscaled, overlapping, imbalanced classes: hinge losses with many active rows at the optimum."""
    rng = np.random.default_rng(seed)
    centre = {c: rng.normal(size=d) * 2 for c in classes}
    out = []
    for i in range(n):
        c = classes[min(int(rng.exponential(1.2)), len(classes) - 1)]
        x = np.maximum(centre[c] + rng.normal(size=d) * 3, 0)
        out.append((f"{c}_{i}.json", c, "train" if i % 3 else "test", x.tolist()))
    return out


def objective(w, x, s, reg=0.1):
    return np.maximum(0, 1 - s * (x @ w)).mean() + reg / 2 * w @ w


def problem(data, c1, c0=None, split="train"):
    x = np.array([r[3] for r in data if r[2] == split and (c0 is None or r[1] in (c1, c0))])
    s = np.array([1 if r[1] == c1 else -1 for r in data if r[2] == split and (c0 is None or r[1] in (c1, c0))])
    return x, s


def test_bundle_reaches_the_optimum_of_every_problem(spark):
    data = rows(150, 6)
    df = spark.createDataFrame(data, SCHEMA).where("split = 'train'")
    posed = [M.Problem("a", "b"), M.Problem("a"), M.Problem("d"), M.Problem("b", "c"), M.Problem("x", "y"), M.Problem("zz")]
    models, sizes = M.train_many(M.tag_rows(df, M.problem_tags(posed)), len(posed), iterations=100, tolerance=1e-5)
    assert models[4] is None and models[5] is None and sizes[4].sum() == 0 and sizes[5, 1] == 0
    for p, m in list(zip(posed, models))[:4]:
        x, s = problem(data, p.class1, p.class0)
        ours = objective(np.array(m.weights), x, s)
        svc = train_svm(df.where(F.col("label_name").isin(p.class1, p.class0) if p.class0 else F.lit(True))
                        .withColumn("label", (F.col("label_name") == p.class1).cast("double")), iterations=25)
        assert ours <= objective(np.array(svc.weights), x, s) + 1e-4
        w = np.zeros(x.shape[1])  # a long descent doesn't get below either
        for t in range(1, 4000):
            w = w * (1 - 1 / t) + ((s * (x @ w) < 1) * s) @ x / len(s) / (0.1 * t)
        assert ours <= objective(w, x, s) + 1e-4


def test_sgd_is_mllibs(spark):
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint
    data = rows(150, 8, 3)
    df = spark.createDataFrame(data, SCHEMA).where("split = 'train'")
    posed = [M.Problem("a", "b"), M.Problem("c")]
    for step, iterations in ((1.0, 12), (0.01, 12)):
        models, _ = M.train_many(M.tag_rows(df, M.problem_tags(posed)), 2, iterations, solver="sgd", step=step)
        for p, m in zip(posed, models):
            x, s = problem(data, p.class1, p.class0)
            want = SVMWithSGD.train(spark.sparkContext.parallelize([LabeledPoint(int(y > 0), v) for v, y in zip(x, s)]),
                                    iterations=iterations, step=step, regParam=0.1, regType="l2")
            assert np.allclose(m.weights, want.weights.toArray(), rtol=1e-9, atol=1e-12)


def test_no_python_in_the_plans(spark):
    df = spark.createDataFrame(rows(60, 4), SCHEMA)
    data = M.tag_rows(df, M.problem_tags([M.Problem("a"), M.Problem("b", "c")]))
    scored = M.with_margins(data, np.ones((2, 4)))
    assert "Python" not in scored._jdf.queryExecution().toString()
    loss, grad = M.hinge_step(data, np.zeros((2, 4)))
    x, s = (np.concatenate([problem(rows(60, 4), "a", split=t)[k] for t in ("train", "test")]) for k in (0, 1))
    assert np.allclose(loss[0], 60) and np.allclose(grad[0], -(s[:, None] * x).sum(axis=0))


def test_prefix_tags_and_blocks(spark, monkeypatch):
    data = [("Siamese_1.json", "Siamese", "train", [1.0, 0.0]), ("Siamese_mix_2.json", "Siamese_mix", "train", [0.0, 1.0]),
            ("x_3.json", "x", "train", [1.0, 1.0]), ("y_4.json", "y", "train", None), ("z_5.json", None, "train", [0.5, 0.5])]
    df = spark.createDataFrame(data, SCHEMA)
    posed = [M.Problem("Siamese"), M.Problem("Siamese_mix", "x"), M.Problem("Siamese", "Siamese_mix")]
    def tags(match):
        out = df.select("file_name", M.problem_tags(posed, match).alias("t")).collect()
        return {r.file_name[:-5]: [tuple(t) for t in r.t] for r in out}
    assert tags("exact")["Siamese_mix_2"] == [(0, -1), (1, 1), (2, -1)] and tags("exact")["z_5"] == [(0, -1)]
    assert tags("prefix")["Siamese_mix_2"] == [(0, 1), (1, 1), (2, 1)]
    whole = M.hinge_step(M.tag_rows(df, M.problem_tags(posed)), np.zeros((3, 2)))
    monkeypatch.setattr(M, "BLOCK", 2)
    parts = M.hinge_step(M.tag_rows(df, M.problem_tags(posed)), np.zeros((3, 2)))
    assert all(np.allclose(a, b) for a, b in zip(whole, parts)) and whole[0].tolist() == [4, 2, 2]


def test_one_vs_rest_and_its_bundle(spark, tmp_dir):
    data = rows(240, 12, 5)
    df = spark.createDataFrame(data, SCHEMA)
    model = M.train_one_vs_rest(df.where("split = 'train'"), classes=["c", "a", "nobody", "b", "d"])
    assert model.classes == ["c", "a", "b", "d"]
    path = tmp_dir + "/ovr"
    assert ModelBundle.of(model).save(spark, path) and not ModelBundle.of(model).save(spark, path)
    bundle = ModelBundle.load(spark, path)
    assert bundle.mode == "ovr" and bundle.dimension == 12
    test = spark.createDataFrame([r for r in data if r[2] == "test"] + [("n_1", "a", "test", None), ("n_2", "a", "test", [1.0])], SCHEMA)
    got = {r.file_name: (r.predicted_class, r.margin) for r in bundle.predict(test).collect()}
    assert got["n_1"] == got["n_2"] == (None, None)
    for r in data:
        if r[2] == "test":
            margins = model.weights @ np.array(r[3])
            assert got[r[0]][0] == model.classes[int(np.argmax(margins))] and abs(got[r[0]][1] - margins.max()) < 1e-9
    single = M.train_one_vs_rest(df.where("label_name = 'a'"))
    assert {r.prediction for r in single.predict(test.where("size(features) = 12")).collect()} == {"a"}
    with pytest.raises(ValueError):
        M.train_one_vs_rest(df.where("false"))


def test_bundle_of_a_binary_model(spark, tmp_dir):
    df = spark.createDataFrame(rows(90, 5), SCHEMA).where("label_name in ('a', 'b')")
    model = train_svm(df.withColumn("label", (F.col("label_name") == "a").cast("double")))
    with pytest.raises(ValueError):
        ModelBundle.of(model)
    ModelBundle.of(model, ("b", "a")).save(spark, tmp_dir + "/m")
    bundle = ModelBundle.load(spark, tmp_dir + "/m")
    from lumisort.operators.models import predict
    want = {r.file_name: ("a" if r.prediction == 1.0 else "b") for r in predict(model, df).collect()}
    assert {r.file_name: r.predicted_class for r in bundle.predict(df).collect()} == want


def test_grid_together_equals_single_fits(spark):
    from lumisort.operators.split import split_positional
    from lumisort.plans.grid import run_grid
    s = split_positional(embeddings_samples(spark, SF_SMALL, with_split=False), 0.8)
    kw = {"classes": ["Persian", "Ragdoll", "nobody"], "cutoffs": [0.3, 0.6]}
    for extra in ({"mode": "ovo"}, {"mode": "ova", "sample_every": 2}):
        a, b = (sorted(map(tuple, run_grid(s, **kw, **extra, solver=x).collect())) for x in ("bundle", "owlqn"))
        assert a == b and any(r[-1] for r in a) and len(a) == 6
