import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from lumisort.llm import mixing, queries


def test_rates_meet_the_targets_and_match_dense_descent(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    t = rng.integers(1, 500, 400)
    members = spark.createDataFrame([(i, int(n), q.tolist()) for i, (n, q) in enumerate(zip(t, p))],
                                    "doc_id long, tokens long, posterior array<double>")
    targets = {"a": 0.6, "b": 0.3, "c": 0.1}
    rate, report = mixing.fit_rates(members, ["a", "b", "c"], targets, steps=25)
    got = np.array([r.rate for r in members.withColumn("rate", rate).orderBy("doc_id").collect()])
    assert (got >= 0).all()
    expected = (got * t) @ p
    for k, name in enumerate("abc"):
        assert expected[k] == pytest.approx(report["expected"][name], rel=1e-9)
    goal = np.array([report["targets"][x] for x in "abc"])
    assert goal / goal.sum() == pytest.approx([0.6, 0.3, 0.1])
    # the same objective by a dense descent to convergence
    whole, ridge, r = goal.sum(), 1e-3, np.ones(400)
    curve = (p * t[:, None]).T @ p / whole
    size = 1 / (np.linalg.eigvalsh(curve).max() + ridge)
    for _ in range(25):
        r = np.maximum(0, r - size * (p @ ((r * t) @ p - goal) / whole) - size * ridge * (r - 1))
    assert got == pytest.approx(r, abs=2e-2)
    assert np.abs(expected - goal).max() < 0.1 * whole and np.abs(expected - goal).max() < 0.5 * np.abs(t @ p - goal).max()


@pytest.mark.parametrize("shares", [(0.8, 0.17, 0.03), (0.97, 0.02, 0.01)])
def test_scarce_domains_reach_the_converged_optimum(spark, shares):
    n, ridge = 2000, 1e-3
    label = np.random.default_rng(1).choice(3, n, p=shares)
    p = np.full((n, 3), 0.015)
    p[np.arange(n), label] = 0.97
    members = spark.createDataFrame([(i, 100, q.tolist()) for i, q in enumerate(p)],
                                    "doc_id long, tokens long, posterior array<double>")
    rate, report = mixing.fit_rates(members, ["clean", "low", "toxic"], queries.MIX_TARGETS, stretch=queries.MIX_STRETCH)
    got = np.array([r.rate for r in members.withColumn("rate", rate).orderBy("doc_id").collect()])
    goal = np.array([report["targets"][x] for x in ("clean", "low", "toxic")])
    whole, r, t = goal.sum(), np.ones(n), np.full(n, 100.0)
    size = 1 / (np.linalg.eigvalsh((p * t[:, None]).T @ p / whole).max() + ridge)
    for _ in range(20_000):  # dense descent until nothing moves
        r = np.maximum(0, r - size * (p @ ((r * t) @ p - goal) / whole) - size * ridge * (r - 1))
    assert got == pytest.approx(r, abs=1e-3)
    assert (got * t) @ p == pytest.approx([report["expected"][x] for x in ("clean", "low", "toxic")], rel=1e-9)
    assert (got * t) @ p == pytest.approx(goal, rel=0.06)  # what is left is the ridge's


def test_query(spark):
    got = queries.QUERIES["op3_soft_mixing"](spark, SF_CHECK)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = queries.label_domains(spark.read.parquet(f"{SF_CHECK}/labels.parquet")).withColumnRenamed("domain", "true")
    assert got.count() == docs.count() and got.where("rate < 0 or membership < 0 or membership > 1").count() == 0
    mean = {r["true"]: r["rate"] for r in got.join(labels, "doc_id").groupBy("true").agg(F.avg("rate").alias("rate")).collect()}
    assert mean["clean"] > 0.95 and mean["toxic"] < 0.5 * mean["clean"] and mean["low"] < mean["clean"]


def test_odd_and_empty_tables(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, "x"), (7, "y"), (8, None), (None, "x"), (99, "x")], "doc_id long, domain string")
    rates, report = mixing.mixing_rates(odd_docs, labels, {"x": 0.5, "y": 0.5})
    got = rates.collect()
    assert len(got) == odd_docs.count() and report["domains"] == ["x", "y"] and all(r.rate >= 0 for r in got)
    assert mixing.mixing_rates(no_docs, labels, {"x": 1.0})[0].count() == 0
    rates, report = mixing.mixing_rates(odd_docs, labels.where("false"), {"x": 1.0})
    assert {r.rate for r in rates.collect()} == {1.0} and report["steps"] == 0
    rates, _ = mixing.mixing_rates(odd_docs, labels, {"other": 1.0})
    assert {r.rate for r in rates.collect()} == {1.0}


@pytest.mark.parametrize("shares", [(0.8, 0.17, 0.03), (0.97, 0.02, 0.01), (0.3, 0.3, 0.4)])
def test_projected_gradients_reach_the_minimum(spark, shares):
    """Rates and totals of the descent against a dense one to convergence."""
    rng = np.random.default_rng(3)
    n, ridge = 1500, 1e-3
    p = 0.1 * rng.dirichlet([0.5] * 3, n) + 0.9 * np.eye(3)[rng.choice(3, n, p=shares)]
    t = rng.integers(0, 400, n)
    members = spark.createDataFrame([(i, int(x), q.tolist()) for i, (x, q) in enumerate(zip(t, p))],
                                    "doc_id long, tokens long, posterior array<double>")
    names = ["clean", "low", "toxic"]
    rated, report = mixing.descend_rates(members, names, queries.MIX_TARGETS, stretch=queries.MIX_STRETCH)
    got = np.array([r.rate for r in rated.orderBy("doc_id").collect()])
    goal, whole = np.array([report["targets"][x] for x in names]), sum(report["targets"].values())
    top = np.linalg.eigvalsh((p * t[:, None]).T @ p / whole).max() + ridge
    push = (1 - (ridge / top) ** 0.5) / (1 + (ridge / top) ** 0.5)
    best = y = np.ones(n)
    for _ in range(20_000):
        new = np.maximum(0, y - (p @ ((y * t) @ p - goal) / whole + ridge * (y - 1)) / top)
        y, best = new + push * (new - best), new

    def objective(r):
        return (((r * t) @ p - goal) ** 2).sum() / whole ** 2 + ridge * (t * (r - 1) ** 2).sum() / whole

    assert (got >= 0).all() and objective(got) <= objective(best) * 1.0002
    assert got == pytest.approx(best, abs=0.1) and np.abs(got - best).mean() < 5e-3
    assert (got * t) @ p == pytest.approx([report["expected"][x] for x in names], rel=1e-9)
    assert (np.abs((got - best) * t @ p) < 0.012 * goal).all()
