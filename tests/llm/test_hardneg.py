import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lumisort.llm import hardneg, queries
from lumisort.session import CONF_BROADCAST_MAX_ROWS


def brute(rows, anchor, n_pos=5, n_neg=3):
    """(id, label, vector) -> sorted result rows, with Python's integers."""
    good = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, l, v in rows
            if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in good:
        if not anchor(a[0]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r) for r in good if len(r[2]) == len(a[2]))
        pos = [x for x in scored if x[2][1] == a[1] and x[2] != a][:n_pos]
        for s, i, _ in pos:
            neg = [x for x in scored if x[2][1] != a[1] and 50 * -s <= 100 * -x[0] <= 95 * -s][:n_neg]
            out += [(a[0], i, k + 1, x[1], -s, -x[0]) for k, x in enumerate(neg)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def clusters(rng, n=600, d=24):
    centres = rng.normal(size=(6, d))
    which = rng.integers(0, 6, n)
    x = centres[which] * rng.choice([0.5, 1, 2], (n, 1)) + rng.normal(size=(n, d)) * 0.3
    x[100:300] = x[100]  # a hot vector, under two labels
    x[310:315] = 0
    label = np.where(rng.random(n) < 0.7, which, rng.integers(0, 6, n))
    label[100:300] = rng.integers(0, 2, 200)
    return [(int(i), int(l), v.tolist()) for i, l, v in zip(rng.permutation(n) * 3, label, x.astype(np.float32))]


SCHEMA = "vec_id long, label int, embedding array<float>"
def tenth():
    return F.col("vec_id") % 10 == 0



@pytest.mark.parametrize("limit", ["200000", "1"])
def test_against_brute_force(spark, limit):
    rows = clusters(np.random.default_rng(3))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 300
    spark.conf.set(CONF_BROADCAST_MAX_ROWS, limit)
    try:
        assert result(hardneg.hard_negatives(df, anchor=tenth())) == want
        # many batches of anchors, few references, a small sample
        small = hardneg.hard_negatives(df, anchor=tenth(), anchor_bytes=2_000, references=2, sample_rows=20)
        assert result(small) == want
    finally:
        spark.conf.unset(CONF_BROADCAST_MAX_ROWS)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    rows = [(i, i % 3, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    rows += [(i, i % 3, [float(x) for x in rng.normal(size=3)]) for i in range(60, 90)]  # another length
    rows += [rows[0], rows[0], (0, 0, [1.0, 2.0, 0.5, 0.0]), (0, 1, [1.0, 2.0, 0.5, 0.0])]  # repeated rows, one id twice
    rows += [(100, None, [1.0] * 4), (110, 1, None), (120, 1, [1.0, None, 1.0, 1.0]), (130, 1, [nan] * 4), (140, 1, [inf] * 4),
             (150, 1, []), (None, 1, [1.0] * 4), (160, 0, [0.0] * 4), (170, 1, [0.0] * 4), (180, 2, [1e17] * 4), (190, 0, [1e17] * 4)]
    rows = [(*r, "x", "y", 7) for r in rows]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, key string, q string, own int")
    want = brute([r[:3] for r in rows if r[0] not in (180, 190)], lambda i: i % 10 == 0)
    assert result(hardneg.hard_negatives(df, anchor=tenth())) == want
    assert hardneg.hard_negatives(df.where("false"), anchor=tenth()).collect() == []
    assert hardneg.hard_negatives(df, anchor=F.lit(False)).collect() == []


def test_scores_beyond_float_precision(spark):
    rng = np.random.default_rng(7)
    rows = [(i, i % 2, [float(x) for x in rng.integers(-2 ** 22, 2 ** 22, 4)]) for i in range(80)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert any(x[4] > 2 ** 53 for x in want)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert result(hardneg.hard_negatives(df, anchor=tenth())) == want


def test_bounds_hold_and_skip(spark):
    rng = np.random.default_rng(9)
    q = np.floor(256 * np.array([r[2] for r in clusters(rng, 400, 16)]))
    norm = np.linalg.norm(q, axis=1)
    refs = hardneg.reference_directions(q, 10)
    angles = hardneg.angles_to(refs, q, norm)
    low, high = hardneg.score_bounds(*hardneg._between(angles, angles, angles), norm[:, None] * norm[None])
    score = q @ q.T
    assert (low <= score).all() and (score <= high).all()
    assert (high < 0.5 * norm[:, None] * norm[None]).mean() > 0.1  # the bounds do tell pairs apart


def test_query_on_given_table(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in queries.read_table(spark, SF_SMALL, "embeddings").collect()]
    assert result(queries.op13_angular_negatives(spark, SF_SMALL)) == brute(rows, lambda i: i % 50 == 0)
