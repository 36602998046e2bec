import hashlib
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lumisort.llm import exact, queries
from lumisort.session import CONF_BROADCAST_MAX_ROWS


def brute(rows, keep="largest"):
    """(doc_id, text) -> sorted result rows; the first of equal ids stays."""
    best = {}
    groups = {}
    for i, (d, t) in enumerate(rows):
        t = t or ""
        groups.setdefault(t, []).append(i)
        sign = 1 if keep == "largest" else -1
        rank = (d is not None, sign * (d or 0), -i)
        if t not in best or rank > best[t][0]:
            best[t] = (rank, i)
    out = []
    for i, (d, t) in enumerate(rows):
        t = t or ""
        b = best[t][1]
        out.append((d, rows[b][0], len(groups[t]), i == b, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=["200000", "1"])
def limit(spark, request):
    """Both join plans: groups broadcast, groups joined by key with hot ones broadcast."""
    spark.conf.set(CONF_BROADCAST_MAX_ROWS, request.param)
    yield
    spark.conf.unset(CONF_BROADCAST_MAX_ROWS)


def copies(n=900):
    rng = random.Random(4)
    texts = [f"text {i}" for i in range(300)] + ["", None, "Text 1", "text 1 ", "té\U0001f600", "a\x00b"]
    return [(i, "hot" if rng.random() < 0.4 else rng.choice(texts)) for i in rng.sample(range(5 * n), n)]


@pytest.mark.parametrize("keep", exact.KEEP)
def test_against_brute_force(spark, limit, keep):
    rows = copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(exact.exact_groups(df, keep=keep)) == brute(rows, keep)


def test_colliding_hashes_are_told_apart(spark, limit):
    rows = copies(400)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for weak in (lambda t: F.unhex(F.substring(F.md5(t), 1, 2)), lambda t: F.lit(b"x")):
        assert result(exact.exact_groups(df, content_hash=weak)) == brute(rows)
        left = exact.drop_exact_duplicates(df, content_hash=weak)
        assert sorted(r.doc_id for r in left.collect()) == sorted(r[0] for r in brute(rows) if r[3])


def test_odd_rows(odd_docs, no_docs, limit):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(exact.exact_groups(odd_docs)) == brute(rows)
    left = exact.drop_exact_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    kept = sorted(((r.doc_id, r.text or "") for r in left.collect()), key=repr)
    want = {t or "": 0 for _, t in rows}
    assert len(kept) == len(want) and {t for _, t in kept} == set(want)
    assert (2, rows[0][1]) in kept  # repeated rows of the largest id: one stays
    for f in (exact.exact_groups, exact.drop_exact_duplicates):
        assert f(no_docs).collect() == []


def test_normalised_texts(spark):
    df = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact.exact_groups(df, normalise=F.lower).collect()}
    assert got == {1: (2, False), 2: (2, True), 3: (3, True)}
    with pytest.raises(ValueError):
        exact.exact_groups(df, keep="first")


def test_plan_is_native(spark):
    out = queries.op11_exact_groups(spark, SF_SMALL)
    plan = out._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
    rows = [(r.doc_id, r.text) for r in queries.read_table(spark, SF_SMALL, "documents").collect()]
    assert result(out) == brute(rows)
