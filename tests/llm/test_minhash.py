import random
import re

import numpy as np
import pytest

from conftest import SF_SMALL
from llm.conftest import prose
from lumisort.llm import graph, minhash, queries


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) >= 5:
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute(rows):
    """{id: (size, component)} for distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(rows, got):
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id), r.doc_id


def test_near_copies_of_near_copies(spark):
    rng = random.Random(8)
    rows = []
    for group in range(6):
        base = prose(rng, 150).split()
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 7)):
                words[rng.randrange(len(words))] = prose(rng, 1) + "q"
            rows.append((rng.randrange(10**6) * 200 + len(rows), " ".join(words)))
    rows += [(1, "a b c"), (2, "A  b\tC"), (3, "a b d"), (4, ""), (5, None), (6, " \n"), (7, "a b c d e"), (8, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(rows, minhash.near_duplicates(df).collect())


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(rows, queries.QUERIES["op6_bbit_minhash"](spark, SF_SMALL).collect())


def test_estimate_is_collision_corrected():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 2**63, 600, np.uint64)
    for share in (0.2, 0.5, 0.9):
        n = int(600 * share)
        a = np.unique(np.concatenate([common[:n], rng.integers(0, 2**63, 600 - n, np.uint64)]))
        b = np.unique(np.concatenate([common[:n], rng.integers(0, 2**63, 600 - n, np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sig = minhash.signatures([a, b], 4096, 5)
        agree = (sig[0] == sig[1]).mean()
        assert (agree - 1 / 256) / (1 - 1 / 256) == pytest.approx(true, abs=0.04)


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(300, 301), (301, 302), (302, 300)]
    links += [(140, 259)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(links)
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for n in got} and set(got) == {n for a, b in links if a != b for n in (a, b)}


def test_odd_and_empty_tables(odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in by_id[2]] == [1, 1] and not by_id[2][0].kept and by_id[1][0].kept
    assert by_id[3][0].component_id == 3 and by_id[3][0].n_shingles == 0
    assert all(r.component_id is None and r.kept for r in by_id[None])
    assert minhash.near_duplicates(no_docs).count() == 0
