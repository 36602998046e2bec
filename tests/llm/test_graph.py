import random

import pytest

from lumisort.llm import graph


def brute(links):
    label = {x: x for p in links for x in p}
    while True:
        new = dict(label)
        for u, v in links:
            m = min(new[u], new[v])
            new[u] = new[v] = m
        if new == label:
            return label
        label = new


@pytest.mark.parametrize("local", [500_000, 3])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL_NODES", local)
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(1000, 1400)]
    star = [(5000, 5000 + i) for i in range(1, 300)]
    loose = [(rng.randrange(6000, 6300), rng.randrange(6000, 6300)) for _ in range(180)]
    links = [p if rng.random() < 0.5 else p[::-1] for p in path + star + loose]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.node: r.component for r in graph.components(df).collect()}
    assert got == brute([p for p in links if p[0] != p[1]])
    named = spark.createDataFrame([("b", "a"), ("c", "b"), ("z", "z")], "a string, b string")
    assert {r.node: r.component for r in graph.components(named).collect()} == {"a": "a", "b": "a", "c": "a"}
    assert graph.components(df.where("false")).collect() == []


def test_components_that_do_not_settle_raise(spark, monkeypatch):
    monkeypatch.setattr(graph, "local_forests", lambda links: links)
    df = spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long")
    with pytest.raises(RuntimeError):
        graph.components(df, max_rounds=1)
