import random

import pytest

from textengine.llm import components as C


def brute(links):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for u, v in links:
        a, b = sorted((root(u), root(v)))
        up[b] = a
    return {x: root(x) for x in up}


def links_of(kind):
    rng = random.Random(kind)
    if kind == "chain":
        order = rng.sample(range(-200, 200), 400)
        return list(zip(order, order[1:], strict=False))
    if kind == "star":
        return [(7, k) for k in range(8, 300)] + [(k, 500 + k) for k in range(20)]
    return [(rng.randrange(500), rng.randrange(500)) for _ in range(300)] + [(5, 5), (1, 2), (2, 1), (1, 2)]


@pytest.mark.parametrize("most", [500_000, 12])
@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components_match_union_find(spark, monkeypatch, kind, most):
    """With 12 links a task the steps between tasks do the work."""
    monkeypatch.setattr(C, "TASK_LINKS", most)
    links = links_of(kind)
    df = spark.createDataFrame(links, "u long, v long").repartition(7)
    got = {r.node: r.root for r in C.components(df).collect()}
    assert got == {k: v for k, v in brute([(u, v) for u, v in links if u != v]).items()}


def test_empty_and_unfinished(spark, monkeypatch):
    assert C.components(spark.createDataFrame([], "u long, v long")).count() == 0
    monkeypatch.setattr(C, "TASK_LINKS", 12)
    with pytest.raises(RuntimeError):
        C.components(spark.createDataFrame(links_of("chain"), "u long, v long").repartition(7), most_rounds=1)
