import random

import pytest

import strata.llm.components as C


@pytest.mark.parametrize("local", [200_000, 40])
def test_paths_stars_and_pairs(spark, monkeypatch, local):
    monkeypatch.setattr(C, "LOCAL", local)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(201, 200), (5, 5), (None, 7), (8, None)]
    random.Random(2).shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long").repartition(4)
    got = {r.node: r.component for r in C.components(df).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}


def test_random_graphs(spark, monkeypatch):
    monkeypatch.setattr(C, "LOCAL", 30)
    r = random.Random(4)
    edges = [(r.randrange(150), r.randrange(150)) for _ in range(120)]
    root = list(range(150))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = C.components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()
    assert {x.node: x.component for x in got} == want and len(got) == len(want)


def test_no_edges(spark):
    assert C.components(spark.createDataFrame([], "u long, v long")).collect() == []
