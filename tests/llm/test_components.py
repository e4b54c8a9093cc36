"""Components against brute force, with one task and with several rounds."""

import random

import pytest

from waymesh.llm import components as c


@pytest.mark.parametrize("block", [500_000, 40])
def test_components(spark, monkeypatch, block):
    monkeypatch.setattr(c, "BLOCK", block)
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(300, 420), rng.randrange(300, 420)) for _ in range(70)] + [(7, 7), (900, 899), (899, 900)]
    got = {r.node: r.component for r in c.components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    up = {i: i for e in edges for i in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                up[a] = up[b] = min(up[a], up[b])
    assert got == up
    assert c.components(spark.createDataFrame([], "u long, v long")).collect() == []
