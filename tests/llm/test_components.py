"""Connected components against a union-find on the driver."""

import random

import pytest

from helpers import union_find
from starloom.llm import components as comp


def edges_of(kind):
    rng = random.Random(3)
    return {
        "empty": [],
        "self": [(5, 5), (5, 5)],
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(1, 200)] + [(500, 3)] * 40,
        "random": [(rng.randrange(-150, 150), rng.randrange(-150, 150)) for _ in range(160)],
        "extremes": [(2**63 - 1, -2**63), (-2**63, 0), (7, 8)],
    }[kind]


@pytest.mark.parametrize("part", [4, 1 << 18])
@pytest.mark.parametrize("kind", ["empty", "self", "chain", "star", "random", "extremes"])
def test_components(spark, monkeypatch, kind, part):
    """Parts of four edges leave most of the work to the star rounds."""
    monkeypatch.setattr(comp, "FOREST_EDGES", part)
    edges = edges_of(kind)
    got = [tuple(r) for r in comp.components(spark.createDataFrame(edges, "a long, b long").repartition(8)).collect()]
    nodes = sorted({x for e in edges for x in e})  # so the smallest place is the smallest node
    place = {x: i for i, x in enumerate(nodes)}
    root, join = union_find(len(nodes))
    for a, b in edges:
        join(place[a], place[b])
    assert sorted(got) == [(x, nodes[root(place[x])]) for x in nodes]
