"""Components that are kept up to date against full builds."""
import random

from tidewire.operators.graph import connected_components, update_components
from tidewire.storage import Scratch

SCHEMA = "u long, v long"


def full(edges):
    of = {}

    def find(x):
        while of.setdefault(x, x) != x:
            x = of[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            of[max(a, b)] = min(a, b)
    return {x: find(x) for x in of}


def days(rng, n):
    """Edges of a sliding window of nodes: each day new ones come, old ones expire, some links go."""
    live, low = set(), 0
    for day in range(n):
        low += 25
        live = {(a, b) for a, b in live if min(a, b) >= low and rng.random() < 0.97}
        live |= {(rng.randrange(low, low + 150), rng.randrange(low, low + 150)) for _ in range(rng.choice([0, 12, 30]))}
        yield set(live)


def test_daily_batches_equal_full_builds(spark):
    before, labels = set(), spark.createDataFrame([], "node long, component long")
    scratch = Scratch(spark, "days")
    for now in days(random.Random(3), 6):
        noisy = [*now, *((b, a) for a, b in list(now)[:3]), (None, 1), (7, 7)]
        make = lambda e: spark.createDataFrame(list(e), SCHEMA)
        labels = update_components(labels, make(before), make(noisy), scratch)
        got = {r["node"]: r["component"] for r in labels.collect()}
        assert got == full(now)
        before = now


def test_nothing_is_left(spark):
    scratch = Scratch(spark, "none")
    edges, none = spark.createDataFrame([(1, 2), (2, 3)], SCHEMA), spark.createDataFrame([], SCHEMA)
    labels = connected_components(edges, "u", "v", scratch)
    assert update_components(labels, edges, none, scratch).count() == 0
    assert {tuple(r) for r in update_components(labels, edges, edges, scratch).collect()} == {(1, 1), (2, 1), (3, 1)}
