"""The manifest against a plain loop over all documents."""
import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidewire.llm import common, merkle
from tidewire.llm.common import lower_ascii

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def spell(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def rise(nodes, arity):
    """Levels of a tree from its leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def expected(rows, arity):
    lower = str.maketrans(common.UPPER, common.LOWER)
    forge = lambda r: r[4].translate(lower) if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4]
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, h(*map(spell, r)), h(*map(spell, r[:4]), spell(forge(r))), r[0]))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: rise([x[2] for x in sorted(by[s])], arity) for s in order}
    top = rise([trees[s][-1][0] for s in order], arity)
    out = []
    for place, s in enumerate(order):
        for i, x in enumerate(sorted(by[s])):
            siblings, node = [], x[3]
            for levels, at in ((trees[s], i), (top, place)):
                for level in levels[:-1]:
                    run = level[at // arity * arity :][:arity]
                    left, right = run[: at % arity], run[at % arity + 1 :]
                    siblings += left + right
                    node, at = h(*left, node, *right), at // arity
            out.append((x[4], x[2], trees[s][-1][0], top[-1][0], h(*siblings), node, node == top[-1][0]))
    return sorted(out, key=str)


def rows_of(n, sources, seed):
    rng = random.Random(seed)
    texts = [None, "", "Mixed Case", "é ß", "x" * 5000, "plain"]
    return [(rng.choice([None, *range(n)]), rng.choice(sources), rng.choice([None, "en"]), rng.choice([None, 1, 22]), rng.choice(texts)) for _ in range(n)]


def found(df, arity=16):
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.verified_rows(df, F.when(marked, lower_ascii(F.col("text"))), arity)
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize(("n", "sources", "arity"), [
    (1, ["a"], 16), (3, [None], 16), (300, ["a"], 16), (700, ["hot"] * 9 + [None, "", "a", "é", "=", "-"], 16), (400, [f"s{i}" for i in range(120)], 4), (60, ["a", "b"], 2),
])
def test_manifest_equals_a_loop(spark, monkeypatch, n, sources, arity):
    monkeypatch.setattr(common, "RANGE_ROWS", 1)  # many ranges, several rounds
    monkeypatch.setattr(common.math, "isqrt", lambda n: 3)
    rows = rows_of(n, sources, n)
    clash = [F.lit(i).alias(c) for i, c in enumerate(("tree", "idx", "path", "__range", "leaf", "root", "skey"))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *clash)
    assert found(df, arity) == expected(rows, arity)


def test_rows_that_are_alike(spark, monkeypatch):
    monkeypatch.setattr(common, "RANGE_ROWS", 1)
    monkeypatch.setattr(common.math, "isqrt", lambda n: 4)
    rows = [(5, "a", "en", 4, "Same")] * 200 + [(None, None, None, None, None)] * 90 + rows_of(50, ["a", "b"], 3)
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows, 16)


def test_no_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_fragments_merge_in_any_order():
    """The monoid: however fragments are grouped, the same runs and the same root come out."""
    rng = random.Random(8)
    sizes = [1, 40, 300]
    nodes = [(t, n, 0, i, sha256(b"%d %d" % (t, i)).digest()) for t, n in enumerate(sizes) for i in range(n)]
    whole, left = merkle.settle(nodes, len(sizes))
    assert len(left) == 1 and left[0][0] == merkle.TOP
    for _ in range(5):
        rng.shuffle(nodes)
        runs, open_ = [], []
        for part in [nodes[i::7] for i in range(7)]:
            r, open_ = merkle.settle([*open_, *part], len(sizes)) if rng.random() < 0.5 else (lambda a, b: (a[0] + b[0], b[1]))(a := merkle.settle(part, len(sizes)), merkle.settle([*open_, *a[1]], len(sizes)))
            runs += r
        assert sorted(runs) == sorted(whole) and open_ == left
