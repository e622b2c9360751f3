"""Each query against its SQL on the smallest tables, and the merge rule against a plain loop."""
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewire.operators import cluster, merge
from tidewire.plans.oracle import SQL
from tidewire.plans.queries import QUERIES

DIR = "/root/testdata/sf0.001"
FAST = [q for q in QUERIES if q in SQL]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "events", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query(spark, duck, name):
    a, b = QUERIES[name](spark, DIR).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    tidy = lambda x: x[sorted(x.columns)].convert_dtypes().astype(str).sort_values(sorted(x.columns)).values.tolist()
    assert tidy(a) == tidy(b)


def test_merge_equals_a_loop(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "omega"]

    def rows(n, tag):
        return [(f"{rng.randrange(16 ** 4):04x}{tag}", "".join(rng.choice(words) for _ in range(6)), float(rng.choice([1, 2])), rng.randrange(10)) for _ in range(n)]

    old, new = rows(12, "a"), rows(40, "b")
    new += [(old[0][0], "other title", 2.0, 3), (new[0][0], new[1][1], 1.0, 0)]
    make = lambda r: spark.createDataFrame(r, "id string, norm string, source_weight double, t long").withColumn("at", F.timestamp_seconds("t")).withColumn("first_seen_at", F.col("at"))
    got = {r["id"]: r["target"] for r in merge.match(make(old), make(new)).collect()}
    g = lambda t: {t[i : i + 3] for i in range(len(t) - 2)}
    dup = lambda a, b: a == b or (min(len(a), len(b)) >= 0.7 * max(len(a), len(b)) and len(g(a) & g(b)) / min(len(g(a)), len(g(b))) >= 0.9)
    alive, want = sorted(old, key=lambda r: (r[3], r[0]), reverse=True), {}
    for r in sorted(new, key=lambda r: (-r[2], -r[3], r[0])):
        if r[0] in want:
            continue
        if any(r[0] == o[0] for o in old):
            want[r[0]] = r[0]
            continue
        exact, near = [o for o in alive if o[1] == r[1]], [o for o in alive if dup(o[1], r[1])]
        want[r[0]] = (exact or near or [r])[0][0]
        if want[r[0]] == r[0]:
            alive.append(r)
    assert got == want


def test_near_duplicates_share_frequent_grams(spark):
    """All pairs by brute force; far more titles than MAX_POSTINGS have each gram."""
    rng = random.Random(6)
    base = "".join(rng.choice("abcdefgh") for _ in range(60))
    rows = {}
    for i in range(300):
        t = list(base[: rng.randrange(25, 61)])
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice("abcxyz")
        rows.setdefault("".join(t), i)
    rows |= {"ab": 400, "abc": 401, "aaaaaaa": 402, "aaaaaaaaaa": 403, "aaaaaaaaaaa": 404}
    g = {t: {t[k : k + 3] for k in range(len(t) - 2)} or {t} for t in rows}
    near = lambda a, b: min(len(a), len(b)) >= 0.7 * max(len(a), len(b)) and len(g[a] & g[b]) / min(len(g[a]), len(g[b])) >= 0.9
    want = {(rows[a], rows[b]): len(g[a] & g[b]) / min(len(g[a]), len(g[b])) for a in rows for b in rows if rows[a] < rows[b] and near(a, b)}
    got = cluster.near_duplicate_titles(spark.createDataFrame([(i, t) for t, i in rows.items()], "id long, norm string")).collect()
    assert {(r["a"], r["b"]): r["containment"] for r in got} == want and len(got) == len(want)


def test_near_edges_do_not_shuffle_titles(spark):
    """Titles that share all their grams: no title goes along with its grams."""
    rng = random.Random(8)
    grams = ["the", "tion", "and", "ing", "ent", "her", "for", "tha", "nth", "int"]
    titles = ["".join(rng.choice(grams) for _ in range(90)) for _ in range(60)]
    titles += [t + "x" for t in titles[:20]]
    heads = spark.createDataFrame([((-i,), t) for i, t in enumerate(titles)], "key struct<o: long>, norm string")
    edges = merge._near_edges(heads)
    assert {(-60 - i, -i) for i in range(20)} <= {(r["a"]["o"], r["b"]["o"]) for r in edges.collect()}
    assert "norm" not in edges._jdf.queryExecution().executedPlan().toString()
