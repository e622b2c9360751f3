"""Similar sets and events against brute force."""
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewire.operators import cluster, graph, similar
from tidewire.storage import Scratch


def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def classes(pairs):
    """Node to the smallest node that it is connected with."""
    of = {}

    def find(x):
        while of.setdefault(x, x) != x:
            x = of[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        of[max(a, b)] = min(a, b)
    return {x: find(x) for x in of}


def random_sets(rng, n):
    """Families of similar sets of very different sizes over few members, and unrelated ones."""
    out = []
    while len(out) < n:
        base = rng.sample(range(400), rng.randrange(1, rng.choice([6, 40, 150])))
        for _ in range(rng.randrange(1, 12)):
            own = [m for m in base if rng.random() < 0.8] or base[:1]
            out.append(sorted({*own, *rng.sample(range(400), rng.randrange(len(base) // 3 + 1))}))
    return {f"{i:03d}": s for i, s in enumerate(out[:n])}


@pytest.mark.parametrize(("least", "long"), [(0.45, 4096), (0.8, 5), (1.0, 4096), (0.2, 7)])
def test_similar_sets(spark, monkeypatch, least, long):
    monkeypatch.setattr(similar, "LIST", long)
    monkeypatch.setattr(similar, "CELLS", 64)
    sets = random_sets(random.Random(int(least * 100)), 260)
    near = lambda a, b: len({*a} & {*b}) / len({*a} | {*b})
    want = {(a, b): near(sets[a], sets[b]) for a in sets for b in sets if a < b and near(sets[a], sets[b]) >= least}
    rows = [(i, [m * 0x9E3779B97F4A7C15 % (1 << 64) - (1 << 63) for m in s]) for i, s in sets.items()]
    scratch = Scratch(spark, "test")
    made = similar.rare_first(spark.createDataFrame([*rows, ("empty", []), ("null", None)], "id string, s array<long>"), scratch)
    got = {(r["a"], r["b"]): r["similarity"] for r in similar.similar_pairs(made, least, scratch).collect()}
    assert got == pytest.approx(want)
    links = {(r["a"], r["b"]) for r in similar.spanning_links(made, least, scratch).collect()}
    assert links <= set(want) and classes(links) == classes(want)


def articles(spark, titles):
    from tidewire.functions.grams import normalize_title

    rows = spark.createDataFrame([(f"{i:06d}", t, f"s{i % 3}") for i, t in enumerate(titles)], "id string, title string, source_id string")
    return rows.withColumn("norm", normalize_title(F.col("title"))).withColumn("at", now())


def brute(titles):
    """(a, b) of same events, as the predicate has it."""
    import re

    norm = [re.sub("[^0-9a-z]+", "", (t or "").lower()) for t in titles]
    gram = lambda t: {t[i : i + n] for n in (2, 3) for i in range(len(t) - n + 1)} if len(t) >= 3 else {t}
    names = [{e for e in re.findall(r"\b[A-Z][A-Za-z0-9]*\b", t or "") if len(e) > 1 and e not in cluster.C.ENTITY_STOP} for t in titles]
    df = Counter(e.lower() for n in names for e in n)
    rare = [{e for e in n if df[e.lower()] <= 3} for n in names]
    grams = [gram(t) for t in norm]
    same = lambda i, j: norm[i] and norm[j] and (len(grams[i] & grams[j]) / len(grams[i] | grams[j]) >= 0.45 or len(rare[i] & rare[j]) >= 2)
    return {(f"{i:06d}", f"{j:06d}") for i in range(len(titles)) for j in range(i + 1, len(titles)) if same(i, j)}


def test_events_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["Acme", "Borealis", "Corvus", "Delta", "engine", "model", "the", "launch", "of", "new", "reasoning", "chips", "Zeta9", "quarter"]
    titles = [" ".join(rng.choice(words) + rng.choice(["", "", str(rng.randrange(30))]) for _ in range(rng.randrange(1, 7))) for _ in range(220)]
    titles += ["", None, "!!", "ab", "ab", "a", "Quark Leptonix x", "zzzz Leptonix wwwwwwwwww vvvvvvvvvv Quark yyyyyyyyy"]
    a, want = articles(spark, titles), brute(titles)
    got = {(r["a"], r["b"]): r["reason"] for r in cluster.same_event_pairs(a, now()).collect()}
    assert set(got) == want and all(got.values())
    assert got["000226", "000227"] == "共同实体：Leptonix、Quark"
    links = {(r["a"], r["b"]) for r in cluster.event_links(a, now()).collect()}
    assert links <= want and classes(links) == classes(want)
    members = {r["id"]: r["cluster_id"] for r in cluster.event_members(a, cluster.event_links(a, now())).collect()}
    assert members == classes(want)
    capped = {(r["a"], r["b"]) for r in cluster.same_event_pairs(a, now(), most=3).collect()}
    assert capped < want


def test_a_family_costs_a_link_for_each_member(spark):
    """5,000 copies of one headline, 600 near copies of another, and strangers."""
    rng = random.Random(9)
    base = "Acme Borealis launches a new reasoning engine for the whole world"
    near = [f"{base} {rng.randrange(10 ** 6)}" for _ in range(600)]
    strange = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40)) for _ in range(300)]
    titles = ["One headline that all of them repeat word for word"] * 5000 + near + strange
    a = articles(spark, titles)
    links = cluster.event_links(a, now())
    assert links.count() < 3 * len(titles)
    sizes = Counter(r["cluster_size"] for r in cluster.event_members(a, links).select("cluster_id", "cluster_size").distinct().collect())
    assert sizes == {5000: 1, 600: 1}


def test_rare_names(spark):
    """A name that all rows have costs a row for each task."""
    rows = [(i, "The") for i in range(3000)] + [(i, f"Name{i // (i % 4 + 1)}") for i in range(900)] + [(7, "ONCE"), (8, "once"), (9, "Once")]
    found = spark.createDataFrame(rows, "id long, entity string").distinct().repartition(6)
    df = Counter(e.lower() for _, e in {*rows})
    want = sorted((i, e, df[e.lower()]) for i, e in {*rows} if df[e.lower()] <= 3)
    assert sorted(map(tuple, cluster.rare_entities(found, Scratch(spark, "test")).collect())) == want
    assert {r["entity"]: r["df"] for r in cluster.entity_counts(found).collect()} == df


def test_components_of_a_star_are_split(spark):
    """A hub that most edges have: its join is split, as the minimum is written before it."""
    edges = spark.range(60_000).select((F.col("id") + 1).alias("x"), F.when(F.col("id") % 3 == 0, F.col("id") + 2).otherwise(F.lit(0)).cast("long").alias("y"))
    got = graph.connected_components(edges, "x", "y", Scratch(spark, "test"))
    assert got.count() == 60_001 and got.where("component <> 0").isEmpty()
    small = {"autoBroadcastJoinThreshold": "-1", "adaptive.advisoryPartitionSizeInBytes": "4k", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "adaptive.skewJoin.skewedPartitionFactor": "1.1"}
    try:
        for k, v in small.items():
            spark.conf.set(f"spark.sql.{k}", v)
        scratch = Scratch(spark, "test")
        hub = scratch.table(spark.range(60_000).repartition(8).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("u"), F.col("id").alias("v")))
        joined = graph.with_least(hub, scratch)
        joined.write.format("noop").mode("overwrite").save()
        joined.count()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in small:
            spark.conf.unset(f"spark.sql.{k}")


def test_long_sets_over_few_members_are_dealt_few_times(spark, monkeypatch):
    """A set goes to each strip that it fits, however many members it has and others share."""
    monkeypatch.setattr(similar, "LIST", 50)
    rng = random.Random(2)
    rows = [(f"{i:03d}", rng.sample(range(600), rng.randrange(150, 400))) for i in range(400)]
    made = similar.rare_first(spark.createDataFrame(rows, "id string, s array<long>"), Scratch(spark, "test"))
    assert similar._dealt(made, 0.45).count() <= 400 * (8 + 4)


def test_a_set_is_written_once(spark, monkeypatch):
    """Blocks hold each set once, however many they are, and meet without a shuffle."""
    monkeypatch.setattr(similar, "LIST", 50)
    rng = random.Random(2)
    rows = [(f"{i:03d}", rng.sample(range(600), rng.randrange(150, 400))) for i in range(400)]
    scratch = Scratch(spark, "test")
    made = similar.rare_first(spark.createDataFrame(rows, "id string, s array<long>"), scratch)
    blocks = scratch.table(similar._dealt(made, 0.45), "blocks")
    inside = [i for r in blocks.collect() for i in similar._read(bytes(r["rows"]))["id"].to_pylist()]
    assert sorted(inside) == [i for i, _ in rows] and blocks.count() == 8
    cells = similar._cells(blocks, 0.45)
    assert "Exchange" not in cells._jdf.queryExecution().executedPlan().toString()
    pairs = [tuple(sorted((r["block"], r["y_block"]))) for r in cells.collect()]
    assert len(pairs) == len({*pairs}) and {(k, k) for k in range(8)} <= {*pairs}


def test_families_that_hubs_connect(spark, monkeypatch):
    """Sets of a family are compared with those of others only; what is connected stays the same."""
    monkeypatch.setattr(similar, "LIST", 40)
    monkeypatch.setattr(similar, "FEW", 20)
    monkeypatch.setattr(similar, "HUBS", 12)
    rng = random.Random(4)
    sets = random_sets(rng, 150) | {f"{900 + i}": sorted({*range(500, 560), 600 + i, 700 + i // 2}) for i in range(90)}
    near = lambda a, b: len({*a} & {*b}) / len({*a} | {*b})
    want = {(a, b) for a in sets for b in sets if a < b and near(sets[a], sets[b]) >= 0.45}
    scratch = Scratch(spark, "test")
    made = similar.rare_first(spark.createDataFrame(list(sets.items()), "id string, s array<long>"), scratch)
    labelled, links = similar._by_hubs(made, 0.45, scratch)
    assert labelled.where("family >= 0").count() >= 90 and labelled.count() == len(sets)
    links = {(r["a"], r["b"]) for r in similar.spanning_links(made, 0.45, scratch).collect()}
    assert links <= want and classes(links) == classes(want)


def test_pairs_are_not_shuffled(spark, monkeypatch):
    """Titles that many articles share, in rows of several articles, near copies of them, pairs by
    names, and an id that two titles have."""
    monkeypatch.setattr(cluster, "COPIES", 4)
    monkeypatch.setattr(similar, "SENT", 50)
    titles = ["Acme launches an engine for the world"] * 23 + [f"Acme launches an engine for the world {k}" for k in range(9) for _ in range(k)]
    titles += ["Quark Leptonix x", "zzzz Leptonix wwwwwwwwww vvvvvvvvvv Quark yyyyyyyyy", "Other words", "Other words"]
    a, want = articles(spark, titles), brute(titles)
    pairs = cluster.same_event_pairs(a, now())
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    got = [(r["a"], r["b"]) for r in pairs.collect()]
    assert set(got) == want and len(got) == len(want)
    twice = a.unionByName(a.where("id = '000000'").withColumn("title", F.lit(titles[40])).withColumn("norm", F.lit("acmelaunchesanenginefortheworld7")))
    got = [(r["a"], r["b"]) for r in cluster.same_event_pairs(twice, now()).collect()]
    assert set(got) == want and len(got) == len(want)


def test_pairs_alone_need_no_counts(spark, monkeypatch):
    """Where the bits tell that sets are similar, their other members are read only for how similar."""
    sets = random_sets(random.Random(5), 80)
    rows = [(i, [m * 0x9E3779B97F4A7C15 % (1 << 64) - (1 << 63) for m in s]) for i, s in sets.items()]
    scratch = Scratch(spark, "test")
    made = similar.rare_first(spark.createDataFrame(rows, "id string, s array<long>"), scratch)
    want = {(r["a"], r["b"]) for r in similar.similar_pairs(made, 0.45, scratch).collect()}
    alone = similar.similar_pairs(made, 0.45, scratch, exact=False)
    assert alone.columns == ["a", "b"] and {tuple(r) for r in alone.collect()} == want
    x = similar._Rows(similar._read(similar._written(pa.table({"num": [0, 1], "id": ["a", "b"], "n": [50, 50], "spare": [1, 1], "words": [b"\xff" * 6 + b"\0" * 154] * 2, "tail": [[1, 2], [1, 3]]}))), 0.45)
    monkeypatch.setattr(similar._Rows, "rest", lambda self, i: pytest.fail("a set is read"))
    assert [len(p) for p, _, _ in similar._links(x, x, 0.45, None, 0, np.less)] == [1]


def test_pairs_without_reasons_are_the_same(spark):
    rng = random.Random(8)
    titles = [f"{' '.join(rng.choices(['alpha', 'beta', 'gamma', 'delta', 'omega'], k=6))} {i % 7}" for i in range(40)] + ["Zorblax meets Quimby", "Here comes Quimby with old friend Zorblax"]
    a = articles(spark, titles)
    want = {(r["a"], r["b"]) for r in cluster.same_event_pairs(a, now()).collect()}
    got = [tuple(r) for r in cluster.same_event_pairs(a, now(), reasons=False).collect()]
    assert len(got) == len(set(got)) and set(got) == want and ("000040", "000041") in want
