"""The stages of the pipeline against plain loops, and what they do with odd rows."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewire.llm import common, mixing, packing, sharding, toxicity, url_filter

DIR = "/root/testdata/sf0.001"
LOW = str.maketrans(common.UPPER, common.LOWER)


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage."""
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, DIR).persist()
        out[name] = (docs, made)
        docs = made
    return out


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    chain = toxicity.train(before, spark.read.parquet(f"{DIR}/labels.parquet"))
    rows = before.collect()
    p = chain.probabilities(list(toxicity.buckets_in(__import__("pyarrow").array([(r["text"] or "").encode() for r in rows]))))
    assert sorted(r["doc_id"] for r, q in zip(rows, p[:, chain.names.index("toxic")]) if q < 0.5) == sorted(r["doc_id"] for r in after.collect())
    assert 0 < after.count() < before.count()


def test_near_copies_stage(stages):
    before, after = stages["ngram_jaccard"]
    sets = {}
    for r in before.collect():
        w = (r["text"] or "").translate(LOW).split()
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    of = {i: i for i in sets}
    for a in sorted(sets):
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and of[a] != of[b]:
                low, high = min(of[a], of[b]), max(of[a], of[b])
                of = {i: low if c == high else c for i, c in of.items()}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(i for i, c in of.items() if i == c)


def test_mixing_stage(stages):
    before, after = stages["mixing"]
    want = Counter()
    for r in mixing.mix(before).collect():
        want[r["doc_id"]] = int(r["taken"] / r["size"] + 0.5) if r["size"] else 1
    assert +want == Counter(r["doc_id"] for r in after.collect())


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(packing.vocabulary())
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in before.collect()}
    copies = Counter(r["doc_id"] for r in before.collect())
    want, places, bins = Counter(), defaultdict(list), defaultdict(int)
    for i, t in ids.items():
        for k in range(0, len(t), 2048):
            want[i, k // 2048, len(t[k : k + 2048]), zlib.crc32(np.array(t[k : k + 2048], "<u4").tobytes())] = copies[i]
    rows = after.collect()
    assert Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows) == want
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spot in places.values():
        assert [o for o, _ in sorted(spot)] == np.cumsum([0, *[n for _, n in sorted(spot)]])[:-1].tolist() and sum(n for _, n in spot) <= 2048
    free = []  # best fit, decreasing
    for n in sorted((n for (_, _, n, _), c in want.items() for _ in range(c)), reverse=True):
        fit = min((x for x in free if x >= n), default=None)
        if fit is None:
            free.append(2048 - n)
        else:
            free[free.index(fit)] -= n
    assert len(places) == len(free)


ODD = [(None, "some words of a lost key", "c"), (None, None, None), (3, "Twice the same text here", "a"), (3, "Twice the same text here", "a"), (4, "twice the same text HERE", "b"), (4, "another text", "b"), (5, "", "c"), (6, "x" * 50_000, None)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_empty_tables(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(ODD, "doc_id long, text string, source string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert stage(spark, docs.where("false"), DIR).count() == 0
    got = stage(spark, docs, DIR)
    rows = got.collect()
    if name != "packing":
        assert got.columns == docs.columns
    if name == "exact_dedup":
        assert Counter(r["doc_id"] for r in rows) == {4: 2, 5: 1, None: 1, 6: 1}
    if name == "mixing":
        # a null key is found again: what the mix takes of its words is what comes out
        taken = {k: (sum(r["taken"] for r in g), sum(r["size"] for r in g)) for k in (None, 3, 6) for g in [[r for r in mixing.mix(docs).collect() if r["doc_id"] == k]]}
        of = Counter((r["doc_id"], r["text"]) for r in rows)
        assert of[None, ODD[0][1]] == int(taken[None][0] / taken[None][1] + 0.5) == of[None, None] > 1
        assert of[3, ODD[2][1]] == 2 * int(taken[3][0] / taken[3][1] + 0.5)


def test_shards_split_rows_that_repeat(spark):
    rows = [(7, "the one text that repeats")] * 3000 + [(100 + i, f"text {i} of its own") for i in range(6000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), shards=10).collect()
    sizes, count, slots = Counter(), Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        count[r["shard"]] += 1
        slots[r["shard"]].append(r["slot"])
    assert len(got) == 9000 and max(sizes.values()) < 1.02 * min(sizes.values()) and max(count.values()) < 1.05 * min(count.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_links_in_every_spelling(spark):
    meta, link = "<meta http-equiv=refresh content={}>", "<link {}>"
    blocked = [
        meta.format('"0;url=\'http://b.net/1\'"'), "<META HTTP-EQUIV='Refresh' CONTENT=0;url=http://b.net/2>", link.format('rel="alternate canonical" href=http://b.net/3'), link.format("href='http://b.net/4' rel=CANONICAL /"),
        link.format('rel=canonical href="/nowhere"') + link.format('title="rel=x > y" rel=canonical href="http://b.net/5"'), meta.format('"900;url=/x"') + meta.format('"0; URL = http://b.net/6"'), meta.format('"0 http://b.net/7"'),
    ]
    free = [
        "<!-- " + link.format('rel=canonical href="http://b.net/a"') + " -->", link.format('rel="canonical-old" href="http://b.net/b"'), meta.format('"900;url=http://b.net/c"'), "<script>var x = '" + link.format('rel=canonical href="http://b.net/d"') + "'</script>",
        link.format('data-rel=canonical href="http://b.net/e"'), link.format("title='rel=canonical' href='http://b.net/f'"), "<!-- open " + link.format('rel=canonical href="http://b.net/g"'), meta.format('"0"'), None, "<link rel=canonical>",
    ]
    df = spark.createDataFrame([(i, f"http://p{i}.org/", h) for i, h in enumerate(blocked + free)], "page_id long, url string, html string")
    got = {r["page_id"] for r in url_filter.filter_urls(df, url_filter.equivalences(df)).where("verdict = 'block'").collect()}
    assert got == set(range(len(blocked)))


def test_folds_keep_copies_together(monkeypatch):
    """Copies of a row are never told by models that have seen one of them."""
    rng = np.random.default_rng(2)
    base = [np.sort(rng.integers(0, toxicity.BUCKETS, 20)) for _ in range(40)]
    rows, fits = [base[i % 40] for i in range(200)], []
    real = toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda r, e, y: fits.append({x.tobytes() for x in r}) or real(r, e, y))
    labels = np.array([[i % 2, i % 3 == 0] for i in range(200)], int)
    toxicity.fit_chain(rows, labels, ["a", "b"])
    folds = [f for f in fits if len(f) < 40]
    assert len(folds) == toxicity.FOLDS and sum(40 - len(f) for f in folds) == 40


def test_null_labels(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} bad" if i % 5 == 0 else f"word{i % 7} good") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, None if i % 10 == 1 else 1, int(i % 5 == 0)) for i in range(150)] + [(None, 1, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    whole = labels.where("quality is not null and doc_id < 200")
    a, b = (toxicity.score(docs, toxicity.train(docs, x)).orderBy("doc_id").collect() for x in (labels, whole))
    assert a == b and {r["doc_id"] for r in a if r["p_toxic"] >= 0.5} == {i for i in range(200) if i % 5 == 0}
