"""Edge cases and brute force on small tables."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewire.llm import embedding_dedup, exact_dedup, license_scan, mixing, ngram_join, packing, sharding, toxicity, url_filter, warc_revisits
from tidewire.storage import Scratch

LONG = "word number one two three four five six seven " * 4000
ROWS = [
    (1, "Same Text here", "a"), (2, "same text HERE", None), (3, None, "b"), (4, "", "a"), (5, "   ", None), (6, LONG, "a"), (7, LONG + "tail", "b"),
    (8, "one", "a"), (9, "ÀB c d e", "é"), (9, "ÀB c d e", "é"), (None, "lost key", "a"), (11, "one two three four five six", "a"), (12, "Released under the MIT License.", "b"),
]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    clash = [F.lit(i).alias(c) for i, c in enumerate(("kept", "size", "shard", "digest", "token", "rows", "key", "v", "p_toxic", "__key", "rank"))]
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *clash)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_exact_dedup(docs, empty):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs).collect()}
    assert {(1, 2, 2, False), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (9, 9, 2, True), (None, None, 1, True)} <= got
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_heavy_digests_are_decided_like_others(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i % 50}") for i in range(600)], "doc_id long, text string")
    sort = lambda d: sorted(map(tuple, d.collect()))
    assert sort(exact_dedup.exact_dedup(df, capacity=8)) == sort(exact_dedup.exact_dedup(df, capacity=1))


def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["taken"] <= 3 * r["size"] for r in rows) and mixing.mix(empty).count() == 0
    by = {r["source"]: (r["target"], r["source_size"]) for r in rows}
    assert sum(t for t, _ in by.values()) == pytest.approx(sum(s for _, s in by.values())) and all(t <= 3 * s for t, s in by.values())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))


def test_sainte_lague(spark):
    df = spark.createDataFrame([("a", 53000), ("b", 24000), ("c", 23000), ("d", 0)], "p string, v long")
    got = {r["p"]: r["s"] for r in mixing.sainte_lague(df, [], "v", F.lit(7), [F.col("p")], "s").collect()}
    top = sorted(((v / (2 * k - 1), p) for p, v in (("a", 53000), ("b", 24000), ("c", 23000)) for k in range(1, 8)), reverse=True)[:7]
    assert got == {"d": 0} | Counter(p for _, p in top)


def test_shards(docs, empty):
    rows = sharding.shard(docs, shards=4).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(ROWS) and all(sorted(s) == list(range(len(s))) for s in slots.values()) and sharding.shard(empty).count() == 0


def test_shards_keep_groups_whole(spark):
    """Groups of up to a shard stay whole; slots and sizes are those of the rows."""
    rng = np.random.default_rng(4)
    texts = [("t%d " % g) * int(rng.integers(1, 60)) for g in range(300) for _ in range(int(rng.integers(1, 5)))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard(df, shards=10).collect()
    by = defaultdict(set)
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        by[texts[r["doc_id"]]].add(r["shard"])
    sizes = np.bincount([r["shard"] for r in rows], [r["size"] for r in rows])
    assert len(rows) == len(texts) and all(len(v) == 1 for v in by.values()) and sizes.max() < 1.03 * sizes.min()


def test_place_goes_where_the_dot_product_is_highest():
    rng = np.random.default_rng(6)
    sizes = rng.integers(0, 50, (40, 3)).astype(float)
    scale, items = np.array(sharding.DIMENSIONS), sizes * 4 / np.maximum(sizes.sum(axis=0), 1)
    room, want = [[1.0] * 3 for _ in range(4)], {}
    for i in sorted(range(40), key=lambda i: (-sum(items[i] * scale), i)):
        want[i] = max(range(4), key=lambda b: (sum(room[b] * items[i] * scale), -b))
        room[want[i]] = [r - x for r, x in zip(room[want[i]], items[i])]
    assert sharding.place(sizes, 4).tolist() == [want[i] for i in range(40)]


def test_shards_split_a_hot_group(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("x"), F.lit(300))).otherwise(F.concat(F.repeat(F.lit("y "), F.lit(100)), F.col("id"))).alias("text"))
    sizes = [r["s"] for r in sharding.shard(df, shards=10).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 10 and max(sizes) < 1.05 * min(sizes)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    rows = packing.pack(docs).collect()
    tok = Tokenizer.from_file(packing.vocabulary())
    want = Counter()
    for key, text, _ in ROWS:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((key, i // 2048, i, len(ids[i : i + 2048]), zlib.crc32(ids[i : i + 2048].tobytes())) for i in range(0, len(ids), 2048))
    assert Counter(tuple(r)[:5] for r in rows) == want and packing.pack(empty).count() == 0
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))] and sum(n for _, n in b) <= 2048


def test_best_fit_is_one_piece_after_the_other():
    rng = np.random.default_rng(1)
    for _ in range(60):
        counts = {int(k): int(c) for k, c in zip(rng.integers(1, 41, 9), rng.integers(1, 30, 9))}
        bins = []
        for n in sorted((k for k, c in counts.items() for _ in range(c)), reverse=True):
            fit = [i for i, r in enumerate(bins) if r >= n]
            if fit:
                bins[min(fit, key=lambda i: (bins[i], i))] -= n
            else:
                bins.append(40 - n)
        runs = packing.best_fit(counts, 40)
        used = Counter()
        for length, rank, each, first, offset in runs:
            later = [r[1] for r in runs if r[0] == length and r[1] > rank]
            for k in range((min(later) if later else counts[length]) - rank):
                used[first + k // each] += length
        assert len(used) == len(bins) and max(used.values()) <= 40 and sum(used.values()) == sum(k * c for k, c in counts.items())


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    near = [base[i % 60] + rng.normal(scale=0.05 * (i % 4), size=8) for i in range(240)]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(near)] + [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [None] * 8), (304, []), (None, [1.0] * 8)]
    got = {r["vec_id"]: tuple(r)[1:] for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), leaf=32).collect()}
    x = np.array(near, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    label = np.arange(240)
    while ((new := np.array([label[link[i]].min() for i in range(240)])) != label).any():
        label = new
    assert all(got[i] == (link[i].sum() - 1, label[i], label[i] == i) for i in range(240))
    assert all(got[k] == (0, k, True) for k in (300, 301, 302, 303, 304)) and got[None][0] == 0


def test_embedding_leaves_are_shuffled_by_group(spark, monkeypatch):
    """Forty leaves, of which each pair is compared: a leaf is shuffled about once for each group that
    it meets, not once for a pair, and the links are those of brute force."""
    import numpy as np

    rng = np.random.default_rng(3)
    v = rng.normal(size=(320, 12)).astype(np.float32)
    v[1::2] = v[::2] + 0.2 * rng.normal(size=(160, 12)).astype(np.float32)
    sent = []
    dealt = embedding_dedup._dealt

    def counted(pairs, leaves, held, scratch):
        out = dealt(pairs, leaves, held, scratch)
        sent.append((pairs.count(), out.count()))
        return out

    monkeypatch.setattr(embedding_dedup, "_dealt", counted)
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(rows, leaf=8).collect()}
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    assert got == dict(enumerate(((u @ u.T >= 0.95).sum(axis=1) - 1).tolist())) and sum(got.values()) > 50
    assert len(sent) == 1 and sent[0][1] < sent[0][0] / 2


def test_embeddings_that_repeat_a_key(spark):
    rows = [(3, [1.0, 0.0]), (3, [0.0, 1.0]), (5, [1.0, 0.01]), (4, [1.0, 0.02]), (7, [-1.0, 0.0]), (7, [-1.0, 0.0])]
    want = [(3, 0, 3, True), (3, 2, 3, True), (4, 2, 3, False), (5, 2, 3, False), (7, 1, 7, True), (7, 1, 7, True)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>").withColumn("leaf", F.lit(1)).withColumn("node", F.lit("x"))
        assert sorted(tuple(r) for r in embedding_dedup.near_duplicates(df).collect()) == want
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_sql_of_links(spark, tmp_path):
    """op2 and op7 equal their SQL where documents and vectors do link."""
    import duckdb

    rng = np.random.default_rng(12)
    base = rng.normal(size=(20, 6))
    vectors = [(i, [float(x) for x in base[i % 20] + rng.normal(scale=0.1 * (i % 3), size=6)]) for i in range(150)] + [(200, None), (201, [0.0] * 6), (202, [float("inf")] * 6)]
    texts = []
    for i in range(120):
        words = [f"w{i % 15}x{k}" for k in range(int(rng.integers(1, 50)))]
        texts.append((i, " ".join(words + ["Same  Tail\tOf It"] * (i % 2))))
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([*texts, (500, None), (501, " ")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    for t in ("embeddings", "documents"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    for query, sql in ((embedding_dedup.op2_embedding_near_dedup, embedding_dedup.SQL), (ngram_join.op7_ngram_join, ngram_join.SQL)):
        got, want = query(spark, str(tmp_path)), db.sql(sql)
        assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall()) and len({r["component_id"] for r in got.collect()}) < got.count()


def test_ngrams(docs, empty, spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs).collect()}
    assert got[1] == (1, 1) and got[2] == (1, 1) and got[3] == (0, 3) and got[5] == (0, 5) and got[6][1] == 6 and got[8] == (1, 8) and got[11] == (3, 11)
    assert ngram_join.jaccard_components(empty).count() == 0


def test_ngrams_brute_force(spark):
    rng = np.random.default_rng(3)
    docs = []
    for i in range(160):
        words = [f"w{i % 8}x{k}" for k in range(60)] if i % 2 else [f"u{rng.integers(40)}" for _ in range(30)]
        for k in rng.integers(0, len(words), i % 4):
            words[k] = f"e{rng.integers(5)}"
        docs.append((i, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, w in ((i, t.split()) for i, t in docs)}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    assert got == label and len(set(label.values())) < 160


def test_urls(spark):
    rows = [(1, "http://a.net/x"), (2, "https://EN.example.net/en/q?x"), (3, None), (4, "nothing"), (5, "https://b.org/fr/1"), (6, "https://c.org/old"), (6, "https://c.org/old"), (7, "http://net")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.when(F.col("page_id") == 6, F.lit('<link rel="canonical" href="http://a.net/x">'))).withColumn("rule", F.lit(0))
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, url_filter.equivalences(pages)).collect()}
    assert got == {(1, "a.net", "/x", "net/", "block"), (2, "en.example.net", "/en/q", "example.net/en/", "allow"), (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "b.org", "/fr/1", "org/fr/", "allow"), (6, "c.org", "/old", None, "block"), (7, "net", "", None, "allow")}
    assert url_filter.filter_urls(pages.where("false"), url_filter.equivalences(pages.where("false"))).count() == 0


def test_urls_follow_relative_targets(spark):
    link, refresh = '<link rel=canonical href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        ("http://a.org/p/q?x=1", link.format("//b.net/y")), ("http://c.org/1/2/3", refresh.format("../d")), ("http://www.c.org/1/d/", link.format("http://b.net/c")),
        ("http://e.org/x", link.format("http://www.f.org/t/")), ("http://g.org/x", link.format("https://f.org/t")), ("http://f.org/t?", link.format("http://b.net/f")),
        ("http://h.org/x", link.format("http://i.org/?a=1&amp;b=2")), ("http://i.org/?a=1&b=2", link.format("http://b.net/i")), ("http://j.org/x", link.format("/y")), ("http://k.org/x", link.format("mailto:a@b.net")),
        ("http://l.org/a", refresh.format("?z=1")), ("http://l.org/a?z=1", link.format("http://b.net/l")), ("nothing", link.format("/x")),
    ]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r["page_id"] for r in url_filter.filter_urls(pages, url_filter.equivalences(pages)).where("verdict = 'block'").collect()}
    assert got == {0, 1, 2, 3, 4, 5, 6, 7, 10, 11}


def test_urls_equal_sql_where_pages_have_links(spark):
    """Aliases, chains, spellings and explicit allows; without a link, spelling alone says nothing."""
    import duckdb

    link, back, refresh = '<link rel="canonical" href="{}">', "<link href='{}' rel='canonical'>", '<meta http-equiv="refresh" content="0; url={}">'
    rows = [
        ("https://example.com/de/", None), ("https://example.com/de", None), ("http://a.org/1", link.format("http://a.org/2")), ("http://www.a.org/2/", refresh.format("http://x.net/")), ("http://b.org/1", back.format("https://b.org/2?utm_source=q")),
        ("http://b.org/2", link.format("http://sub.example.com/de/x")), ("http://c.org/fr/1", link.format("http://c.net/1")), ("http://d.org/1", link.format("http://d.org/2")), (None, link.format("http://x.net/")), ("http://a.org/1", None),
    ] + [(f"http://hub.org/{i}", link.format("http://hub.net/")) for i in range(40)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    cols = ["page_id", "host", "path", "rule", "verdict"]
    got = {tuple(r) for r in url_filter.filter_urls(df, url_filter.equivalences(df)).select(*cols).collect()}
    pages = df.toPandas()  # noqa: F841
    want = {tuple(None if x is None or x != x else x for x in r) for r in duckdb.sql(url_filter.SQL).df()[cols].itertuples(index=False)}
    assert got == want and {r[0] for r in got if r[4] == "block"} == {0, 2, 3, 4, 5, 9, *range(10, 50)}


def test_long_urls(spark):
    df = spark.createDataFrame([(1, "http://a.net/" + "x" * 200_000, ""), (2, "x" * 200_000, "")], "page_id long, url string, html string")
    assert [r["verdict"] for r in url_filter.filter_urls(df, url_filter.equivalences(df)).orderBy("page_id").collect()] == ["block", "allow"]


def test_resolved_urls_equal_urljoin(spark):
    from urllib.parse import urljoin

    from tidewire.functions.url import resolve_url

    bases = ["http://a.org", "http://a.org/", "https://a.org/b/c/d?q=1#f", "http://a.org/b/c/"]
    refs = ["g", "./g", "g/", "/g", "//h.org", "//h.org/x", "?y", "g?y", "#s", "g#s", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "g;x=1/../y", "g?y/../x", "http://x.org/a", "a/b/../c"]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string")
    got = {(r["b"], r["r"]): r["u"] for r in df.select("b", "r", resolve_url(F.col("r"), F.col("b")).alias("u")).collect()}
    assert got == {(b, r): urljoin(b, r) for b in bases for r in refs}


def test_revisits(spark):
    h = lambda **x: [(k, v) for k, v in x.items()]
    rows = [
        ("a", "http://x.com/1", 10, "response", "t1", None, h(ETag="t1", Server="s", Date="10"), "one"), ("b", "https://www.x.com/1/", 20, "response", "t2", None, h(Date="20"), "two"),
        ("r1", "https://x.com/1", 15, "revisit", "W/t1", None, h(Date="15", Server="no"), None), ("r2", "https://x.com/1#f", 20, "revisit", "t1", None, None, None), ("r3", "https://x.com/1", 21, "revisit", "t1", None, None, None),
        ("r4", None, 30, "revisit", None, None, None, None), ("r5", "https://x.com/1", None, "revisit", "t1", None, None, None), ("r6", "https://x.com/1", 40, "revisit", None, None, None, None), ("r7", "https://y.com/", 40, "revisit", "t", None, None, None),
    ]
    df = spark.createDataFrame(rows, f"record_id string, url string, ts long, kind string, etag string, last_modified string, headers {warc_revisits.HEADERS}, payload string")
    got = {r["record_id"]: r for r in warc_revisits.resolve_revisits(df).collect()}
    assert {k: (r["response_id"], r["status"]) for k, r in got.items()} == {"r1": ("a", "resolved"), "r2": ("a", "resolved"), "r3": ("b", "validator_mismatch"), "r4": (None, "no_response"), "r5": (None, "no_response"), "r6": ("b", "no_validator"), "r7": (None, "no_response")}
    assert got["r1"]["payload"] == "one" and sorted(map(tuple, got["r1"]["headers"])) == [("date", "15"), ("etag", "t1"), ("server", "s")]
    assert warc_revisits.resolve_revisits(df.where("false")).count() == 0


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 300, 40)) + (" Vile!" if i % 9 == 0 else "")) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 9 == 0).cast("int").alias("toxic")).where("doc_id < 600")
    chain = toxicity.train(df, labels)
    got = {r["doc_id"] for r in toxicity.score(df, chain).where("doc_id >= 600 and p_toxic >= 0.5").collect()}
    assert got == {i for i in range(600, 900) if i % 9 == 0}
    assert toxicity.score(docs, chain).count() == len(ROWS) and toxicity.score(empty, chain).count() == 0
    assert toxicity.clean(docs, chain, "toxic").columns == docs.columns
    assert toxicity.score(docs, toxicity.train(df, labels.where("false"))).count() == len(ROWS)


def test_licenses(docs, empty):
    got = license_scan.scan(docs).collect()
    assert [(r["doc_id"], r["license"], r["coverage"], r["first_word"], r["end_word"]) for r in got] == [(12, "MIT notice", 1.0, 0, 5)] and license_scan.scan(empty).count() == 0
    index = license_scan.Index(license_scan.TEMPLATES)
    words = license_scan.TEMPLATES["ISC"].split()
    words[10:12] = ["replaced"]
    found = license_scan.find(index, ("before " * 50 + " ".join(words) + " after" * 9).encode())
    assert [(n, a, b) for n, _, _, a, b in found] == [("ISC", 50, 50 + len(words))]


def test_one_report_for_a_place():
    index = license_scan.Index(license_scan.TEMPLATES)
    for name, text in license_scan.TEMPLATES.items():
        assert [n for n, *_ in license_scan.find(index, f"some words before {text} and after".encode())] == [name]


def test_long_texts_against_alignment_everywhere(spark):
    """Damaged license texts in other words: every one that alignment at all diagonals finds is found."""
    index = license_scan.Index(license_scan.TEMPLATES)
    rng = np.random.default_rng(13)
    names = [n for n, t in license_scan.TEMPLATES.items() if len(t.split()) >= license_scan.SHORT]
    hit = total = 0
    for k in range(60):
        name = names[k % len(names)]
        words = license_scan.TEMPLATES[name].split()
        for at in rng.integers(0, len(words), int(len(words) * rng.uniform(0, 0.25))):
            words[at] = f"q{at}"
        h = license_scan.hashes(" ".join([*(f"a{i}" for i in range(rng.integers(30))), *words, "end"]).encode())
        t = index.words[index.names.index(name)]
        best = max(license_scan.align(t, h, d, license_scan._band(t))[0] for d in range(-2, 34))
        if best >= index.least(index.names.index(name)):
            total += 1
            hit += name in [n for n, *_ in license_scan.find_in(index, h)]
    assert total >= 30 and hit == total


def test_short_notices():
    """Changed notices, and any texts of their words against alignment everywhere."""
    index = license_scan.Index(license_scan.TEMPLATES)
    names = lambda t: [n for n, *_ in license_scan.find(index, t.encode())]
    assert names("Released under MIT License") == names("It was released, under the good MIT License") == ["MIT notice"]
    assert names("Licensed under a CC BY 4.0") == names("licensed now under a CC BY at 4.0") == ["CC-BY-4.0 notice"]
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0 notice"] and names("Licensed under CC BY-SA 4.0.") == ["CC-BY-SA-4.0 notice"]
    rng = np.random.default_rng(8)
    short = {n: t.split() for n, t in license_scan.TEMPLATES.items() if n.endswith("notice")}
    for _ in range(300):
        words = list(short[rng.choice(list(short))])
        for _ in range(rng.integers(4)):
            at = rng.integers(len(words))
            words[at : at + rng.integers(2)] = [["the", "q"][rng.integers(2)]] * rng.integers(2)
        h = license_scan.hashes(" ".join(["x"] * rng.integers(9) + words + ["y"] * 3).encode())
        best = {}
        for i, t in enumerate(index.words):
            if index.names[i] in short:
                found = max(license_scan.align(t, h, d, 4 + len(t) // 8)[0] for d in range(-len(t), len(h)))
                best |= {index.names[i]: found / len(t)} if found >= 0.8 * len(t) else {}
        got = {n: c for n, c, *_ in license_scan._notices(index, h)}
        assert got == {n: c for n, c in best.items() if c == max(best.values())}


def test_ngrams_in_pieces(spark, monkeypatch):
    """A hot passage and a hot family, cut into pieces of a few rows."""
    monkeypatch.setattr(ngram_join, "PIECE", 7)
    rng = np.random.default_rng(10)
    docs = {}
    for i in range(90):
        words = [f"p{k}" for k in range(40)] + [f"t{i % 30 if i < 60 else 99}x{k}" for k in range(30)]
        for k in rng.integers(0, len(words), i % 3):
            words[k] = f"e{i}"
        docs[i] = words
    sets = {i: {tuple(w[k : k + 4]) for k in range(len(w) - 3)} for i, w in docs.items()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    label = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(df).collect()} == label


def test_ngrams_with_a_frequent_line(spark, monkeypatch):
    """A line that all documents have makes no group of all of them, and near copies are still met."""
    rng, line = np.random.default_rng(11), " ".join(f"w{k}" for k in range(20))
    texts = [" ".join(f"{i}x{k}" for k in rng.permutation(40)) for i in range(120)]
    texts += [" ".join([*t.split()[:-1], "other"]) for t in texts[:5]]
    groups, table = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, name="t": [out := table(self, df, name), groups.append(out.groupBy("hub").count().agg(F.max("count")).first()[0]) if name == "groups" else 0][0])
    df = spark.createDataFrame([(i, f"{line}\n{t}") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(df).collect()}
    assert got == {i: i if i < 120 else i - 120 for i in range(125)}
    assert len(groups) == 1 and groups[0] <= 4


@pytest.mark.parametrize("short, room", [(0, 4), (1000, 1), (0, 1)])
@pytest.mark.parametrize("percent", [10, 40, 60, 100])
def test_candidates_of_all_lengths(monkeypatch, short, room, percent):
    monkeypatch.setattr(ngram_join, "SHORT", short)
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 60, 900).astype(np.uint64)
    sets = [np.unique(np.append(base[: rng.integers(20, 900)], rng.integers(0, 1 << 60, i % 9).astype(np.uint64))) for i in range(60)]
    sets += [sets[0], base[:60], base[:140]]
    g = len(sets)
    sig = ngram_join.Signatures(np.array([len(s) for s in sets]), [ngram_join.bitmap(s, room) for s in sets])
    near = {(i, j) for i in range(g) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))}
    found = ngram_join.candidates(np.array([0, g]), sig, np.arange(g), np.zeros(g, int), percent)
    assert near <= {(max(a, b), min(a, b)) for i, j in found for a, b in zip(i.tolist(), j.tolist())}


@pytest.mark.parametrize("shift", [0, 1 << 62, -(1 << 62)])
def test_near_copies_with_a_repeated_doc_id(spark, shift):
    say = lambda tag, *changed: " ".join(f"{tag}{k}" if k not in changed else "other" for k in range(60))
    rows = [(1, say("a")), (5, say("a", 59)), (5, say("b")), (6, say("b", 59)), (7, say("c")), (7, say("c", 0)), (7, say("c")), (8, say("d")), (9, say("e")), (9, say("f")), (4, say("f", 0)), (None, say("g")), (None, say("h"))]
    rows = [(k if k is None else k + shift, t) for k, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = Counter(map(tuple, corpus_pipeline.drop_near_copies(spark, df, "").collect()))
    certain = {rows[i] for i in (0, 2, 7, 8, 10, 11, 12)}
    assert {r for r in left if r[0] != 7 + shift} == certain and len([r for r in left if r[0] == 7 + shift]) == 1
    got = Counter(tuple(r) for r in ngram_join.jaccard_components(df).select("doc_id", "component_id").collect())
    want = Counter({(1, 1): 1, (5, 1): 1, (5, 5): 1, (6, 5): 1, (7, 7): 3, (8, 8): 1, (9, 9): 1, (9, 4): 1, (4, 4): 1})
    assert got == Counter({(a + shift, b + shift): n for (a, b), n in want.items()} | {(None, None): 2})


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, "/root/testdata/sf0.001").persist()
        if name != "packing":
            assert docs.columns == before.columns
        if name == "exact_dedup":
            low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            best = {}
            for r in before.collect():
                k = (r["text"] or "").translate(low)
                best[k] = max(best.get(k, -1), r["doc_id"])
            assert sorted(best.values()) == sorted(r["doc_id"] for r in docs.collect())
    assert docs.count() > 0
