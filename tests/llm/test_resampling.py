"""Importance resampling against a plain loop over all texts."""
import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewire.llm import common, resampling as R

LOWER = str.maketrans(common.UPPER, common.LOWER)
DIR = "/root/testdata/sf0.001"


def features(text, gram):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, gram + 1) for i in range(len(words) - k + 1)]


def expected(rows, target, gram=1, buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = [(k, *features(t, gram)) for k, t in rows]
    s = Counter(bucket(f) for _, _, fs in found for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x, gram)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    out = []
    for k, words, fs in found:
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([words >= least, k, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((x for x in out if x[0]), key=lambda x: (-x[4], x[1] is None, x[1]))
    for place, x in enumerate(fit[: percent * len(fit) // 100]):
        x[5] = place + 1
    return sorted((tuple(x[1:]) for x in out), key=str)


TEXTS = [None, "", "  ..", "One", "été Über x9 9x", "a b a b " * 12, "Word-number one, two! " * 9, "lorem ipsum dolor sit amet " * 3000, "日本 語 " * 30]


def table(spark, n):
    clash = [F.lit(i).alias(c) for i, c in enumerate(("row", "counts", "rank", "bucket", "gain", "__range", "weight"))]
    rows = [(i if i % 7 else None, TEXTS[i * i % len(TEXTS)] if i % 3 else f"text {i} of many words " * (i % 9)) for i in range(n)]
    rows += [(5, rows[5][1])] * 3
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3).select("*", *clash)


@pytest.mark.parametrize(("gram", "buckets", "percent"), [(1, 10_000, 10), (1, 7, 50), (3, 1000, 30), (2, 1, 0)])
def test_resampling_equals_a_loop(spark, monkeypatch, gram, buckets, percent):
    monkeypatch.setattr(common, "RANGE_ROWS", 16)
    monkeypatch.setattr(R, "SLICE", 1000)
    rows, docs = table(spark, 160)
    target = ["one two three words of text", None, "dolor sit", "été Über"]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = R.resample(docs, aim, gram=gram, buckets=buckets, percent=percent, least=5)
    tied = lambda rows: sorted((r[:4] for r in rows), key=str)  # noqa: E731  rows that repeat a key may swap their ranks
    got = [tuple(r) for r in got.collect()]
    want = expected(rows, target, gram, buckets, 5, percent)
    assert tied(got) == tied(want)
    assert sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4]) == list(range(1, sum(r[4] is not None for r in want) + 1))
    assert [r[3] for r in sorted((r for r in got if r[4]), key=lambda r: r[4])] == [r[3] for r in sorted((r for r in want if r[4]), key=lambda r: r[4])]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.resample(none, none).count() == 0
    rows, docs = table(spark, 40)
    assert sorted(map(tuple, R.resample(docs, none, percent=0).collect()), key=str) == expected(rows, [], percent=0)


def test_query_equals_sql(spark):
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    got = sorted((tuple(r) for r in R.op12_importance_resampling(spark, DIR).collect()), key=str)
    assert got == sorted(c.sql(R.SQL).fetchall(), key=str)
