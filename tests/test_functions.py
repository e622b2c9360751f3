from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidewire.functions import grams, terms, text, time as T, url
from tidewire.operators.graph import connected_components
from tidewire.storage import Scratch

NOW = "2026-09-16 12:00:00"


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("raw, want", [
    ("HTTP://www.Example.com:80/a//b/?utm_source=x&id=2&ref=y#top", "https://example.com/a/b?id=2"),
    ("https://a.com", "https://a.com/"), ("//a.com/x/", "https://a.com/x"), ("not a url", "not a url"), ("", ""),
    ("https://a.com:8080/p?q=a+b&blank=&x=%7E*", "https://a.com:8080/p?q=a+b&x=~%2A"), ("https://a.com:port/x", "https://a.com:port/x"), ("ftp://A.com/f", "ftp://a.com/f"),
])
def test_canonical_url(spark, raw, want):
    assert one(spark, url.canonical_url(F.col("u")), u=raw) == want
    assert one(spark, url.canonical_url(F.col("u")), u=want) == want


@pytest.mark.parametrize("raw, want, note", [
    ("Wed, 16 Sep 2026 08:00:00 GMT", "2026-09-16 08:00:00", None), ("16 Sep 2026 08:00:00 +0800", "2026-09-16 00:00:00", None), ("2026-09-16T08:00:00+00:00", "2026-09-16 08:00:00", None),
    ("2026-09-16 08:00:00", "2026-09-16 08:00:00", "tz_assumed"), ("1789545600", "2026-09-16 08:00:00", None), ("1789545600000", "2026-09-16 08:00:00", None),
    ("16 September 2026 08:00 GMT", "2026-09-16 08:00:00", None), ("Sep 16, 2026", "2026-09-16 00:00:00", "tz_assumed"), ("Wed, 16 Sep 2026", "2026-09-16 00:00:00", "tz_assumed"),
    ("September 16, 2026 08:00:00 +08", "2026-09-16 00:00:00", None), ("2026-09-16T08:00:00+08", "2026-09-16 00:00:00", None), ("20260916T080000Z", "2026-09-16 08:00:00", None),
    ("20260916", "2026-09-16 00:00:00", "tz_assumed"), ("2026-09-16", "2026-09-16 00:00:00", "tz_assumed"), ("Wed, 16 Sep 2026 08:00:00 EST", "2026-09-16 08:00:00", "tz_assumed"),
    ("2026-13-45T99:99:99Z", None, "unparseable"), ("Sep 31, 2026", None, "unparseable"),
    ("2026-09-17T08:00:00Z", None, "future_date"), ("1999-01-01T00:00:00Z", None, "implausible"), ("soon", None, "unparseable"), ("08:30", None, "unparseable"), (" ", None, "missing"), (None, None, "missing"),
])
def test_parse_published(spark, raw, want, note):
    got = one(spark, T.parse_published(F.col("t").cast("string"), F.lit(NOW).cast("timestamp")), t=raw)
    assert (got["ts"] and got["ts"].strftime("%Y-%m-%d %H:%M:%S"), got["note"]) == (want, note)


def test_override_comes_before_the_check_for_the_future(spark):
    got = one(spark, T.parse_published(F.col("t"), F.lit(NOW).cast("timestamp"), F.lit(480)), t="Wed, 16 Sep 2026 19:00:00 GMT")
    assert (got["ts"].hour, got["note"]) == (11, "tz_corrected")


def test_text(spark):
    assert one(spark, text.html_to_text(F.col("t")), t="<p>A &amp;amp; B</p><script>x</p></script>c<br>d&lt;b&gt;") == "A & B c d"
    assert one(spark, text.is_boilerplate(F.col("t")), t="点击查看原文>") and one(spark, text.is_boilerplate(F.col("t")), t="Read more »")
    assert not one(spark, text.is_boilerplate(F.col("t")), t="Read more books, the author said, and then went on for quite a while about it")
    assert one(spark, text.detect_lang(F.col("t")), t="发布 GPT 模型") == "zh" and one(spark, text.detect_lang(F.col("t")), t="123") == "other"
    assert len(one(spark, text.truncate(F.col("t")), t="x" * 300)) == 240
    assert one(spark, text.first_image(F.col("t")), t='<img src="https://e.com/logo.png"><img src="x" data-src="//c.com/a.jpg">') == "https://c.com/a.jpg"


def test_grams_and_terms(spark):
    assert one(spark, grams.normalize_title(F.col("t")), t="ＧＰＴ-6 发布！") == "gpt6发布"
    assert sorted(one(spark, grams.entities(F.col("t")), t="OpenAI ships GPT-6 and The Agent, 发布GPT-7发布")) == ["GPT-6", "OpenAI"]
    assert one(spark, grams.is_duplicate(F.col("a"), F.col("b")), a="A new model was released today", b="A new model was released today - News")
    assert not one(spark, grams.is_duplicate(F.col("a"), F.col("b")), a="GPT-6", b="GPT-6 is a model that was released today")
    assert one(spark, terms.matched_terms(F.col("t"), F.lit(None).cast("string")), t="She said the AI chair") == ["AI"]
    assert one(spark, terms.signals(F.col("t"), F.lit("")), t="X raises funding, open source") == ["开源", "融资/并购"]
    assert one(spark, T.relative_time(F.col("m").cast("timestamp"), F.lit(NOW).cast("timestamp")), m="2026-09-14 12:00:00") == "2 天前"


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (None, 4)] + [(100, k) for k in range(101, 160)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b", Scratch(spark, "t"))
    got = {r["node"]: r["component"] for r in got.collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} | {k: 100 for k in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b", Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("raw, text_, old", [
    ("<p>a&amp;&amp</p><b>c</b>", "a&&amp c", "a&& c"), ("&lt;b&gt;x &copy;&#39;&#x41;&nbsp;&quo", "x ©'A &quo", "x ©'A &quo"), ("a &ampx; &amp;amp b", "a &ampx; &amp b", "a &x; & b"),
])
def test_references_without_a_semicolon(spark, raw, text_, old):
    assert one(spark, text.html_to_text(F.col("t"), whole=True), t=raw) == text_
    assert one(spark, text.html_to_text(F.col("t")), t=raw) == old


def test_queries_on_pages_with_cut_references_equal_their_sql(spark, tmp_path):
    import duckdb

    from tidewire.plans.oracle import SQL
    from tidewire.plans.queries import QUERIES

    page = "<html><title>Words &amp;&amp</title><h1>Some words that go on for long enough &amp</h1><p>and on &amp;amp</p></html>"
    spark.createDataFrame([(1, page), (2, None), (3, "&am <b>x</b> &quot;&copy")], "page_id long, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("html_text", "clean_summary"):
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).collect())) == sorted(duck.sql(SQL[name]).fetchall())
