"""The daily run over landed files, its documents, the page and the streams."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewire import cli, config as C, console, site
from tidewire.operators import intake
from tidewire.plans import daily
from tidewire.streaming import intake as stream

AT = dt.datetime(2026, 9, 16, 12, tzinfo=dt.timezone.utc)
NOW = "2026-09-16T12:00:00Z"


def item(title, link, date="Wed, 16 Sep 2026 08:00:00 GMT", text="", more=""):
    return f"<item><title>{title}</title><link>{link}</link><pubDate>{date}</pubDate><description>{text}</description>{more}</item>"


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    d = tmp_path_factory.mktemp("landed")
    put = lambda n, *items: (d / n).write_text(f"<rss><channel>{''.join(items)}</channel></rss>")
    long = "A summary that is long enough to say something of its own."
    put("qbitai.xml", item("Acme Borealis launches a new reasoning engine", "https://q.com/1?utm_source=x", text=long), item("Old", "https://q.com/2", "Wed, 01 Jul 2026 08:00:00 GMT"), item("", "https://q.com/3"))
    put("infoq-ai.xml", item("Acme Borealis launches a new reasoning engines", "https://i.com/1", "Wed, 16 Sep 2026 16:00:00 GMT", "点击查看原文"), item("Bench", "https://q.com/1", text=long + long))
    put("openai.xml", *[item(f"Note number {'x' * i} of the lab about {chr(97 + i) * 9}", f"https://o.com/{i}", f"Tue, 15 Sep 2026 08:{i:02d}:00 GMT") for i in range(25)])
    (d / "verge-ai.xml").write_text("<feed><entry><title>Broken & raw</title><link href='https://v.com/1'/><updated>2026-09-16T08:00:00Z</updated></entry></feed>")
    put("arxiv.xml", item("Paper kept", "https://a.org/1", more="<arxiv:announce_type>new</arxiv:announce_type>"), item("Paper cross-listed", "https://a.org/2", more="<arxiv:announce_type>cross</arxiv:announce_type>"))
    hit = {"objectID": "7", "title": "Hit of the day", "url": "", "created_at": "2026-09-16T07:00:00Z", "points": 200, "num_comments": 3}
    (d / "hn.1.json").write_text(json.dumps({"hits": [hit]}))
    (d / "hn.2.json").write_text(json.dumps({"hits": [hit | {"points": 250}]}))
    put("ifanr.xml")
    put("sspai.xml", item("A walk in the park", "https://s.com/1", "Sat, 01 Aug 2026 08:00:00 GMT"), item("GPT for walks", "https://s.com/2", "Tue, 01 Sep 2026 08:00:00 GMT"))
    return str(d)


@pytest.fixture(scope="module")
def first(spark, landed):
    return daily.run(spark, landed, spark.createDataFrame([], intake.ARTICLE), AT)


def test_outcomes(first):
    per = {o["id"]: o for o in first.report["sources"]}
    pick = lambda i, *k: tuple(per[i][x] for x in k)
    assert pick("qbitai", "status", "items_seen", "items_kept", "items_out_of_window", "items_new") == ("ok", 3, 2, 1, 1)
    assert pick("infoq-ai", "items_tz_corrected", "items_summary_dropped", "items_new", "items_dup", "status") == (2, 1, 1, 1, "ok")  # an id that another source brought in this run is new for both
    assert pick("openai", "items_seen", "items_kept") == (25, 20)
    assert pick("verge-ai", "status", "items_new", "items_kept") == ("parse_warning", 0, 1)
    assert pick("arxiv", "items_seen", "items_kept") == (2, 1)
    assert pick("hn", "items_seen", "items_new", "items_dup") == (2, 1, 0)
    assert pick("ifanr", "status", "items_seen") == ("parse_warning", 0)
    assert pick("sspai", "items_kept", "items_filtered", "status") == (1, 1, "stale")
    assert pick("leiphone", "status", "http_status") == ("failed", None)
    assert first.report["overall"] == "partial" and any("疑似" not in w and "stale" in w for w in first.report["warnings"])


def test_articles(first):
    rows = {r["url"]: r for r in first.articles.collect()}
    a = rows["https://q.com/1?utm_source=x"]
    assert a["canonical_url"] == "https://q.com/1" and a["title"].startswith("Acme") and a["source_id"] == "qbitai"
    hit = rows["https://news.ycombinator.com/item?id=7"]
    assert (hit["heat"], hit["comments"], hit["lang"]) == (250, 3, "en")
    assert "HN 250 分 · 3 评论" in hit["reasons"]
    assert all(list(h) == ["article_id", *daily.HIGHLIGHT] and h["source_name"] for h in first.highlights)
    assert first.report["highlights"] == [h["article_id"] for h in first.highlights]
    assert "https://i.com/1" not in rows and len(rows) == len({r["id"] for r in rows.values()}) == first.counts["total"]
    assert first.report["total_new"] == len(rows) and "Hit of the day" in {h["title"] for h in first.highlights}


def test_second_run_adds_nothing(spark, landed, first):
    again = daily.run(spark, landed, first.articles, AT)
    assert again.report["total_new"] == 0
    key = lambda r: sorted(map(str, r.articles.select(*intake.FIELDS, "score", "cluster_id").collect()))
    assert key(again) == key(first)


def test_documents_and_page(spark, landed, first, tmp_path, capsys):
    args = ["collect", "--input", landed, "--now", NOW, "--data-dir"]
    assert cli.main([*args, str(tmp_path / "dry"), "--only", "ifanr", "--dry-run", "--quiet"]) == 0 and not (tmp_path / "dry").exists()
    assert cli.main([*args, str(tmp_path / "a")]) == 0
    text = capsys.readouterr().out
    assert "合计：16 个源" in text and "今日重点" in text and "需要关注的源：" in text
    daily.publish(spark, first, str(tmp_path / "b"), AT)
    for name in (daily.NEWS, daily.RUNS, daily.STATUS, daily.META):
        assert (tmp_path / "a" / name).read_bytes() == (tmp_path / "b" / name).read_bytes()
    news, status = (json.loads((tmp_path / "a" / n).read_text("utf-8")) for n in (daily.NEWS, daily.STATUS))
    assert news["counts"]["total"] == len(news["articles"]) and news["articles"][0]["first_seen_at"] == NOW
    assert sum(v for k, v in status["health"].items() if k != "success_rate_7d") == 16 and status["health"]["success_rate_7d"] == 0.0
    daily.publish(spark, first, str(tmp_path / "a"), AT)
    assert len(json.loads((tmp_path / "a" / daily.RUNS).read_text("utf-8"))["runs"]) == 2
    (tmp_path / "t.html").write_text(f"<script>const D = {site.PLACEHOLDER}; if (!D) fetch('data/news.json')</script>")
    page, _ = site.build(str(tmp_path / "t.html"), str(tmp_path / "a"), str(tmp_path / "out"))
    assert site.check(page, str(tmp_path / "t.html")) == [] and (tmp_path / "out" / "data" / daily.META).exists()
    (tmp_path / "bad.html").write_text("<script src='x.js'></script>")
    assert len(site.check(str(tmp_path / "bad.html"), "none")) == 4
    assert cli.main(["collect", "--input", landed, "--only", "nobody", "--quiet"]) == 2


def test_audit(spark, landed):
    items, _ = daily.read_landed(spark, landed, C.select_sources(), daily.instant(AT))
    rows = {r["source_id"]: r for r in intake.audit(items, daily.instant(AT)).collect()}
    assert rows["infoq-ai"]["date_shapes"] == {"GMT": 2} and rows["infoq-ai"]["time_verdict"] == "slightly_ahead"
    late = intake.audit(items, daily.instant(AT - dt.timedelta(hours=4))).where("source_id = 'infoq-ai'").first()
    assert (late["time_verdict"], late["suggested_offset_minutes"]) == ("tz_mislabelled", 480)


def test_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "unknown.xml").write_text("")
    done = daily.run(spark, str(tmp_path / "in"), spark.createDataFrame([], intake.ARTICLE), AT, only=["qbitai"])
    assert (done.report["overall"], done.counts["total"], done.highlights) == ("failed", 0, [])
    assert "抓取失败" in console.render(done.report, [])


def test_streams(spark, landed, tmp_path):
    rows = stream.articles(stream.landed_items(spark, landed, 2), C.dim_source(spark), daily.instant(AT))
    seen = []
    stream.merge_each(stream.first_sightings(rows), str(tmp_path / "c1"), lambda b, n: seen.extend(r["id"] for r in b.select("id").collect())).awaitTermination(120)
    assert len(seen) == len(set(seen)) and len(seen) > 20
    large = stream.oversized(spark, landed, most=100).writeStream.format("memory").queryName("large").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    large.awaitTermination(120)
    assert spark.table("large").where("source_id = 'openai' and length > 100").count() == 1
    q = stream.arrivals(rows, late="60 days").writeStream.format("memory").queryName("arrivals").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("arrivals").agg(F.sum("n")).first()[0] >= len(seen)
