from pyspark.sql import functions as F

from tidewire.sources import feeds


def test_feeds(spark, tmp_path):
    (tmp_path / "one.xml").write_text(
        "<rss><channel><item><title><![CDATA[A & B]]></title><link>https://a.com/1</link><pubDate>Wed, 16 Sep 2026 08:00:00 GMT</pubDate><category>x</category>"
        "<description>&lt;p&gt;Hi&lt;/p&gt;</description><media:content url='https://a.com/p.jpg' type='image/jpeg'/></item>"
        "<item><title>broken <b>< </title><link>https://a.com/2</link></item><item><title>no link</title></item></channel></rss>"
    )
    (tmp_path / "two.xml").write_text("<feed><entry><title>E</title><link rel='alternate' href='https://b.com/1?x=1&amp;y=2'/><updated>2026-09-16T08:00:00Z</updated></entry></feed>")
    rows = {r["url"]: r for r in feeds.read_feeds(spark, str(tmp_path)).collect()}
    assert set(rows) == {"https://a.com/1", "https://a.com/2", "https://b.com/1?x=1&y=2"}
    a = rows["https://a.com/1"]
    assert (a["source_id"], a["title"], a["summary_raw"], a["image_url"], a["tags"]) == ("one", "A & B", "<p>Hi</p>", "https://a.com/p.jpg", ["x"])
    now = F.lit("2026-09-17 00:00:00").cast("timestamp")
    assert feeds.cap_by_date(feeds.announced(feeds.read_feeds(spark, str(tmp_path))), F.lit(1), now).count() == 2


def test_fields_by_other_names(spark, tmp_path):
    (tmp_path / "rss.xml").write_text(
        "<rss><item><title>A</title><link>https://a.com/1</link><dc:date>2026-09-16</dc:date><content:encoded><![CDATA[<p>Body</p>]]></content:encoded>"
        "<media:thumbnail href='https://a.com/t.jpg'/><category><![CDATA[x]]></category></item></rss>"
    )
    (tmp_path / "atom.xml").write_text(
        "<feed><entry><title>B</title><link href='https://b.com/1'/><link rel='enclosure' type='audio/mpeg' href='https://b.com/s.mp3'/>"
        "<link rel='enclosure' type='image/png' href='https://b.com/p.png'/><issued>2026-09-15</issued><category term='y' label='Y'/></entry></feed>"
    )
    a, b = sorted(feeds.read_feeds(spark, str(tmp_path)).collect(), key=lambda r: r["title"])
    assert (a["summary_raw"], a["published_raw"], a["image_url"], a["tags"]) == ("<p>Body</p>", "2026-09-16", "https://a.com/t.jpg", ["x"])
    assert (b["url"], b["published_raw"], b["image_url"], b["tags"]) == ("https://b.com/1", "2026-09-15", "https://b.com/p.png", ["y"])


def test_declared_encodings(spark, tmp_path):
    text = "<?xml version='1.0' encoding='{}'?><rss><item><title>{}</title><link>https://a.com/1</link></item></rss>"
    words = {"gb2312": "发布镕", "ISO-8859-1": "café", "utf-16": "发布", "UTF-8": "发布", "no-such": "发布"}
    for name, word in words.items():
        kind = {"gb2312": "gbk", "no-such": "utf-8"}.get(name, name)
        (tmp_path / f"{name}.xml").write_bytes(text.format(name, word).encode(kind))
    assert {r["source_id"]: r["title"] for r in feeds.read_feeds(spark, str(tmp_path)).collect()} == words
    files = feeds.landed(spark.read.format("binaryFile").load(str(tmp_path)))
    assert {r["fault"] for r in feeds.feed_profile(files).collect()} == {None}


def test_hits(spark, tmp_path):
    (tmp_path / "hn.json").write_text('{"hits": [{"objectID": "7", "title": " A  b", "url": "", "points": 9}]}')
    r = feeds.read_hits(spark, str(tmp_path / "hn.json")).first()
    assert (r["title"], r["url"], r["heat"], r["comments"]) == ("A b", "https://news.ycombinator.com/item?id=7", 9, 0)


def one(spark, tmp_path, *bodies):
    """Rows of files, each of one body, in their order."""
    for i, body in enumerate(bodies):
        (tmp_path / f"f{i}.xml").write_text(body)
    return sorted(feeds.read_feeds(spark, str(tmp_path)).collect(), key=lambda r: (r["source_id"], r["place"]))


def test_the_link_that_leads_to_the_page(spark, tmp_path):
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>T</title>{}</entry></feed>'
    rows = one(
        spark, tmp_path,
        atom.format('<link rel="replies" href="https://a.com/r"/><link rel="self" href="https://a.com/s"/><link rel="edit" href="https://a.com/e"/><link rel="alternate" type="text/html" href="https://a.com/1"/>'),
        atom.format('<link href="https://a.com/how-to-enclosure-design"/><link rel="enclosure" type="image/png" href="https://a.com/p.png"/>'),
        '<rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><item><title>T</title><atom:link rel="self" href="https://a.com/self"/><link>https://a.com/3</link></item></channel></rss>',
        "<rss><item><title>T</title><guid>https://a.com/4</guid></item></rss>",
        "<rss><item><title>T</title><guid isPermaLink='false'>https://a.com/no</guid></item></rss>",
        atom.format('<link rel="alternate" type="application/json" href="https://a.com/j"/><link rel="alternate" href="https://a.com/6"/>'),
    )
    assert [r["url"] for r in rows] == ["https://a.com/1", "https://a.com/how-to-enclosure-design", "https://a.com/3", "https://a.com/4", "https://a.com/6"]
    assert rows[1]["image_url"] == "https://a.com/p.png"


def test_only_what_stands_in_the_item_counts(spark, tmp_path):
    rows = one(
        spark, tmp_path,
        "<feed><entry><source><title>Other</title><link href='https://o.com/'/><updated>2020-01-01</updated></source><author><name>N</name></author><title>Own</title><link href='https://a.com/1'/><updated>2026-09-15</updated></entry></feed>",
        "<rss><channel><!-- <item><title>gone</title><link>https://a.com/g</link></item> --><item><title>A</title><link>https://a.com/2</link></item></channel></rss>",
        "<rss><item><title>Raw & broken</title><!-- <link>https://a.com/x</link> --><link>https://a.com/3</link><source url='https://o.com'>Other</source></item><!-- <item><title>gone</title><link>https://a.com/g</link></item> --></rss>",
        "<rss xmlns:m='http://search.yahoo.com/mrss/'><item><title>A</title><link>https://a.com/4</link><m:group><m:content url='https://a.com/v.mp4' type='video/mp4'/><m:content url='https://a.com/i.jpg' type='image/jpeg'/></m:group></item></rss>",
        "<feed><entry><title type='xhtml'><div>An <b>x</b></div></title><link href='https://a.com/5'/><content type='xhtml'><div>Body <img src='https://a.com/b.jpg'/> &lt;end</div></content></entry></feed>",
        "<rss><channel><title>Chan</title><image><title>I</title></image><item><link>https://a.com/6</link><description><![CDATA[<item>not one</item> <title>no</title>]]></description><title>B</title></item></channel></rss>",
    )
    assert [(r["title"], r["url"]) for r in rows] == [
        ("Own", "https://a.com/1"), ("A", "https://a.com/2"), ("Raw & broken", "https://a.com/3"), ("A", "https://a.com/4"), ("<div>An <b>x</b></div>", "https://a.com/5"), ("B", "https://a.com/6"),
    ]
    assert rows[0]["published_raw"] == "2026-09-15" and rows[3]["image_url"] == "https://a.com/i.jpg"
    assert rows[4]["summary_raw"] == '<div>Body <img src="https://a.com/b.jpg"></img> &lt;end</div>' and rows[4]["image_url"] == "https://a.com/b.jpg"


def test_a_broken_item_costs_no_other(spark, tmp_path):
    good = "<item><title>G{0} &amp; co</title><link>https://a.com/g{0}</link><media:content url='https://a.com/{0}.jpg'/></item>"
    broken = [
        "<item><title>B1 <b>< </title><link>https://a.com/b1</link></item>", "<item><title>B2 &nbsp;&copy; x</title><link>https://a.com/b2?a=1&b=2</link><description><![CDATA[<p>a & b]]></description></item>",
        "<item><title>B3</title><link>https://a.com/b3</link><description>open <i>tag</description></item>", "<item><title>B4</title><link>https://a.com/b4</link>",
    ]
    text = "<rss><channel>" + "".join(good.format(i) + b for i, b in enumerate(broken)) + good.format(9)
    rows = one(spark, tmp_path, text)
    assert [r["url"] for r in rows] == [u for i in range(4) for u in (f"https://a.com/g{i}", ["https://a.com/b1", "https://a.com/b2?a=1&b=2", "https://a.com/b3", "https://a.com/b4"][i])] + ["https://a.com/g9"]
    by = {r["url"]: r for r in rows}
    assert by["https://a.com/g1"]["title"] == "G1 & co" and by["https://a.com/g1"]["image_url"] == "https://a.com/1.jpg"
    assert by["https://a.com/b2?a=1&b=2"]["title"] == "B2 © x" and by["https://a.com/b2?a=1&b=2"]["summary_raw"] == "<p>a & b"
    profile = feeds.feed_profile(feeds.landed(spark.read.format("binaryFile").load(str(tmp_path)))).first()
    assert profile["items_seen"] == 9 and profile["fault"]


def test_empty_and_foreign_files(spark, tmp_path):
    for name, body in {"b": b"<html><body>no feed</body></html>", "c": b"\xff\xfe\x00", "d": b"<rss><channel></channel></rss>"}.items():
        (tmp_path / f"{name}.xml").write_bytes(body)
    assert feeds.read_feeds(spark, str(tmp_path)).count() == 0
    seen = {r["source_id"]: (r["items_seen"], r["fault"] is None) for r in feeds.feed_profile(feeds.landed(spark.read.format("binaryFile").load(str(tmp_path)))).collect()}
    assert seen == {"b": (0, True), "c": (0, False), "d": (0, True)}
