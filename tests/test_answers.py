"""Landed answers as a data source, captures of files, and the reader's view."""
import datetime as dt
import hashlib
import json
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from tidewire import cli
from tidewire.operators import intake, view
from tidewire.plans import daily
from tidewire.sources import answers, manifest

AT = dt.datetime(2026, 9, 16, 12, tzinfo=dt.timezone.utc)


def hit(i, points, hours, **more):
    return {"objectID": str(i), "title": f"Hit {i}", "url": f"https://a.com/{i}", "created_at": "2026-09-16T07:00:00Z", "created_at_i": int(AT.timestamp()) - hours * 3600, "points": points, "num_comments": i} | more


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "landed"
    d.mkdir()
    (d / "hn.1.json").write_text(json.dumps({"hits": [hit(1, 100, 5), hit(2, 90, 24 * 40), hit(3, 30, 2), hit(4, 30, 9), hit(5, None, 1)]}))
    (d / "hn.2.json").write_text("{broken")
    (d / "big.json").write_text("x" * 2000)
    (d / "odd.json").write_text('{"hits": [{"points": "many"}]}')
    (d / "list.json").write_text("[1]")
    (d / "hnx.json").write_text("{}")
    return d


def test_broken_answers_are_rows(spark, folder):
    rows = answers.answers(spark, str(folder), ["hn", "big", "odd", "list", "none"], most=1500)
    assert rows.rdd.getNumPartitions() == 6
    load = lambda: answers.answers(spark, str(folder), ["hn", "big", "odd", "list", "none"], most=1500)
    assert {r["source_id"]: r["error"].partition("：")[0] for r in answers.faults(load()).collect()} == {"hn": "bad_json", "big": "too_large", "odd": "bad_json", "list": "bad_json", "none": "missing_fixture"}
    assert load().where("fault is null").count() == 5 and answers.answers(spark, str(folder), []).count() == 0


def test_filters_reach_the_files(spark, folder):
    found = answers.on_tracks(spark, str(folder), "hn", int(AT.timestamp()))
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "GreaterThan(points,80)" in plan and "GreaterThan(points,20)" in plan and plan.count("GreaterThan(created_at_i,") == 2 and ") Filter" not in plan
    assert sorted((r["track"], r["object_id"]) for r in found.collect()) == [("fresh", "1"), ("fresh", "3"), ("high", "1")]
    # what isn't pushed is left to Spark
    load = lambda: answers.answers(spark, str(folder), ["hn"])
    assert [r["object_id"] for r in load().where("points > 20 and title like '%4'").collect()] == ["4"]
    assert load().where("source_id = 'big'").count() == 0 and load().where("points < 100 and num_comments >= 3").count() == 2


def test_requests_say_the_same(spark):
    at = int(AT.timestamp())
    asked = parse_qs(urlsplit(answers.TRACKS[0].url("https://search.example/api", "AI & more", at, 20)).query)
    assert asked == {"query": ["AI & more"], "tags": ["story"], "numericFilters": [f"points>80,created_at_i>{at - 30 * 24 * 3600}"], "hitsPerPage": ["20"]}


def test_a_broken_answer_is_a_failed_source(spark, tmp_path):
    for body, status in (("{broken", "failed"), (json.dumps({"hits": []}), "parse_warning"), (json.dumps({"hits": [hit(1, 100, 1)]}), "ok")):
        (tmp_path / "hn.json").write_text(body)
        done = daily.run(spark, str(tmp_path), spark.createDataFrame([], intake.ARTICLE), AT, only=["hn"])
        told = done.report["sources"][0]
        assert told["status"] == status and (status != "failed" or told["error"].startswith("bad_json"))
    assert (told["items_seen"], told["items_new"]) == (2, 1)  # one answer serves both tracks


def test_manifest(spark, tmp_path):
    for name, body in {"a.xml": b"1", "b.xml": b"2", "c.xml": b"3"}.items():
        (tmp_path / name).write_bytes(body)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    then = spark.createDataFrame([("a.xml", sha(b"1")), ("b.xml", sha(b"x")), ("gone.xml", sha(b"4")), ("blank.xml", None)], "name string, sha256 string")
    now = manifest.manifest(spark.read.format("binaryFile").load(str(tmp_path)))
    assert {r["name"]: r["status"] for r in manifest.compare(then, now).collect()} == {"a.xml": "same", "b.xml": "changed", "c.xml": "added", "gone.xml": "missing", "blank.xml": "missing"}
    assert manifest.compare(then.where("false"), now.where("false")).count() == 0


def test_a_run_refuses_changed_files(spark, tmp_path, capsys):
    d = tmp_path / "in"
    d.mkdir()
    (d / "ifanr.xml").write_text("<rss></rss>")
    told = {"sources": [{"id": "ifanr", "file": "ifanr.xml", "sha256": hashlib.sha256(b"other").hexdigest()}]}
    (tmp_path / "manifest.json").write_text(json.dumps(told))
    args = ["collect", "--input", str(d), "--now", "2026-09-16T12:00:00Z", "--only", "ifanr", "--data-dir", str(tmp_path / "out"), "--quiet", "--manifest", str(tmp_path / "manifest.json")]
    assert cli.main(args) == 2 and "ifanr.xml: changed" in capsys.readouterr().err and not (tmp_path / "out").exists()
    told["sources"][0]["sha256"] = hashlib.sha256(b"<rss></rss>").hexdigest()
    (tmp_path / "manifest.json").write_text(json.dumps(told))
    assert cli.main(args) == 0
    assert cli.main([*args[:4], "2101-01-01"]) == 2


ROWS = [  # id, title, summary, source, lang, days old, reasons, cluster, sources, score, picture
    ("a", "GPT one", None, "s1", "zh", 0, ["x", "官方"], "a", 2, 5.0, None), ("b", "Two", "about gpt", "s1", "en", 3, ["x"], "a", 2, 4.0, "u"), ("c", "Three", None, "s2", "zh", 8, [], None, 1, 3.0, "u"),
    ("d", "Four", "", "s2", "zh", 1, None, None, 1, 2.0, None), ("e", "Five", None, "s3", "en", 0, ["涉及x"], None, None, 1.0, None),
]


def test_view(spark):
    df = spark.createDataFrame(ROWS, "id string, title string, summary string, source_id string, lang string, old int, reasons array<string>, cluster_id string, independent_sources int, score double, image_url string")
    now = F.lit("2026-09-16 12:00:00").cast("timestamp")
    df = df.withColumn("at", F.timestamp_micros(F.unix_micros(now) - F.col("old").cast("long") * 86_400_000_000))
    top, read = df.where("id = 'a'").select("id"), df.where("id in ('d', 'e')").select("id")
    ids = lambda **kw: "".join(sorted(r["id"] for r in view.listed(df, view.View(**kw), now, top, read).collect()))
    assert ids() == "cd" and ids(lang=None) == "bcde" and ids(lang=None, with_highlights=True) == "abcde"
    assert ids(lang=None, keyword=" gPt ", with_highlights=True) == "ab" and ids(lang=None, source="s1") == "b" and ids(lang=None, reason="x") == "b" and ids(lang=None, cluster="a", with_highlights=True) == "ab"
    assert ids(lang=None, days=7) == "bde" and ids(lang=None, unread=True) == "bc" and ids(lang=None, multi_source=True) == "b" and ids(lang="en", unread=True, days=1) == ""
    assert ids(lang=None, keyword="  ") == "bcde"
    got = {(r["facet"], r["value"]): r["n"] for r in view.facets(df).collect()}
    assert got == {
        ("all", ""): 5, ("source", "s1"): 2, ("source", "s2"): 2, ("source", "s3"): 1, ("lang", "zh"): 3, ("lang", "en"): 2, ("cluster", "a"): 2, ("multi_source", "true"): 2, ("multi_source", "false"): 3,
        ("reason", "x"): 2, ("reason", "官方"): 1, ("reason", "涉及x"): 1,
    }
    assert view.lead(df).first()["id"] == "b" and view.lead(df.where("image_url is null")).first()["id"] == "a" and view.lead(df.where("false")).count() == 0
