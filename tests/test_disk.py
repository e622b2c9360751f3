"""What is shuffled and written on the way, as disk is what large tables run out of."""
import re
import time
from pathlib import Path

from pyspark.sql import functions as F

from tidewire.operators import cluster, score, views
from tidewire.plans import queries
from tidewire.storage import CLEANUP, Scratch

DIR = "/root/testdata/sf0.001"


def exchanged(df):
    """Names of the columns that the plan's exchanges send."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    sent = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert sent
    return {c.split("#")[0].strip() for row in sent for c in row.split(", ")}


def written(monkeypatch):
    """The columns of each table that is written from now on."""
    seen, table = [], Scratch.table
    monkeypatch.setattr(Scratch, "table", lambda self, df, name="t": seen.append((name, df.columns)) or table(self, df, name))
    return seen


def test_no_text_meets_the_events(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        assert exchanged(views.articles(spark, DIR)) >= {"title", "summary"}
        assert "text" not in exchanged(views.articles(spark, DIR))
        assert not {"text", "title", "summary"} & exchanged(views.articles(spark, DIR).select("id", "source_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_titles_are_written_once(spark, monkeypatch):
    """Equal titles, one without a title, and two rows that repeat an id."""
    rows = [("a", "Same words here"), ("b", "same, words: HERE"), ("c", "?!"), ("d", "Another thing"), ("d", "Another thing"), ("e", None)]
    norm = F.regexp_replace(F.lower(F.coalesce("title", F.lit(""))), "[^a-z]+", "")
    at = F.lit("2024-01-31 00:00:00").cast("timestamp")
    articles = spark.createDataFrame(rows, "id string, title string").withColumn("norm", norm).withColumn("at", at)
    seen = written(monkeypatch)
    links = cluster.event_links(articles, at)
    assert {(r["a"], r["b"]) for r in links.collect()} == {("a", "b")}
    assert sum("norm" in columns for _, columns in seen) == 1
    assert not any("title" in columns for _, columns in seen)


def test_shuffles_of_a_written_table_go(spark):
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*.data")}
    before = files()
    counts = spark.range(100_000).groupBy((F.col("id") % 5000).alias("k")).count()
    table = Scratch(spark, "t").table(counts, "counts")
    assert table.count() == 5000 and spark.conf.get(CLEANUP) == "false"
    until = time.time() + 10
    while left := [f for f in files() - before if f.stat().st_size > 10_000]:
        assert time.time() < until, left
        time.sleep(0.1)


def test_events_of_no_document_are_not_shuffled(spark, tmp_path):
    """Ten times the events that there are documents: those beyond the documents' numbers stay out."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    most = docs.agg(F.max("doc_id")).first()[0]
    events = spark.range(-5, 10 * most).select(F.col("id").alias("event_id"), F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit(7.0).alias("value"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = views.articles(spark, str(tmp_path)).select("id", "heat", "at")
        assert found.where("heat = 7").count() == docs.count()
        found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        text = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
        assert plan.toString().count("event_id") and re.search(r"event_id#\d+L? >= Subquery", text) and re.search(r"event_id#\d+L? <= Subquery", text)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scores_do_not_shuffle_texts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        at = F.lit("2024-01-31 00:00:00").cast("timestamp")
        rows = [("a", "Title", "Text", "s", 1.0, False, 3)]
        articles = spark.createDataFrame(rows, "id string, title string, summary string, source_id string, source_weight double, source_official boolean, heat int").withColumn("at", at)
        members = spark.createDataFrame([("a", "a", 2, 2)], "id string, cluster_id string, cluster_size long, independent_sources long")
        scored = score.evaluate(articles, members, at)
        assert not {"title", "summary"} & exchanged(scored.select("id", "score", "reasons"))
        assert {"title", "summary"} <= exchanged(scored.select("id", "title", "summary"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_scored_articles_are_written_as_far_as_they_are_read(spark, monkeypatch):
    seen = written(monkeypatch)
    queries.facet_counts(spark, DIR)
    queries.lead_story(spark, DIR)
    kept = [set(columns) for name, columns in seen if name == "scored"]
    assert len(kept) == 2 and not kept[0] & {"id", "title", "summary"} and "summary" not in kept[1]


def test_only_the_last_table_stays(spark):
    scratch = Scratch(spark, "t")
    a = scratch.table(spark.range(10), "a")
    b = scratch.table(a.where("id > 3"), "b")
    last = scratch.last(a.join(b, "id"), "last")
    assert last.count() == 6 and [p.name for p in Path(scratch.path.removeprefix("file:")).iterdir()] == ["003-last"]
