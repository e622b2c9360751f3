"""The driver's tables as articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.functions.grams import normalize_title
from tidewire.functions.text import clean_summary, detect_lang, squeeze

#: The reference time of every query over the test tables.
NOW = "2024-01-31 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined with events: the first line is the title, the rest the summary, the event
    with the document's number gives time and heat, the source's number weight and rank. What is read
    of a text is taken before the join, so no text is shuffled, and of that only what is asked for.
    Events outside the documents' numbers are left out before it."""
    rest = F.when(F.instr("text", "\n") > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise("")
    read = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = read.select(
        "doc_id", "source", squeeze(F.split_part("text", F.lit("\n"), F.lit(1))).alias("title"), clean_summary(rest).alias("summary"), detect_lang(F.col("text")).alias("lang")
    )
    named = F.col("event_id").between(read.agg(F.min("doc_id")).scalar(), read.agg(F.max("doc_id")).scalar())
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where(named).select(F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("published_at"), F.col("value").cast("int").alias("heat"))
    n = F.regexp_extract("source", r"(\d+)$", 1).try_cast("int")
    return docs.join(events, "doc_id", "left").select(
        F.substring(F.sha1(F.col("doc_id").cast("string").cast("binary")), 1, 16).alias("id"), "doc_id", "title",
        normalize_title(F.col("title")).alias("norm"), F.col("source").alias("source_id"), (F.lit(0.85) + F.coalesce(n, F.lit(0)) % 6 * 0.1).alias("source_weight"),
        (F.coalesce(n, F.lit(1)) % 5 == 0).alias("source_official"), "published_at", now().alias("first_seen_at"),
        F.coalesce("published_at", now()).alias("at"), "summary", "lang", "heat",
    )
