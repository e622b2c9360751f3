"""Counts of the store, outcomes of sources, and health of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewire import config as C


def count_columns(at: Column) -> list[Column]:
    """The counts of a store, for `agg` or for an observation of its write. last_24h and last_7d look
    at the publish time alone."""
    age = F.unix_micros(at) - F.unix_micros("published_at")
    n = lambda c: F.count(F.when(c, 1))
    return [
        F.count("*").alias("total"), n(F.col("lang") == "zh").alias("zh"), n(F.col("lang") == "en").alias("en"), n(F.col("source_official")).alias("official"),
        n(F.col("published_at").isNotNull()).alias("with_published_at"), n(F.col("published_at").isNull()).alias("without_published_at"), n(F.col("cluster_id").isNotNull()).alias("clustered"),
        n(F.col("image_url").isNotNull()).alias("with_image"), n(age <= 86_400_000_000).alias("last_24h"), n(age <= 7 * 86_400_000_000).alias("last_7d"),
    ]


def store_counts(articles: DataFrame, at: Column) -> DataFrame:
    """One row of counts."""
    return articles.agg(*count_columns(at))


def source_outcomes(articles: DataFrame, at: Column, keep: Column, days: int = C.WINDOW_DAYS) -> DataFrame:
    """One row for each source: rows seen, kept and filtered, with a summary, out of the window, the
    newest kept publish time, and a status."""
    old = F.unix_micros("at") < F.unix_micros(at) - days * 86_400_000_000
    n = lambda c: F.count(F.when(c, 1))
    out = articles.withColumn("kept", keep).groupBy("source_id").agg(
        F.count("*").alias("items_seen"), n(F.col("kept")).alias("items_kept"), n(~F.col("kept")).alias("items_filtered"), n(F.col("summary").isNotNull()).alias("items_with_summary"),
        n(F.col("kept") & old).alias("items_out_of_window"), F.countDistinct(F.when(F.col("kept") & ~old, F.col("id"))).alias("items_new"), F.max(F.when(F.col("kept"), F.col("published_at"))).alias("latest_published_at"),
    )
    stale = F.unix_micros("latest_published_at") < F.unix_micros(at) - C.STALE_SOURCE_DAYS * 86_400_000_000
    return out.withColumn("status", F.when(stale, "stale").when(F.col("items_new") == 0, "no_new").otherwise("ok"))


STATUSES = ("ok", "no_new", "stale", "parse_warning", "failed")


def health(outcomes: DataFrame) -> DataFrame:
    """(status, n) with a row for every status."""
    all_of = outcomes.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    return all_of.join(outcomes.groupBy("status").agg(F.count("*").alias("n")), "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def overall(outcomes: DataFrame, added: Column) -> DataFrame:
    failed = F.col("status") == "failed"
    return outcomes.agg(F.when(F.every(failed), "failed").when(F.some(failed), "partial").when(added == 0, "no_new").otherwise("success").alias("overall"))


def success_rate(runs: DataFrame, at: Column, days: int = 7) -> DataFrame:
    """Share of the runs of the last days that ended in success or no_new, to 4 places; partial does
    not count. Also the start of the last such run of any age."""
    good = F.col("overall").isin("success", "no_new")
    recent = F.unix_micros("started_at") >= F.unix_micros(at) - days * 86_400_000_000
    return runs.agg(F.round(F.avg(F.when(recent, good.cast("int"))), 4).alias("success_rate_7d"), F.max(F.when(good, F.col("started_at"))).alias("last_success_at"))
