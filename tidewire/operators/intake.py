"""From feed items to articles, and what a source's batch was worth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewire import config as C
from tidewire.functions.grams import normalize_title
from tidewire.functions.terms import should_keep
from tidewire.functions.text import clean_image_url, clean_summary, detect_lang, squeeze
from tidewire.functions.time import date_shape, effective, parse_published, suggested_offset, zone_verdict
from tidewire.functions.url import article_id, canonical_url

#: The store's columns. `norm` and `at` are derived from the title and the times.
ARTICLE = (
    "id string, title string, norm string, url string, canonical_url string, source_id string, source_name string, source_name_en string, source_lang string, "
    "source_official boolean, source_weight double, published_at timestamp, published_raw string, published_note string, first_seen_at timestamp, "
    "last_seen_at timestamp, at timestamp, summary string, summary_source string, image_url string, lang string, heat int, comments int"
)
FIELDS = [c.split()[0] for c in ARTICLE.split(", ")]


def normalise(items: DataFrame, dim: DataFrame, at: Column) -> DataFrame:
    """Articles of (source_id, title, url, published_raw, summary_raw, image_url, heat, comments),
    with `kept` (does the source's topic filter let it pass) and `dropped` (a summary was there but
    told nothing). Rows without title or address, and those of unknown sources, are dropped; null
    columns count as empty. `dim` is the registry, a fixed few rows."""
    d = F.broadcast(dim.select(F.col("id").alias("source_id"), "name", "name_en", F.col("lang").alias("source_lang"), "official", "weight", "relevance_filter", "offset_minutes"))
    u, t = F.trim(F.coalesce("url", F.lit(""))), squeeze(F.col("title"))
    joined = items.withColumn("title", t).withColumn("url", u).where("title <> '' and url <> ''").join(d, "source_id")
    a = joined.withColumn("canonical_url", canonical_url(F.col("url"))).where("canonical_url <> ''")
    a = a.withColumn("summary", clean_summary(F.col("summary_raw"))).withColumn("p", parse_published(F.col("published_raw"), at, F.col("offset_minutes")))
    found = detect_lang(F.concat_ws(" ", "title", F.coalesce("summary", F.lit(""))))
    return a.select(
        article_id(F.col("canonical_url")).alias("id"), "title", normalize_title(F.col("title")).alias("norm"), "url", "canonical_url", "source_id",
        F.col("name").alias("source_name"), F.coalesce(F.nullif("name_en", F.lit("")), "name").alias("source_name_en"), "source_lang", F.col("official").alias("source_official"),
        F.col("weight").alias("source_weight"), F.col("p.ts").alias("published_at"), F.nullif("published_raw", F.lit("")).alias("published_raw"), F.col("p.note").alias("published_note"),
        at.alias("first_seen_at"), at.alias("last_seen_at"), effective(F.col("p.ts"), at).alias("at"), "summary",
        F.when(F.col("summary").isNull(), "none").otherwise("feed").alias("summary_source"), clean_image_url(F.col("image_url")).alias("image_url"),
        F.when(found == "other", F.col("source_lang")).otherwise(found).alias("lang"), F.col("heat").cast("int").alias("heat"), F.col("comments").cast("int").alias("comments"),
        should_keep(F.col("relevance_filter"), F.col("title"), F.col("summary")).alias("kept"),
        (F.col("summary").isNull() & (F.coalesce("summary_raw", F.lit("")) != "")).alias("dropped"),
    )


def outcomes(dim: DataFrame, profile: DataFrame, articles: DataFrame, targets: DataFrame, at: Column, days: int = C.WINDOW_DAYS) -> DataFrame:
    """One row for each source of `dim`.

    `profile` has (source_id, answered, items_seen, fault, error) of the sources that answered, `articles` all
    normalised rows, `targets` what the merge made of those kept inside the window. A source without
    an answer has failed; one with malformed or no usable items is a warning and has no new or
    repeated rows; else a newest item older than the limit makes it stale, nothing new no_new.
    """
    n = lambda c: F.count(F.when(c, 1))
    inside = F.unix_micros("at") >= F.unix_micros(at) - days * 86_400_000_000
    a = articles.join(targets.where("priority = 0").select("id", F.lit(True).alias("added")).distinct(), "id", "left")
    offered = F.when(F.col("kept") & inside, F.col("id"))
    worth = a.groupBy("source_id").agg(
        F.count("*").alias("usable"), n(F.col("kept")).alias("items_kept"), n(~F.col("kept")).alias("items_filtered"), n(F.col("published_note") == "tz_corrected").alias("items_tz_corrected"),
        n(F.col("dropped")).alias("items_summary_dropped"), n(F.col("image_url").isNotNull()).alias("items_with_image"), n(F.col("kept") & ~inside).alias("items_out_of_window"),
        F.countDistinct(F.when(F.col("added"), offered)).alias("new"), F.countDistinct(offered).alias("ids"), F.max(F.when(F.col("kept"), F.col("published_at"))).alias("latest_published_at"),
    )
    rows = dim.select(F.col("id").alias("source_id"), "name", F.coalesce(F.nullif("name_en", F.lit("")), "name").alias("name_en"), "url").join(profile, "source_id", "left").join(worth, "source_id", "left")
    zero = [c for c in worth.columns if c not in ("source_id", "latest_published_at")]
    rows = rows.fillna(0, ["items_seen", *zero])
    age = F.floor((F.unix_micros(at) - F.unix_micros("latest_published_at")) / 86_400_000_000)
    stale = F.unix_micros("latest_published_at") < F.unix_micros(at) - C.STALE_SOURCE_DAYS * 86_400_000_000
    failed, warned = F.col("error").isNotNull() | F.col("answered").isNull(), F.col("fault").isNotNull() | (F.col("usable") == 0)
    status = F.when(failed, "failed").when(warned, "parse_warning").when(stale, "stale").when(F.col("new") == 0, "no_new").otherwise("ok")
    # What the report says of a source.
    note = (
        F.when(F.col("status") == "failed", F.coalesce("error", F.lit("missing_fixture：没有该源的响应文件")))
        .when(F.col("fault").isNotNull(), F.concat(F.lit("XML 非法但已容错解析："), "fault"))
        .when((F.col("status") == "parse_warning") & (F.col("items_seen") == 0), "响应中没有任何条目（源格式可能已变）")
        .when(F.col("status") == "parse_warning", F.concat(F.col("items_seen").cast("string"), F.lit(" 条原始条目全部缺少标题或链接")))
        .when(F.col("status") == "stale", F.concat(F.lit("最新条目发布于 "), F.date_format("latest_published_at", "yyyy-MM-dd"), F.lit("（"), age.cast("string"), F.lit(f" 天前），超过 {C.STALE_SOURCE_DAYS} 天阈值")))
    )
    counted = ~F.col("status").isin("failed", "parse_warning")
    return rows.withColumn("status", status).select(
        F.col("source_id").alias("id"), "name", "name_en", "url", "status", F.when(F.col("status") != "failed", 200).alias("http_status"), F.col("items_seen").cast("long").alias("items_seen"),
        "items_kept", "items_filtered", "items_tz_corrected", "items_summary_dropped", "items_with_image", "items_out_of_window",
        F.when(counted, F.col("new")).otherwise(0).alias("items_new"), F.when(counted, F.col("ids") - F.col("new")).otherwise(0).alias("items_dup"), "latest_published_at", note.alias("error"),
    )


def warnings(rows: DataFrame) -> DataFrame:
    """One sentence for each source that needs somebody's attention."""
    return rows.where(F.col("status").isin("failed", "parse_warning", "stale")).select("id", F.concat("name", F.lit("["), "status", F.lit("]"), F.coalesce(F.concat(F.lit(" "), "error"), F.lit(""))).alias("warning"))


def audit(items: DataFrame, at: Column) -> DataFrame:
    """One row for each source: what its items carry, the shapes of their dates, and whether the
    newest of them lies in the future, as mislabelled zones make it."""
    far = F.lit("2100-01-01 00:00:00").cast("timestamp")
    filled = lambda c: F.count(F.when(F.trim(F.coalesce(c, F.lit(""))) != "", 1))
    size = F.length(F.coalesce("summary_raw", F.lit("")))
    by = items.withColumn("shape", date_shape(F.col("published_raw"))).withColumn("ts", parse_published(F.col("published_raw"), far)["ts"])
    shapes = by.groupBy("source_id", "shape").agg(F.count("*").alias("n")).groupBy("source_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("shape", "n")))).alias("date_shapes"))
    out = by.groupBy("source_id").agg(
        F.count("*").alias("entries"), filled("title").alias("with_title"), filled("url").alias("with_url"), F.count(F.when(size > 0, 1)).alias("with_summary"),
        F.min(size).alias("summary_min"), F.max(size).alias("summary_max"), F.max("ts").alias("newest_published"),
    )
    newest = F.col("newest_published")
    return out.join(shapes, "source_id").withColumn("time_verdict", zone_verdict(newest, at)).withColumn("suggested_offset_minutes", suggested_offset(newest, at))
