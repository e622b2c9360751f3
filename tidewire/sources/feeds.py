"""Landed RSS, Atom and JSON files as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidewire import config as C
from tidewire.functions.text import first_image, media_image, squeeze
from tidewire.functions.time import parse_published
from tidewire.sources.markup import read_items

#: Fields of an item with its time, the first one that is there counts.
DATES = ("pubdate", "published", "dcterms:issued", "issued", "updated", "dcterms:modified", "modified", "dc:date", "date", "dcterms:created", "created")
SUMMARIES = ("summary", "description", "content:encoded", "content")
#: What a link may lead to that is a page.
PAGES = ("", "text/html", "application/xhtml+xml")


def _named(*names: str) -> Column:
    return F.filter("item", lambda e: e["name"].isin(*names))


def _first(texts: Column) -> Column:
    return F.try_element_at(F.filter(F.transform(texts, lambda t: F.trim(t)), lambda t: t != ""), F.lit(1))


def _field(name: str) -> Column:
    """The text of an item's first element of that name that has any; null if there is none."""
    return _first(F.transform(_named(name), lambda e: e["text"]))


def _attribute(e: Column, name: str) -> Column:
    return F.coalesce(e["attrs"][name], F.lit(""))


def _media(elements: Column) -> Column:
    address = lambda e: F.coalesce(F.nullif(_attribute(e, "url"), F.lit("")), _attribute(e, "href"))
    return media_image(F.transform(elements, lambda e: F.struct(address(e).alias("url"), _attribute(e, "type").alias("type"))))


def _link() -> Column:
    """Where an item leads: the text of its link, else the address of one that is an alternate and a
    page, else its number, unless that is said to be no address."""
    alternate = F.filter(_named("link"), lambda e: _attribute(e, "rel").isin("", "alternate") & F.lower(_attribute(e, "type")).isin(*PAGES))
    number = F.filter(_named("guid"), lambda e: (F.lower(_attribute(e, "ispermalink")) != "false") & F.contains(e["text"], F.lit("://")))
    return F.coalesce(_field("link"), _first(F.transform(alternate, lambda e: _attribute(e, "href"))), _first(F.transform(number, lambda e: e["text"])))


def landed(files: DataFrame) -> DataFrame:
    """(source_id, variant, n_variants, content) of files <source id>.<anything>, in the order of
    their names from 0. The answers to a source's requests are a few files of at most MAX_BYTES."""
    named = files.select(F.regexp_extract("path", r"([^/.]+)\.[^/]*$", 1).alias("source_id"), "path", F.when(F.col("length") <= C.MAX_BYTES, F.col("content")).alias("content"))
    w = W.partitionBy("source_id")
    return named.select("source_id", (F.row_number().over(w.orderBy("path")) - 1).alias("variant"), F.count("*").over(w).alias("n_variants"), "content")


def feed_profile(feeds: DataFrame) -> DataFrame:
    """(source_id, items_seen, fault) of (source_id, content): items before any is dropped, and why
    the file is not well-formed, null if it is. Content that is null or empty has no items."""
    return read_items(feeds).select("source_id", F.size("items").alias("items_seen"), "fault")


def feed_items(feeds: DataFrame) -> DataFrame:
    """One row for each item of (source_id, content), in feed order: source_id, place, title, url,
    published_raw, summary_raw, image_url, tags, announce. Only what stands directly in an item
    counts, or in a group of media. Items without title or link are dropped."""
    items = read_items(feeds).select("source_id", F.posexplode("items").alias("place", "item"))
    body = F.array_join(F.flatten(F.array(*[F.transform(_named(n), lambda e: e["text"]) for n in SUMMARIES])), "\n")
    attached = F.filter(_named("link"), lambda e: _attribute(e, "rel") == "enclosure")
    image = F.coalesce(*[_media(e) for e in (_named("media:content"), _named("media:thumbnail"), _named("enclosure"), attached)], first_image(body))
    term = lambda e: F.trim(F.coalesce(F.nullif(_attribute(e, "term"), F.lit("")), e["text"]))
    tags = F.filter(F.transform(_named("category"), term), lambda t: t != "")
    out = items.select(
        "source_id", "place", squeeze(_field("title")).alias("title"), F.trim(_link()).alias("url"),
        F.coalesce(*[_field(n) for n in DATES]).alias("published_raw"), F.coalesce(*[_field(n) for n in SUMMARIES], F.lit("")).alias("summary_raw"),
        image.alias("image_url"), tags.alias("tags"), F.lower(_field("arxiv:announce_type")).alias("announce"),
    )
    return out.where("title <> '' and url <> ''")


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """`feed_items` of the files `path`/<source id>.xml."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(path)
    return feed_items(landed(files).where("variant = 0"))


def announced(items: DataFrame, kinds: tuple[str, ...] = C.ANNOUNCE_TYPES) -> DataFrame:
    """Without items of other announcement kinds; those that name none stay."""
    return items.where(F.col("announce").isNull() | F.col("announce").isin(*kinds))


def cap_by_date(items: DataFrame, limit: Column, now: Column) -> DataFrame:
    """The newest `limit` items of each source (all if null); undated ones come last, ties keep
    their place in the feed."""
    w = W.partitionBy("source_id").orderBy(parse_published(F.col("published_raw"), now)["ts"].desc_nulls_last(), "place")
    return items.withColumn("__n", F.row_number().over(w)).where(limit.isNull() | (F.col("__n") <= limit)).drop("__n")


HITS = "hits array<struct<objectID:string,title:string,url:string,created_at:string,points:int,num_comments:int>>"


def _hits(hit: DataFrame) -> DataFrame:
    url = F.coalesce(F.nullif(F.trim("url"), F.lit("")), F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("objectID")))
    return hit.select(
        "source_id", squeeze(F.col("title")).alias("title"), url.alias("url"), F.col("created_at").alias("published_raw"),
        F.coalesce("points", F.lit(0)).alias("heat"), F.coalesce("num_comments", F.lit(0)).alias("comments"),
    ).where("title <> ''")


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSON search answer; an item without its own address gets that of its discussion."""
    hit = spark.read.schema(HITS).option("multiLine", True).json(path).select(F.lit("hn").alias("source_id"), F.explode("hits").alias("h"))
    return _hits(hit.select("source_id", "h.*"))


def hit_rows(answers: DataFrame) -> DataFrame:
    """The hits of both tracks of landed answers (see `answers`), as a bag: the first answer serves
    the first track, the second one, or else the first again, the other. Broken answers have none."""
    twice = F.when(F.col("n_variants") == 1, 2).otherwise(1)
    hits = answers.where("fault is null and variant < 2").withColumn("__again", F.explode(F.array_repeat(F.lit(0), twice))).drop("__again")
    return hits.withColumnRenamed("object_id", "objectID")


def hit_items(answers: DataFrame) -> DataFrame:
    return _hits(hit_rows(answers))
