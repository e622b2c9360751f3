"""What a reader sees of the articles: the list under filters, the filters' counts, the lead story."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class View:
    """Filters that all must hold. The default shows one language and leaves out the highlights, which
    stand above the list; `EVERYTHING` is what is left when all filters are cleared."""

    lang: str | None = "zh"
    keyword: str | None = None
    source: str | None = None
    reason: str | None = None
    cluster: str | None = None
    days: int | None = None
    unread: bool = False
    multi_source: bool = False
    with_highlights: bool = False


EVERYTHING = View(lang=None)


def matches(view: View, at: Column) -> Column:
    """Do an article's own columns pass the view? A reason must be one of the article's, word for
    word; a keyword may stand anywhere in title or summary, in any case; `days` go back from `at`."""
    keyword = F.lit((view.keyword or "").strip().lower())
    hay = F.lower(F.concat_ws("\n", "title", F.coalesce("summary", F.lit(""))))
    tests = [
        (view.lang, F.col("lang") == view.lang), ((view.keyword or "").strip(), F.contains(hay, keyword)), (view.source, F.col("source_id") == view.source),
        (view.reason, F.array_contains("reasons", F.lit(view.reason))), (view.cluster, F.col("cluster_id") == view.cluster),
        (view.days, F.unix_micros("at") >= F.unix_micros(at) - (view.days or 0) * 86_400_000_000), (view.multi_source, F.col("independent_sources") >= 2),
    ]
    out = F.lit(True)
    for asked, holds in tests:
        if asked not in (None, False, ""):
            out = out & F.coalesce(holds, F.lit(False))
    return out


def listed(articles: DataFrame, view: View, at: Column, highlights: DataFrame, read: DataFrame | None = None) -> DataFrame:
    """The articles (id, title, summary, source_id, lang, at, reasons, cluster_id,
    independent_sources) that a view shows. `highlights` (id) are a few rows; `read` (id) may be
    large, is matched by id and only asked for unread articles."""
    out = articles.where(matches(view, at))
    if not view.with_highlights:
        out = out.join(F.broadcast(highlights.select("id")), "id", "left_anti")
    if view.unread and read is not None:
        out = out.join(read.select("id"), "id", "left_anti")
    return out


def facets(articles: DataFrame) -> DataFrame:
    """(facet, value, n): how many articles each choice of a filter shows by itself, over source,
    lang, cluster, multi_source and reason, and all of them. One pass counts the facets of which an
    article has one value each, in sets of groups; reasons are counted by their members."""
    one = articles.select("source_id", "lang", "cluster_id", (F.coalesce("independent_sources", F.lit(1)) >= 2).cast("string").alias("multi_source"))
    keys = ["source_id", "lang", "cluster_id", "multi_source"]
    sets = one.groupingSets([[k] for k in keys] + [[]], *keys).agg(F.count("*").alias("n"), F.grouping_id(*keys).alias("set"))
    # a key's bit is 0 where rows are grouped by it
    named = F.when(F.col("set") == 2 ** len(keys) - 1, "all")
    value = F.lit("")
    for i, k in enumerate(keys):
        own = F.col("set") == 2 ** len(keys) - 1 - 2 ** (len(keys) - 1 - i)
        named, value = named.when(own, k.removesuffix("_id")), F.when(own, F.col(k)).otherwise(value)
    single = sets.select(named.alias("facet"), value.alias("value"), "n").where("value is not null")
    reasons = articles.select(F.explode(F.array_distinct("reasons")).alias("value")).groupBy("value").agg(F.count("*").alias("n"))
    return single.unionByName(reasons.withColumn("facet", F.lit("reason")))


def lead(highlights: DataFrame) -> DataFrame:
    """The highlight that leads: of those with a picture the one with the highest score, or of all if
    none has one; ties go to the smallest id. No highlights give no rows."""
    rank = F.struct(F.col("image_url").isNotNull().alias("pictured"), F.col("score").alias("score"), F.translate("id", "0123456789abcdef", "fedcba9876543210").alias("id"))
    best = highlights.agg(F.max_by(F.struct(*highlights.columns), rank).alias("h"))
    return best.where("h is not null").select("h.*")
