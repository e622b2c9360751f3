"""Scores with reasons, and the short list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewire import config as C
from tidewire.functions.terms import signals
from tidewire.functions.time import relative_time


def evaluate(articles: DataFrame, members: DataFrame, at: Column, table: dict[str, tuple[str, ...]] = C.SIGNALS) -> DataFrame:
    """`articles` with cluster fields, signals, score and reasons; without a cluster an article is
    alone. Comments count in a reason where `articles` has that column. Signals are read before the
    join, so titles and summaries are only shuffled where they are asked for."""
    w = C.SCORE_WEIGHTS
    a = articles.withColumn("signals", signals(F.col("title"), F.col("summary"), table))
    a = a.join(members, "id", "left").withColumn("cluster_size", F.coalesce("cluster_size", F.lit(1))).withColumn("independent_sources", F.coalesce("independent_sources", F.lit(1)))
    n = F.col("independent_sources")
    cross = F.when(n >= 2, F.least(F.lit(1.0), (n - 1) / max(1, C.CROSS_SATURATION - 1))).otherwise(0.0)
    hours = F.greatest(F.lit(0.0), (F.unix_micros(at) - F.unix_micros("at")) / 3_600_000_000)
    recency = F.greatest(F.lit(0.0), 1 - hours / C.RECENCY_HOURS)
    heat = F.least(F.coalesce("heat", F.lit(0)), F.lit(1000)) / 1000
    score = w["source"] * F.col("source_weight") + w["cross"] * cross + w["recency"] * recency + w["signal"] * F.least(F.size("signals"), F.lit(2)) + w["heat"] * heat
    when = relative_time(F.col("at"), at)
    talk = F.coalesce("comments", F.lit(0)) if "comments" in articles.columns else F.lit(0)
    talk = F.when(talk != 0, F.concat(F.lit(" · "), talk.cast("string"), F.lit(" 评论"))).otherwise("")
    text = F.array(
        F.when(n >= 2, F.concat(n.cast("string"), F.lit(" 个独立来源报道"))).when(F.col("cluster_size") >= 2, F.concat(F.lit("同一事件聚合 "), F.col("cluster_size").cast("string"), F.lit(" 条"))),
        F.when(F.col("source_official"), F.lit("官方一手来源")), when,
        F.when(F.size("signals") > 0, F.concat(F.lit("涉及"), F.array_join("signals", "、"))),
        F.when(F.coalesce("heat", F.lit(0)) != 0, F.concat(F.lit("HN "), F.col("heat").cast("string"), F.lit(" 分"), talk)),
    )
    return a.withColumn("score", F.round(score, 3)).withColumn("when", when).withColumn("reasons", F.filter(text, lambda r: r.isNotNull()))


def why(n: Column, heat: Column, names: Column, official: Column) -> Column:
    """The rule by which an article is a highlight, or null."""
    return (
        F.when(n >= C.HIGHLIGHT_SOURCES, F.concat(n.cast("string"), F.lit(" 个独立来源同时报道")))
        .when(F.coalesce(heat, F.lit(0)) >= C.HIGHLIGHT_HEAT, F.concat(F.lit("社区热度 "), heat.cast("string"), F.lit(" 分")))
        .when(F.size(names) >= C.HIGHLIGHT_SIGNALS, F.concat(F.lit("命中多重信号："), F.array_join(names, "、")))
        .when(official & (F.size(names) >= 1), F.concat(F.lit("官方来源，涉及"), F.try_element_at(names, F.lit(1))))
    )


def card_reasons(rule: Column, reasons: Column, when: Column) -> Column:
    """The rule and the reasons that tell something else, four at most, then without the time."""
    kept = F.filter(reasons, lambda r: ~((F.contains(rule, F.lit("信号")) & F.startswith(r, F.lit("涉及"))) | (F.contains(rule, F.lit("独立来源")) & F.endswith(r, F.lit("个独立来源报道"))) | (F.contains(rule, F.lit("社区热度")) & F.startswith(r, F.lit("HN ")))))
    return F.filter(F.slice(F.array_distinct(F.concat(F.array(rule), kept)), 1, 4), lambda r: r != when)


def highlights(scored: DataFrame, limit: int | None = None) -> DataFrame:
    """The best article of each event that a rule names, by score and id; 5 unless told otherwise."""
    picked = scored.withColumn("why", why(F.col("independent_sources"), F.col("heat"), F.col("signals"), F.col("source_official"))).where("why is not null")
    best = W.partitionBy(F.coalesce("cluster_id", "id")).orderBy(F.col("score").desc(), "id")
    top = picked.withColumn("place", F.row_number().over(best)).where("place = 1").orderBy(F.col("score").desc(), "id").limit(limit or C.HIGHLIGHT_ITEMS)
    return top.select("id", "title", "source_id", "score", card_reasons(F.col("why"), F.col("reasons"), F.col("when")).alias("reasons"), "cluster_size", "independent_sources")
