"""Merging a batch into the store: which rows are new, which refresh a stored one, what stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewire import config as C
from tidewire.operators.cluster import near_duplicate_titles
from tidewire.storage import Scratch

MAX_ROUNDS = 100


def split_by_window(articles: DataFrame, at: Column, days: int = C.WINDOW_DAYS) -> DataFrame:
    """With `inside`: is the effective time within `days` before `at`, the bound included?"""
    return articles.withColumn("inside", F.unix_micros("at") >= F.unix_micros(at) - days * 86_400_000_000)


def retain(articles: DataFrame, at: Column, days: int = C.WINDOW_DAYS, capacity: int | None = C.MAX_STORE_ITEMS) -> DataFrame:
    """Rows inside the window, at most `capacity` of the newest, or all, unsorted, if it is None."""
    inside = split_by_window(articles, at, days).where("inside").drop("inside")
    if capacity is None:
        return inside
    return inside.orderBy(F.col("at").desc(), F.col("first_seen_at").desc(), F.col("id").desc()).limit(capacity)


def _key(stored: bool) -> Column:
    """What orders rows, smallest first: stored ones by time, first sight and id, all descending,
    and then those of the batch by weight, time and id. No global sort is needed to compare two."""
    at, back = -F.unix_micros("at"), F.translate("id", "0123456789abcdef", "fedcba9876543210")
    parts = (F.lit(0), at.cast("double"), -F.unix_micros("first_seen_at"), back) if stored else (F.lit(1), -F.col("source_weight"), at, F.col("id"))
    return F.struct(*[p.alias(n) for p, n in zip((*parts, F.col("id")), ("batch", "o1", "o2", "o3", "id"))])


def _near_edges(heads: DataFrame) -> DataFrame:
    """(a, b) of rows (key, norm), one for each title, whose titles are near duplicates, a earlier
    than b. The titles are numbered, so that only numbers and bitmaps are shuffled by gram."""
    scratch = Scratch(heads.sparkSession, "near")
    rows = scratch.table(heads.withColumn("id", F.monotonically_increasing_id()), "numbered")
    pairs = scratch.table(near_duplicate_titles(rows.select("id", "norm")).select("a", "b"), "pairs")
    side = lambda c: rows.select(F.col("id").alias(c), F.col("key").alias(f"k{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))


def match(existing: DataFrame, incoming: DataFrame, fuzzy: bool = True) -> DataFrame:
    """(id, target, priority) for each distinct incoming id: the row that it is merged into, itself
    if it is new. Incoming rows come by weight, time and id. A row matches one of the same id, else
    the first with the same normalised title, else a near duplicate (the earliest one); only rows
    that were stored or have survived can be matched, which is settled in rounds until nothing is
    open. Matches are not transitive, so this is no matter of connected components.
    """
    scratch = Scratch(existing.sparkSession, "merge")
    store = existing.select(_key(True).alias("key"), "norm", F.lit(0).alias("batch"))
    first = incoming.withColumn("n", F.row_number().over(W.partitionBy("id").orderBy(F.col("source_weight").desc(), F.col("at").desc()))).where("n = 1")
    known = first.join(existing.select("id"), "id", "left_semi").select("id", F.col("id").alias("target"), F.lit(1).alias("priority"))
    rest = first.join(existing.select("id"), "id", "left_anti")
    nodes = scratch.table(store.unionByName(rest.select(_key(False).alias("key"), "norm", F.lit(1).alias("batch"))), "nodes")
    titled = nodes.where("norm <> ''")
    # Later rows of a title share its first one's fate: they match it if it survives, and otherwise
    # whatever absorbed it, which is earlier than all of them. So the rounds see each title once.
    head = scratch.table(titled.groupBy("norm").agg(F.min("key").alias("head")), "heads")
    if fuzzy:
        edges = _near_edges(head.select(F.col("head").alias("key"), "norm")).where("b.batch = 1")
    else:
        edges = head.select(F.col("head").alias("a"), F.col("head").alias("b")).where("false")
    edges = scratch.table(edges, "edges")
    state = scratch.table(head.select(F.col("head").alias("key"), F.when(F.col("head.batch") == 0, 1).cast("int").alias("alive")), "state")
    for _ in range(MAX_ROUNDS):
        seen = edges.join(state.select(F.col("key").alias("a"), "alive"), "a").groupBy("b").agg(F.max(F.coalesce("alive", F.lit(0))).alias("hit"), F.count(F.when(F.col("alive").isNull(), 1)).alias("open"))
        now = F.when(F.col("alive").isNotNull(), F.col("alive")).when(F.col("hit") == 1, 0).when(F.coalesce("open", F.lit(0)) == 0, 1)
        new = scratch.table(state.join(seen, state["key"] == seen["b"], "left").select("key", now.cast("int").alias("alive")), "state")
        scratch.drop(state)
        state = new
        if state.where("alive is null").isEmpty():
            break
    else:
        raise RuntimeError("the survivors did not settle")
    alive = state.where("alive = 1").select(F.col("key").alias("a"))
    best = edges.join(alive, "a").groupBy("b").agg(F.min("a").alias("m"))
    fate = head.join(best, head["head"] == best["b"], "left").join(state, head["head"] == state["key"]).select("norm", "head", "alive", "m")
    late = titled.where("batch = 1").select("key", "norm").join(fate, "norm")
    own = F.col("alive") == 1
    target = F.when(own, F.col("head.id")).otherwise(F.col("m.id"))
    priority = F.when(own & (F.col("head") == F.col("key")), 0).when(own, 2).otherwise(3)
    told = late.select(F.col("key.id").alias("id"), target.alias("target"), priority.alias("priority"))
    blank = nodes.where("norm = '' and batch = 1").select(F.col("key.id").alias("id"), F.col("key.id").alias("target"), F.lit(0).alias("priority"))
    return scratch.table(known.unionByName(told).unionByName(blank), "targets")


#: Columns that a later row may change; all others are an article's identity. `DERIVED` ones are
#: computed anew after a merge.
VOLATILE = ("published_at", "published_raw", "published_note", "summary", "summary_source", "heat", "comments", "image_url", "source_name_en", "last_seen_at", "at")
DERIVED = ("cluster_id", "cluster_size", "independent_sources", "score", "reasons")


def merge(existing: DataFrame, incoming: DataFrame, at: Column, days: int = C.WINDOW_DAYS, capacity: int | None = C.MAX_STORE_ITEMS, fuzzy: bool = True) -> tuple[DataFrame, DataFrame]:
    """(the new store, targets of the batch). A stored row keeps id, title and first_seen_at; its
    time is filled only if missing, the longest summary and the largest heat win, ties going to the
    stored row and then to the earlier one."""
    targets = match(existing, incoming, fuzzy)
    batch = incoming.withColumn("rank", _key(False)).join(targets.select("id", "target", "priority"), "id")
    base = existing.withColumn("rank", _key(True)).withColumn("target", F.col("id")).withColumn("priority", F.lit(0))
    rows = base.unionByName(batch, allowMissingColumns=True)
    has = set(existing.columns)
    who = F.struct(*[c for c in existing.columns if c not in VOLATILE])
    first = lambda c, ok: F.min_by(c, F.when(ok, F.col("rank")))
    dated = F.struct(*[c for c in ("published_at", "published_raw", "published_note") if c in has])
    told = F.struct(*[c for c in ("summary", "summary_source") if c in has])
    aggs = [
        first(who, F.col("id") == F.col("target")).alias("who"), first(dated, F.col("published_at").isNotNull()).alias("dated"),
        first(dated, F.col("id") == F.col("target")).alias("undated"), first(told, F.col("id") == F.col("target")).alias("untold"),
        F.min_by(told, F.when(F.col("summary") != "", F.struct(-F.length("summary"), F.col("rank")))).alias("told"),
        F.max("heat").alias("heat"), F.count("*").alias("rows"), F.max("rank.batch").alias("touched"),
    ]
    if "comments" in has:
        aggs.append(F.max("comments").alias("comments"))
    if "image_url" in has:
        aggs.append(first("image_url", F.col("image_url").isNotNull()).alias("image_url"))
    if "source_name_en" in has:
        aggs.append(F.max_by("source_name_en", F.when(F.col("source_name_en") != "", F.col("rank"))).alias("source_name_en"))
    if "last_seen_at" in has:
        aggs.append(first("last_seen_at", F.col("id") == F.col("target")).alias("seen_before"))
    merged = rows.groupBy("target").agg(*aggs).drop("target")
    merged = merged.withColumn("dated", F.coalesce("dated", "undated")).withColumn("told", F.coalesce("told", "untold")).drop("undated", "untold")
    rest = [c for c in merged.columns if c not in ("who", "dated", "told")]
    merged = merged.select("who.*", "dated.*", "told.*", *rest).withColumn("at", F.coalesce("published_at", "first_seen_at"))
    before = F.col("seen_before") if "last_seen_at" in has else F.col("first_seen_at")
    merged = merged.withColumn("last_seen_at", F.when(F.col("touched") == 1, at).otherwise(before)).drop("touched", "seen_before")
    return retain(merged, at, days, capacity), targets


def sync_names(articles: DataFrame, dim: DataFrame) -> DataFrame:
    """Display names as the registry has them now."""
    names = F.broadcast(dim.where("enabled").select(F.col("id").alias("source_id"), F.coalesce(F.nullif("name_en", F.lit("")), "name").alias("__name")))
    return articles.join(names, "source_id", "left").withColumn("source_name_en", F.coalesce("__name", "source_name_en")).drop("__name")
