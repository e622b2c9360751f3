"""Events: similar articles, joined over shared grams and rare entities."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewire import config as C
from tidewire.functions.grams import blocking_grams, containment, entities, jaccard, same_event, shingle_set
from tidewire.operators import similar
from tidewire.operators.graph import connected_components
from tidewire.storage import Scratch

#: 64-bit words in the bitmap of a title's grams.
WORDS = 8
#: Articles of one title that stand in a row together, or so.
COPIES = 256


def found_entities(articles: DataFrame, stop: tuple[str, ...] = C.ENTITY_STOP) -> DataFrame:
    """(id, entity): names in each title; case variants are different ones."""
    return articles.select("id", F.explode(entities(F.col("title"), stop)).alias("entity"))


def entity_counts(found: DataFrame) -> DataFrame:
    """(entity, df) of (id, entity): how many rows have each name, by its lower-cased form."""
    return found.groupBy(F.lower("entity").alias("entity")).agg(F.count("*").alias("df"))


def rare_entities(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, entity, df) of the rows of (id, entity) whose name at most RARE_ENTITY_DF, three, rows have.

    Rows are numbered, and of each name only the least and the largest number, the number of rows and
    the exclusive or of their numbers are kept, from which the one in the middle follows. So a task
    sends one row for a name, however many rows have it, and no name's rows ever meet.
    """
    assert C.RARE_ENTITY_DF == 3
    rows = scratch.table(found.withColumn("num", F.monotonically_increasing_id()), "entities")
    ends = rows.groupBy(F.lower("entity")).agg(F.count("*").alias("df"), F.min("num").alias("lo"), F.max("num").alias("hi"), F.bit_xor("num").alias("x"))
    lo, hi = F.col("lo"), F.col("hi")
    nums = F.when(F.col("df") == 1, F.array(lo)).when(F.col("df") == 2, F.array(lo, hi)).otherwise(F.array(lo, F.col("x").bitwiseXOR(lo).bitwiseXOR(hi), hi))
    few = ends.where(F.col("df") <= C.RARE_ENTITY_DF).select("df", F.explode(nums).alias("num"))
    return rows.join(few, "num").select("id", "entity", "df")


def blocked_pairs(postings: DataFrame, most: int = C.MAX_POSTINGS) -> DataFrame:
    """Distinct pairs a < b of ids that share a key which 2 to `most` rows have. Keys with more rows
    are dropped before the join, so no key makes more than most^2 / 2 pairs."""
    kept = postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n").between(2, most)).select("key")
    p = postings.join(kept, "key")
    a, b = p.select("key", F.col("id").alias("a")), p.select("key", F.col("id").alias("b"))
    return a.join(b, "key").where("a < b").select("a", "b").distinct()


@dataclass
class _Recent:
    """Articles of the window: rows (id, key, norm) with a title, `key` its digest, (id, entity) of
    rare names, the smallest id that has a title and its row, (key, head, row), and the packed grams
    of the heads."""

    rows: DataFrame
    rare: DataFrame
    heads: DataFrame
    sets: DataFrame


def _hashed(norm: Column) -> Column:
    return F.array_distinct(F.transform(shingle_set(norm), lambda g: F.xxhash64(g)))


def _recent(articles: DataFrame, at: Column, window_hours: int, stop: tuple[str, ...], scratch: Scratch, of: str = "id") -> _Recent:
    """Titles are long, so they are written once, normalised, and met by their digests. Sets are told
    apart by the `of` of their heads, "id" or "row"."""
    recent = articles.where(F.unix_micros("at") >= F.unix_micros(at) - window_hours * 3_600_000_000)
    key = F.when(F.col("norm") != "", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)))
    recent = recent.select("id", entities(F.col("title"), stop).alias("names"), "norm", key.alias("key"), F.monotonically_increasing_id().alias("row"))
    recent = scratch.table(recent, "recent")
    rare = rare_entities(recent.select("id", F.explode("names").alias("entity")), scratch)  # a name counts wherever it is
    rows = recent.where("key is not null")
    heads = scratch.table(rows.groupBy("key").agg(F.min(F.struct("id", "row")).alias("h")).select("key", F.col("h.id").alias("head"), "h.row"), "heads")
    norms = rows.select("id", "row", "norm").join(heads.select("row"), "row", "left_semi")
    sets = scratch.table(norms.select(F.col(of).alias("id"), _hashed(F.col("norm")).alias("s")), "grams")
    packed = similar.rare_first(sets, scratch)
    scratch.drop(sets)
    rare = scratch.table(rare.join(rows.select("id"), "id").select("id", "entity"), "rare")
    return _Recent(rows.select("id", "key", "norm"), rare, heads, packed)


def _by_entities(rare: DataFrame) -> DataFrame:
    """(a, b, shared) of rows that have two rare names in common. Three rows at most have one."""
    a, b = rare.select("entity", F.col("id").alias("a")), rare.select("entity", F.col("id").alias("b"))
    met = a.join(b, "entity").where("a < b").groupBy("a", "b").agg(F.array_sort(F.collect_set("entity")).alias("shared"))
    return met.where(F.size("shared") >= C.CLUSTER_SHARED_ENTITIES)


def event_links(articles: DataFrame, at: Column, window_hours: int = C.CLUSTER_WINDOW_HOURS, stop: tuple[str, ...] = C.ENTITY_STOP) -> DataFrame:
    """(a, b) of articles within the window before `at` that tell of the same event: enough of the
    links of `same_event_pairs` to connect what those connect, about one for an article. Exact; no
    key is too frequent, and copies of a title cost one link each."""
    scratch = Scratch(articles.sparkSession, "events")
    now = _recent(articles, at, window_hours, stop, scratch)
    copies = now.rows.join(now.heads, "key").where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"))
    near = similar.spanning_links(now.sets, C.CLUSTER_JACCARD, scratch)
    return scratch.last(copies.unionByName(near).unionByName(_by_entities(now.rare).select("a", "b")).distinct(), "links")


def same_event_pairs(articles: DataFrame, at: Column, window_hours: int = C.CLUSTER_WINDOW_HOURS, stop: tuple[str, ...] = C.ENTITY_STOP, most: int | None = None, reasons: bool = True) -> DataFrame:
    """(a, b, reason), without `reasons` (a, b), of all pairs of articles within the window before `at`
    that tell of the same event. Exact, and so quadratic in an event's articles: `event_links` connects the same ones.

    Pairs come out of the tasks that find them: those by title from blocks of titles with the articles
    that have them, those by names alone from a table, which a few rows for an article make. Only
    where articles repeat an id with different titles are pairs shuffled, as they may repeat then.

    With `most`, only pairs are looked at that share a 4-gram or a rare name which no more than `most`
    articles have (MAX_POSTINGS in the daily collection that this follows); others are lost.
    """
    scratch = Scratch(articles.sparkSession, "pairs")
    now = _recent(articles, at, window_hours, stop, scratch, "row")
    members = scratch.table(now.rows.join(now.heads, "key").select("id", "row").distinct(), "members")
    many = members.groupBy("row").agg(F.ceil(F.count("*") / COPIES).alias("parts"))
    part = F.pmod(F.xxhash64("id"), "parts")
    copies = members.join(many, "row").groupBy("row", part.alias("part")).agg(F.collect_list("id").alias("ids"))
    sets = now.sets.withColumnRenamed("id", "row").join(copies, "row").withColumn("num", F.monotonically_increasing_id())
    sets = scratch.table(sets.select("num", F.col("ids").alias("id"), "n", "spare", "words", "tail"), "copies")
    alike = similar.similar_pairs(sets, C.CLUSTER_JACCARD, scratch, reasons)
    side = lambda c: now.rows.select(F.col("id").alias(c), F.col("norm").alias(f"norm_{c}"))
    named = _by_entities(now.rare).join(side("a"), "a").join(side("b"), "b")
    named = named.select("a", "b", jaccard(_hashed(F.col("norm_a")), _hashed(F.col("norm_b"))).alias("similarity"), "shared")
    named = scratch.table(named.where(F.col("similarity") < C.CLUSTER_JACCARD), "named")
    if reasons:
        alike = alike.withColumn("shared", F.lit(None).cast("array<string>"))
    found = alike.unionByName(named.select(alike.columns))
    if not members.groupBy("id").count().where("count > 1").isEmpty():
        found = found.where("a <> b")
        found = found.groupBy("a", "b").agg(F.max("similarity").alias("similarity"), F.max("shared").alias("shared")) if reasons else found.distinct()
    if most is not None:
        by_gram = now.rows.select("id", F.explode(blocking_grams(F.col("norm"), 4)).alias("key"))
        by_name = now.rare.select("id", F.concat(F.lit("\0"), F.lower("entity")).alias("key")).distinct()
        found = found.join(blocked_pairs(scratch.table(by_gram.unionByName(by_name), "keys"), most), ["a", "b"], "left_semi")
    return found.select("a", "b", same_event(F.col("similarity"), F.col("shared")).alias("reason")) if reasons else found


def event_members(articles: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, cluster_id, cluster_size, independent_sources) for the members of every event, with the
    smallest member id as cluster_id. `pairs` are those of `event_links` or `same_event_pairs`."""
    scratch = Scratch(articles.sparkSession, "events")
    of = connected_components(pairs, "a", "b", scratch).select(F.col("node").alias("id"), F.col("component").alias("cluster_id"))
    named = scratch.last(of.join(articles.select("id", "source_id"), "id"), "members")
    sizes = named.groupBy("cluster_id").agg(F.count("*").alias("cluster_size"), F.countDistinct("source_id").alias("independent_sources"))
    return named.join(sizes, "cluster_id").select("id", "cluster_id", "cluster_size", "independent_sources")


def cross_source(members: DataFrame) -> DataFrame:
    return members.where("cluster_size >= 2 and independent_sources >= 2")


def near_duplicate_titles(titles: DataFrame) -> DataFrame:
    """(a, b, containment) over distinct normalised titles (id, norm): similar lengths, 90 % of the
    smaller set of 3-grams shared. The result is exact; no gram is too frequent.

    A set that shares nine tenths of its grams has one of its rarest tenth in common with the other,
    so only those are looked up, and only among titles of nearby lengths. A gram counts only as early
    in the larger set as the first common one can be. Each gram sets one of 64 * WORDS bits; a title
    has no more bits that the other one lacks than grams that it may lack.
    """
    scratch = Scratch(titles.sparkSession, "titles")
    grams = F.transform(blocking_grams(F.col("norm"), 3), lambda g: F.xxhash64(g))
    sets = scratch.table(titles.select("id", F.length("norm").alias("l"), F.array_distinct(grams).alias("s")), "sets")
    least = lambda n: F.ceil(n * C.DUP_CONTAINMENT - 1e-9)
    rows = sets.select("id", "l", F.size("s").alias("n"), F.explode("s").alias("g"))
    w, bit = W.partitionBy("id"), F.shiftrightunsigned("g", 6)
    flag = F.expr("shiftleft(1L, cast(g & 63 as int))")
    words = [F.bit_or(F.when(F.pmod(bit, F.lit(WORDS)) == k, flag).otherwise(F.lit(0).cast("long"))).over(w).alias(f"w{k}") for k in range(WORDS)]
    # one more than the ratio allows, so that rounding cannot part neighbours
    band = F.floor(F.log(F.col("l").cast("double")) / -math.log(0.999 * C.DUP_LENGTH_RATIO))
    # written before it is joined, so that the join of a gram that most titles have can be split
    counts = scratch.table(rows.groupBy("g").agg(F.count("*").alias("df")), "frequencies")
    placed = rows.join(counts, "g").select("id", "l", "n", "g", band.alias("band"), F.row_number().over(w.orderBy("df", "g")).alias("place"), *words)
    placed = scratch.table(placed, "placed")
    x = placed.where(F.col("place") <= F.col("n") - least(F.col("n")) + 1).drop("place")
    x = x.withColumn("band", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])))
    few = x.groupBy("g", "band").agg(F.min("n").alias("few"))
    y = placed.join(few, ["g", "band"]).where((F.col("n") >= F.col("few")) & (F.col("place") <= F.col("n") - least(F.col("few")) + 1)).drop("few")
    x, y = (t.select("g", "band", *[F.col(c).alias(f"{side}_{c}") for c in t.columns if c not in ("g", "band")]) for side, t in (("x", x), ("y", y)))
    nx, ny = F.col("x_n"), F.col("y_n")
    fit = (nx < ny) | ((nx == ny) & (F.col("x_id") < F.col("y_id")))
    fit &= (F.col("y_place") <= ny - least(nx) + 1) & (F.least("x_l", "y_l") >= C.DUP_LENGTH_RATIO * F.greatest("x_l", "y_l"))
    lacks = sum((F.bit_count(F.col(f"x_w{k}").bitwiseAND(F.bitwise_not(F.col(f"y_w{k}")))) for k in range(WORDS)), F.lit(0))
    pairs = x.join(y, ["g", "band"]).where(fit & (lacks <= nx - least(nx))).select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", containment(F.col("sa"), F.col("sb")).alias("containment")).where(F.col("containment") >= C.DUP_CONTAINMENT)
