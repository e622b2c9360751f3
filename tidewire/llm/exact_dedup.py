"""10. Exact dedup with a heavy-hitter split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.llm.common import LOWER, UPPER, lower_ascii, read, session, text_of
from tidewire.storage import Scratch

#: Counters of the Misra-Gries summary, and so the most rows that are ever broadcast.
CAPACITY = 4096
#: Most partial summaries that meet in the task that merges them.
SUMMARIES = 512


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per row of `docs`: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; the row with the largest key stays. A
    Misra-Gries summary (`freqItems`) over all digests finds every digest that more than one row in
    `capacity` has. An exact count verifies them, and the winners, `capacity` rows at most, are
    broadcast: rows of those groups are decided where they are read and never shuffled. All other
    digests are grouped by an ordinary shuffle, in which no group is larger than a `capacity`-th of
    the rows.

    Null text counts as empty, and all empty texts are one group. A null key loses to any other; if
    all keys of a group are null, its rows stay. Rows that repeat a key as well as a text are the
    same document and share its verdict. No rows give no rows. Other columns of `docs` are not read.
    """
    digests, winners, groups = split(docs, key, text, capacity)
    heavy = digests.join(F.broadcast(winners), "text_sha256")
    rest = digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").join(groups, "text_sha256", "left")
    out = heavy.unionByName(
        rest.withColumn("keep_id", F.coalesce("keep_id", "doc_id")).withColumn("group_size", F.coalesce("group_size", F.lit(1)))
    )
    return out.select(
        F.col("doc_id").alias(key), "keep_id", F.col("group_size").cast("long"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def digest(text: str = "text") -> Column:
    return F.sha2(lower_ascii(text_of(text)), 256)


def split(docs: DataFrame, key: str, text: str, capacity: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a written table of doc_id and text_sha256 of all rows, the winners: heavy groups, at most
    `capacity`, and the other groups of several rows); groups are text_sha256, keep_id, group_size."""
    scratch = Scratch(session(docs), "exact-dedup")
    digests = scratch.table(docs.select(F.col(key).alias("doc_id"), digest(text).alias("text_sha256")), "digests")
    rows = digests.count()
    summary = digests.select("text_sha256").coalesce(SUMMARIES).stat.freqItems(["text_sha256"], 1.0 / capacity)
    found = scratch.table(summary.select(F.explode("text_sha256_freqItems").alias("text_sha256")), "summary")
    counted = lambda d: d.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    winners = scratch.table(
        counted(digests.join(F.broadcast(found), "text_sha256", "left_semi")).where(
            F.col("group_size") >= max(2, -(-rows // capacity))
        ),
        "winners",
    )
    light = digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    return digests, winners, counted(light).where("group_size > 1")


def kept_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows of `docs` that `exact_dedup` keeps, with all their columns. Copies in heavy groups go
    where they are read, before anything is shuffled; rows that share a key are told apart by their
    text. Nulls, repeated rows and empty tables as there; columns that begin with `__` are used."""
    digests, winners, groups = split(docs, key, text, capacity)
    light = digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").join(groups, "text_sha256")
    gone = light.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    best = winners.select(F.col("text_sha256").alias("__digest"), F.col("keep_id").alias("__keep"), F.lit(True).alias("__heavy"))
    marked = docs.withColumn("__digest", digest(text)).join(F.broadcast(best), "__digest", "left")
    marked = marked.where(F.col("__heavy").isNull() | F.col(key).eqNullSafe(F.col("__keep")))
    same = F.col(key).eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__sha"))
    return marked.join(gone, same, "left_anti").select(*docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


SQL = f"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
