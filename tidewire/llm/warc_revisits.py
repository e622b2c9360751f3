"""5. WARC: not-modified revisits, resolved by an as-of join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidewire.functions.url import canonical_url
from tidewire.llm.common import read, session
from tidewire.plans.sqltext import canonical_url_sql
from tidewire.storage import Scratch, cell_rows

#: Headers that a 304 response may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Most pieces that the time line of one URL is cut into.
PIECES = 1024

HEADERS = "array<struct<name:string,value:string>>"


def weak(etag: Column) -> Column:
    """The tag for a weak comparison."""
    return F.regexp_replace(F.trim(etag), r"^[Ww]/", "")


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, with the permitted ones of the revisit in place of theirs. Names are
    lower-cased; one that repeats keeps all its values."""
    clean = lambda h: F.transform(F.coalesce(h, F.array().cast(HEADERS)), lambda x: F.struct(F.lower(F.trim(x["name"])).alias("name"), x["value"].alias("value")))
    allowed = F.array(*map(F.lit, PERMITTED))
    update = F.filter(clean(revisit), lambda x: F.array_contains(allowed, x["name"]))
    names = F.transform(update, lambda x: x["name"])
    kept = F.filter(clean(response), lambda x: ~F.coalesce(F.array_contains(names, x["name"]), F.lit(False)))
    return F.concat(kept, update)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row for each revisit of `records` (record_id, url, ts long, kind `response` or `revisit`,
    etag, last_modified, headers, payload): record_id, url, canonical, ts, response_id, status,
    headers, payload.

    The response is the latest one of the same canonical URL with an earlier ts (of equal ts, the
    largest record_id). Where both have an entity tag, these must be equal by weak comparison; else,
    where both have it, last_modified must be equal. `status` is resolved,
    validator_mismatch, no_validator or no_response; payload and merged headers are given where
    it is resolved, headers of the revisit alone otherwise.

    The as-of join looks at each (URL, piece of the time line) by itself and carries the last
    response of the earlier pieces over, so a URL with a third of all rows is cut by quantiles of
    ts and no window holds more than a piece. A null ts, or a null or empty URL, finds no response,
    and a response with one is found by none. Repeated revisits are each answered; if responses repeat a
    record_id, one of them is used. No rows give no rows; further columns are ignored.
    """
    scratch = Scratch(session(records), "revisits")
    keys = records.select(
        F.col("record_id").alias("id"), F.col("kind"), F.when(F.trim("url") != "", canonical_url(F.col("url"))).alias("canonical"),
        F.col("ts").cast("long").alias("ts"), "etag", "last_modified",
    )
    keys = scratch.table(keys, "keys")
    n = keys.count()
    rows = cell_rows(n)
    hot = keys.groupBy("canonical").count().where(F.col("count") > rows).select("canonical", F.lit(True).alias("hot"))
    pieces = min(PIECES, max(1, 2 * n // rows))
    cuts = keys.agg(F.percentile_approx("ts", [i / pieces for i in range(1, pieces)] or [0.5], 10 * pieces).alias("c")).first()["c"] or []
    cuts = F.array(*[F.lit(x) for x in sorted(set(cuts))]) if cuts else F.array().cast("array<long>")
    piece = F.when(F.col("hot"), F.size(F.filter(cuts, lambda x: x < F.col("ts")))).otherwise(0)
    dealt = keys.where("canonical is not null and ts is not null").join(hot, "canonical", "left").withColumn("piece", piece).drop("hot")
    dealt = scratch.table(dealt, "dealt")
    this = F.when(F.col("kind") == "response", F.struct("ts", "id", "etag", "last_modified"))
    per = dealt.groupBy("canonical", "piece").agg(F.max(this).alias("last"))
    before = W.partitionBy("canonical").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    carried = per.select("canonical", "piece", F.max("last").over(before).alias("carried"))
    within = F.max(this).over(W.partitionBy("canonical", "piece").orderBy("ts").rangeBetween(W.unboundedPreceding, -1))
    asof = dealt.withColumn("within", within).where("kind = 'revisit'").join(carried, ["canonical", "piece"])
    asof = asof.withColumn("r", F.coalesce("within", "carried"))
    tag, other = weak(F.col("etag")), weak(F.col("r.etag"))
    status = (
        F.when(F.col("r").isNull(), "no_response")
        .when(tag.isNotNull() & other.isNotNull(), F.when(tag == other, "resolved").otherwise("validator_mismatch"))
        .when(F.col("last_modified").isNotNull() & F.col("r.last_modified").isNotNull(), F.when(F.col("last_modified") == F.col("r.last_modified"), "resolved").otherwise("validator_mismatch"))
        .otherwise("no_validator")
    )
    asof = asof.select("id", "canonical", "ts", F.col("r.id").alias("response_id"), status.alias("status"))
    unkeyed = keys.where("kind = 'revisit' and (canonical is null or ts is null)").select("id", "canonical", "ts", F.lit(None).cast(keys.schema["id"].dataType).alias("response_id"), F.lit("no_response").alias("status"))
    found = scratch.table(asof.unionByName(unkeyed), "found")
    found = found.withColumn("fetch", F.when(F.col("status") == "resolved", F.col("response_id")))
    wanted = found.select("fetch").where("fetch is not null").distinct()
    bodies = (
        records.where("kind = 'response'").select(F.col("record_id").alias("fetch"), F.col("headers").alias("h"), F.col("payload"))
        .join(wanted, "fetch", "left_semi").dropDuplicates(["fetch"])
    )
    own = records.where("kind = 'revisit'").select(F.col("record_id").alias("id"), "url", F.col("headers").alias("own"))
    own = own.dropDuplicates(["id"])
    out = found.join(own, found["id"].eqNullSafe(own["id"]), "left").drop(own["id"]).join(bodies, "fetch", "left")
    return out.select(
        F.col("id").alias("record_id"), "url", "canonical", "ts", "response_id", "status",
        F.when(F.col("fetch").isNotNull(), merged_headers(F.col("h"), F.col("own"))).otherwise(merged_headers(F.lit(None).cast(HEADERS), F.col("own"))).alias("headers"), "payload",
    )


def captures(pages: DataFrame) -> DataFrame:
    """Two records for each page: the full response, and a later conditional request for the same
    URL that was answered 304, with the validator that the client held."""
    header = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    tag = F.md5(F.coalesce("html", F.lit("")))
    none = F.lit(None).cast("string")
    full = F.array(header("Content-Type", F.lit("text/html")), header("Content-Length", F.octet_length("html")), header("ETag", tag), header("Date", F.col("page_id") * 2))
    short = F.array(header("Date", F.col("page_id") * 2 + 2001), header("Cache-Control", F.lit("max-age=60")), header("Content-Length", F.lit(0)))
    a = pages.select(F.concat(F.lit("r"), F.col("page_id")).alias("record_id"), "url", (F.col("page_id") * 2).alias("ts"), F.lit("response").alias("kind"), tag.alias("etag"), none.alias("last_modified"), full.alias("headers"), F.col("html").alias("payload"))
    b = pages.select(F.concat(F.lit("v"), F.col("page_id")).alias("record_id"), "url", (F.col("page_id") * 2 + 2001).alias("ts"), F.lit("revisit").alias("kind"), F.concat(F.lit("W/"), tag).alias("etag"), none.alias("last_modified"), short.alias("headers"), none.alias("payload"))
    return a.unionByName(b)


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(captures(read(spark, sf_dir, "pages")))
    lines = F.array_join(F.array_sort(F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"]))), "\n")
    return out.select("record_id", "url", "canonical", "ts", "response_id", "status", lines.alias("headers"), F.length("payload").cast("long").alias("payload_chars"), F.md5("payload").alias("payload_md5"))


SQL = f"""
WITH p AS (SELECT page_id, url, html, md5(coalesce(html, '')) AS tag, {canonical_url_sql("url")} AS canonical FROM pages),
v AS (SELECT p.page_id, p.url, p.canonical, p.tag, page_id * 2 + 2001 AS ts FROM p),
j AS (SELECT v.*, r.page_id AS rid, r.tag AS rtag, r.html, row_number() OVER (PARTITION BY v.page_id ORDER BY r.page_id DESC) AS n
  FROM v JOIN p r ON r.canonical = v.canonical AND r.page_id * 2 < v.ts)
SELECT 'v' || page_id AS record_id, url, canonical, ts, 'r' || rid AS response_id, CASE WHEN tag = rtag THEN 'resolved' ELSE 'validator_mismatch' END AS status,
  CASE WHEN tag = rtag THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || strlen(html) || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts || chr(10) || 'etag: ' || tag
       ELSE 'cache-control: max-age=60' || chr(10) || 'date: ' || ts END AS headers,
  CASE WHEN tag = rtag THEN length(html) END AS payload_chars, CASE WHEN tag = rtag THEN md5(html) END AS payload_md5
FROM j WHERE n = 1
"""
