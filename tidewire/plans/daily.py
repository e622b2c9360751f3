"""A daily run: landed feeds are merged into the store, events found, articles scored, and the
documents of the site written."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidewire import config as C
from tidewire.operators import cluster, intake, merge, report, score
from tidewire.sources import answers, feeds, manifest, store
from tidewire.sources.files import Files
from tidewire.storage import Scratch

NEWS, RUNS, STATUS, META = "news.json", "runs.json", "update-status.json", "meta.json"
HIGHLIGHT = ("title", "url", "source_name", "source_name_en", "image_url", "score", "reasons", "cluster_size", "independent_sources")
HIT_COLUMNS = {"summary_raw": "string", "image_url": "string", "place": "int"}


@dataclass
class Run:
    """What a run found: tables for the engine, and its report, which is small."""

    articles: DataFrame
    outcomes: DataFrame
    targets: DataFrame
    report: dict
    highlights: list[dict]
    counts: dict
    written: list[str] = field(default_factory=list)


def instant(at: dt.datetime) -> Column:
    """A time with a zone as a literal, whatever the session's time zone is."""
    return F.timestamp_seconds(F.lit(int(at.timestamp())))


def iso(at: dt.datetime | None) -> str | None:
    return at and at.astimezone(dt.timezone.utc).isoformat(timespec="seconds")


def _epochs(df: DataFrame, *names: str) -> DataFrame:
    """Times as seconds, so that what the driver reads does not hang on the session's zone."""
    for n in names:
        df = df.withColumn(n, F.unix_seconds(n))
    return df


def _moment(seconds: int | None) -> dt.datetime | None:
    return None if seconds is None else dt.datetime.fromtimestamp(seconds, dt.timezone.utc)


def read_landed(spark: SparkSession, path: str, sources: list[tuple], at: Column) -> tuple[DataFrame, DataFrame]:
    """(items of all sources, their profile) from the landed files <source id>.<anything>."""
    dim = spark.createDataFrame(sources, C.SOURCE_SCHEMA)
    d = F.broadcast(dim.select(F.col("id").alias("source_id"), "kind", "max_items"))
    files = feeds.landed(spark.read.format("binaryFile").load(path)).join(d, "source_id")
    xml = files.where("kind <> 'hn' and variant = 0")
    told = Scratch(spark, "answers").table(answers.answers(spark, path, [s[0] for s in sources if s[4] == "hn"]))  # a few hits
    items = feeds.feed_items(xml).join(d, "source_id")
    fresh = items.where("kind <> 'arxiv'").unionByName(feeds.announced(items.where("kind = 'arxiv'")))
    capped = feeds.cap_by_date(fresh, F.col("max_items"), at).drop("kind", "max_items", "announce", "tags")
    capped = capped.withColumn("heat", F.lit(None).cast("int")).withColumn("comments", F.lit(None).cast("int"))
    hits = feeds.hit_items(told)
    for name, kind in HIT_COLUMNS.items():
        hits = hits.withColumn(name, F.lit(None).cast(kind))
    large = F.when(F.col("content").isNull(), "too_large：响应超过大小上限")
    seen = feeds.feed_profile(xml).join(xml.select("source_id", large.alias("error")), "source_id")
    totals = feeds.hit_rows(told).groupBy("source_id").agg(F.count("*").cast("int").alias("items_seen")).join(answers.faults(told), "source_id", "full")
    answered = files.where("kind = 'hn'").select("source_id").distinct().join(totals, "source_id", "left")
    seen = seen.unionByName(answered.select("source_id", F.coalesce("items_seen", F.lit(0)).alias("items_seen"), F.lit(None).cast("string").alias("fault"), "error"))
    return capped.unionByName(hits), seen.withColumn("answered", F.lit(True))


def changed_files(spark: SparkSession, path: str, captured: str) -> list[str]:
    """Names and states of landed files that differ from a captured manifest, a JSON file whose
    `sources` each have a file and its sha256. A manifest is a few dozen rows."""
    with open(captured, encoding="utf-8") as f:
        told = [(s["file"], s.get("sha256")) for s in json.load(f)["sources"] if s.get("file")]
    then = spark.createDataFrame(told, "name string, sha256 string").dropDuplicates(["name"])
    now = manifest.manifest(spark.read.format("binaryFile").load(path))
    apart = manifest.compare(then, now).where(F.col("status").isin("changed", "missing") & (F.col("name") != os.path.basename(captured)))
    return [f"{r['name']}: {r['status']}" for r in apart.orderBy("name").collect()]


def run(
    spark: SparkSession, landed: str, existing: DataFrame, at: dt.datetime, *, only: list[str] | None = None, days: int = C.WINDOW_DAYS,
    capacity: int = C.MAX_STORE_ITEMS, trigger: str = "fixture", notes: tuple[str, ...] = (),
) -> Run:
    """One run over the landed files. The same files, store and time give the same result; a second
    run over its own result adds nothing."""
    scratch, now, sources = Scratch(spark, "daily"), instant(at), C.select_sources(only)
    dim = spark.createDataFrame(sources, C.SOURCE_SCHEMA)
    items, profile = read_landed(spark, landed, sources, now)
    offers, counted = Observation("offers"), Observation("counts")  # counts that are taken while tables are written
    inside = merge.split_by_window(intake.normalise(items, dim, now), now, days)
    batch = scratch.table(inside.observe(offers, F.count(F.when(F.col("kept") & F.col("inside"), 1)).alias("rows")), "batch")
    offered = batch.where("kept and inside").select(*intake.FIELDS)
    base = existing.drop(*merge.DERIVED)
    merged, targets = merge.merge(base, offered, now, days, capacity)
    kept = scratch.table(merge.sync_names(merged.drop("rows"), C.dim_source(spark)), "store")
    members = cluster.event_members(kept, cluster.event_links(kept, now))
    scored = scratch.table(score.evaluate(kept, cluster.cross_source(members), now).observe(counted, *report.count_columns(now)), "scored")
    articles = scored.select(*intake.FIELDS, "cluster_id", "cluster_size", "independent_sources", "score", "reasons")
    outcomes = scratch.table(intake.outcomes(dim, scratch.table(profile, "profile"), batch, targets, now, days), "outcomes")
    top = score.highlights(scored).join(scored.select("id", "source_name", "source_name_en", "url", "image_url"), "id").orderBy(F.col("score").desc(), "id")
    high = [r.asDict() for r in top.select(F.col("id").alias("article_id"), *HIGHLIGHT).collect()]  # five rows
    sums = targets.agg(F.count(F.when(F.col("priority") == 0, 1)).alias("new")).first()
    rows, added, counts = offers.get["rows"], sums["new"], dict(counted.get)
    order = {s[0]: i for i, s in enumerate(sources)}
    per = sorted((r.asDict() for r in _epochs(outcomes, "latest_published_at").collect()), key=lambda r: order[r["id"]])  # a row for each registered source
    for r in per:
        r["latest_published_at"], r["duration_ms"] = iso(_moment(r["latest_published_at"])), 0
    ended = report.overall(outcomes, F.lit(added)).first()["overall"]
    told = {r["id"]: r["warning"] for r in intake.warnings(outcomes).collect()}
    suffix = hashlib.sha1("|".join((trigger, ",".join(order), "True")).encode()).hexdigest()[:6]
    made = {
        "run_id": f"{at.astimezone(dt.timezone.utc):%Y%m%dT%H%M%SZ}-{suffix}", "started_at": iso(at), "finished_at": iso(at), "duration_ms": 0, "trigger": trigger, "offline": True,
        "sources": per, "overall": ended, "total_in_store": counts["total"], "total_new": added, "total_dup": rows - added,
        "highlights": [h["article_id"] for h in high], "warnings": [*notes, *(told[i] for i in order if i in told)],
    }
    return Run(articles, outcomes, targets, made, high, counts)


#: The store's folder beside the documents.
STORE = "store"


def _history(spark: SparkSession, data_dir: str) -> list[dict]:
    """Earlier runs, as the published version tells them, or else the file in the folder; an
    unreadable one counts as none."""
    told = store.Snapshots(spark, os.path.join(data_dir, STORE)).document(RUNS)
    try:
        if told is None:
            with open(os.path.join(data_dir, RUNS), encoding="utf-8") as f:
                told = f.read()
        runs = json.loads(told)["runs"]
    except (OSError, ValueError, KeyError, TypeError):
        return []
    return runs if isinstance(runs, list) else []


def _rates(spark: SparkSession, runs: list[dict], at: Column) -> dict:
    past = spark.createDataFrame([(r.get("started_at"), r.get("overall")) for r in runs], "started_at string, overall string")
    row = _epochs(report.success_rate(past.withColumn("started_at", F.col("started_at").try_cast("timestamp")), at), "last_success_at").first()
    return {"success_rate_7d": row["success_rate_7d"], "last_success_at": iso(_moment(row["last_success_at"]))}


def publish(spark: SparkSession, done: Run, data_dir: str, at: dt.datetime, days: int = C.WINDOW_DAYS) -> list[str]:
    """Publish the store and the four documents of the site as one version, and then put copies of
    the documents beside it, each as a whole. Whenever this is cut short, the version before stands,
    with its store and its documents. The articles are read as JSON rows one partition at a time;
    their number is capped by the store's capacity."""
    runs = [*_history(spark, data_dir), done.report][-C.RETAIN_RUNS :]
    rates, head = _rates(spark, runs, instant(at)), {"schema_version": 1}
    ordered = done.articles.orderBy(F.col("at").desc(), F.col("first_seen_at").desc(), F.col("id").desc())
    utc = lambda c: F.concat(F.regexp_replace(F.timestamp_seconds(F.unix_seconds(c)).cast("string"), " ", "T"), F.lit("Z"))
    public = ordered.withColumns({c: utc(c) for c in ("published_at", "first_seen_at", "last_seen_at")}).drop("norm", "at")
    rows = [json.loads(r["j"]) for r in public.select(F.to_json(F.struct(*public.columns), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator()]
    fields = ("id", "name", "name_en", "lang", "kind", "url", "weight", "official")
    registry = [dict(zip(fields, s)) for s in C.SOURCES if s[11]]
    for s in registry:
        s["name_en"] = s["name_en"] or s["name"]
    per = done.report["sources"]
    health = {s: sum(o["status"] == s for o in per) for s in report.STATUSES}
    r = done.report
    docs = {
        NEWS: head | {"generated_at": iso(at).replace("+00:00", "Z"), "window_days": days, "sources": registry, "counts": done.counts, "articles": rows},
        RUNS: head | {"runs": runs},
        STATUS: head | {
            "generated_at": iso(at), "run_id": r["run_id"], "trigger": r["trigger"], "offline": r["offline"], "overall": r["overall"], "total_in_store": r["total_in_store"],
            "new_this_run": r["total_new"], "deduped_this_run": r["total_dup"], "window_days": C.WINDOW_DAYS, "health": health | {"success_rate_7d": rates["success_rate_7d"]},
            "sources": per, "highlights": done.highlights,
        },
        META: head | {
            "last_run_id": r["run_id"], "last_run_at": iso(at).replace("+00:00", "Z"), "last_success_at": rates["last_success_at"] and rates["last_success_at"].replace("+00:00", "Z"),
            "total_articles": done.counts["total"], "source_count": len(registry), "success_rate_7d": rates["success_rate_7d"], "window_days": C.WINDOW_DAYS, "highlights": done.highlights,
        },
    }
    texts = {name: store.document_text(doc) for name, doc in docs.items()}
    store.save(done.articles, os.path.join(data_dir, STORE), texts)
    done.written, files = [os.path.join(data_dir, name) for name in texts], Files(spark)
    for path, text in zip(done.written, texts.values()):
        files.replace(path, text)
    return done.written
