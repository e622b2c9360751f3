"""Command line: `python -m tidewire collect|site|audit`."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from pyspark.sql import SparkSession, functions as F

from tidewire import config as C, console, site
from tidewire.operators import intake
from tidewire.plans import daily
from tidewire.sources import store

#: Exit codes: a run with at least one source, one in which all failed, one that was interrupted.
DONE, ALL_FAILED, INTERRUPTED = 0, 1, 130
LAST_YEAR = 2100


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewire")
    sub = p.add_subparsers(dest="command", required=True)
    ids = lambda text: [x.strip() for x in text.split(",") if x.strip()]
    c = sub.add_parser("collect", help="merge landed feeds into the store")
    c.add_argument("--input", required=True, metavar="DIR", help="landed files <source id>.<anything>")
    c.add_argument("--now", metavar="ISO8601", help="the run's reference time; the present if not given")
    c.add_argument("--only", type=ids, metavar="IDS")
    c.add_argument("--window-days", type=int, default=C.WINDOW_DAYS)
    c.add_argument("--max-items", type=int, default=C.MAX_STORE_ITEMS)
    c.add_argument("--data-dir", default="data", metavar="DIR")
    c.add_argument("--trigger", choices=tuple(console.TRIGGER), default="fixture")
    c.add_argument("--manifest", metavar="FILE", help="refuse landed files that differ from this capture")
    c.add_argument("--dry-run", action="store_true", help="write nothing")
    c.add_argument("--rebuild", action="store_true", help="start from an empty store")
    c.add_argument("--quiet", action="store_true")
    s = sub.add_parser("site", help="build the page")
    s.add_argument("--template", required=True)
    s.add_argument("--data", default="data")
    s.add_argument("--out", default="dist")
    s.add_argument("--check", action="store_true")
    a = sub.add_parser("audit", help="what the items of each source carry")
    a.add_argument("--input", required=True, metavar="DIR")
    a.add_argument("--now", metavar="ISO8601")
    a.add_argument("--only", type=ids, metavar="IDS")
    a.add_argument("--json", metavar="FILE", help="write the rows into a file as well")
    return p


def moment(text: str | None) -> dt.datetime:
    """A time in UTC, to the second; without a zone it is UTC. Times after the year 2100 are slips."""
    if text is None:
        return dt.datetime.now(dt.timezone.utc).replace(microsecond=0)
    at = dt.datetime.fromisoformat(text)
    if at.year > LAST_YEAR:
        raise ValueError(f"{text} is after the year {LAST_YEAR}")
    return (at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)).astimezone(dt.timezone.utc)


def collect(spark: SparkSession, a: argparse.Namespace) -> int:
    """The store is kept as Parquet beside the documents: it is the next run's input."""
    at, path, notes = moment(a.now), os.path.join(os.path.abspath(a.data_dir), daily.STORE), ()
    if a.manifest and (apart := daily.changed_files(spark, a.input, a.manifest)):
        raise ValueError("；".join(apart))
    existing = store.load(spark, path, intake.ARTICLE)
    if a.rebuild:
        notes = ("--rebuild：已丢弃现有存储重建",) if not existing.isEmpty() else ()
        existing = existing.limit(0)
    done = daily.run(spark, a.input, existing, at, only=a.only, days=a.window_days, capacity=a.max_items, trigger=a.trigger, notes=notes)
    if not a.dry_run:
        daily.publish(spark, done, os.path.abspath(a.data_dir), at, a.window_days)
    if not a.quiet:
        print(console.render(done.report, done.highlights))
    return ALL_FAILED if done.report["overall"] == "failed" else DONE


def audit(spark: SparkSession, a: argparse.Namespace) -> int:
    now = daily.instant(moment(a.now))
    items, _ = daily.read_landed(spark, a.input, C.select_sources(a.only), now)
    found = intake.audit(items, now).withColumn("newest_published", F.col("newest_published").cast("string")).orderBy("source_id")
    rows = [r.asDict() for r in found.collect()]  # one for each registered source
    for row in rows:
        print(json.dumps(row, ensure_ascii=False))
    if a.json:
        store.write_json_atomic(a.json, rows)
    return DONE


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    if a.command == "site":
        page, notes = site.build(a.template, a.data, a.out)
        faults = site.check(page, a.template) if a.check else []
        print("\n".join([page, *notes, *faults]))
        return 1 if faults else 0
    spark = SparkSession.builder.appName("tidewire").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return (collect if a.command == "collect" else audit)(spark, a)
    except KeyboardInterrupt:
        return INTERRUPTED
    except ValueError as fault:
        print(fault, file=sys.stderr)
        return 2
