"""Dates as feeds write them."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewire.functions import time as T

NOW = "2026-09-16 12:00:00"
#: Text, time in UTC, note.
DATES = [
    ("Wed, 16 Sep 2026 08:51:10 +0000", "2026-09-16 08:51:10", None), ("Wed, 16 Sep 2026 08:51:10 +0800", "2026-09-16 00:51:10", None), ("Wed, 16 Sep 2026 08:51:10 GMT", "2026-09-16 08:51:10", None),
    ("2026-09-16T07:00:00+00:00", "2026-09-16 07:00:00", None), ("Wed, 16 Sep 2026 00:00:00 -0400", "2026-09-16 04:00:00", None), ("2026-09-16 08:00:00", "2026-09-16 08:00:00", "tz_assumed"),
    ("2026-09-16 13:30:00 GMT", "2026-09-16 13:30:00", None), ("2026-09-16 20:00:00 GMT", None, "future_date"), ("1990-01-01T00:00:00Z", None, "implausible"),
    (None, None, "missing"), ("   ", None, "missing"), ("昨天", None, "unparseable"), ("not a date", None, "unparseable"), ("2026-13-45T99:99:99Z", None, "unparseable"), ("周三", None, "unparseable"),
    ("1789560000", "2026-09-16 12:00:00", None), ("1789560000000", "2026-09-16 12:00:00", None),
    ("16 Sep 2026 10:00 AM", "2026-09-16 10:00:00", "tz_assumed"), ("Sep 16 2026 10:00:00", "2026-09-16 10:00:00", "tz_assumed"), ("Wed Sep 16 10:00:00 2026", "2026-09-16 10:00:00", "tz_assumed"),
    ("09/16/2026", "2026-09-16 00:00:00", "tz_assumed"), ("16-Sep-2026 10:00:00", "2026-09-16 10:00:00", "tz_assumed"), ("2026.09.16", "2026-09-16 00:00:00", "tz_assumed"),
    ("16 Sept 2026 10:00:00 GMT", "2026-09-16 10:00:00", None), ("Wednesday, 16-Sep-26 10:00:00 GMT", "2026-09-16 10:00:00", None), ("2026年9月16日", "2026-09-16 00:00:00", "tz_assumed"),
    ("2026年9月16日 10:05", "2026-09-16 10:05:00", "tz_assumed"), ("September 16, 2026 at 1:05 p.m.", "2026-09-16 13:05:00", "tz_assumed"), ("Sep 15, 2026, 12:30 am UTC", "2026-09-15 00:30:00", None),
    ("15/09/2026 12:30 PM", "2026-09-15 12:30:00", "tz_assumed"), ("Tue Sep 15 23:59:59 UTC 2026", "2026-09-15 23:59:59", None), ("15th of Sep 2026", "2026-09-15 00:00:00", "tz_assumed"),
    ("2026-09-15T08:00:00.123456789Z", "2026-09-15 08:00:00.123456", None), ("2026-09-15T08:00:00,5+02", "2026-09-15 06:00:00.500000", None), ("20260915T080000Z", "2026-09-15 08:00:00", None),
    ("20260915", "2026-09-15 00:00:00", "tz_assumed"), ("20260915080001", "2026-09-15 08:00:01", "tz_assumed"), ("2026/09/15 08:00", "2026-09-15 08:00:00", "tz_assumed"), ("2026-09-15 08:00:00 UTC+8", "2026-09-15 00:00:00", None),
    ("Tue, 15 Sep 2026 08:00:00 +0000 (UTC)", "2026-09-15 08:00:00", None), ("Tue, 15 Sep 2026 08:00:00 EST", "2026-09-15 08:00:00", "tz_assumed"), ("2026-09-15+08:00", "2026-09-14 16:00:00", None), ("2026-09-15Z", "2026-09-15 00:00:00", None),
    ("1 Jan 99", None, "implausible"), ("2026-09-15T8:05", "2026-09-15 08:05:00", "tz_assumed"), ("15 Sep 2026 08:05:30.25 -03:30", "2026-09-15 11:35:30.250000", None),
    # partial dates, and what is none
    ("10:00", None, "unparseable"), ("Sep 2026", None, "unparseable"), ("16 Sep", None, "unparseable"), ("2026", None, "unparseable"), ("Wed", None, "unparseable"), ("16 Sep 2026 25:00:00", None, "unparseable"),
    ("30 Feb 2026", None, "unparseable"), ("13:00 PM 15 Sep 2026", None, "unparseable"), ("updated 15 Sep 2026", None, "unparseable"), ("15 Sep 2026 08:00:00 08:00:00", None, "unparseable"), ("15 Sep Oct 2026", None, "unparseable"),
    ("2026-09-15 08:00:00 <b>", None, "unparseable"), ("1 2 3 4", None, "unparseable"), ("x" * 100_000, None, "unparseable"), ("1" * 5000, None, "unparseable"), ("Sep " * 5000, None, "unparseable"), ("1:00" * 5000, None, "unparseable"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(DATES)], "i int, raw string")
    p = T.parse_published(F.col("raw"), F.lit(NOW).cast("timestamp"))
    return {r["i"]: (r["ts"], r["note"]) for r in df.select("i", p.alias("p")).select("i", F.col("p.ts").cast("string").alias("ts"), "p.note").collect()}


@pytest.mark.parametrize("i", range(len(DATES)), ids=lambda i: str(DATES[i][0])[:40])
def test_date(parsed, i):
    _, ts, note = DATES[i]
    at = parsed[i][0] and dt.datetime.fromisoformat(parsed[i][0])
    assert (at, parsed[i][1]) == (ts and dt.datetime.fromisoformat(ts), note)


def test_an_override_replaces_any_zone(spark):
    df = spark.createDataFrame([("Wed, 16 Sep 2026 19:26:11 GMT",), ("2026年9月16日 19:26:11",), ("Wed Sep 16 19:26:11 2026",)], "raw string")
    p = T.parse_published(F.col("raw"), F.lit(NOW).cast("timestamp"), F.lit(480))
    assert {(str(r["ts"]), r["note"]) for r in df.select(p.alias("p")).select(F.col("p.ts").cast("string").alias("ts"), "p.note").collect()} == {("2026-09-16 11:26:11", "tz_corrected")}
