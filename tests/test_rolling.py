"""The rolling store against the batch merge."""
import datetime as dt
import json
import random

from pyspark.sql import functions as F

from tidewire.operators import intake, merge
from tidewire.streaming import rolling

T0 = dt.datetime(2026, 9, 1)


def article(rng, i):
    seen = T0 + dt.timedelta(hours=rng.randrange(40))
    published = rng.choice([None, T0 - dt.timedelta(hours=rng.randrange(200)), T0 - dt.timedelta(days=40)]) if i % 9 else T0 - dt.timedelta(days=40)
    r = dict.fromkeys(intake.FIELDS) | {
        "id": f"{i:016x}", "title": f"Title {i} {rng.randrange(3)}", "norm": f"title{i}", "url": f"https://a.com/{i}?{rng.randrange(5)}", "source_id": rng.choice("ab"), "source_weight": rng.choice([1.0, 1.1, 1.3]), "source_official": False,
        "published_at": published, "published_raw": published and str(published), "first_seen_at": seen, "last_seen_at": seen, "at": published or seen, "summary": rng.choice([None, "", "short", "a longer one " * rng.randrange(1, 4)]),
        "heat": rng.choice([None, 3, 50]), "comments": rng.choice([None, 1]), "image_url": rng.choice([None, f"u{rng.randrange(3)}"]), "source_name_en": rng.choice(["", "N1", "N2"]), "lang": "en",
    }
    return r


def test_rows_in_any_order_come_to_the_same():
    rng = random.Random(1)
    for i in range(30):
        rows = [{k: int(v.timestamp() * 1e6) if isinstance(v, dt.datetime) else v for k, v in article(rng, i).items()} for _ in range(6)]
        ends = []
        for _ in range(8):
            rng.shuffle(rows)
            kept = None
            for r in rows:
                kept = rolling.refreshed(kept, r)
            ends.append({k: v for k, v in kept.items() if k != "ranks"})
        assert all(e == ends[0] for e in ends) or len({(r["source_weight"], r["at"]) for r in rows}) < len(rows)


def test_a_shuffled_stream_ends_in_the_batch_store(spark, tmp_path):
    rng = random.Random(7)
    rows, ranks = [], set()
    while len(rows) < 90:
        r = article(rng, rng.randrange(20))
        if (r["id"], r["source_weight"], r["at"]) not in ranks:  # the batch merge has no order for those that tie
            ranks.add((r["id"], r["source_weight"], r["at"]))
            rows.append(r)
    end = dict(article(rng, 999), first_seen_at=T0 + dt.timedelta(days=90), last_seen_at=T0 + dt.timedelta(days=90), published_at=None, at=T0 + dt.timedelta(days=90))
    folder = tmp_path / "in"
    for n, part in enumerate([rows[:30], rows[30:60], rows[60:], [end], [dict(end, id="f" * 16)]]):
        spark.createDataFrame([tuple(r[f] for f in intake.FIELDS) for r in part], intake.ARTICLE).coalesce(1).write.parquet(str(folder / f"{n}"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stream = spark.readStream.schema(intake.ARTICLE).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
    store, told = {}, {}

    def keep(batch, n):
        for r in batch.collect():
            told[r["outcome"]] = told.get(r["outcome"], 0) + r["rows"]
            if r["outcome"] != rolling.LATE:
                store[r["id"]] = r.asDict()

    try:
        q = rolling.rolling_store(stream, delay="2 days").writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(keep).trigger(availableNow=True).start()
        assert q.awaitTermination(400)
        progress = [json.loads(p.json) if hasattr(p, "json") and isinstance(p.json, str) else p for p in q.recentProgress]
        left = progress[-1]["stateOperators"][0]["numRowsTotal"]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    late = [r for r in rows if r["at"] < r["first_seen_at"] - dt.timedelta(days=30)]
    assert told[rolling.LATE] == len(late) > 0 and sum(told.values()) == len(rows) + 2
    inside = spark.createDataFrame([tuple(r[f] for f in intake.FIELDS) for r in rows if r not in late], intake.ARTICLE)
    at = F.lit(str(T0 + dt.timedelta(days=2))).cast("timestamp")
    want, _ = merge.merge(spark.createDataFrame([], intake.ARTICLE), inside, at, days=10_000, capacity=None, fuzzy=False)
    fields = [f for f in intake.FIELDS if f not in ("last_seen_at",)]
    tidy = lambda r: tuple(r[f] or None for f in fields)  # noqa: E731  an empty summary is none
    assert sorted(map(str, map(tidy, want.collect()))) == sorted(str(tidy(r)) for i, r in store.items() if i not in (end["id"], "f" * 16))
    assert left <= 4  # all that has left the window is dropped, timers included
