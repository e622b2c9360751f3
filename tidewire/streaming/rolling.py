"""The store as the state of a stream: each article kept up to date while it is inside the window."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewire import config as C
from tidewire.operators.intake import ARTICLE, FIELDS
from tidewire.storage import importable

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a row of the stream came to: a new article, a change to one, nothing, or too old.
NEW, REFRESHED, SEEN, LATE = "new", "refreshed", "seen", "out_of_window"
IDENTITY = ("title", "norm", "url", "canonical_url", "source_id", "source_name", "source_lang", "source_official", "source_weight", "first_seen_at", "lang")
DATED = ("published_at", "published_raw", "published_note")
TOLD = ("summary", "summary_source")
#: For each group of fields the weight and time of the row that it is from; see `refreshed`.
#: Times are microseconds here, whatever zone a worker is in.
PLAIN = ARTICLE.replace(" timestamp", " long")
TIMES = ("published_at", "first_seen_at", "last_seen_at", "at")
STATE = f"{PLAIN}, ranks array<double>"
DAY = 86_400_000_000
_WHO, _DATED, _TOLD, _IMAGE, _NAME = range(0, 10, 2)


def refreshed(kept: dict | None, row: dict) -> dict:
    """What is known of an article after one more row of it, in whatever order rows come: its
    identity is that of the row with the largest weight and then time; so are its publish time and
    picture, of rows that have one; the longest summary, the largest heat and number of comments and
    the last sight count; the display name is the last one."""
    rank = [-row["source_weight"], -float(row["at"])]
    if kept is None:
        return row | {"ranks": rank * 5}
    out, ranks = dict(kept), list(kept["ranks"])

    def take(at: int, fields: tuple[str, ...], better: bool) -> None:
        if better:
            out.update({f: row[f] for f in fields})
            ranks[at : at + 2] = rank

    take(_WHO, IDENTITY, rank < ranks[_WHO : _WHO + 2])
    has, had = row["published_at"] is not None, kept["published_at"] is not None
    take(_DATED, DATED, (has, [-x for x in rank]) > (had, [-x for x in ranks[_DATED : _DATED + 2]]))
    size = lambda r: len(r["summary"] or "")
    take(_TOLD, TOLD, (size(row), [-x for x in rank]) > (size(kept), [-x for x in ranks[_TOLD : _TOLD + 2]]))
    take(_IMAGE, ("image_url",), (row["image_url"] is not None, [-x for x in rank]) > (kept["image_url"] is not None, [-x for x in ranks[_IMAGE : _IMAGE + 2]]))
    take(_NAME, ("source_name_en",), (bool(row["source_name_en"]), rank) > (bool(kept["source_name_en"]), ranks[_NAME : _NAME + 2]))
    for f in ("heat", "comments", "last_seen_at"):
        out[f] = max((x for x in (kept[f], row[f]) if x is not None), default=None)
    out["at"], out["ranks"] = out["published_at"] or out["first_seen_at"], ranks
    return out


class Rolling(StatefulProcessor):
    """Keeps an article as the value of its id, until its time is `days` before the watermark."""

    def __init__(self, days: int):
        self.days = days * DAY

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.article = handle, handle.getValueState("article", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = before = dict(zip([*FIELDS, "ranks"], self.article.get())) if self.article.exists() else None
        late = inside = 0
        for row in rows:
            row = row.asDict()
            if row["at"] < row["first_seen_at"] - self.days:
                late += 1
            else:
                kept, inside = refreshed(kept, {f: row[f] for f in FIELDS}), inside + 1
        if inside:
            self.article.update(tuple(kept[f] for f in [*FIELDS, "ranks"]))
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer((kept["at"] + self.days) // 1000 + 1)
            fields = [f for f in FIELDS if f != "last_seen_at"]
            outcome = NEW if before is None else REFRESHED if any(kept[f] != before[f] for f in fields) else SEEN
            yield Row(outcome=outcome, rows=inside, **{f: kept[f] for f in FIELDS})
        if late:
            yield Row(outcome=LATE, rows=late, **(dict.fromkeys(FIELDS) | {"id": key[0]}))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.article.clear()
        return iter(())

    def close(self) -> None:
        pass


def rolling_store(articles: DataFrame, days: int = C.WINDOW_DAYS, delay: str = "1 day") -> DataFrame:
    """A stream of (outcome, rows, article...) of a stream of articles: each article as it stands after
    a batch that had rows of it, matched by id, and for rows older than `days` before their first
    sight only their number. The same rows in any order end in the same articles.

    A row's reference time is its `first_seen_at`, which is also the watermark; rows may come `delay`
    out of order. When the watermark has passed an article's time by `days`, its state is dropped, so
    state is bounded by the window and not by the stream's age. Near titles are matched by the batch
    merge alone. The state store is RocksDB.
    """
    spark = articles.sparkSession
    importable(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    plain = articles.select(*FIELDS).withColumn("__seen", F.col("first_seen_at")).withWatermark("__seen", delay)
    plain = plain.withColumns({c: F.unix_micros(c) for c in TIMES})
    made = plain.groupBy("id").transformWithState(Rolling(days), f"outcome string, rows long, {PLAIN}", "Update", "eventTime")
    return made.withColumns({c: F.timestamp_micros(c) for c in TIMES})


def outcomes(rows: DataFrame) -> DataFrame:
    """(outcome, rows) of what a batch of `rolling_store` came to."""
    return rows.groupBy("outcome").agg(F.sum("rows").alias("rows"))
