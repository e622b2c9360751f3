"""Landed JSON answers as a data source: filters reach the files, and broken answers are rows."""

from __future__ import annotations

import json
from dataclasses import dataclass
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
)

from tidewire import config as C
from tidewire.storage import importable

FORMAT = "tidewire_answers"
SCHEMA = (
    "source_id string, variant int, n_variants int, object_id string, title string, url string, created_at string, created_at_i long, points int, num_comments int, fault string, detail string"
)
_FIELDS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Columns whose filters are applied while a file is read.
PUSHED = ("source_id", "points", "created_at_i", "num_comments", "fault")
_TESTS = {
    EqualTo: lambda a, b: a is not None and a == b, GreaterThan: lambda a, b: a is not None and a > b, GreaterThanOrEqual: lambda a, b: a is not None and a >= b,
    LessThan: lambda a, b: a is not None and a < b, LessThanOrEqual: lambda a, b: a is not None and a <= b, IsNotNull: lambda a, b: a is not None, IsNull: lambda a, b: a is None,
}


@dataclass
class _Answer(InputPartition):
    source_id: str
    variant: int
    n_variants: int
    path: str | None


class Answers(DataSource):
    """Options: `path`, a folder of files `<source id>.<anything>`; `sources`, comma-separated ids to
    read, of which one without a file is a row with the fault `missing_fixture`; `maxBytes`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], [s for s in self.options["sources"].split(",") if s], int(self.options.get("maxBytes", C.MAX_BYTES)))


class _Reader(DataSourceReader):
    def __init__(self, path: str, sources: list[str], most: int):
        self.path, self.sources, self.most, self.tests = path, sources, most, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in PUSHED:
                self.tests.append((type(f).__name__, f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def _passes(self, row: dict) -> bool:
        tests = {k.__name__: t for k, t in _TESTS.items()}
        return all(tests[kind](row[name], value) for kind, name, value in self.tests)

    def partitions(self) -> list[_Answer]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        names = sorted(i.path for i in system.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.File)
        out = []
        for source in self.sources:
            if not all(_TESTS[EqualTo](source, v) for k, n, v in self.tests if (k, n) == ("EqualTo", "source_id")):
                continue  # a file that a filter excludes is never opened
            own = [n for n in names if n.rpartition("/")[2].startswith(f"{source}.") and not n.endswith(".tmp")]
            out += [_Answer(source, i, len(own), n) for i, n in enumerate(own)] or [_Answer(source, 0, 0, None)]
        return out or [_Answer("", 0, 0, None)]

    def read(self, p: _Answer):
        if p.source_id:
            for row in self._rows(p):
                if self._passes(row):
                    yield tuple(row[c] for c in _FIELDS)

    def _rows(self, p: _Answer):
        from pyarrow import fs

        blank = dict.fromkeys(_FIELDS) | {"source_id": p.source_id, "variant": p.variant, "n_variants": p.n_variants}
        broken = lambda kind, detail: blank | {"fault": kind, "detail": detail}
        if p.path is None:
            yield broken("missing_fixture", "没有该源的响应文件")
            return
        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        if (system.get_file_info(p.path).size or 0) > self.most:
            yield broken("too_large", "响应超过大小上限")
            return
        try:
            with system.open_input_stream(p.path) as f:
                hits = json.loads(f.read().decode("utf-8")).get("hits") or []
            rows = [self._hit(blank, h) for h in hits]
        except (ValueError, AttributeError, TypeError) as e:
            yield broken("bad_json", f"JSON 解析失败：{e}"[:200])
            return
        yield from rows

    @staticmethod
    def _hit(blank: dict, h: dict) -> dict:
        text = lambda k: None if h.get(k) is None else str(h[k])
        whole = lambda k: None if h.get(k) is None else int(h[k])
        own = {"object_id": text("objectID"), **{k: text(k) for k in ("title", "url", "created_at")}, **{k: whole(k) for k in ("created_at_i", "points", "num_comments")}}
        return blank | own


def answers(spark: SparkSession, path: str, sources: list[str], most: int = C.MAX_BYTES) -> DataFrame:
    """Rows of SCHEMA of landed answers, a partition for each file. A hit has no fault; an answer that
    is missing, too large or no JSON is one row with nothing but its fault. Filters on PUSHED columns
    are applied where a file is read. Spark keeps what it pushes with what was loaded, so a plan must
    not filter one loaded table in two ways: load it for each, or write it first."""
    importable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Answers)
    return spark.read.format(FORMAT).option("path", path).option("sources", ",".join(sources)).option("maxBytes", most).load()


def faults(rows: DataFrame) -> DataFrame:
    """(source_id, error) of the sources whose answers are missing or broken: the kind, and what it
    was. A source with several broken answers is told by the first."""
    broken = rows.where(F.col("fault").isNotNull())
    return broken.groupBy("source_id").agg(F.min_by(F.concat("fault", F.lit("："), "detail"), "variant").alias("error"))


@dataclass(frozen=True)
class Track:
    """A query's filters: more points than `points`, and newer than `hours` before the run."""

    name: str
    points: int
    hours: int

    def url(self, base: str, query: str, at: int, page: int) -> str:
        """The request that has a search service apply the same filters; `at` in seconds."""
        numbers = f"points>{self.points},created_at_i>{at - self.hours * 3600}"
        return f"{base}?{urlencode({'query': query, 'tags': 'story', 'numericFilters': numbers, 'hitsPerPage': str(page)})}"


#: What has proved itself in the window, and what is on the rise.
TRACKS = (Track("high", C.HN_TRACKS["min_points_high"], 24 * C.WINDOW_DAYS), Track("fresh", C.HN_TRACKS["min_points_fresh"], C.HN_TRACKS["fresh_hours"]))


def on_tracks(spark: SparkSession, path: str, source: str, at_seconds: int, tracks: tuple[Track, ...] = TRACKS) -> DataFrame:
    """The hits of each track, as a bag: one that is on both comes twice, with `track`. Each track is
    loaded with its own filters."""
    out = None
    for t in tracks:
        own = answers(spark, path, [source]).where((F.col("points") > t.points) & (F.col("created_at_i") > at_seconds - t.hours * 3600)).withColumn("track", F.lit(t.name))
        out = own if out is None else out.unionByName(own)
    return out
