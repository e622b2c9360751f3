"""The store and the documents of a run: versions that are published as a whole."""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidewire import config as C
from tidewire.sources.files import Files, write_atomic

ARTICLES, COMMITS, VERSIONS = "articles", "commits", "versions"
COMMIT = re.compile(r"(\d{12})\.json")
#: Versions that stay: readers of the last one but one may still be at it.
KEEP = 2


class Conflict(RuntimeError):
    """Another run has published the version that this one was to follow."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    #: Name to bytes of the files of the articles.
    files: dict[str, int]


class Snapshots:
    """Versions of a store below one folder.

    A run writes `versions/<number>-<token>/` and publishes it by giving one small file the name
    `commits/<number>.json`, which names that folder and all its files. Readers take the commit with
    the largest number and nothing else, so a run that fails, or is killed at any moment, leaves what
    was published before; what it has left behind is swept by a later run. Of two runs that follow
    the same version one gets the name and the other a `Conflict`.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def _commits(self) -> dict[int, str]:
        return {int(m[1]): f"{self.root}/{COMMITS}/{n}" for n in self.files.sizes(f"{self.root}/{COMMITS}") if (m := COMMIT.fullmatch(n))}

    def latest(self) -> Version | None:
        commits = self._commits()
        if not commits:
            return None
        number = max(commits)
        told = json.loads(self.files.read(commits[number]))
        return Version(number, f"{self.root}/{VERSIONS}/{told['version']}", told["files"])

    def read(self, schema: str) -> DataFrame | None:
        """The articles of the latest version, None before the first. A version that has lost a file,
        or whose files lack a column, is refused."""
        now = self.latest()
        if now is None:
            return None
        there, path = self.files.sizes(f"{now.folder}/{ARTICLES}"), f"{now.folder}/{ARTICLES}"
        if lost := sorted(n for n, size in now.files.items() if there.get(n) != size):
            raise ValueError(f"{path} is damaged: {', '.join(lost[:3])}")
        return _checked(self.spark, path, schema)

    def document(self, name: str) -> str | None:
        """A document of the latest version."""
        now = self.latest()
        return now and self.files.read(f"{now.folder}/{name}")

    def publish(self, articles: DataFrame, documents: dict[str, str] | None = None) -> Version:
        """Write a version and make it the latest. `articles` may read the version before it."""
        before = self.latest()
        number = before.number + 1 if before else 1
        name = f"{number:012d}-{uuid.uuid4().hex[:12]}"
        folder = f"{self.root}/{VERSIONS}/{name}"
        articles.write.parquet(f"{folder}/{ARTICLES}")
        for file, text in (documents or {}).items():
            self.files.write(f"{folder}/{file}", text)
        parts = {n: size for n, size in self.files.sizes(f"{folder}/{ARTICLES}").items() if n.startswith("part-")}
        draft = f"{self.root}/{COMMITS}/{name}.tmp"
        self.files.write(draft, json.dumps({"version": name, "files": parts, "documents": sorted(documents or {})}))
        if not self.files.rename(draft, f"{self.root}/{COMMITS}/{number:012d}.json"):
            raise Conflict(f"version {number} of {self.root} is there already")
        self.sweep()
        return Version(number, folder, parts)

    def sweep(self, keep: int = KEEP) -> None:
        """Delete versions before the last `keep`, and what runs have left that can no longer be
        published because their number is taken. A run still under way has a larger one."""
        commits = self._commits()
        last = max(commits, default=0)
        live = {json.loads(self.files.read(commits[n]))["version"] for n in sorted(commits)[-keep:]}
        for n in sorted(commits)[:-keep]:
            self.files.delete(commits[n])
        for folder, suffix in ((VERSIONS, ""), (COMMITS, ".tmp")):
            for name in self.files.sizes(f"{self.root}/{folder}"):
                number = re.match(r"(\d{12})-", name)
                if number and name.endswith(suffix) and int(number[1]) <= last and name.removesuffix(suffix) not in live:
                    self.files.delete(f"{self.root}/{folder}/{name}")


def _checked(spark: SparkSession, path: str, schema: str) -> DataFrame:
    empty = spark.createDataFrame([], schema)
    found = spark.read.parquet(path).columns
    if lost := [c for c in empty.columns if c not in found]:
        raise ValueError(f"{path} lacks the columns {', '.join(lost)}")
    return spark.read.schema(schema).parquet(path)


def save(articles: DataFrame, path: str, documents: dict[str, str] | None = None) -> Version:
    """Publish the store and a run's documents as one version."""
    return Snapshots(articles.sparkSession, path).publish(articles, documents)


def load(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The store, or no rows before the first run. A store that is damaged or lacks a column is
    refused, and so are Parquet files that no version names, unless their job has marked them whole."""
    snapshots = Snapshots(spark, path)
    found = snapshots.read(schema)
    if found is not None:
        return found
    names = snapshots.files.sizes(path)
    if not any(n.startswith("part-") for n in names):
        return spark.createDataFrame([], schema)
    if "_SUCCESS" not in names:
        raise ValueError(f"{path} is half-written")
    return _checked(spark, path, schema)


def published_folder(root: str) -> str | None:
    """The latest version's folder of a store on this machine, without Spark."""
    commits = os.path.join(root, COMMITS)
    names = sorted(n for n in os.listdir(commits) if COMMIT.fullmatch(n)) if os.path.isdir(commits) else []
    if not names:
        return None
    with open(os.path.join(commits, names[-1]), encoding="utf-8") as f:
        return os.path.join(root, VERSIONS, json.load(f)["version"])


def retain_runs(runs: DataFrame, keep: int = C.RETAIN_RUNS) -> DataFrame:
    """The newest runs; the feature is a cap of a few dozen rows."""
    place = F.row_number().over(W.orderBy(F.col("started_at").desc(), F.col("run_id").desc()))
    return runs.withColumn("__n", place).where(F.col("__n") <= keep).drop("__n")


def inline_json(value: Column) -> Column:
    """JSON that can stand inside a script element."""
    return F.replace(F.to_json(value), F.lit("</"), F.lit("<\\/"))


def document_text(payload: object) -> str:
    """A document with one newline at its end."""
    return json.dumps(payload, ensure_ascii=False, indent=2).rstrip("\n") + "\n"


def write_json_atomic(path: str, payload: object) -> None:
    """A document, put in place by a rename."""
    write_atomic(path, document_text(payload))
