"""Intermediate tables in the folder that every executor shares."""

from __future__ import annotations

import math
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Files of an intermediate table for each core, at most: many tiny partitions become few files.
FILES = 8
#: Spark's setting by which the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only where the session names none and all
    of it runs on this machine."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewire-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


class Scratch:
    """Tables written once and read back, so that a lost executor never costs more than one stage.

    The files live under `shared_root` and go when the driver's JVM ends, or earlier through `drop`.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        path = self._hadoop(self.path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
        self._n = 0
        self._tables: list[DataFrame] = []

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def table(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write `df` and return it as a scan of what was written. Partitions that share a file are
        still computed one after the other, so memory does not grow. What was shuffled for it is not
        read again and goes at once, not when the driver happens to collect its garbage."""
        self._n += 1
        path = f"{self.path}/{self._n:03d}-{name}"
        conf = df.sparkSession.conf
        before = conf.get(CLEANUP, None)
        conf.set(CLEANUP, "true")
        try:
            df.coalesce(FILES * self.spark.sparkContext.defaultParallelism).write.parquet(path)
        finally:
            conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._tidewire_path = path
        self._tables.append(out)
        return out

    def drop(self, table: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        path = self._hadoop(table._tidewire_path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self._tables = [t for t in self._tables if t is not table]

    def last(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write `df` as the one table that is still read, and delete all others."""
        table = self.table(df, name)
        for other in [t for t in self._tables if t is not table]:
            self.drop(other)
        return table


def cell_rows(n: int) -> int:
    """Rows that one window may hold: grows with the square root, so that both the cells and the
    table of their offsets stay small at any size."""
    return max(256, math.isqrt(max(n, 0)))


def importable(spark: SparkSession) -> None:
    """Let local Python workers import this package even where the driver only extended sys.path.
    On a cluster the package is shipped with --py-files."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (env.get("PYTHONPATH", ""), here) if x)
