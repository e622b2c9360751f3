"""Landed files against a manifest of what was captured."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def manifest(files: DataFrame) -> DataFrame:
    """(name, bytes, sha256) of a binaryFile table; a name is the path's last part. Files are read by
    the tasks, one row each."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(name.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def compare(captured: DataFrame, landed: DataFrame) -> DataFrame:
    """(name, status, captured_sha256, landed_sha256) for each name in either of two tables (name,
    sha256): `same`, `changed`, `added` if only landed, `missing` if only captured. A null digest is
    unlike any other; names must differ within a table."""
    a = captured.select("name", F.col("sha256").alias("captured_sha256"), F.lit(True).alias("__a"))
    b = landed.select("name", F.col("sha256").alias("landed_sha256"), F.lit(True).alias("__b"))
    status = (
        F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "missing").when(F.col("captured_sha256") == F.col("landed_sha256"), "same").otherwise("changed")
    )
    return a.join(b, "name", "full").select("name", status.alias("status"), "captured_sha256", "landed_sha256")
