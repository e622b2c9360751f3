"""Streams of landed files and of articles. An extension: the batch run needs none of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire import config as C
from tidewire.operators import intake
from tidewire.sources import feeds

LANDED = "path string, modificationTime timestamp, length long, content binary"


def _landed(spark: SparkSession, path: str, files_a_trigger: int) -> DataFrame:
    files = spark.readStream.format("binaryFile").schema(LANDED).option("pathGlobFilter", "*.xml").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_a_trigger).load(path)
    return files.withColumn("source_id", F.regexp_extract("path", r"([^/.]+)\.[^/]*$", 1))


def landed_items(spark: SparkSession, path: str, files_a_trigger: int = 64) -> DataFrame:
    """A stream of the items of XML files as they land in `path` or its folders. A file is read once;
    how many a trigger takes is bounded, as each is held in memory while it is split. Files of more
    than MAX_BYTES have no items here, `oversized` names them."""
    fit = _landed(spark, path, files_a_trigger).where(F.col("length") <= C.MAX_BYTES)
    return feeds.feed_items(fit.select("source_id", "content"))


def oversized(spark: SparkSession, path: str, files_a_trigger: int = 64, most: int = C.MAX_BYTES) -> DataFrame:
    """A stream of (source_id, path, length) of the files that are too large to be read."""
    return _landed(spark, path, files_a_trigger).where(F.col("length") > most).select("source_id", "path", "length")


def articles(items: DataFrame, dim: DataFrame, at: Column) -> DataFrame:
    """Normalised articles of a stream of items that their source's topic filter lets pass."""
    bare = items.withColumn("heat", F.lit(None).cast("int")).withColumn("comments", F.lit(None).cast("int"))
    return intake.normalise(bare, dim, at).where("kept").select(*intake.FIELDS)


def first_sightings(stream: DataFrame, days: int = C.WINDOW_DAYS) -> DataFrame:
    """Each article once, however often its feed repeats it inside the window. State is dropped as
    the watermark on `at` passes, so its size follows the window and not the stream's age."""
    return stream.withWatermark("at", f"{days} days").dropDuplicatesWithinWatermark(["id"])


def arrivals(stream: DataFrame, window: str = "1 hour", late: str = "2 days") -> DataFrame:
    """(start, source_id, n): articles for each window of their time; rows later than `late` are
    left out, as their window is closed."""
    by = stream.withWatermark("at", late).groupBy(F.window("at", window).alias("w"), "source_id")
    return by.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "source_id", "n")


def merge_each(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], **trigger) -> StreamingQuery:
    """Run `step(batch, number)` for every batch. A batch may come again after a failure, which a
    merge by id survives: its own result adds nothing new."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step).trigger(**(trigger or {"availableNow": True})).start()
