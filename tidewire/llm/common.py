"""Pieces that several of the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidewire.storage import Scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: A word, as the contracts spell it: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def gapless_rank(df: DataFrame, keys: list[str], cell: Column, order: list[Column], out: str) -> DataFrame:
    """`df` with `out`: the row's place among the rows with its keys, from 0 without gaps.

    `cell` deals the rows of one key to small cells; only a cell is ever sorted in one task. The
    cells' sizes are summed into offsets, one row for each cell. `df` should be a written table, as
    it is read twice.
    """
    df = df.withColumn("__cell", cell)
    by = [*keys, "__cell"]
    counts = df.groupBy(*by).agg(F.count("*").alias("__n"))
    before = W.partitionBy(*keys).orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*by, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1
    return (
        df.withColumn("__place", place)
        .join(offsets, by)
        .withColumn(out, (F.col("__off") + F.col("__place")).cast("long"))
        .drop("__cell", "__place", "__off")
    )


#: Rows of a range, at least.
RANGE_ROWS = 8192


def ranges(df: DataFrame, order: list[Column], scratch: Scratch) -> DataFrame:
    """`df`, a written table, dealt into ranges of about equal length of the order given and written
    with `__range`, the number of each row's range. Rows that tie are parted too, by their place in
    the scan, so no value can fill a range alone; ranges lengthen with the square root of the rows."""
    rows = df.count()
    n = max(1, -(-rows // max(RANGE_ROWS, 8 * math.isqrt(rows))))
    dealt = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, *order, "__tie")
    return scratch.table(dealt.drop("__tie").withColumn("__range", F.spark_partition_id().cast("long")), "ranges")


def crc32_sql(x: str) -> str:
    """DuckDB's expression for the unsigned CRC-32 of a text's UTF-8 bytes; null of null."""
    code = lambda at: f"(instr('0123456789ABCDEF', substr(hex({x}), {at}, 1)) - 1)"
    octets = f"list_transform(range(strlen({x})), lambda i: ({code('2 * i + 1')} * 16 + {code('2 * i + 2')})::BIGINT)"
    bits = "list_reduce(list_concat([xor(c, o)], range(8)), lambda v, b: xor(v >> 1, (v & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, o: {bits}), 4294967295::BIGINT)"


#: Bytes of text that are split into words at a time.
SLICE = 1 << 22


def by_bytes(column: pa.Array, most: int) -> Iterator[pa.Array]:
    """Slices of a column of texts with about `most` bytes each; a longer text is one of its own."""
    total = np.concatenate([[0], np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(), dtype=np.int64)])
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield column.slice(at, end - at)
        at = end


def words_in(texts: pa.Array, lower: bool) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(number of each word, the different words, bounds of each text in the first): the texts, as
    bytes, are split at ASCII white space; with `lower`, A-Z are lower-cased first."""
    text = texts.view(pa.string())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    coded = parts.flatten().dictionary_encode()
    bounds = np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy(), dtype=np.int64)])
    word, words = coded.indices.to_numpy(), coded.dictionary.view(pa.binary()).to_pylist()
    if b"" in words:  # white space at an end of a text
        real = word != words.index(b"")
        bounds = np.concatenate([[0], np.cumsum(real, dtype=np.int64)])[bounds]
        word = word[real]
    return word, words, bounds


def trim() -> None:
    """Give freed memory back to the system. A worker stays for later tasks and counts until then."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


class Memo(dict):
    """What a Python worker remembers of words, for `most` of them at a time. A worker serves many
    tasks; when a task of another operator begins, `use` empties what the last one has left."""

    most = 300_000
    _last: Memo | None = None

    def use(self) -> Memo:
        if Memo._last is not None and Memo._last is not self:
            Memo._last.forget()
        Memo._last = self
        return self

    def forget(self) -> None:
        self.clear()

    def make(self, word):
        raise NotImplementedError

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        self[word] = out = self.make(word)
        return out
