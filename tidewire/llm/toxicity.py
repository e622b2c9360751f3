"""6. Toxicity by classifier chains."""

from __future__ import annotations

import functools
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm.common import SLICE, Memo, by_bytes, read, session, text_of, trim, words_in
from tidewire.storage import importable

#: Labelled rows that the chain is fitted on, at most: those with the smallest hash of their key.
SAMPLE = 8192
#: Hash buckets of the features, and features that a model keeps, by their chi-square with the label.
BUCKETS = 1 << 18
KEEP = 2000
FOLDS = 5
STEPS = 500
PENALTY = 1e-5
#: Categories in the order of the chain: column of the labels, value that counts as positive.
CATEGORIES = (("quality", 0), ("toxic", 1))

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def features(word: bytes) -> tuple[int, ...]:
    """Buckets of a word: itself in lower case without punctuation around it, the punctuation that
    it ends in, and whether it is in capitals."""
    w = word.decode("utf-8", "replace")
    core = w if w.isalnum() else _EDGE.sub("", w)
    out = (_bucket(f"w:{core.lower()}"),) if core else ()
    if w != core:
        out += (_mark(w.replace(core, "", 1) if core else w),)
    return (*out, _bucket("c:")) if len(core) > 1 and core.isupper() else out


def _bucket(name: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(name) % BUCKETS


@functools.lru_cache(4096)
def _mark(punctuation: str) -> int:
    return _bucket(f"p:{re.sub(r'(.)\1+', r'\1\1', punctuation)[:8]}")


class Buckets(Memo):
    """features() by word."""

    most = 200_000

    def make(self, word: bytes) -> tuple[int, ...]:
        return features(word)


_BUCKETS = Buckets()


def buckets_in(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct buckets of each text of a column of bytes, sorted."""
    for texts in by_bytes(column, SLICE):
        word, words, bounds = words_in(texts, False)
        found = [_BUCKETS[w] for w in words]
        many = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(many.sum()))
        start = np.cumsum(many) - many
        row = np.repeat(np.arange(len(texts)), np.diff(bounds))
        n = many[word]
        at = np.arange(n.sum()) + np.repeat(start[word] - (np.cumsum(n) - n), n)
        every = np.repeat(row, n) * BUCKETS + flat[at]
        every.sort()
        once = every[np.append(True, every[1:] != every[:-1])[: len(every)]]  # each bucket of a text once
        cuts = np.searchsorted(once, np.arange(len(texts) + 1) * BUCKETS)
        yield from (once[i:j] % BUCKETS for i, j in zip(cuts[:-1], cuts[1:]))


@dataclass
class Linear:
    """A logistic model over kept buckets and the probabilities that earlier models of the chain gave."""

    keep: np.ndarray
    weights: np.ndarray
    chained: np.ndarray
    bias: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit(rows: list[np.ndarray], earlier: np.ndarray, y: np.ndarray) -> Linear:
    """Chi-square selection, then full-batch Adagrad on the penalised logistic loss, in which both
    labels weigh the same in total, so that 0.5 is the threshold."""
    if not y.any():  # nothing to learn: never positive
        return Linear(np.empty(0, np.int64), np.empty(0), np.zeros(earlier.shape[1]), -10.0)
    n, positive = len(rows), float(y.sum())
    lengths = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate([*rows, np.empty(0, np.int64)])
    per = np.repeat(y, lengths)
    seen, hits = np.bincount(flat, minlength=BUCKETS), np.bincount(flat, per, minlength=BUCKETS)
    expected = seen * positive / n
    score = np.where(seen >= 3, (hits - expected) ** 2 / np.maximum(expected * (1 - seen / max(n, 1)), 1e-9), 0)
    keep = np.sort(np.lexsort((np.arange(BUCKETS), -score))[:KEEP])
    keep = keep[score[keep] > 24]  # p < 1e-6
    place = np.full(BUCKETS, -1)
    place[keep] = np.arange(len(keep))
    cols = place[flat]
    at = np.repeat(np.arange(n), lengths)[cols >= 0]
    cols = cols[cols >= 0]
    k, c = len(keep), earlier.shape[1]
    w, b = np.zeros(k + c), np.log(positive / max(n - positive, 1e-9))
    weight = np.where(y > 0, n / (2 * positive), n / (2 * max(n - positive, 1e-9)))
    seen_w, seen_b = np.full(k + c, 1e-8), 1e-8
    for _ in range(STEPS):
        margin = np.bincount(at, w[cols], minlength=n) + earlier @ w[k:] + b
        r = (_sigmoid(margin) - y) * weight / max(n, 1)
        g = np.concatenate([np.bincount(cols, r[at], minlength=k)[:k], earlier.T @ r]) + PENALTY / max(n, 1) * w
        gb = r.sum()
        seen_w += g * g
        seen_b += gb * gb
        w -= 0.5 * g / np.sqrt(seen_w)
        b -= 0.5 * gb / np.sqrt(seen_b)
    return Linear(keep, w[:k], w[k:], float(b))


def _margins(model: Linear, rows: list[np.ndarray], earlier: np.ndarray) -> np.ndarray:
    full = np.zeros(BUCKETS)
    full[model.keep] = model.weights
    own = np.array([full[r].sum() for r in rows]) if rows else np.zeros(0)
    return own + earlier @ model.chained + model.bias


@dataclass
class Chain:
    names: list[str]
    models: list[Linear]

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        """Of each category, each fed with those of the earlier ones."""
        out = np.zeros((len(rows), 0))
        for m in self.models:
            out = np.column_stack([out, _sigmoid(_margins(m, rows, out))])
        return out


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, names: list[str]) -> Chain:
    """One model a category, in order. What a model learns from its predecessors are out-of-fold
    predictions: those that models fitted without the row, and without its copies, gave for it."""
    fold = np.array([zlib.crc32(np.sort(r).astype("<i8").tobytes()) % FOLDS for r in rows], int)
    earlier, models = np.zeros((len(rows), 0)), []
    for j in range(labels.shape[1]):
        y = labels[:, j].astype(float)
        models.append(_fit(rows, earlier, y))
        held = np.zeros(len(rows))
        for f in range(FOLDS if j + 1 < labels.shape[1] else 0):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            m = _fit([rows[i] for i in inside], earlier[inside], y[inside])
            held[outside] = _sigmoid(_margins(m, [rows[i] for i in outside], earlier[outside]))
        earlier = np.column_stack([earlier, held])
    return Chain(names, models)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", categories: tuple[tuple[str, int], ...] = CATEGORIES, sample: int = SAMPLE) -> Chain:
    """Fit the chain on at most `sample` labelled documents, those with the smallest hash of their
    key. Label rows that are null in any of the categories, and labels without a document, are left
    out. Of labels that repeat a key the positive ones count, and of documents that repeat one a
    single text, so what the driver collects is bounded. Null texts are empty. Without any labelled
    document, or any positive one, a model never says yes."""
    importable(session(docs))
    whole = labels.where(F.col(key).isNotNull())
    for c, _ in categories:
        whole = whole.where(F.col(c).isNotNull())
    ys = [f"__y{i}" for i in range(len(categories))]
    some = whole.groupBy(F.col(key).alias("__key")).agg(*[F.max((F.col(c) == v).cast("int")).alias(y) for y, (c, v) in zip(ys, categories)])
    some = some.orderBy(F.xxhash64("__key"), "__key").limit(sample)
    kind = some.schema["__key"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _BUCKETS.use()
        for b in batches:
            found = pa.array(list(buckets_in(b.column(b.num_columns - 1))), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], found], names=["__key", *ys, "f"])
        _BUCKETS.forget()
        trim()

    texts = docs.select(F.col(key).alias("__key"), text_of(text).cast("binary").alias("text"))
    found = texts.join(F.broadcast(some), "__key").select("__key", *ys, "text")
    found = found.mapInArrow(rows, f"__key {kind}, " + ", ".join(f"{y} int" for y in ys) + ", f array<long>")
    got = found.groupBy("__key").agg(*[F.max(y).alias(y) for y in ys], F.min_by("f", F.xxhash64("f")).alias("f")).collect()
    got.sort(key=lambda r: tuple(r["f"]))  # the fit doesn't depend on the order of rows
    y = np.array([[r[c] for c in ys] for r in got]).reshape(len(got), len(ys))
    return fit_chain([np.array(r["f"], dtype=np.int64) for r in got], y, [c for c, _ in categories])


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, p_<category>... for each row of `docs`. The chain is a few thousand numbers, whatever
    the data; nothing is shuffled. Null and empty texts have no features and get the bias; a text
    without white space is one word; rows that repeat are each scored; no rows give no rows. Other
    columns are not read."""
    importable(session(docs))
    kind = docs.select(F.col(key).alias("__key")).schema["__key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _BUCKETS.use()
        for b in batches:
            p = chain.probabilities(list(buckets_in(b.column(1))))
            cols = [pa.array(p[:, j]) for j in range(p.shape[1])]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["__key", *[f"p_{n}" for n in chain.names]])
        _BUCKETS.forget()
        trim()

    texts = docs.select(F.col(key).alias("__key"), text_of(text).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"__key {kind}, " + ", ".join(f"p_{n} double" for n in chain.names)).withColumnRenamed("__key", key)


def clean(docs: DataFrame, chain: Chain, category: str, text: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, whose probability of `category` is below 0.5. Null
    and empty texts are judged by the bias alone; rows that repeat are each judged, and alike; no rows
    give no rows; other columns, whatever their names, pass through."""
    importable(session(docs))
    j = chain.names.index(category)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _BUCKETS.use()
        for b in batches:
            rows = list(buckets_in(pc.fill_null(b.column(at), "").view(pa.binary())))
            yield b.filter(pa.array(chain.probabilities(rows)[:, j] < 0.5, pa.bool_()))
        _BUCKETS.forget()
        trim()

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    chain = train(docs, read(spark, sf_dir, "labels"))
    return score(docs, chain).select("doc_id", F.col("p_quality").alias("p_low_quality"), "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))
