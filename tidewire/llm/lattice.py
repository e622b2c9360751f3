"""11. Likelihood of texts over all ways to spell their words with a vocabulary's pieces."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.llm.common import by_bytes, read, session, trim, words_in
from tidewire.storage import Scratch, importable

VOCABULARY = "piece_bpe_32k.model"
#: What a piece at the start of a word begins with.
START = "▁"
#: Ranks are read as frequencies of 1 / (rank + SHIFT).
SHIFT = 2.7
#: Words' worth of the vocabulary's own scores in the trained ones.
PRIOR = 1000.0
#: Most words that are sent to all tasks; each is known by its bytes or, if longer, by a digest.
FREQUENT, SHORT = 1 << 17, 24
#: Text that is split into words at a time, in bytes.
PART = 1 << 23
#: Text whose words' lattices are in memory at a time, in bytes.
CHARACTERS = 1 << 18
#: Parts of an expected count that are told apart, so that sums don't hang on their order.
UNIT = 1 << 20
#: Documents whose key's CRC-32 leaves HELD of FOLDS are not learnt from.
FOLDS, HELD = 7, 2
LN10 = math.log(10)


def vocabulary(path: str | None = None) -> dict[str, float]:
    """Piece to natural log weight, from an existing vocabulary's own scores; a byte's piece is the
    byte as a character from U+DC00 on. Scores that only rank pieces (0, -1, -2, ...) count as those
    of a Zipf distribution; bytes, which have no rank, are as rare as the last piece."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    pieces, octets = {}, []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            octets.append(chr(0xDC00 + int(model.id_to_piece(i)[1:-1], 16)))
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i)] = model.get_score(i)
    if pieces and min(pieces.values()) < -100:
        pieces = {p: -math.log(SHIFT - s) for p, s in pieces.items()}
    rarest = min(pieces.values(), default=0.0)
    pieces |= dict.fromkeys(octets, rarest)
    total = math.log(sum(map(math.exp, pieces.values())))
    return {p: w - total for p, w in pieces.items()}


class Lattice:
    """All ways to spell words: an arc from place to place for each piece that stands there, and for
    a character that is no piece its bytes. Many words are taken at a time; `weights` are natural
    logs, in the order of `pieces`."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces, self.weights = list(pieces), np.array(list(pieces.values()))
        self.octet = {ord(p) - 0xDC00: i for i, p in enumerate(pieces) if _is_octet(p)}
        nodes, edges, ends = {"": 0}, {}, {}
        for i, piece in enumerate(pieces):
            if not _is_octet(piece):
                for k in range(1, len(piece) + 1):
                    over, node = nodes[piece[: k - 1]], nodes.setdefault(piece[:k], len(nodes))
                    edges[over << 21 | ord(piece[k - 1])] = node
                ends[nodes[piece]] = i
        self.keys = np.array(sorted(edges), np.int64)
        self.child = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.ends = np.full(len(nodes), -1, np.int64)
        self.ends[list(ends)] = list(ends.values())

    def _arcs(self, words: list[str]) -> _Arcs:
        lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
        code = np.frombuffer("".join([START + w for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lens)
        first = np.cumsum(lens) - lens
        stop = (first + lens)[word]
        none = np.zeros(0, np.int64)
        live, node, length, found = np.arange(len(code)), np.zeros(len(code), np.int64), 0, [(none, none, none)]
        while len(live):
            inside = live + length < stop[live]
            live, node = live[inside], node[inside]
            key = node << 21 | code[live + length]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            live, node, length = live[hit], self.child[at[hit]], length + 1
            piece = self.ends[node]
            whole = piece >= 0
            found.append((live[whole], np.full(whole.sum(), length), piece[whole]))
        alone = np.ones(len(code), bool)
        alone[found[min(1, length)][0]] = False
        odd, which = np.unique(code[alone], return_inverse=True)
        spelt = [[self.octet[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in odd]
        found.append((np.flatnonzero(alone), np.ones(len(which), np.int64), -1 - which))
        at, length, piece = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((length, at - first[word[at]]))
        at, length, piece = at[order], length[order], piece[order]
        column = at - first[word[at]]
        cuts = np.flatnonzero(np.diff(column) | np.diff(length)) + 1
        weight = np.concatenate([self.weights, [self.weights[s].sum() for s in spelt[::-1]]])[piece]
        source = at + word[at]  # a word has a place more than characters
        return _Arcs(source, source + length, weight, piece, spelt, np.concatenate([[0], cuts, [len(at)]]).tolist(), first + np.arange(len(words)), lens)

    def forward(self, words: list[str]) -> np.ndarray:
        """Natural log of the summed probability of all spellings of each word."""
        arcs = self._arcs(words)
        return arcs.ahead()[arcs.last]

    def expected(self, words: list[str]) -> np.ndarray:
        """How often spellings of the words have each piece on average, in UNITs and for all words."""
        arcs = self._arcs(words)
        share = arcs.shares()
        units = np.floor(share * UNIT + 0.5)
        plain = arcs.piece >= 0
        out = np.bincount(arcs.piece[plain], units[plain], len(self.pieces))
        each = np.bincount(-1 - arcs.piece[~plain], units[~plain], len(arcs.spelt))
        for own, n in zip(arcs.spelt, each):
            np.add.at(out, own, n)
        return out.astype(np.int64)


@dataclass
class _Arcs:
    """Arcs between places, in runs (`cuts`) that start equally far into their words and are equally
    long, so that a run has one arc of a word at most; runs are in order of their start."""

    source: np.ndarray
    target: np.ndarray
    weight: np.ndarray
    piece: np.ndarray
    spelt: list[list[int]]
    cuts: list[int]
    first: np.ndarray
    lens: np.ndarray

    @property
    def last(self) -> np.ndarray:
        return self.first + self.lens

    def ahead(self) -> np.ndarray:
        """Log of what all ways from a word's start to each place weigh."""
        out = np.full(self.last[-1] + 1 if len(self.lens) else 0, -np.inf)
        out[self.first] = 0.0
        for a, b in zip(self.cuts, self.cuts[1:]):
            to = self.target[a:b]
            out[to] = np.logaddexp(out[to], out[self.source[a:b]] + self.weight[a:b])
        return out

    def shares(self) -> np.ndarray:
        """The part of a word's probability that goes through each arc."""
        ahead = self.ahead()
        behind = np.full(len(ahead), -np.inf)
        behind[self.last] = 0.0
        for a, b in zip(self.cuts[-2::-1], self.cuts[::-1]):
            of = self.source[a:b]
            behind[of] = np.logaddexp(behind[of], self.weight[a:b] + behind[self.target[a:b]])
        whole = np.repeat(ahead[self.last], self.lens + 1)
        return np.exp(np.minimum(0.0, ahead[self.source] + self.weight + behind[self.target] - whole[self.source]))


def _is_octet(piece: str) -> bool:
    return "\udc00" <= piece[0] <= "\udcff"


def _by_length(words: list[bytes]) -> Iterator[list[str]]:
    """Words as texts, some CHARACTERS of them at a time; a longer one is a part of its own."""
    own, size = [], 0
    for w in words:
        if own and size + len(w) > CHARACTERS:
            yield own
            own, size = [], 0
        own.append(w.decode("utf-8", "replace"))
        size += len(w) + 1
    if own:
        yield own


def held_out(key: Column, folds: int = FOLDS, held: int = HELD) -> Column:
    """Whether a document is kept from learning; a null key is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == held, F.lit(False))


def _bytes(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, total, trained) of `docs` (text in bytes, held): how often all and training documents
    have each word, A-Z lower-cased."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in by_bytes(batch.column("text"), PART):
                word, words, bounds = words_in(texts, True)
                held = batch.column("held").slice(at, len(texts)).to_numpy(zero_copy_only=False)
                at += len(texts)
                total = np.bincount(word, minlength=len(words))
                trained = np.bincount(word, np.repeat(~held, np.diff(bounds)), len(words)).astype(np.int64)
                some = np.flatnonzero(total)
                yield pa.record_batch([pa.array([words[i] for i in some], pa.binary()), pa.array(total[some]), pa.array(trained[some])], ["word", "total", "trained"])
        trim()

    found = docs.mapInArrow(count, "word binary, total long, trained long")
    return found.groupBy("word").agg(F.sum("total").alias("total"), F.sum("trained").alias("trained"))


def train(words: DataFrame, pieces: dict[str, float], prior: float = PRIOR) -> dict[str, float]:
    """The pieces with their weights after one step of expectation maximisation over the different
    training words, the given weights counting as those of `prior` pieces more."""
    lattice = Lattice(pieces)
    send = session(words).sparkContext.broadcast(lattice)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(send.value.pieces), np.int64)
        for batch in batches:
            for part in _by_length(batch.column("word").to_pylist()):
                counts += send.value.expected(part)
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(some), pa.array(counts[some])], ["piece", "n"])

    found = words.where("trained > 0").select("word").mapInArrow(gather, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(pieces))
    for r in found.collect():  # of pieces
        counts[r["piece"]] = r["n"] / UNIT
    trained = (counts + prior * np.exp(lattice.weights)) / (counts.sum() + prior)
    return dict(zip(lattice.pieces, np.log(trained).tolist()))


def _key(word: bytes) -> bytes:
    return word if len(word) <= SHORT else b"\n" + blake2b(word, digest_size=16).digest()


def score_texts(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of `docs`: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words (A-Z lower-cased) and one end. base_score is that of counts with one added.
    `score` is the log10 probability of the text under a model whose lattice has two kinds of arcs:
    a word of the training documents as a whole, by its count less a discount, and for what the
    discount leaves, all segmentations of the word into the pieces of an existing vocabulary, summed
    by a forward recursion in logs. The pieces' weights are the vocabulary's own scores, updated by
    the different training words. Probabilities of all words and the end sum to one.

    Each different word is scored once. The FREQUENT most frequent ones go to all tasks, with a
    digest for long ones, so that bound holds in bytes; other words meet their documents in a join
    on the word, in which none is frequent. Null text counts as empty: one token, the end. Documents
    with a null key are learnt from; rows that repeat a key are rows of their own. Without training
    documents words are spelt by the vocabulary's scores alone and base_score is 0. No rows give no
    rows. Other columns are not read.
    """
    spark = session(docs)
    importable(spark)
    scratch = Scratch(spark, "lattice")
    named = docs.select(F.col(key).alias("doc_id"), held.alias("held"), _bytes(F.col(text)).alias("text"))
    words = scratch.table(word_counts(named.select("text", "held")), "words")
    ends = named.where(~F.col("held")).count()
    has = lambda c: F.count(F.when(F.col("trained") == c, 1))
    told = words.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("n"), F.count(F.when(F.col("trained") > 0, 1)).alias("v"), has(1).alias("once"), has(2).alias("twice")).first()
    n_words, n = told["n"], told["n"] + ends
    distinct = told["v"] + (ends > 0)
    base_off = math.log10(n + distinct + 1)
    discount = told["once"] / (told["once"] + 2 * told["twice"]) if told["once"] else 0.5
    end_score = math.log10((ends + 1) / (n + 2))
    rest = math.log((n_words + 1) / (n + 2))  # what the end leaves
    spelt = discount * told["v"] / n_words if n_words else 1.0
    lattice = spark.sparkContext.broadcast(Lattice(train(words, vocabulary(path))))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marginal = np.concatenate([np.zeros(0), *(lattice.value.forward(part) for part in _by_length(batch.column("word").to_pylist()))])
            trained = batch.column("trained").to_numpy()
            with np.errstate(divide="ignore"):
                whole = np.log(np.maximum(trained - discount, 0) / max(n_words, 1))
            lp = (np.logaddexp(whole, math.log(spelt) + marginal) + rest) / LN10
            cells = [batch.column("word"), batch.column("total"), pa.array(trained > 0), pa.array(np.log10(trained + 1.0) - base_off), pa.array(lp)]
            yield pa.record_batch(cells, ["word", "total", "known", "base", "lp"])

    weighed = scratch.table(words.mapInArrow(weigh, "word binary, total long, known boolean, base double, lp double"), "weighed")
    heavy = spark.sparkContext.broadcast({_key(bytes(r["word"])): (r["known"], r["base"], r["lp"]) for r in _frequent(weighed).collect()})

    def read_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = heavy.value
        for batch in batches:
            at = 0
            for texts in by_bytes(batch.column("text"), PART):
                word, words, bounds = words_in(texts, True)
                found = [known.get(_key(w)) for w in words]
                score = np.array([f or (False, 0.0, 0.0) for f in found], float).reshape(-1, 3)
                doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
                sums = [np.bincount(doc, score[word, i], len(texts)).astype(float) for i in range(3)]
                rare = np.array([f is None for f in found], bool)[word] if len(words) else np.zeros(0, bool)
                pairs, times = np.unique(doc[rare] * len(words) + word[rare], return_counts=True)
                whose, which = np.divmod(pairs, max(len(words), 1))
                cuts = pa.array(np.searchsorted(whose, np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array([words[i] for i in which], pa.binary())), pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64()))]
                own = batch.slice(at, len(texts))
                at += len(texts)
                cells = [own.column("row"), own.column("doc_id"), own.column("held"), pa.array(np.diff(bounds) + 1), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), *lists]
                yield pa.record_batch(cells, ["row", "doc_id", "held", "n_tokens", "n_known", "base", "lp", "rare", "times"])
        trim()

    id_type = docs.schema[key].dataType.simpleString()
    schema = f"row long, doc_id {id_type}, held boolean, n_tokens long, n_known long, base double, lp double, rare array<binary>, times array<long>"
    texts = scratch.table(named.withColumn("row", F.monotonically_increasing_id()).mapInArrow(read_texts, schema), "texts")
    each = texts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    times = F.col("times")
    met = each.join(weighed.select("word", "known", "base", "lp"), "word").select(
        "row", F.when(F.col("known"), times).otherwise(0).alias("n_known"), (times * F.col("base")).alias("base"), (times * F.col("lp")).alias("lp")
    )
    own = ("doc_id", "held", "n_tokens")
    both = texts.select("row", *own, "n_known", "base", "lp").unionByName(met, allowMissingColumns=True)
    summed = both.groupBy("row").agg(*[F.max(c).alias(c) for c in own], *[F.sum(c).alias(c) for c in ("n_known", "base", "lp")])
    end_base = math.log10(ends + 1) - base_off
    return summed.select(
        F.col("doc_id").alias(key), F.col("held").alias("held_out"), "n_tokens", (F.col("n_known") + int(ends > 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + end_base).alias("base_score"), (F.col("lp") + end_score).alias("score"),
    )


def _frequent(words: DataFrame) -> DataFrame:
    """The words above the least count that FREQUENT words at most reach; counts are told apart to a
    sixth of a power of two, so some four hundred steps are looked at."""
    step = F.floor(F.log2(F.col("total").cast("double")) * 6)
    reached, least = 0, None
    for r in sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True):
        reached += r["count"]
        if reached > FREQUENT:
            break
        least = r["step"]
    return words.where(step >= least) if least is not None else words.where("false")


def op11_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read(spark, sf_dir, "documents"), held_out(F.col("doc_id")))
