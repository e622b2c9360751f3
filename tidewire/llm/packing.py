"""1. Best-fit packing of token sequences."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm.common import SLICE, Memo, by_bytes, gapless_rank, read, session, text_of, trim, words_in
from tidewire.storage import Scratch, cell_rows, importable

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
END = 0
#: Words whose ids a worker remembers before it starts afresh.
REMEMBER = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Words without these are in NFC and hold no white space, control characters or special tokens.
ODD = r"[^\n\x21-\x7e\xa1-\u024f]|<\|"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level BPE: itself where it is visible Latin-1,
    else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Known(Memo):
    """Ids of words, and of the parts that words are made of."""

    def __init__(self) -> None:
        self.parts: dict[str, bytes] = {}

    def forget(self) -> None:
        self.clear()
        self.parts.clear()


class WordIds:
    """Ids of texts, as little-endian unsigned 32-bit bytes.

    Where a vocabulary lower-cases, drops white space, splits by one pattern and then merges bytes,
    no token spans white space, and a text's ids are those of its words in turn; a plain word's ids
    are those of the parts that the pattern finds in it. Words and parts are encoded once and
    remembered. Other words of such a vocabulary, and texts of any other vocabulary, go through the
    tokenizer as they are.
    """

    def __init__(self, path: str):
        import json
        import os

        import regex

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # only these parts: the whole file as Python objects would fill a worker's memory
        state = lambda x: json.loads(x.__getstate__()) if x is not None else {}
        normal, split = state(self.tokenizer.normalizer).get("normalizers", []), state(self.tokenizer.pre_tokenizer).get("pretokenizers", [])
        kinds = [[x["type"] for x in part] for part in (normal, split)]
        self.by_word = kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] and type(self.tokenizer.model).__name__ == "BPE"
        if self.by_word:
            self.find = regex.compile(f'(?:{split[0]["pattern"]["Regex"]})|\\n').findall
        self.odd = regex.compile(ODD).finditer
        self.letters = _byte_letters()
        self.known = Known()

    def _part(self, part: str) -> bytes:
        out = self.known.parts.get(part)
        if out is None:
            spelt = part.encode().decode("latin-1").translate(self.letters)
            out = self.known.parts[part] = array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()
        return out

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of new words, which are remembered."""
        if len(self.known) + len(words) > REMEMBER:
            self.known.clear()
        if len(self.known.parts) > REMEMBER:
            self.known.parts.clear()
        lines = b"\n".join(words).decode("utf-8", "replace")
        starts = np.cumsum([0, *(len(x) + 1 for x in lines.split("\n"))]) if next(self.odd(lines), None) else None
        odd = sorted({int(np.searchsorted(starts, m.start(), "right")) - 1 for m in self.odd(lines)}) if starts is not None else []
        out, own = [], []
        for part in [*self.find(lines.lower()), "\n"]:
            if part == "\n":
                out.append(b"".join(own))
                own = []
            else:
                own.append(self.known.parts.get(part) or self._part(part))
        for i, ids in zip(odd, self._whole([words[i] for i in odd])):
            out[i] = ids
        self.known.update(zip(words, out))
        return out

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a column of bytes."""
        for texts in by_bytes(column, SLICE):
            if not self.by_word:
                yield from (np.frombuffer(x, "<u4") for x in self._whole(texts.to_pylist()))
                continue
            word, words, bounds = words_in(texts, False)
            ids = list(map(self.known.get, words))
            new = [i for i, x in enumerate(ids) if x is None]
            for i, x in zip(new, self.learn([words[i] for i in new]) if new else ()):
                ids[i] = x
            length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            start = np.cumsum(length) - length
            many = length[word]
            ends = np.concatenate([[0], np.cumsum(many)])
            kind = np.int32 if ends[-1] < 1 << 31 else np.int64
            at = np.arange(ends[-1], dtype=kind) + np.repeat((start[word] - ends[:-1]).astype(kind), many)
            flat = np.frombuffer(b"".join(ids), "<u4")[at]
            cuts = ends[bounds]
            yield from (flat[i:j] for i, j in zip(cuts[:-1], cuts[1:]))


_LOADED: dict[str, WordIds] = {}


def _ids(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def cutter(path: str, capacity: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow batches of (doc_id, text as bytes) to batches of PIECES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _ids(path)
        words.known.use()
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for key, ids in zip(batch.column(0).to_pylist(), words.texts(batch.column(1))):
                ids = memoryview(ids.tobytes() + end)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            cols = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        words.known.forget()
        trim()

    return run


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: is any bin open there?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, filled: bool) -> None:
        i = self.leaves + capacity
        self.any[i] = filled
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity >= least that a bin has, in logarithmic time."""
        i = self.leaves + least
        if self.any[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over a histogram of lengths: rows (length, first rank, pieces a bin,
    first bin, offset). A row says: from that rank on, pieces of that length fill the bins from
    `first bin` on, so many each, from `offset` on.

    Pieces of one length are alike and so are bins with the same remaining capacity, so whole runs
    of bins are filled in a step exactly as one piece after the other would fill them: the tightest
    bin that a piece fits stays the tightest for the next one until nothing more fits. Steps grow
    with the number of different lengths, not of pieces.
    """
    tree, free, bins, out = CapacityTree(capacity), {}, 0, []

    def give(room: int, first: int, many: int) -> None:
        if many and room:
            free.setdefault(room, []).append((first, many))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, many = capacity, bins, -(-left // (capacity // length))
                bins += many
            else:
                first, many = free[room].pop()
                if not free[room]:
                    tree.set(room, False)
            each = room // length
            full = min(many, left // each)
            if full:
                out.append((length, rank, each, first, capacity - room))
                give(room - each * length, first, full)
                rank, left, first, many = rank + full * each, left - full * each, first + full, many - full
            if many and 0 < left < each:
                out.append((length, rank, left, first, capacity - room))
                give(room - left * length, first, 1)
                first, many, left = first + 1, many - 1, 0
            give(room, first, many)
    return np.array(out, dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each document.

    A document is its ids and then id 0, so an empty or null text is one piece of length 1. Only
    documents of more than `capacity` ids are cut. The histogram of piece lengths, at most
    `capacity` rows, goes to the driver, which packs it by best-fit decreasing; each piece then
    finds its place from its rank among the pieces of its length. Ranks are dealt over small cells,
    so a length that a third of all pieces have is no hot task. A row that repeats a key is packed
    like any other. Columns other than the two named are not read; no rows give no rows.
    """
    spark, scratch = session(docs), Scratch(session(docs), "pack")
    importable(spark)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("text"))
    pieces = scratch.table(texts.mapInArrow(cutter(path or vocabulary(), capacity), PIECES), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = best_fit(counts, capacity)
    n = sum(counts.values())
    cells = spark.createDataFrame([(k, -(-c // cell_rows(n))) for k, c in counts.items()], "length long, cells long")
    dealt = pieces.join(F.broadcast(cells), "length")
    ranked = gapless_rank(dealt, ["length"], F.pmod(F.xxhash64("doc_id", "piece"), "cells"), [F.col("doc_id"), F.col("piece")], "rank")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((runs[:, 1], runs[:, 0])) if len(runs) else []
        by = runs[order]
        big = int(n) + 1
        first = by[:, 0] * big + by[:, 1]
        for batch in batches:
            t = pa.Table.from_batches([batch])
            length, rank = (t[c].to_numpy() for c in ("length", "rank"))
            run = by[np.searchsorted(first, length * big + rank, "right") - 1]
            k = rank - run[:, 1]
            t = t.append_column("sequence_id", pa.array(run[:, 3] + k // run[:, 2])).append_column("offset", pa.array(run[:, 4] + k % run[:, 2] * length))
            yield from t.drop_columns(["rank"]).to_batches()

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(assign, PIECES + ", sequence_id long, offset long").withColumnRenamed("doc_id", key)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
