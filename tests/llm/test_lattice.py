"""The lattice against a plain listing of all spellings, and scores against a plain loop."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.llm import common, lattice as L

LOWER = str.maketrans(common.UPPER, common.LOWER)


def spellings(text, pieces):
    """All ways to write `text` with pieces; bytes stand for characters that are none."""
    if not text:
        yield []
        return
    heads = [text[:k] for k in range(1, len(text) + 1) if text[:k] in pieces]
    if text[0] not in pieces:
        heads.append(None)
    for head in heads:
        used = [head] if head else [chr(0xDC00 + b) for b in text[0].encode()]
        for tail in spellings(text[len(head or "x") :], pieces):
            yield used + tail


PIECES = {"▁": 0.2, "▁a": 0.1, "a": 0.1, "b": 0.1, "ab": 0.05, "▁ab": 0.05, "bab": 0.1, "é": 0.05, "ba": 0.05} | {chr(0xDC00 + b): 0.2 / 256 for b in range(256)}
LOGS = {p: math.log(w) for p, w in PIECES.items()}
WORDS = ["", "a", "abab", "babab", "é", "xaé", "日b", "aaaa", "▁a", "b▁ab"]


def chance(word):
    return sum(math.prod(PIECES[p] for p in way) for way in spellings("▁" + word, PIECES))


def test_forward_sums_all_spellings():
    got = L.Lattice(LOGS).forward(WORDS)
    assert got == pytest.approx([math.log(chance(w)) for w in WORDS], abs=1e-12)
    assert len(L.Lattice(LOGS).forward([])) == 0
    # a word of many characters neither underflows nor depends on its neighbours
    assert L.Lattice(LOGS).forward(["a" * 5000, "b"])[1] == pytest.approx(math.log(chance("b"))) and np.isfinite(L.Lattice(LOGS).forward(["x" * 5000])).all()


def test_expected_counts_are_means_over_all_spellings():
    model, want = L.Lattice(LOGS), Counter()
    for w in WORDS:
        for way in spellings("▁" + w, PIECES):
            for p in way:
                want[p] += math.prod(PIECES[q] for q in way) / chance(w)
    got = dict(zip(model.pieces, model.expected(WORDS) / L.UNIT))
    assert {p: n for p, n in got.items() if n} == pytest.approx(dict(want), abs=1e-4)


def test_existing_scores():
    pieces = L.vocabulary()
    assert sum(map(math.exp, pieces.values())) == pytest.approx(1) and len(pieces) > 30_000
    assert pieces["▁the"] > pieces["▁something"] and sum(p[0] >= "\udc00" and p[0] <= "\udcff" for p in pieces) == 256


def plain(rows):
    """base_score as the contract has it, and n_known."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for _, t in rows]
    held = [k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows]
    c = Counter(w for ws, h in zip(words, held) if not h for w in [*ws, None])
    n, v = sum(c.values()), len(c)
    return [(k, h, len(ws) + 1, sum(c[w] > 0 for w in [*ws, None]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*ws, None])) for (k, _), ws, h in zip(rows, words, held)]


ROWS = [(i, f"Common words of text {i % 5} and ùn {'x' * (i % 60)}") for i in range(90)] + [(None, "common"), (3, None), (4, ""), (5, "Common COMMON"), (5, "Common COMMON"), (91, "long " * 4000), (92, "y" * 20_000)]


@pytest.mark.parametrize("frequent", [1 << 17, 3, 0])
def test_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(L, "FREQUENT", frequent)
    monkeypatch.setattr(L, "PART", 500)
    clash = [F.lit(i).alias(c) for i, c in enumerate(("row", "word", "held", "lp", "total", "base"))]
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3).select("*", *clash)
    got = L.score_texts(docs, L.held_out(F.col("doc_id"))).collect()
    key = lambda r: str(r[:5])
    want = sorted(plain(ROWS), key=key)
    rows = sorted((tuple(r) for r in got), key=key)
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    assert [r[5] for r in rows] == pytest.approx([r[5] for r in want], rel=1e-12)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in rows)
    assert next(r[6] for r in rows if r[0] == 3 and r[2] == 1) == next(r[6] for r in rows if r[0] == 4 and r[2] == 1)


def test_probabilities_sum_to_one(spark):
    """What single words and the empty text have, against the formula."""
    rows = [(i, t) for i, t in enumerate(["a b a", "a c", "b"] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in L.score_texts(docs, F.lit(False)).collect()}
    n, ends = 30, 15
    c, pieces = {"a": 15, "b": 10, "c": 5}, L.vocabulary()
    one = L.Lattice(pieces)
    counts = one.expected(list(c)) / L.UNIT
    trained = dict(zip(one.pieces, np.log((counts + L.PRIOR * np.exp(one.weights)) / (counts.sum() + L.PRIOR))))
    assert sum(map(math.exp, trained.values())) == pytest.approx(1)
    spelt = 0.5 * 3 / n
    word = lambda w: (n + 1) / (n + ends + 2) * ((c[w] - 0.5) / n + spelt * math.exp(L.Lattice(trained).forward([w])[0]))
    end = (ends + 1) / (n + ends + 2)
    assert got[0] == pytest.approx(math.log10(word("a") ** 2 * word("b") * end)) and got[2] == pytest.approx(math.log10(word("b") * end))


def test_no_training_documents_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.score_texts(docs, F.lit(True)).collect()}
    assert got[1]["base_score"] == 0 and got[1]["train_tokens"] == 0 and got[1]["n_known"] == 0 and got[1]["score"] < got[2]["score"] < 0
    assert L.score_texts(docs.where("false"), F.lit(False)).count() == 0
