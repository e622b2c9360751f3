"""7. N-gram Jaccard join with signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewire.llm.common import LOWER, SLICE, UPPER, WORD, by_bytes, lower_ascii, read, session, text_of, trim, words_in
from tidewire.operators.graph import connected_components
from tidewire.storage import Scratch, importable

#: Words in a shingle and least similarity in hundredths, as the contract of the query has them.
SHINGLE, PERCENT = 4, 85
#: Children of a tree node.
FAN = 8
#: Rows of one hub that are compared in one task; a larger group is cut into pieces whose pairs are
#: compared apart.
PIECE = 8192
#: Smallest tokens of a row by which it finds hubs, and the share of them that it has in common with
#: a hub, at least, to be compared with it before all others. Hubs only decide what is compared
#: first, not whether.
SKETCH, FAMILY = 16, 0.5
#: Documents, about, in which tokens are counted to tell the frequent ones, how many of them have a
#: frequent token at least, and how many tokens are told. This settles the order of tokens, by which
#: all tokens of all documents are met, and no result.
COUNTED, FREQUENT, TOLD = 1 << 14, 3, 1 << 17
#: Groups up to this length need no tree.
SHORT = 24
#: Groups above this length are searched twice.
LONG = 256
#: Bits of a bitmap for each token, at least, in groups up to SHORT and in longer ones.
NARROW, WIDE = 1, 4
#: Documents whose keys are broadcast to pick their texts, at most; for more, all texts are shuffled.
PICKED = 1 << 18
#: Node pairs that are looked at together, and bytes that their bitmaps may take.
SLAB, SLAB_BYTES = 1 << 15, 1 << 23
#: Bytes of bitmaps that are held at a time.
HELD_BYTES = 1 << 24
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of k words, given the words' hashes. With
    fewer words, the whole sequence is one; without words there is none."""
    if not len(words):
        return np.empty(0, np.uint64)
    k = min(k, len(words))
    out = np.full(len(words) - k + 1, np.uint64(k))
    for i in range(k):
        out = (out ^ words[i : len(words) - k + 1 + i]) * MIX
        out ^= out >> np.uint64(31)
    out *= MIX2
    return np.unique(out ^ (out >> np.uint64(29)))


def sets_of(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The shingles of each text of a column of bytes, A-Z in lower case."""
    import xxhash

    for texts in by_bytes(column, SLICE):
        word, words, bounds = words_in(texts, True)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[word]
        yield from (shingles(hashes[i:j], k) for i, j in zip(bounds[:-1], bounds[1:]))


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int):
    """Least intersection of sets of sizes a and b that are similar enough, times (100 + percent)."""
    return percent * (a + b)


def prefix_length(n: int, percent: int) -> int:
    """Similar sets share one of so many first tokens in any common order."""
    return n - -(-percent * n // 100) + 1 if n else 0


def rare_first(h: np.ndarray, frequent: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The places of a sorted set's tokens in a common order: those that are not in the sorted array
    `frequent` first, then by their ranks there; ties stay in the order of the tokens."""
    if not len(frequent):
        return np.arange(len(h))
    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
    return np.argsort(np.where(frequent[at] == h, ranks[at], 0), kind="stable")


def bitmap(h: np.ndarray, room: int) -> bytes:
    """A bit for each token, in `room` to 2 * room bits a token and 64 at least."""
    bits = 64
    while bits < room * len(h):
        bits *= 2
    at = np.zeros(bits, np.uint8)
    at[(h & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(at, bitorder="little").tobytes()


def spans(percent: int) -> list[int]:
    """How many times as long, in powers of two, the longer bitmap of two similar sets can be."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be 1 to 100")
    out = [1]
    while out[-1] * percent < 100:
        out.append(2 * out[-1])
    return out if len(out) > 1 else [1, 2]


class Signatures:
    """Sizes and bitmaps of rows; bitmaps of one length are a matrix of 64-bit words."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes]):
        self.n = sizes.astype(np.int64)
        lengths = np.array([len(b) for b in bitmaps], np.int64)
        self.width = lengths // 8
        self.row = np.zeros(len(bitmaps), np.int64)
        self.words: dict[int, np.ndarray] = {}
        for w in np.unique(self.width):
            mine = np.flatnonzero(self.width == w)
            self.row[mine] = np.arange(len(mine))
            self.words[int(w)] = np.frombuffer(b"".join(bitmaps[i] for i in mine), np.uint64).reshape(len(mine), w)

    def folded(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of rows of one length, folded to `width` words."""
        own = int(self.width[rows[0]])
        m = self.words[own][self.row[rows]]
        while m.shape[1] > width:
            m = m[:, : m.shape[1] // 2] | m[:, m.shape[1] // 2 :]
        return m


def popcount(m: np.ndarray) -> np.ndarray:
    return np.bitwise_count(m).sum(axis=1, dtype=np.int64)


class SignatureTree:
    """Rows in the order of their size; a node has the OR of its children's bitmaps, the range of
    their sizes, and the most tokens that any row has in the bitmap and beyond its set bits."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, mapped: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        n, b, m = sizes[self.order], bits[self.order], mapped[self.order]
        self.levels = [(b, n, n, m - popcount(b), m)]
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, extra, m = self.levels[-1]
            at = np.arange(0, len(lo), FAN)
            most = np.maximum.reduceat
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at), most(hi, at), most(extra, at), most(m, at)))


def close(x: tuple, i: np.ndarray, y: tuple, j: np.ndarray, percent: int, exact: bool) -> np.ndarray:
    """Can nodes i of x and j of y hold a similar pair? A common token sets a common bit, and tokens
    that share a bit with another one are no more than those beyond the set bits, so an overlap is
    at most the common bits plus the fewer of these. Of two rows (`exact`), each token that the
    other one surely lacks counts off as well."""
    (bx, lx, hx, ex, mx), (by, ly, hy, ey, my) = x, y
    ok = (100 * hx[i] >= percent * ly[j]) & (100 * hy[j] >= percent * lx[i])
    at = np.flatnonzero(ok)
    a, b = bx[i[at]], by[j[at]]
    most = popcount(a & b) + np.minimum(ex[i[at]], ey[j[at]])
    if exact:
        most = np.minimum(most, np.minimum(mx[i[at]] - popcount(a & ~b), my[j[at]] - popcount(b & ~a)))
    ok[at] = (100 + percent) * most >= needed(lx[i[at]], ly[j[at]], percent)
    return ok


def slab_rows(words: int) -> int:
    """Node pairs whose bitmaps of so many words may be looked at together."""
    return max(FAN * FAN, min(SLAB, SLAB_BYTES // (8 * words)))


def dual_traversal(x: SignatureTree, y: SignatureTree, percent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of x and y that may be similar, slab by slab. Depth first over slabs of node pairs, so
    that memory is bounded; with `same`, each pair once."""
    stack = [(len(x.levels) - 1, len(y.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    slab = slab_rows(x.levels[0][0].shape[1])
    while stack:
        p, q, i, j = stack.pop()
        if len(i) > slab:
            half = len(i) // 2
            stack += [(p, q, i[:half], j[:half]), (p, q, i[half:], j[half:])]
            continue
        ok = close(x.levels[p], i, y.levels[q], j, percent, p == q == 0)
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if p == q == 0:
            keep = i < j if same else slice(None)
            yield x.order[i[keep]], y.order[j[keep]]
            continue
        down_x, down_y = p >= q, q >= p
        fx, fy = (FAN if down_x else 1), (FAN if down_y else 1)
        i = np.repeat(i * fx, fx * fy) + np.tile(np.repeat(np.arange(fx), fy), len(i))
        j = np.repeat(j * fy, fx * fy) + np.tile(np.tile(np.arange(fy), fx), len(j))
        p, q = p - down_x, q - down_y
        ok = (i < len(x.levels[p][1])) & (j < len(y.levels[q][1]))
        if same:
            ok &= i <= j
        stack.append((p, q, i[ok], j[ok]))


def candidates(start: np.ndarray, sig: Signatures, group: np.ndarray, side: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs that may be similar within each run of rows (`start` has the runs' bounds) and that
    differ in `group`. side is 0 for a run that is compared with itself, else 1 or 2: then pairs
    have one row of each."""
    lengths = np.diff(start)
    for g in np.unique(lengths[(lengths > 1) & (lengths <= SHORT)]):
        i, j = np.triu_indices(g, 1)
        at = start[:-1][lengths == g]
        a, b = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
        keep = (group[a] != group[b]) & ((side[a] == 0) | (side[a] != side[b]))
        yield from _rows_close(sig, a[keep], b[keep], percent)
    for k in np.flatnonzero(lengths > SHORT):
        rows = np.arange(start[k], start[k + 1])
        if (group[rows] == group[rows[0]]).all():
            continue
        sides = (rows, rows) if side[rows[0]] == 0 else (rows[side[rows] == 1], rows[side[rows] == 2])
        for w in np.unique(sig.width[rows]):
            left = sides[0][sig.width[sides[0]] == w]
            for v in sorted({*(w // s for s in spans(percent)), *(w * s for s in spans(percent))}):
                right = sides[1][sig.width[sides[1]] == v]
                same = side[rows[0]] == 0
                if not len(left) or not len(right) or (same and v < w):
                    continue
                width = int(min(w, v))
                x = SignatureTree(sig.n[left], sig.folded(left, width), sig.n[left])
                y = x if same and v == w else SignatureTree(sig.n[right], sig.folded(right, width), sig.n[right])
                for i, j in dual_traversal(x, y, percent, same and v == w):
                    a, b = left[i], right[j]
                    keep = group[a] != group[b]
                    yield a[keep], b[keep]


def _rows_close(sig: Signatures, a: np.ndarray, b: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows that may be similar, looked at by the lengths of their bitmaps."""
    swap = sig.width[a] > sig.width[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    near = spans(percent)[-1] * sig.width[a] >= sig.width[b]
    a, b = a[near], b[near]
    for w in np.unique(sig.width[a]):
        for v in (w * s for s in spans(percent)):
            mine = np.flatnonzero((sig.width[a] == w) & (sig.width[b] == v))
            slab = slab_rows(int(v))
            for at in range(0, len(mine), slab):
                i, j = a[mine[at : at + slab]], b[mine[at : at + slab]]
                level = []
                for rows in (i, j):
                    bits = sig.folded(rows, int(w))
                    n = sig.n[rows]
                    level.append((bits, n, n, n - popcount(bits), n))
                k = np.arange(len(i))
                ok = close(level[0], k, level[1], k, percent, True)
                yield i[ok], j[ok]


def _table(batches: Iterator[pa.RecordBatch], most: int, run: list[str]) -> Iterator[pa.Table]:
    """Tables of about `most` bytes that end where a run of equal `run` columns ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.get_total_buffer_size()
        if size < most:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        last = np.ones(t.num_rows, bool)
        for c in run:
            v = t[c].to_numpy()
            last &= v == v[-1]
        cut = t.num_rows - (int(np.argmin(last[::-1])) if not last.all() else t.num_rows)
        if cut:
            yield t.slice(0, cut)
            t = t.slice(cut)
        held = t.to_batches()
        size = t.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _tokens(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in (t for b in batches for t in by_bytes(b.column(0), SLICE)):
            found = np.concatenate([np.empty(0, np.uint64), *sets_of(texts, k)])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["token"])
        trim()

    return run


def _frequent(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted tokens, their ranks from 1 by the logarithm of their frequency): those that many of
    about COUNTED documents have, TOLD at most."""
    some = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, texts.count() // COUNTED))) == 0)
    counts = some.select("text").mapInArrow(_tokens(k), "token long").groupBy("token").agg(F.count("*").alias("df"))
    found = counts.where(F.col("df") >= FREQUENT).orderBy(F.col("df").desc(), "token").limit(TOLD).toArrow()
    tokens = found["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.log2(found["df"].to_numpy()).astype(np.int8)[order]


def _sets(k: int, percent: int, frequent: np.ndarray, ranks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            out: list[tuple] = []
            for key, h in zip(b.column(0).to_pylist(), sets_of(b.column(1), k)):
                first = h[rare_first(h, frequent, ranks)[: prefix_length(len(h), percent)]].view(np.int64)
                out.append((key, len(h), xxhash.xxh3_128_digest(h.tobytes()), first, h[:SKETCH].copy().view(np.int64), bitmap(h, NARROW), bitmap(h, WIDE)))
            cols = list(zip(*out)) if out else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "n", "set", "prefix", "sketch", "narrow", "wide"])
        trim()

    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return (100 + percent) * int((both[1:] == both[:-1]).sum()) >= needed(len(x), len(y), percent)


def _linked(k: int, percent: int):
    """Of rows (a, b, text), each run of one `a` led by the row in which b is a, the pairs a, b whose
    texts are similar. One leader's set is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.empty(0, np.uint64)
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sets_of(batch.column(2), k)):
                if a == b:
                    own = h
                elif similar(own, h, percent):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(2)], names=["a", "b"])
        trim()

    return run


def _once(found: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(found, axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]
    rows = rows[:, np.append(True, (rows[:, 1:] != rows[:, :-1]).any(axis=0))[: rows.shape[1]]]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["a", "b", "hub"])


class Forest:
    """Which pairs join what earlier ones have not: a spanning forest over the components of rows."""

    def __init__(self, component: np.ndarray):
        self.of = np.unique(component, return_inverse=True)[1]
        self.root = np.arange(self.of.max(initial=-1) + 1)

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            i = self.root[i]
        return i

    def new(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The places of the pairs (rows a, rows b) that join."""
        picked = []
        for k in np.flatnonzero(self.root[self.of[a]] != self.root[self.of[b]]):
            x, y = self._find(self.of[a[k]]), self._find(self.of[b[k]])
            if x != y:
                self.root[max(x, y)] = min(x, y)
                picked.append(k)
        if picked:
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
        return np.array(picked, np.int64)


def _cross(percent: int, forest: bool):
    """Pairs of rows of different components that may be similar, with the hub of their group. With
    `forest`, of pairs that would join the same components one is enough."""
    run_by = ["hub", "ca", "cb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _table(batches, HELD_BYTES, run_by):
            keys = np.stack([t[c].to_numpy() for c in run_by])
            start = np.flatnonzero(np.append(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)), True))
            sig = Signatures(t["n"].to_numpy(), t["bits"].to_pylist())
            own, ca, cb = t["c"].to_numpy(), keys[1], keys[2]
            side = np.where(ca == cb, 0, np.where(own == ca, 1, 2))
            doc, component, found = t["doc_id"].to_numpy(), t["component"].to_numpy(), []
            tree = Forest(component)
            for a, b in candidates(start, sig, component, side, percent):
                if forest:
                    new = tree.new(a, b)
                    a, b = a[new], b[new]
                found.append(np.stack([np.minimum(doc[a], doc[b]), np.maximum(doc[a], doc[b]), keys[0][a]]))
                if sum(f.shape[1] for f in found) > 1 << 18:
                    yield _once(found)
                    found = []
            if found:
                yield _once(found)
        trim()

    return run


def _pieces(df: DataFrame) -> DataFrame:
    """Each row once for each pair of pieces that it takes part in: its piece `c`, the pair `ca`
    and `cb`. A group of up to PIECE rows is one piece, and then a row stays one row. In larger ones,
    rows of the hub's component have pieces of their own, which are not paired with each other."""
    cuts = lambda n: F.ceil(n / PIECE).cast("long")
    small = F.col("rows") <= PIECE
    outer = F.when(small, 1).otherwise(cuts(F.col("others")))
    inner = F.when(small, 0).otherwise(cuts(F.col("rows") - F.col("others")))
    df = df.withColumn("outer", outer).withColumn("inner", inner)
    c = F.when(small | F.col("outside"), F.pmod(F.xxhash64("doc_id"), "outer")).otherwise(F.col("outer") + F.pmod(F.xxhash64("doc_id"), F.greatest("inner", F.lit(1))))
    df = df.withColumn("c", c.cast("long"))
    all_of = F.when(F.col("c") < F.col("outer"), F.col("outer") + F.col("inner")).otherwise(F.col("outer"))
    df = df.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), all_of.cast("long") - 1)))
    return df.withColumn("ca", F.least("c", "o")).withColumn("cb", F.greatest("c", "o")).drop("o", "rows", "others", "outer", "inner", "outside")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of `pairs`, a written table, that are similar by their whole sets. `b` comes to
    `a` with its text. A leader of many pairs has them dealt over groups of about PIECE, each with a
    copy of its text, so no task holds all of them. Texts of few documents are picked where they are
    read; those of many go through a shuffle."""
    parts = int(session(pairs).conf.get("spark.sql.shuffle.partitions"))
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIECE).cast("long").alias("cuts"))
    dealt = pairs.join(many.hint("merge"), "a").withColumn("cut", F.pmod(F.xxhash64("b"), "cuts"))
    leaders = many.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut"))
    wanted = dealt.select("a", "b", "cut").unionByName(leaders)
    texts = texts.where("doc_id is not null").select(F.col("doc_id").alias("b"), "text")
    some = wanted.select("b").distinct()
    if some.count() <= PICKED:
        texts = texts.join(F.broadcast(some), "b", "left_semi")
    rows = wanted.join(texts.hint("merge"), "b")
    rows = rows.repartition(parts, "a", "cut").sortWithinPartitions("a", "cut", F.col("a") != F.col("b"))
    return rows.select("a", "b", "text").mapInArrow(_linked(shingle, percent), "a long, b long")


def told_apart(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """(`docs` with a long `__row` that no two texts share, the rows (__row, __key) whose `__row` is
    not the key). It is the key, unless texts that differ repeat one: each of these has a new number
    then, outside the range of the keys."""
    scratch = Scratch(session(docs), "rows")
    k, sha = F.col(key).cast("long"), F.sha2(lower_ascii(text_of(text)), 256)
    often = docs.where(k.isNotNull()).groupBy(k.alias("__key")).count().where("count > 1").select("__key")
    often = scratch.table(often, "repeated")
    if often.isEmpty():
        return docs.withColumn("__row", k), None
    several = docs.withColumn("__key", k).join(often.hint("merge"), "__key", "left_semi").groupBy("__key").agg(F.min(sha).alias("lo"), F.max(sha).alias("hi"))
    several = scratch.table(several.where("lo <> hi").select("__key"), "several")
    marked = docs.withColumn("__key", k).withColumn("__sha", sha)
    lo, hi = docs.agg(F.min(k), F.max(k)).first()
    # the numbers go up from the largest key or, where that leaves too little room, down from the least
    number = F.lit(hi) + 1 + F.monotonically_increasing_id() if hi < 0 or hi <= -lo else F.lit(lo) - 1 - F.monotonically_increasing_id()
    texts = marked.join(several, "__key", "left_semi").select("__key", "__sha").distinct()
    renamed = scratch.table(texts.withColumn("__new", number), "renamed")
    keyed = marked.join(renamed, ["__key", "__sha"], "left").withColumn("__row", F.coalesce("__new", "__key"))
    return keyed.select(*docs.columns, "__row"), renamed.select(F.col("__new").alias("__row"), "__key")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """What `row_components` gives, for docs in which texts that differ may repeat a key: each text
    is then judged by itself."""
    keyed, renamed = told_apart(docs, key, text)
    out = row_components(keyed, "__row", text, shingle, percent)
    if renamed is not None:
        out = Scratch(session(docs), "judged").table(out, "rows").join(renamed, "__row", "left").withColumn("__row", F.coalesce("__key", "__row"))
        least = out.where("__row is not null").groupBy("component_id").agg(F.min("__row").alias("__least"))
        out = out.join(least, "component_id", "left").withColumn("component_id", F.col("__least"))
    return out.select(F.col("__row").alias(key), "n_shingles", "component_id")


def row_components(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """key, n_shingles, component_id for each row of `docs`: documents link when the Jaccard
    similarity of their sets of word shingles is at least percent / 100, and component_id is the
    smallest key that links reach. The result is exact.

    1. A text becomes the set of its shingles' hashes. Equal sets are one from here on.
    2. Similar sets share one of their first hashes in any common order (prefix filter), so posting
       lists over these hold every link. Hashes that many of a sample of documents have come last in
       that order, so a line that very many documents have makes no list of all of them; where the
       sample tells nothing, the order is that of the hashes. Lists are counted with a map-side
       combine, and those of one row are dropped.
    3. The first and last rows that have one of a row's smallest hashes are hubs. A row is compared
       by its whole set with the two hubs that it shares most of these with, so a family of N near
       copies is joined in about 2 N comparisons, whatever its size.
    4. All lists with one first row are a group, in which each row is once. Groups that still hold
       several components are searched by signature trees, whose nodes hold OR-combined bitmaps of
       the tokens and ranges of sizes; a dual traversal drops node pairs by the largest overlap that
       they allow. Only pairs of different components come out, and they are verified on whole
       sets, once a pair.
    5. Long groups are searched twice. The first time only pairs come out that would join what
       others of the task would not, so their number grows with the rows. The second time, by then
       known components, all pairs come out, of those groups that had any.
    6. The components of all links are the result.

    Leaders and groups of more than PIECE rows are cut, groups into pieces that are compared in
    pairs, so that no task holds a whole one; what a task holds is bounded in bytes. Pieces within
    the hub's component are not compared with each other. Joins by document never broadcast.

    Null, empty and blank texts have no shingles, link with nothing and are their own component; a
    null key likewise. Rows may repeat a key only with the same text (`told_apart` sees to that). No
    rows give no rows. Other columns are not read.
    """
    spark, scratch = session(docs), Scratch(session(docs), "ngram")
    importable(spark)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("text"))
    sets = scratch.table(texts.mapInArrow(_sets(shingle, percent, *_frequent(texts, shingle)), "doc_id long, n long, set binary, prefix array<long>, sketch array<long>, narrow binary, wide binary"), "sets")
    rows = scratch.table(sets.select("doc_id", "n", "set"), "rows")
    real = rows.where("n > 0 and doc_id is not null")
    classes = scratch.table(real.groupBy("set").agg(F.min("doc_id").alias("rep")), "classes")
    reps = sets.where("n > 0 and doc_id is not null").join(classes.select(F.col("rep").alias("doc_id"), "set").hint("merge"), ["doc_id", "set"], "left_semi")
    reps = scratch.table(reps.drop("set"), "representatives")
    scratch.drop(sets)

    def listed(column: str) -> tuple[DataFrame, DataFrame]:
        """The tokens of a column, and the lists of several rows that they make."""
        tokens = reps.select("doc_id", "n", F.size(column).alias("p"), F.explode(column).alias("token"))
        lists = tokens.groupBy("token").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("rows > 1")
        return tokens, scratch.table(lists.select("token", "first", "last"), "lists")

    tokens, lists = listed("sketch")
    met = tokens.join(lists.hint("merge"), "token").select("doc_id", "p", "first", "last")
    hubs = met.select("doc_id", "p", F.posexplode(F.array("first", "last")).alias("kind", "hub")).where("hub <> doc_id")
    shared = hubs.groupBy("doc_id", "hub", "kind", "p").agg(F.count("*").alias("shared")).where(F.col("shared") >= FAMILY * F.col("p"))
    best = shared.groupBy("doc_id", "kind").agg(F.max_by("hub", F.struct("shared", F.negative("hub"))).alias("a"))
    near = scratch.table(best.select("a", F.col("doc_id").alias("b")).distinct(), "near-hubs")
    scratch.drop(lists)
    links = scratch.table(_verified(near, texts, shingle, percent), "links")
    tokens, lists = listed("prefix")
    group = tokens.join(lists.hint("merge"), "token").select(F.col("first").alias("hub"), "doc_id", "n").distinct()
    group = scratch.table(group, "groups")
    scratch.drop(lists)
    bits = reps.select("doc_id", "narrow", "wide")

    def judged(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows of groups that hold several components: of short groups, and of others."""
        joined = connected_components(links, "a", "b", scratch)
        joined = scratch.table(joined.select(F.col("node").alias("doc_id"), F.col("component").alias("joined")), "joined")
        named = lambda df, key, out: df.join(joined.select(F.col("doc_id").alias(key), "joined").hint("merge"), key, "left").withColumn(out, F.coalesce("joined", key)).drop("joined")
        outside = F.col("component") != F.col("own")
        rows = scratch.table(named(named(group, "doc_id", "component"), "hub", "own").select("hub", "doc_id", "n", "component", outside.alias("outside")), "named")
        several = rows.groupBy("hub").agg(F.count("*").alias("rows"), F.sum(F.col("outside").cast("long")).alias("others")).where("others > 0")
        several = scratch.table(several, "several")
        short = rows.join(several.where(F.col("rows") <= SHORT).select("hub").hint("merge"), "hub").groupBy("hub").agg(F.collect_list(F.struct("doc_id", "n", "component")).alias("m"))
        fits = lambda x, y: (x["component"] != y["component"]) & (100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"]))
        short = short.select("hub", F.explode(F.filter("m", lambda x: F.exists("m", lambda y: fits(x, y)))).alias("x")).select("hub", "x.*")
        return short, rows.join(several.where(F.col("rows") > SHORT).hint("merge"), "hub")

    def searched(short: DataFrame | None, longer: DataFrame, forest: bool) -> DataFrame:
        cells = ["hub", "ca", "cb"]
        rows = _pieces(longer).join(bits.withColumnRenamed("wide", "bits").drop("narrow").hint("merge"), "doc_id")
        rows = rows.select(*cells, "c", "doc_id", "component", "n", "bits")
        if short is not None:
            zero = [F.lit(0).cast("long").alias(c) for c in ("ca", "cb", "c")]
            rows = rows.unionByName(short.select("*", *zero).join(bits.withColumnRenamed("narrow", "bits").drop("wide").hint("merge"), "doc_id"))
        runs = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *cells).sortWithinPartitions(*cells)
        return scratch.table(runs.mapInArrow(_cross(percent, forest), "a long, b long, hub long"), "candidates")

    tried = searched(None, judged(links)[1].where(F.col("rows") > LONG), True)
    more = _verified(scratch.table(tried.select("a", "b").distinct(), "tried"), texts, shingle, percent)
    links = scratch.table(links.unionByName(more), "links")
    short, longer = judged(links)
    had = tried.select("hub").distinct().withColumn("had", F.lit(True))
    longer = longer.join(had.hint("merge"), "hub", "left").where((F.col("rows") <= LONG) | F.col("had")).drop("had")
    rest = searched(short, longer, False)
    pairs = scratch.table(rest.select("a", "b").distinct(), "pairs")
    found = _verified(pairs, texts, shingle, percent)
    component = connected_components(links.unionByName(found), "a", "b", scratch)
    member = classes.join(component.hint("merge"), classes["rep"] == component["node"], "left").select("set", F.coalesce("component", "rep").alias("component"))
    member = scratch.table(member, "members")
    out = real.select("doc_id", "n", "set").join(member.hint("merge"), "set").select("doc_id", "n", "component").unionByName(
        rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component"))
    )
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - {SHINGLE - 2}, least(len(w), 1) + 1)), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id
  AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM s LEFT JOIN c ON s.doc_id = c.a
"""
