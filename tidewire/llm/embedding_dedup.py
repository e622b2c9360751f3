"""2. Embedding near-dedup by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import ArrayType, FloatType

from tidewire.llm.common import read, session
from tidewire.operators.graph import connected_components
from tidewire.storage import Scratch, importable

THRESHOLD = 0.95
#: Leading principal dimensions of the grid, and of the boxes that prune.
GRID = 6
BOX = 8
#: Vectors in a leaf of the sequence, leaves in an interval of the next level, and vectors in the
#: blocks that a pair of leaves is cut into.
LEAF = 2048
FAN = 16
BLOCK = 256
#: Leaves that a task holds while others pass by, and bytes that they may take.
HELD, HELD_BYTES = 16, 1 << 26
#: Vectors that the principal dimensions are fitted on, at most. They order and prune; which
#: vectors link does not depend on them.
FIT = 8192


def usable(c: Column) -> Column:
    """No null, no null or non-finite component, and not zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(c.isNotNull() & ~F.exists(c, bad) & F.exists(c, lambda x: x != 0), F.lit(False))


def unit(raw: list[list[float]] | np.ndarray, dim: int) -> np.ndarray:
    """Rows scaled to length 1 in double precision; shorter vectors are filled up with zeros."""
    out = np.zeros((len(raw), dim))
    for i, v in enumerate(raw):
        out[i, : len(v)] = v
    out /= np.maximum(np.abs(out).max(axis=1, keepdims=True), np.finfo(float).tiny)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def axes(sample: np.ndarray) -> np.ndarray:
    """Principal dimensions as columns, the leading one first."""
    if not len(sample):
        return np.eye(sample.shape[1])
    _, v = np.linalg.eigh(np.cov(sample.T).reshape(sample.shape[1], -1) if len(sample) > 1 else np.eye(sample.shape[1]))
    return v[:, ::-1].copy()


def apart(lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> float:
    """Squared distance of two boxes."""
    return float((np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a)) ** 2).sum())


def forest(linked: np.ndarray) -> Iterator[tuple[bool, int, int]]:
    """For a boolean matrix of links between rows and columns: (is a column, its number, row that
    stands for its component), once for each row and column that has a link, so that components
    need no list of all links."""
    rows, cols = linked.any(axis=1), np.zeros(linked.shape[1], bool)
    while rows.any():
        seed = int(np.argmax(rows))
        front = np.zeros(len(rows), bool)
        front[seed] = True
        rows[seed] = False
        while front.any():
            new = linked[front].any(axis=0) & ~cols
            cols |= new
            yield from ((True, int(c), seed) for c in np.flatnonzero(new))
            front = linked[:, new].any(axis=1) & rows
            rows &= ~front
            yield from ((False, int(r), seed) for r in np.flatnonzero(front))


def join_leaves(a: dict, b: dict, same: bool, basis: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of two leaves: how many vectors each one of a and of b links with (counting copies),
    and edges that join the components. Blocks of the leaves whose boxes are further apart than the
    threshold allows are skipped."""
    x, y = a["v"], b["v"]
    px, py = x @ basis, y @ basis
    far = 2 - 2 * threshold + 1e-9
    na, nb, edges = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64), []
    for i in range(0, len(x), BLOCK):
        si = slice(i, i + BLOCK)
        lo, hi = px[si].min(axis=0), px[si].max(axis=0)
        for j in range(i if same else 0, len(y), BLOCK):
            sj = slice(j, j + BLOCK)
            if apart(lo, hi, py[sj].min(axis=0), py[sj].max(axis=0)) > far:
                continue
            linked = x[si] @ y[sj].T >= threshold
            if same and i == j:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            na[si] += linked @ b["m"][sj]
            if not (same and i == j):
                nb[sj] += linked.T @ a["m"][si]
            ids, other = a["id"][si], b["id"][sj]
            edges += [(int(other[k] if col else ids[k]), int(ids[seed])) for col, k, seed in forest(linked)]
    return na, nb, edges


def _dealt(pairs: DataFrame, leaves: DataFrame, held: int, scratch: Scratch) -> DataFrame:
    """The leaves of the pairs (a, b), once for each cell (group, part) that they take part in, in order.

    A group of `held` leaves is held (`probing` 0) by the tasks of its parts, and each leaf that is
    paired with some of them (`with`) passes by once, in one part. So a leaf is shuffled once for a
    group, not once for a pair.
    """
    wanted = pairs.groupBy(F.floor(F.col("a") / held).alias("group"), F.col("b").alias("leaf")).agg(F.collect_set("a").alias("with"))
    wanted = scratch.table(wanted, "wanted")
    groups = scratch.table(wanted.groupBy("group").agg(F.ceil(F.count("*") / (2 * held)).cast("int").alias("parts")), "cells")
    body = leaves.select("leaf", "id", "m", "v")
    own = body.withColumn("group", F.floor(F.col("leaf") / held)).join(groups, "group").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = own.withColumn("probing", F.lit(0)).withColumn("with", F.lit(None).cast("array<long>"))
    other = body.join(wanted, "leaf").join(groups, "group").withColumn("part", F.pmod(F.xxhash64("leaf"), "parts").cast("int")).withColumn("probing", F.lit(1))
    columns = ["group", "part", "probing", "leaf", "with", "id", "m", "v"]
    cells = groups.agg(F.sum("parts")).first()[0] or 1
    both = own.select(*columns).unionByName(other.select(*columns))
    return both.repartition(int(cells), "group", "part").sortWithinPartitions("group", "part", "probing")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, leaf: int = LEAF) -> DataFrame:
    """key, n_links, component_id, kept for each row of `vectors`.

    Equal vectors are first reduced to one with a count. Their unit vectors, in double precision,
    are cut by a grid with cells as wide as the Euclidean distance that the cosine stands for, over
    the leading principal dimensions, and sorted by cell. The sorted sequence is cut into leaves;
    intervals of leaves, and intervals of those, form a tree. From the root down, pairs of
    intervals are joined with their children while their boxes are close enough to hold a link;
    the pairs are a DataFrame at each level. Pairs of leaves are compared by blocks. They return a
    count for each vector and a spanning forest, never the list of links, so near copies of a
    vector cost no output. Components come from the distributed graph operator.

    Vectors that are null, zero or hold a null or non-finite component link with nothing and are
    their own component. Vectors of different lengths are compared as if filled up with zeros. Rows
    that repeat count as other vectors, also where they repeat a key. A null key is a row like any
    other, but cannot be reached.
    No rows give no rows. Other columns are not read.
    """
    spark, scratch = session(vectors), Scratch(session(vectors), "ego")
    importable(spark)
    raw = np.float32 if vectors.schema[vector].dataType == ArrayType(FloatType()) else np.float64  # as they are shuffled
    v = F.col(vector).cast("array<double>")
    rows = scratch.table(vectors.select(F.col(key).cast("long").alias("id"), F.when(usable(v), v).alias("v")), "rows")
    good = rows.where("v is not null and id is not null")
    reps = scratch.table(good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("m")), "distinct")
    shape = reps.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    n, dim = shape["n"], shape["d"] or 1
    sample = reps.orderBy(F.xxhash64("id"), "id").limit(FIT).select("v").collect()
    basis = axes(unit([r["v"] for r in sample], dim))
    grid, box = min(GRID, dim), min(BOX, dim)
    side = float(np.sqrt(2 - 2 * threshold))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            p = unit(t["v"].to_pylist(), dim) @ basis[:, :grid]
            c = np.floor(p / side).astype(np.int32)
            for k in range(grid):
                t = t.append_column(f"c{k}", pa.array(c[:, k]))
            yield from t.append_column("p", pa.array(p[:, -1])).to_batches()

    kinds = "v array<double>, id long, m long"
    names = [f"c{k}" for k in range(grid)]
    cut = reps.select("v", "id", "m").mapInArrow(cells, kinds + "".join(f", {c} int" for c in names) + ", p double")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            t = pa.Table.from_batches([b]).append_column("part", pa.array(np.full(b.num_rows, part, np.int32)))
            yield from t.append_column("at", pa.array(np.arange(at, at + b.num_rows))).to_batches()
            at += b.num_rows

    ordered = cut.orderBy(*names, "p", "id").select("v", "id", "m")
    ordered = scratch.table(ordered.mapInArrow(number, kinds + ", part int, at long"), "sequence")
    offsets = ordered.groupBy("part").agg(F.count("*").alias("c"))
    before = W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = offsets.select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("off"))  # one row a partition
    numbered = ordered.join(F.broadcast(offsets), "part").withColumn("node", F.col("off") + F.col("at")).withColumn("leaf", F.floor(F.col("node") / leaf).cast("long"))

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        values = np.zeros((t.num_rows, dim), raw)
        for i, one in enumerate(t["v"].to_pylist()):
            values[i, : len(one)] = one
        p = unit(values, dim) @ basis[:, :box]
        cols = {"leaf": t["leaf"][:1], "id": pa.array([t["node"].to_pylist()], pa.list_(pa.int64())), "m": pa.array([t["m"].to_pylist()], pa.list_(pa.int64()))}
        cols["v"] = pa.array([values.tobytes()])
        cols |= {f"lo{k}": pa.array([p[:, k].min()]) for k in range(box)} | {f"hi{k}": pa.array([p[:, k].max()]) for k in range(box)}
        return pa.table(cols)

    sides = [f"lo{k}" for k in range(box)] + [f"hi{k}" for k in range(box)]
    leaves = scratch.table(
        numbered.select("leaf", "node", "m", "v").groupBy("leaf").applyInArrow(
            build, "leaf long, id array<long>, m array<long>, v binary" + "".join(f", {s} double" for s in sides)
        ),
        "leaves",
    )
    levels, count = [leaves.select(F.col("leaf").alias("i"), *sides)], -(-n // leaf)
    while count > 1:
        up = levels[-1].groupBy(F.floor(F.col("i") / FAN).cast("long").alias("i"))
        levels.append(scratch.table(up.agg(*[(F.min if s[0] == "l" else F.max)(s).alias(s) for s in sides]), "level"))
        count = -(-count // FAN)
    pairs = levels[-1].select(F.col("i").alias("a"), F.col("i").alias("b"))
    near = sum(
        (F.pow(F.greatest(F.lit(0.0), F.col(f"x.lo{k}") - F.col(f"y.hi{k}"), F.col(f"y.lo{k}") - F.col(f"x.hi{k}")), 2) for k in range(box)), F.lit(0.0)
    ) <= 2 - 2 * threshold + 1e-9
    for level in reversed(levels[:-1]):
        up = level.withColumn("up", F.floor(F.col("i") / FAN).cast("long"))
        down = pairs.join(up.alias("x"), F.col("a") == F.col("x.up")).join(up.alias("y"), F.col("b") == F.col("y.up"))
        down = down.where((F.col("x.i") <= F.col("y.i")) & near)
        pairs = scratch.table(down.select(F.col("x.i").alias("a"), F.col("y.i").alias("b")), "pairs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}
        for b in batches:
            for r in range(b.num_rows):
                get = lambda c: b.column(b.schema.get_field_index(c))[r].as_py()  # noqa: B023, E731
                side = lambda: {"id": np.array(get("id")), "m": np.array(get("m")), "v": unit(np.frombuffer(get("v"), raw).reshape(-1, dim), dim)}  # noqa: B023, E731
                if key != (get("group"), get("part")):
                    key, held = (get("group"), get("part")), {}
                if not get("probing"):
                    held[get("leaf")] = side()
                    continue
                own = None
                for a in get("with"):
                    same = a == get("leaf")
                    own = own if same or own else side()
                    x, y = held[a], held[a] if same else own
                    na, nb, edges = join_leaves(x, y, same, basis, threshold)
                    out = [(int(i), None, int(c)) for i, c in zip(x["id"], na) if c] + [(int(i), None, int(c)) for i, c in zip(y["id"], nb) if c]
                    out += [(u, w, 0) for u, w in edges]
                    cols = list(zip(*out)) if out else [()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["u", "w", "n"])

    found = scratch.table(_dealt(pairs, leaves, max(1, min(HELD, -(-n // (8 * leaf)), HELD_BYTES // (8 * leaf * dim))), scratch).mapInArrow(compare, "u long, w long, n long"), "links")
    counts = found.where("n > 0").groupBy("u").agg(F.sum("n").alias("links"))
    component = connected_components(found.where("w is not null"), "u", "w", scratch)
    known = numbered.select("v", "id", "m", "node").join(counts.withColumnRenamed("u", "node"), "node", "left").join(component, "node", "left")
    known = known.select("v", "id", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    known = scratch.table(known, "known")
    known = known.join(known.groupBy("component").agg(F.min("id").alias("component_id")), "component").select("v", "n_links", "component_id")
    out = good.join(known, "v").select("id", "n_links", "component_id").unionByName(
        rows.where("v is null or id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    )
    return out.select(F.col("id").alias(key), F.col("n_links").cast("long"), F.col("component_id").cast("long"), F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


_USABLE = "coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false)"
SQL = f"""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE {_USABLE}),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""
