"""13. Merkle manifest of a dataset: a tree for each source, and one over the sources."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidewire.llm.common import LOWER, UPPER, crc32_sql, gapless_rank, lower_ascii, ranges, read, session
from tidewire.storage import Scratch, importable

#: Children of a node.
ARITY = 16
#: The number of the tree over the sources' roots; a source's tree has the source's place from 0.
TOP = -1
#: Fragments that a task merges.
FAN_IN = 16
#: What a leaf commits to.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32

STEPS = "array<struct<left:binary,right:binary>>"
FOREST = "__range long, kind string, tree long, n long, level int, idx long, digest binary, children binary"


def field(c: Column) -> Column:
    """A value spelt so that no two rows spell alike: `-` if null, else its bytes' number and itself."""
    t = c.cast("string")
    return F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))


def leaf(*fields: Column) -> Column:
    """SHA-256 of a row's fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def height(n: int, arity: int = ARITY) -> int:
    """Levels above the leaves of a tree of `n` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // arity), h + 1
    return h


def settle(nodes: Iterable[tuple], sources: int, arity: int = ARITY) -> tuple[list[tuple], list[tuple]]:
    """(runs, open nodes) of a fragment: (tree, n, level, idx, digest) of nodes whose run of siblings
    isn't whole yet. A run is whole when all nodes that the tree's number of leaves gives it are
    there; it then becomes its parent (tree, n, level, idx, digest, children). A source's root is a
    leaf of the tree over the sources.

    Fragments form a monoid: their union, settled. Whatever order and grouping they are merged in,
    the same runs are found, each once, and the root is what is open in the end.
    """
    levels: dict[tuple[int, int], dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for tree, n, level, idx, digest in nodes:
        levels[tree, n][level].append((idx, digest))
    runs, left = [], []
    while levels:
        tree, n = max(levels)  # the tree over the sources comes last
        own, width, level = levels.pop((tree, n)), n, 0
        while own:
            here = sorted(own.pop(level, ()))
            if width == 1:
                for idx, digest in here:
                    if tree == TOP:
                        left.append((tree, n, level, idx, digest))
                    else:
                        levels[TOP, sources][0].append((tree, digest))
                break
            at = 0
            while at < len(here):
                run = here[at][0] // arity
                end = at + 1
                while end < len(here) and here[end][0] // arity == run:
                    end += 1
                if end - at == min(arity, width - run * arity):
                    children = b"".join(d for _, d in here[at:end])
                    digest = sha256(children.hex().encode()).digest()
                    runs.append((tree, n, level + 1, run, digest, children))
                    own[level + 1].append((run, digest))
                else:
                    left += [(tree, n, level, idx, digest) for idx, digest in here[at:end]]
                at = end
            width, level = -(-width // arity), level + 1
    return runs, left


def _forest(place: int, runs: list[tuple], left: list[tuple]) -> dict[str, list]:
    cells = [(place, "run", *r) for r in runs] + [(place, "open", *o, None) for o in left]
    return dict(zip(("__range", "kind", "tree", "n", "level", "idx", "digest", "children"), map(list, zip(*cells)))) if cells else {}


def _table(columns: dict[str, list], schema: pa.Schema) -> pa.Table:
    rows = len(columns.get("kind", ()))
    return pa.table([pa.array(columns.get(f.name, [None] * rows), f.type) for f in schema], schema=schema)


@dataclass
class Manifest:
    """Written tables: `leaves` (id, leaf, forged, tree, n, idx), `runs` (tree, n, level, idx, digest,
    children) of all nodes that have children, and what is known of the whole."""

    leaves: DataFrame
    runs: DataFrame
    sources: int
    longest: int
    root: bytes | None
    scratch: Scratch
    arity: int


def build(rows: DataFrame, arity: int = ARITY) -> Manifest:
    """The trees over `rows` (id, source, leaf, forged); `forged` is carried along.

    Leaves of a source ascend by id, null first, and by leaf. Rows are dealt into ranges of that
    order, so one source, or rows that are all alike, fill many ranges. A task folds a range's
    leaves into the few nodes at its two ends that lack siblings, and rounds of tasks merge FAN_IN
    neighbouring fragments each, until one node is open. A round is written before the next begins.
    """
    spark = session(rows)
    importable(spark)
    scratch = Scratch(spark, "merkle")
    id_type = rows.schema["id"].dataType.simpleString()
    skey = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    keyed = scratch.table(rows.select("id", skey.alias("skey"), "leaf", "forged"), "digests")
    order = [F.col("skey"), F.col("id").asc_nulls_first(), F.col("leaf")]
    dealt = ranges(keyed, order, scratch)
    spans = scratch.table(dealt.groupBy("__range", "skey").agg(F.count("*").alias("rows")), "spans")
    trees = scratch.table(spans.groupBy("skey").agg(F.sum("rows").alias("n"), F.min("__range").alias("__first")), "trees")
    trees = scratch.table(gapless_rank(trees, [], F.col("__first"), [F.col("skey")], "tree").select("skey", "n", "tree"), "numbered")
    told = trees.agg(F.count("*").alias("s"), F.max("n").alias("longest")).first()
    sources, longest = told["s"], told["longest"] or 0
    last = spans.agg(F.max("__range")).first()[0]
    before = W.partitionBy("skey").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("off", F.coalesce(F.sum("rows").over(before), F.lit(0))).join(trees, "skey").select("__range", "skey", "off", "n", "tree")

    def plant(part: pa.Table, span: pa.Table) -> pa.Table:
        part = part.take(pc.sort_indices(part, sort_keys=[("skey", "ascending"), ("id", "ascending"), ("leaf", "ascending")], null_placement="at_start"))
        span = span.sort_by("skey")
        skeys = part["skey"].combine_chunks().dictionary_encode()
        counts = np.bincount(skeys.indices.to_numpy(), minlength=len(skeys.dictionary))
        off, n, tree = (np.repeat(span[c].to_numpy(), counts) for c in ("off", "n", "tree"))
        idx = off + np.arange(len(part)) - np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        place = part["__range"][0].as_py()
        digests = part["leaf"].to_pylist()
        runs, left = settle(zip(tree.tolist(), n.tolist(), [0] * len(part), idx.tolist(), digests), sources, arity)
        schema = pa.schema([("__range", pa.int64()), ("kind", pa.string()), ("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.binary()), ("children", pa.binary()), ("id", part["id"].type), ("forged", pa.binary())])
        own = {"kind": ["leaf"] * len(part), "__range": [place] * len(part), "tree": tree, "n": n, "level": [0] * len(part), "idx": idx, "digest": digests, "id": part["id"].combine_chunks(), "forged": part["forged"].combine_chunks()}
        return pa.concat_tables([_table(own, schema), _table(_forest(place, runs, left), schema)])

    def merge(fragment: pa.Table) -> pa.Table:
        place = fragment["__range"][0].as_py()
        runs, left = settle(zip(*(fragment[c].to_pylist() for c in ("tree", "n", "level", "idx", "digest"))), sources, arity)
        return _table(_forest(place, runs, left), fragment.schema)

    slim = dealt.select("__range", "skey", "id", "leaf", "forged")
    planted = slim.groupBy("__range").cogroup(spans.groupBy("__range")).applyInArrow(plant, f"{FOREST}, id {id_type}, forged binary")
    forest = scratch.table(planted, "forest")
    leaves = forest.where("kind = 'leaf'").select("id", F.col("digest").alias("leaf"), "forged", "tree", "n", "idx")
    names = [c.split()[0] for c in FOREST.split(", ")]
    rounds = [forest.where("kind <> 'leaf'").select(*names)]
    while last:
        last //= FAN_IN
        nearer = rounds[-1].where("kind = 'open'").withColumn("__range", F.expr(f"__range div {FAN_IN}"))
        rounds.append(scratch.table(nearer.groupBy("__range").applyInArrow(merge, FOREST), "round"))
    root = rounds[-1].where("kind = 'open'").select("digest").first()  # one node
    runs = rounds[0]
    for r in rounds[1:]:
        runs = runs.unionByName(r)
    runs = runs.where("kind = 'run'").select("tree", "n", "level", "idx", "digest", "children")
    return Manifest(leaves, runs, sources, longest, root and bytes(root[0]), scratch, arity)


def _children(over: DataFrame, kids: DataFrame, m: Manifest) -> DataFrame:
    """`kids` (tree, n, level, idx, ...) with subroot and path, the siblings to the left and right in
    each run up to the root, from the nodes `over` them (ptree, pidx, children, subroot, path)."""
    tops = F.lit(m.arity).cast("double")
    is_root = F.col("n") <= F.pow(tops, F.col("level"))  # the only node of its level
    ptree = F.when(is_root, TOP).otherwise(F.col("tree"))
    at = F.when(is_root, F.col("tree")).otherwise(F.col("idx"))
    joined = kids.withColumn("ptree", ptree.cast("long")).withColumn("__at", at).withColumn("pidx", F.expr(f"__at div {m.arity}"))
    joined = joined.join(over, ["ptree", "pidx"])
    first = (F.pmod("__at", F.lit(m.arity)) * DIGEST).cast("int")
    step = F.struct(F.substr("children", F.lit(1), first).alias("left"), F.substr("children", first + 1 + DIGEST).alias("right"))
    alone = (F.col("ptree") == TOP) & F.lit(m.sources == 1)  # the only source's root is the root
    path = F.when(alone, F.col("path")).otherwise(F.concat(F.array(step), F.col("path")))
    subroot = F.when(F.col("tree") >= 0, F.coalesce("subroot", F.substr("children", first + 1, F.lit(DIGEST))))
    return joined.withColumn("__path", path).withColumn("__subroot", subroot).drop("ptree", "pidx", "__at", "children", "path", "subroot").withColumnsRenamed({"__path": "path", "__subroot": "subroot"})


def prove(m: Manifest) -> DataFrame:
    """`leaves` with subroot and path; no rows of an empty dataset.

    Paths grow from the root down, a level at a time. Only nodes with children carry one, a
    sixteenth of the leaves, and a leaf meets that of its parent in one join at the end.
    """
    spark, scratch = session(m.leaves), m.scratch
    state = f"ptree long, pidx long, children binary, subroot binary, path {STEPS}"
    above = spark.createDataFrame([(TOP, 0, bytearray(m.root or b""), None, [])], state)

    def parents(level: int, tree: Column, over: DataFrame) -> DataFrame:
        own = m.runs.where(tree & (F.col("level") == level)).drop("digest").withColumnRenamed("children", "own")
        kids = _children(over, own, m) if over is not None else own.withColumns({"subroot": F.lit(None).cast("binary"), "path": F.array().cast(STEPS)})
        return scratch.table(kids.select(F.col("tree").alias("ptree"), F.col("idx").alias("pidx"), F.col("own").alias("children"), "subroot", "path"), "paths")

    for i, level in enumerate(range(height(m.sources, m.arity), 0, -1)):
        above = parents(level, F.col("tree") == TOP, above if i else None)
    found = above
    for level in range(height(m.longest, m.arity), 0, -1):
        found = above.unionByName(parents(level, F.col("tree") >= 0, found))
    return _children(found, m.leaves.withColumn("level", F.lit(0)), m).drop("level")


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its way, as hex."""
    return F.aggregate(path, as_hex(start), lambda node, s: F.sha2(F.concat(as_hex(s["left"]), node, as_hex(s["right"])), 256))


def proof(path: Column) -> Column:
    """All siblings on the way in one text, as hex."""
    return F.array_join(F.transform(path, lambda s: as_hex(F.concat(s["left"], s["right"]))), "")


def verified_rows(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY) -> DataFrame:
    """One row per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. The
    manifest is that of `docs`; folded_root is recomputed from the text `tampered` where that is not
    null, else from the row as it is.

    A null source has a tree of its own, before all others. Rows that repeat a doc_id follow each
    other by leaf; rows that are alike in all fields take any places among themselves, which gives
    the same rows. A null doc_id comes first. One document is its own root; no rows give no rows.
    Only the five fields are read of `docs`, other columns may have any names.
    """
    named = docs.select(*FIELDS, (F.lit(None).cast("string") if tampered is None else tampered).alias("__text"))
    other = leaf(*[F.col(c) for c in FIELDS[:-1]], F.col("__text"))
    forged = F.when(F.col("__text").isNotNull() & ~F.col("__text").eqNullSafe(F.col("text").cast("string")), other)
    rows = named.select(F.col("doc_id").alias("id"), "source", leaf(*[F.col(c) for c in FIELDS]).alias("leaf"), forged.alias("forged"))
    m = build(rows, arity)
    root = F.lit((m.root or b"").hex())
    out = prove(m).select(
        F.col("id").alias("doc_id"), as_hex(F.col("leaf")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), fold(F.coalesce("forged", "leaf"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, with upper case lost in a fifth of the documents."""
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return verified_rows(read(spark, sf_dir, "documents"), F.when(marked, lower_ascii(F.col("text").cast("string"))))


def _sql(levels: int = 8, tops: int = 6) -> str:
    """SQL for sources of 16^levels rows and 16^tops sources at most."""
    spell = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    digest = lambda text: f"sha256({' || '.join([*(spell(c) for c in FIELDS[:-1]), spell(text)])})"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [
        f"base AS MATERIALIZED (SELECT doc_id, leaf, forged, sk, row_number() OVER (PARTITION BY sk ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY sk) AS n FROM (SELECT doc_id, coalesce('=' || source, '-') AS sk, {digest('text')} AS leaf, "
        f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 5 = 0 THEN {digest(lowered)} ELSE {digest('text')} END AS forged FROM documents))",
        "l0 AS MATERIALIZED (SELECT sk, i, n, leaf AS d FROM base)",
        "w0 AS (SELECT doc_id, leaf, sk, i, n, forged AS f, '' AS p FROM base)",
    ]

    def climb(node: str, walk: str, step: int, keys: str) -> None:
        parts.append(f"r{step} AS MATERIALIZED (SELECT sk, i // {ARITY} AS i, n, list(d ORDER BY i) AS ds FROM {node} WHERE n > 1 GROUP BY sk, i // {ARITY}, n)")
        parts.append(f"l{step + 1} AS MATERIALIZED (SELECT sk, i, (n + {ARITY - 1}) // {ARITY} AS n, sha256(array_to_string(ds, '')) AS d FROM r{step} UNION ALL SELECT sk, i, n, d FROM {node} WHERE n = 1)")
        left, right = f"array_to_string(ds[1:w.i % {ARITY}], '')", f"array_to_string(ds[w.i % {ARITY} + 2:], '')"
        parts.append(
            f"w{step + 1} AS (SELECT doc_id, leaf, {keys} w.sk, w.i // {ARITY} AS i, (w.n + {ARITY - 1}) // {ARITY} AS n, CASE WHEN ds IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f, "
            f"CASE WHEN ds IS NULL THEN p ELSE p || {left} || {right} END AS p FROM {walk} w LEFT JOIN r{step} r ON r.sk = w.sk AND r.i = w.i // {ARITY})"
        )

    for k in range(levels):
        climb(f"l{k}", f"w{k}", k, "")
    parts.append(f"l{levels + 1} AS MATERIALIZED (SELECT '' AS sk, row_number() OVER (ORDER BY sk) - 1 AS i, count(*) OVER () AS n, d, sk AS source FROM l{levels})")
    parts.append(f"w{levels + 1} AS (SELECT doc_id, leaf, d AS subroot, l.sk, l.i, l.n, f, p FROM w{levels} w JOIN l{levels + 1} l ON l.source = w.sk)")
    for k in range(levels + 1, levels + 1 + tops):
        climb(f"l{k}", f"w{k}", k, "subroot,")
    end = levels + 1 + tops
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = d AS verified FROM w{end} JOIN l{end} ON true"


SQL = _sql()
