"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tidewire.storage import Scratch

MAX_ROUNDS = 60


def _observed(edges: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, tuple[int, int]]:
    """The edges, written, and what tells them from others: their number and a sum of hashes, which
    are taken while they are written."""
    seen = Observation()
    table = scratch.table(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), name)
    return table, (seen.get["n"], int(seen.get["h"] or 0))


def with_least(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """`edges` (u, v) with `m`, the least v of each u. The minima, combined before they are shuffled,
    are written before they are joined: a join of two scans is one that Spark splits where a node has
    very many edges, while an aggregate's own partitions could not be."""
    low = scratch.table(edges.groupBy("u").agg(F.min("v").alias("m")), "low")
    return edges.join(low, "u")


def connected_components(edges: DataFrame, src: str, dst: str, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of an undirected edge table; component is the smallest node
    that can be reached. Null ends, loops and repeated edges are ignored; no edges give no rows.

    Alternates the large-star and small-star steps (Kiveris et al. 2014) until the edge set stays
    as it is. A step is a map-side combined minimum and a join on the same key, which Spark splits
    where a node has a very large neighbourhood. Every round is written to the shared folder, which
    cuts the lineage, and replaces the last.
    """
    u, v = F.col(src), F.col(dst)
    e = edges.where(u.isNotNull() & v.isNotNull() & (u != v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")
    )
    cur, state = _observed(e.distinct(), scratch, "edges")
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the least of a node and its neighbours; a neighbour that is larger than the node gets it
        large = with_least(both, scratch).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        mid = scratch.table(large, "large")
        joined = with_least(mid, scratch)
        small = joined.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        new, after = _observed(small.distinct(), scratch, "small")
        scratch.drop(mid)
        scratch.drop(cur)
        cur, before, state = new, state, after
        if state == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def update_components(labels: DataFrame, before: DataFrame, now: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for the edges `now` (u, v), given `labels` (node, component) of the edges
    `before`: what `connected_components` gives for all of them, at the cost of what has changed.

    Components that have lost an edge, or a node with its edges, are built again from the edges that
    they have kept. All others stand. Added edges are contracted to the labels of their ends, so only
    one node for each component takes part in joining them, and a component's smallest node is the
    smallest of the labels that meet. Null ends, loops and repeated edges are ignored, and an edge is
    the same whichever end comes first.
    """
    u, v = F.col("u"), F.col("v")
    tidy = lambda e: e.where(u.isNotNull() & v.isNotNull() & (u != v)).select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct()
    before, now = scratch.table(tidy(before), "before"), scratch.table(tidy(now), "now")
    removed, added = before.join(now, ["u", "v"], "left_anti"), scratch.table(now.join(before, ["u", "v"], "left_anti"), "added")
    touched = scratch.table(removed.join(labels, removed["u"] == labels["node"]).select("component").distinct(), "touched")
    again = labels.join(touched, "component", "left_semi").select(F.col("node").alias("u"))
    kept = now.join(added, ["u", "v"], "left_anti").join(again, "u", "left_semi")
    stands = labels.join(touched, "component", "left_anti").select("node", "component")
    base = scratch.table(stands.unionByName(connected_components(kept, "u", "v", scratch)), "base")
    of = lambda side: base.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
    met = added.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    joined = connected_components(met, "u", "v", scratch).select(F.col("node").alias("component"), F.col("component").alias("__to"))
    ends = added.select(F.col("u").alias("node")).unionByName(added.select(F.col("v").alias("node"))).distinct().join(base, "node", "left_anti")
    told = base.unionByName(ends.withColumn("component", F.col("node")))
    return scratch.table(told.join(joined, "component", "left").select("node", F.coalesce("__to", "component").alias("component")), "components")
