"""3. Mixing sources to target weights by Sainte-Laguë apportionment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidewire.llm.common import WORD, read, session, text_of, word_count
from tidewire.storage import Scratch, cell_rows

#: Words in a block.
BLOCK = 16
#: Times that a source, and so any of its documents, may be taken at most.
EPOCHS = 3
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def sainte_lague(df: DataFrame, group: list[str], votes: str, seats: Column, order: list[Column], out: str) -> DataFrame:
    """`df` with `out`: its share of the group's seats by the highest quotients votes / (2k - 1).

    The divisor that fills all seats lies between total / (seats + n/2) and total / (seats - n/2)
    for n parties, so each party surely wins the quotients up to the second bound and none beyond
    the first. Only those between are made and ranked: about two for each party, whatever the
    number of seats. Ties go by `order`. Parties without votes win nothing.
    """
    g = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    df = (
        df.withColumn("__seats", seats.cast("long"))
        .withColumn("__v", F.col(votes).cast("double"))
        .withColumn("__total", F.sum("__v").over(g))
        .withColumn("__n", F.sum(F.when(F.col("__v") > 0, 1).otherwise(0)).over(g) / 2)
    )
    sure = F.floor(F.col("__v") * (F.col("__seats") - F.col("__n")) / F.col("__total") + 0.5) - 1
    most = F.floor(F.col("__v") * (F.col("__seats") + F.col("__n")) / F.col("__total") + 0.5) + 1
    some = (F.col("__v") > 0) & (F.col("__seats") > 0)
    df = df.withColumn("__base", F.when(some, F.greatest(sure, F.lit(0))).otherwise(0).cast("long"))
    df = df.withColumn("__left", F.col("__seats") - F.sum("__base").over(g))
    ks = F.when(some, F.sequence(F.col("__base") + 1, F.greatest(most.cast("long"), F.col("__base") + 1))).otherwise(F.array().cast("array<long>"))
    own = [c for c in df.columns if not c.startswith("__")]
    ranked = df.select(*own, "__base", "__left", F.explode_outer(ks).alias("__k"), "__v").withColumn(
        "__q", F.col("__v") / (2 * F.col("__k") - 1)
    )
    w = (W.partitionBy(*group) if group else W.partitionBy(F.lit(0))).orderBy(F.col("__q").desc_nulls_last(), *order, F.col("__k"))
    ranked = ranked.withColumn("__won", (F.row_number().over(w) <= F.col("__left")) & F.col("__k").isNotNull())
    return ranked.groupBy(*own, "__base").agg(F.sum(F.col("__won").cast("long")).alias("__more")).select(
        *own, (F.col("__base") + F.col("__more")).alias(out)
    )


def targets(sources: DataFrame, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """sources (source, source_size) with place, target: weights by code point order with null last
    share all sizes; a target stops at epochs * source_size and the excess goes to the others by
    weight. The level at which the rest share is found by one pass in the order of cap / weight."""
    one = W.partitionBy(F.lit(0))
    s = sources.withColumn("place", F.row_number().over(one.orderBy(F.col("source").isNull(), "source")) - 1)
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * epochs)
    before = one.orderBy(F.col("cap") / F.col("w"), "place").rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumn("num", F.sum("source_size").over(one) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    s = s.withColumn("den", F.sum("w").over(one) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    free = F.col("cap") * F.col("den") > F.col("num") * F.col("w")
    level = F.min(F.when(free, F.struct(F.col("cap") / F.col("w"), "place", "num", "den"))).over(one)
    s = s.withColumn("level", level)
    shared = (F.col("w") * F.col("level.num")) / F.col("level.den")
    return s.select("source", "source_size", "place", F.when(F.coalesce(free, F.lit(False)), shared).otherwise(F.col("cap")).cast("double").alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, block: int = BLOCK, seed: str = SEED) -> DataFrame:
    """key, source, size, source_size, target, taken: the words that the mix takes of each document.

    The mix is as large as `docs`, in blocks of `block` words. Sainte-Laguë apportionment gives
    each source a whole number of blocks for its target, and then each of its shards (documents
    dealt by a hash) a whole number of those. A shard's words lie on a line in the order of a
    seeded hash of the document, cut into blocks and repeated up to `epochs` times; the shard's
    quota takes the first blocks of that line. A document's `taken` is what those blocks cover of
    it, so it is at most epochs * size, and a rerun takes the same words.

    No row of a source is sorted with more than a shard of it; the tables of sources and of shards
    hold one row each. Only DataFrame functions are used. Null and empty texts have size 0 and
    nothing is taken of them; a null source is a source, the last; rows that repeat a key are each
    a document; no rows give no rows. Columns other than the three named are not read.
    """
    scratch = Scratch(session(docs), "mix")
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    base = scratch.table(
        docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(text_of(text)).alias("size"), mark.alias("mark"))
        .withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))),
        "sizes",
    )
    n = base.count()
    shards = max(1, n // cell_rows(n))
    base = base.withColumn("shard", F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") % shards)
    cells = scratch.table(base.groupBy("skey", "source", "shard").agg(F.sum("size").alias("cell_size")), "shards")
    sources = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, epochs)
    blocks = F.ceil(F.sum("source_size").over(W.partitionBy(F.lit(0))) / block)
    sources = scratch.table(sainte_lague(sources, [], "target", blocks, [F.col("place")], "seats"), "sources")
    sources = sources.withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    quotas = sainte_lague(cells.join(sources, "skey"), ["skey"], "cell_size", F.col("seats"), [F.col("shard")], "quota")
    quotas = scratch.table(quotas.select("skey", "shard", "cell_size", "source_size", "target", "quota"), "quotas")
    at = F.coalesce(F.sum("size").over(W.partitionBy("skey", "shard").orderBy("mark", "key").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    line = base.withColumn("at", at).join(quotas, ["skey", "shard"])
    length = F.least(F.col("quota") * block, F.col("cell_size") * epochs)
    whole = F.floor(length / F.col("cell_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), length - whole * F.col("cell_size") - F.col("at")))
    taken = F.when(F.col("cell_size") > 0, whole * F.col("size") + part).otherwise(0)
    return line.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", taken.cast("long").alias("taken"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


SQL = f"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS mark FROM documents),
n AS (SELECT greatest(1, count(*) // greatest(256, floor(sqrt(count(*)))::BIGINT)) AS shards FROM base),
docs AS (SELECT base.*, ('0x' || substr(mark, 1, 8))::BIGINT % shards AS shard FROM base, n),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM docs GROUP BY source),
caps AS (SELECT *, (place % 3 + 1)::BIGINT AS w, source_size * {EPOCHS} AS cap FROM src),
line AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS num, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS den
  FROM caps WINDOW b AS (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT num AS lnum, den AS lden FROM line WHERE cap * den > num * w ORDER BY cap / w, place LIMIT 1),
tgt AS (SELECT source, source_size, place, (CASE WHEN cap * den > num * w THEN (w * lnum)::DOUBLE / lden::DOUBLE ELSE cap END)::DOUBLE AS target FROM line LEFT JOIN lvl ON true),
tot AS (SELECT ceil(sum(source_size) / {BLOCK})::BIGINT AS seats FROM src),
q1 AS (SELECT source, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, place, k) AS r
  FROM (SELECT tgt.*, unnest(generate_series(1, (target / {BLOCK})::BIGINT + 60)) AS k FROM tgt WHERE target > 0)),
s1 AS (SELECT source, count(*) AS seats FROM q1, tot WHERE r <= tot.seats GROUP BY source),
cell AS (SELECT source, shard, sum(size)::BIGINT AS cell_size FROM docs GROUP BY ALL),
q2 AS (SELECT source, shard, seats, row_number() OVER (PARTITION BY source ORDER BY v / (2 * k - 1) DESC, shard, k) AS r
  FROM (SELECT cell.source, shard, seats, cell_size::DOUBLE AS v, unnest(generate_series(1, seats)) AS k
        FROM cell JOIN s1 ON cell.source IS NOT DISTINCT FROM s1.source WHERE cell_size > 0)),
s2 AS (SELECT source, shard, count(*) AS quota FROM q2 WHERE r <= seats GROUP BY ALL),
pos AS (SELECT docs.*, cell_size, coalesce(quota, 0) AS quota, coalesce(sum(size) OVER (PARTITION BY docs.source, docs.shard ORDER BY mark, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs JOIN cell ON docs.source IS NOT DISTINCT FROM cell.source AND docs.shard = cell.shard
  LEFT JOIN s2 ON docs.source IS NOT DISTINCT FROM s2.source AND docs.shard = s2.shard),
len AS (SELECT *, least(quota * {BLOCK}, cell_size * {EPOCHS}) AS l FROM pos)
SELECT doc_id, len.source, size::BIGINT AS size, source_size, target,
  (CASE WHEN cell_size > 0 THEN (l // cell_size) * size + greatest(0, least(size, l % cell_size - start)) ELSE 0 END)::BIGINT AS taken
FROM len JOIN tgt ON len.source IS NOT DISTINCT FROM tgt.source
"""
