"""12. Importance resampling towards a target's distribution of hashed n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.llm.common import LOWER, SLICE, UPPER, by_bytes, crc32_sql, gapless_rank, ranges, read, session, trim
from tidewire.storage import Scratch, importable

#: A word: a run of digits, letters a-z and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Most words of a feature, and the buckets that features are hashed to.
GRAM, BUCKETS = 1, 10_000
#: Documents of fewer words are never drawn; of the others this part in a hundred is.
LEAST_WORDS, PERCENT = 20, 10
SEED = 2024
#: Memory of a task's database, which gets texts of about SLICE bytes at a time.
MEMORY = "192MB"
#: Scores that share a step of the histogram which bounds what is sorted.
STEP = 16


def _crc(grams: pa.ChunkedArray) -> pa.Array:
    return pa.array(list(map(zlib.crc32, grams.cast(pa.binary()).to_pylist())), pa.int64())


def _counting(gram: int, buckets: int) -> str:
    """SQL over texts (place, text): place, words, and the different buckets with their features."""
    gram_of = "SELECT place, word AS gram FROM word"
    if gram > 1:
        runs = [f"concat_ws(' ', word{''.join(f', lead(word, {j}) OVER run' for j in range(1, k))})" for k in range(2, gram + 1)]
        whole = [f"CASE WHEN lead(word, {k}) OVER run IS NOT NULL THEN {run} END" for k, run in enumerate(runs, 1)]
        listed = f"SELECT place, [{', '.join(['word', *whole])}] AS grams FROM word WINDOW run AS (PARTITION BY place ORDER BY spot)"
        gram_of = f"SELECT place, gram FROM (SELECT place, unnest(grams) AS gram FROM ({listed})) WHERE gram IS NOT NULL"
    spot = ", unnest(range(len(words))) AS spot" if gram > 1 else ""
    return (
        f"WITH split AS (SELECT place, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM texts), "
        f"word AS (SELECT place, unnest(words) AS word{spot} FROM split), "
        f"gram AS MATERIALIZED (SELECT place, gram, count(*) AS n FROM ({gram_of}) GROUP BY ALL), "
        f"code AS (SELECT gram, crc(gram) % {buckets} AS bucket FROM (SELECT DISTINCT gram FROM gram)), "
        "hashed AS (SELECT place, bucket, sum(n)::BIGINT AS n FROM gram JOIN code USING (gram) GROUP BY ALL), "
        "held AS (SELECT place, list(bucket::INT ORDER BY bucket) AS buckets, list(n ORDER BY bucket) AS counts, sum(n)::BIGINT AS features FROM hashed GROUP BY place) "
        "SELECT coalesce(len(words), 0)::BIGINT AS n_words, coalesce(features, 0)::BIGINT AS n_features, coalesce(buckets, []::INT[]) AS buckets, coalesce(counts, []::BIGINT[]) AS counts "
        "FROM split LEFT JOIN held USING (place) ORDER BY place"
    )


def bucket_counts(docs: DataFrame, text: str = "text", gram: int = GRAM, buckets: int = BUCKETS) -> DataFrame:
    """The other columns of `docs` with n_words, n_features, buckets and counts (arrays): a database
    in each task splits texts into words, makes runs of them with window functions and hashes the
    runs. Null text has no words. It never spills: a task's texts pass in slices."""
    importable(session(docs))
    kept = [c for c in docs.columns if c != text]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept] + ["n_words long", "n_features long", "buckets array<int>", "counts array<long>"])
    query = _counting(gram, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(config={"threads": "1", "memory_limit": MEMORY, "temp_directory": ""}) as base:
            base.create_function("crc", _crc, ["VARCHAR"], "BIGINT", type="arrow")
            for batch in batches:
                at = 0
                for texts in by_bytes(batch.column(text), SLICE):
                    base.register("texts", pa.table({"place": range(len(texts)), "text": texts}))
                    made = base.sql(query).to_arrow_table()
                    base.unregister("texts")
                    own = batch.slice(at, len(texts))
                    at += len(texts)
                    yield from pa.table([*(own.column(c) for c in kept), *made.columns], [*kept, *made.column_names]).combine_chunks().to_batches()
        trim()

    return docs.select(*kept, F.col(text).cast("string").alias(text)).mapInArrow(count, schema)


def merged(counts: DataFrame, name: str) -> DataFrame:
    """(bucket, `name`): the features of all rows in each bucket."""
    each = counts.select(F.explode(F.arrays_zip("buckets", "counts")).alias("b"))
    return each.groupBy(F.col("b.buckets").alias("bucket")).agg(F.sum("b.counts").alias(name))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of all buckets: a thousand times the log of how much likelier the bucket is in
    the target than in the raw data, each with one more feature than it has."""
    both = session(raw).range(buckets).select(F.col("id").cast("int").alias("bucket")).join(raw, "bucket", "left").join(target, "bucket", "left").na.fill(0, ["s", "t"])
    total = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    of = lambda c: F.col(c).cast("double") + 1
    odds = of("t") * F.lit(float(total["s"] + buckets)) / (of("s") * F.lit(float(total["t"] + buckets)))
    return both.select("bucket", F.floor(F.lit(1000) * F.ln(odds)).alias("gain"))


def noise(key: Column, seed: int = SEED) -> Column:
    """A thousandth of a draw from the Gumbel distribution that hangs on nothing but key and seed; a
    null key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", *, gram: int = GRAM, buckets: int = BUCKETS, least: int = LEAST_WORDS,
    percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs`: key, n_features, weight, score, rank.

    A row's weight is the mean of its features' gains towards `target`, rounded down; adding Gumbel
    noise and taking the highest scores draws without replacement in proportion to the weights. Of
    the rows of at least `least` words, `percent` in a hundred are drawn, ties going to smaller keys
    and null keys last; `rank` is null for others. Bucket counts are written once, in each row's
    order, and all else is read from them: they are summed for the corpus, and joined with the gains,
    of which there are `buckets`.

    Null and empty texts have no features and weight 0. Rows that repeat a key are rows of their own
    that share their noise. An empty target leaves the raw data's log frequencies, negated; no rows
    give no rows. Other columns are not read.
    """
    spark = session(docs)
    scratch = Scratch(spark, "resampling")
    named = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    counts = scratch.table(bucket_counts(named, gram=gram, buckets=buckets), "counts")
    aim = scratch.table(bucket_counts(target.select(F.col(text).alias("text")), gram=gram, buckets=buckets), "target")
    gain = scratch.table(gains(scratch.table(merged(counts, "s"), "s"), scratch.table(merged(aim, "t"), "t"), buckets), "gains")
    own = ["row", "doc_id", "n_words", "n_features"]
    each = counts.select(*own, F.explode_outer(F.arrays_zip("buckets", "counts")).alias("b")).select(*own, F.col("b.buckets").alias("bucket"), F.col("b.counts").alias("n"))
    total = F.coalesce(F.sum(F.col("n") * F.col("gain")), F.lit(0))
    weighed = each.join(F.broadcast(gain), "bucket", "left").groupBy(*own).agg(F.when(F.col("n_features") > 0, F.floor(total / F.col("n_features"))).otherwise(0).alias("weight"))
    scored = scratch.table(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("step", F.floor(F.col("score") / STEP)), "scored")
    fit = scored.where(F.col("n_words") >= least)
    steps = sorted(fit.groupBy("step").count().collect(), reverse=True)  # scores span some 2^17 at most
    draws = sum(r["count"] for r in steps) * percent // 100
    reached, lowest = 0, None
    for r in steps:
        if reached < draws:
            reached, lowest = reached + r["count"], r["step"]
    high = F.col("n_words") >= F.lit(least)
    high = high & (F.col("step") >= lowest) if lowest is not None else F.lit(False)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    listed = gapless_rank(ranges(scratch.table(scored.where(high), "high"), order, scratch), [], F.col("__range"), order, "place")
    rank = F.when(F.col("place") < draws, F.col("place") + 1)
    out = listed.withColumn("rank", rank).unionByName(scored.where(~high).withColumn("rank", F.lit(None).cast("long")), allowMissingColumns=True)
    return out.select(F.col("doc_id").alias(key), "n_features", F.col("weight").cast("long"), F.col("score").cast("long"), "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _sql() -> str:
    words = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}')"
    gain = f"floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0) + {BUCKETS})::DOUBLE)))"
    return (
        f"WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, coalesce({words}, []) AS words FROM documents), "
        f"w AS MATERIALIZED (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(words) AS word FROM d) GROUP BY ALL), "
        f"b AS MATERIALIZED (SELECT unnest({words}) AS word FROM benchmark), "
        f"code AS MATERIALIZED (SELECT word, {crc32_sql('word')} % {BUCKETS} AS bucket FROM (SELECT word FROM w UNION SELECT word FROM b)), "
        "s AS (SELECT bucket, sum(n) AS s FROM w JOIN code USING (word) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM b JOIN code USING (word) GROUP BY bucket), "
        f"gain AS MATERIALIZED (SELECT bucket, {gain} AS gain FROM s FULL JOIN t USING (bucket)), "
        "mean AS (SELECT r, floor(sum(n * gain) / sum(n)) AS weight FROM w JOIN code USING (word) JOIN gain USING (bucket) GROUP BY r), "
        f"x AS MATERIALIZED (SELECT doc_id, len(words) AS n_features, coalesce(weight, 0)::BIGINT AS weight, ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN mean USING (r)), "
        "y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM x), "
        f"z AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= {LEAST_WORDS}) AS fit FROM y) "
        f"SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND place <= {PERCENT} * fit // 100 THEN place END AS rank FROM z"
    )


SQL = _sql()
