"""Mixing sources to target weights by hash-threshold histograms (DataFrame operations only).

Each document has a hash that decides its place in its source. A source whose target is
k whole times its size and a rest takes every document k times, and once more those
whose hash is at most a threshold: thresholds of growing budgets are nested, so a
document that a smaller mix takes stays in every larger one.

Nothing is sorted to find a threshold. A histogram sums sizes by source and leading bits
of the hash; its running sum shows the one bucket in which the budget runs out. Only the
documents of that bucket are summed again by the next bits, and once more by whole hash,
where a handful is left. The filter is then a comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import FEW_ROWS, WORD, stored

#: Bits of the hash, and of it in each histogram.
HASH_BITS, BUCKET_BITS, LEVELS = 60, 12, 2
#: Weights of the sources in order, repeating, and most repeats of a document.
WEIGHTS, MOST = (1, 2, 3), 3
#: A source, null or not, as columns that join like any others.
SOURCE = ["_source", "_no_source"]


def _hash(doc_id: str, text: str):
    """60 bits of a digest of id and text: rows that tie are equal."""
    whole = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("/"),
                           F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(whole, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """A narrow row for each document: ``doc_id``, source, ``size`` in words, hash."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
        F.col("source").isNull().alias("_no_source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        _hash("doc_id", "text").alias("_hash"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """For each source its size, ``target``, whole ``_times`` and the ``_budget`` of the rest.

    A target is the level times the weight, but at most ``most`` times the size; the level
    is where targets add up to all words. Sources are taken by the ratio at which they
    reach their cap: running sums give the level if just the first ones are capped; it is
    the largest one that does not exceed the next source's ratio.
    """
    sizes = rows.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("_no_source", "_source")
    nth = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    caps = sizes.withColumn("_weight", nth.cast("bigint")).withColumn("_cap", F.col("source_size") * most)
    ratio = F.col("_cap") / F.col("_weight")
    by_ratio = Window.orderBy(ratio, "_no_source", "_source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) \
        / (F.sum("_weight").over(all_rows) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
    ranked = caps.withColumn("_ratio", ratio).withColumn("_try", level) \
        .withColumn("_level", F.max(F.when(F.col("_try") <= F.col("_ratio"), F.col("_try"))).over(
            Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("_level").isNull(), F.col("_cap").cast("double")) \
        .otherwise(F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight")))
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return ranked.withColumn("target", target).withColumn("_times", F.least(times, F.lit(most)).cast("bigint")) \
        .withColumn("_budget", F.col("target") - F.col("_times") * F.col("source_size")) \
        .select(*SOURCE, "source_size", "target", "_times", "_budget")


def thresholds(spark: SparkSession, rows: DataFrame, aims: DataFrame) -> DataFrame:
    """``aims`` with ``_threshold``: hashes up to it are taken once more. It is the one
    whose sum comes nearest to the budget."""
    shift = HASH_BITS - BUCKET_BITS
    bucket = F.shiftright("_hash", shift)
    edge = aims.select(*SOURCE, F.col("_budget").alias("_left"))
    inside, on = rows, SOURCE
    for level in range(LEVELS + 1):
        last = level == LEVELS
        sums = inside.withColumn("_bucket", F.col("_hash") if last else bucket) \
            .groupBy(*SOURCE, "_bucket").agg(F.sum("size").alias("_sum"))
        upto = Window.partitionBy(*SOURCE).orderBy("_bucket")
        run = stored(spark, sums, f"mix-histogram-{level}").join(edge.select(*SOURCE, "_left"), SOURCE) \
            .withColumn("_after", F.sum("_sum").over(upto)).withColumn("_before", F.col("_after") - F.col("_sum"))
        if last:
            taken = run.where((F.col("_before") + F.col("_after")) / 2 <= F.col("_left")).groupBy(*SOURCE) \
                .agg(F.max("_bucket").alias("_inner"))
            break
        edge = stored(spark, run.where((F.col("_before") < F.col("_left")) & (F.col("_left") < F.col("_after")))
                      .select(*SOURCE, "_bucket", (F.col("_left") - F.col("_before")).alias("_left")), f"mix-edge-{level}")
        on = [*SOURCE, "_bucket"]
        inside = inside.withColumn("_bucket", bucket).join(edge.drop("_left"), on).drop("_bucket")
        full = stored(spark, run.where(F.col("_after") <= F.col("_left")).groupBy(*SOURCE)
                      .agg(((F.max("_bucket") + 1) * F.lit(1 << shift) - 1).alias(f"_upto{level}")), f"mix-full-{level}")
        aims = aims.join(full, SOURCE, "left")
        if level + 1 < LEVELS:
            shift -= BUCKET_BITS
            bucket = F.shiftright("_hash", shift)
    return aims.join(taken, SOURCE, "left").withColumn("_threshold", F.greatest(
        F.lit(-1).cast("bigint"), *[F.col(f"_upto{k}") for k in range(LEVELS)], F.col("_inner")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """A narrow row for each document: ``doc_id``, ``size`` (words), ``source_size``, ``target``
    (of its source), ``times`` the mix takes it, ``taken`` words, and its ``_hash``.

    A null text has size 0; null is a source of its own, the last. Rows equal in id and
    text share their fate; a table without words has targets 0. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = stored(spark, sized(docs), "mix-sizes")
    aims = stored(spark, targets(rows, weights, most), "mix-targets")
    cut = stored(spark, thresholds(spark, rows, aims), "mix-thresholds")
    few = cut.count() <= FEW_ROWS  # a row for each source
    times = F.col("_times") + F.when(F.col("_hash") <= F.col("_threshold"), 1).otherwise(0)
    return rows.join(F.broadcast(cut) if few else cut, SOURCE).withColumn("times", F.least(times, F.lit(most))) \
        .select("doc_id", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"), "_hash")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it, all its columns."""
    fate = mix(docs).where("times > 0").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"), "_hash", "times") \
        .distinct()
    body = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"), _hash("doc_id", "text").alias("_hash"))
    return body.join(fate, ["_key", "_hash"]).select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))) \
        .select("row.*")


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM rows GROUP BY source),
tries AS (
  SELECT *, 3 * source_size / w AS ratio,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS try
  FROM sizes
  WINDOW before AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max(try) AS level FROM tries WHERE try <= ratio),
aims AS (
  SELECT source, source_size,
         CASE WHEN level IS NULL THEN (3 * source_size)::DOUBLE ELSE least((3 * source_size)::DOUBLE, level * w) END AS target
  FROM tries, level),
whole AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS times FROM aims),
placed AS (
  SELECT r.*, a.source_size, a.target, a.times, a.target - a.times * a.source_size AS budget,
         sum(size) OVER (PARTITION BY r.source ORDER BY h) AS after_it, sum(size) OVER (PARTITION BY r.source, h) AS own
  FROM rows r JOIN whole a ON r.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
       (size * least(times + CASE WHEN (after_it - own + after_it) / 2 <= budget THEN 1 ELSE 0 END, 3))::BIGINT AS taken
FROM placed
"""
