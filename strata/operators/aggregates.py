"""Group aggregates: the daily activity metrics and a skew-safe exact median.

``exact_median`` never gathers a group's values into one task. Values are
first pre-aggregated to ``(group, value, count)`` (map-side combine, so
repeated values collapse) and written once, dealt by ranges of (group, value):
a hot group spans many ranges. Counts per range give each range's place in its
group, and only the one or two ranges that hold the middle ranks are ranked
value by value. The same steps run whatever a group's size; infinities are
ordered like any value. The interpolation (``lo + (hi - lo) * 0.5``) matches
SQL ``median``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.semantics import iff
from strata.session import scratch_path


def exact_median(df: DataFrame, keys: list[str], value: str | Column, out: str = "median") -> DataFrame:
    """``median(value)`` per ``keys`` (NULLs ignored; groups of only NULLs vanish)."""
    v = F.col(value) if isinstance(value, str) else value
    return weighted_median(df.where(v.isNotNull())
                             .groupBy(*keys, v.cast("double").alias("_v"))
                             .agg(F.count(F.lit(1)).alias("_c")), keys, out)


def weighted_median(base: DataFrame, keys: list[str], out: str = "median") -> DataFrame:
    """``exact_median`` of values that are already counted: one row (``keys``, ``_v``,
    ``_c``) for each value of a group."""
    spark = base.sparkSession
    # written, so that both reads below see one dealing; lost executors reread it
    path = scratch_path(spark, "median")
    base.repartitionByRange(*keys, "_v").withColumn("_piece", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    by_piece = Window.partitionBy(*keys).orderBy("_piece")
    pieces = (placed.groupBy(*keys, "_piece").agg(F.sum("_c").alias("_s"))
                    .withColumn("_n", F.sum("_s").over(Window.partitionBy(*keys)))
                    .withColumn("_before", F.sum("_s").over(by_piece) - F.col("_s")))
    lo, hi = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    middle = pieces.where((F.col("_before") <= hi) & (lo < F.col("_before") + F.col("_s"))) \
        .select(*keys, "_piece", "_before", lo.alias("_lo"), hi.alias("_hi"))
    upto = (Window.partitionBy(*keys, "_piece").orderBy("_v")
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = placed.join(middle, [*keys, "_piece"]).withColumn("_end", F.col("_before") + F.sum("_c").over(upto))
    picked = ranked.where((F.col("_end") - F.col("_c") <= F.col("_hi")) & (F.col("_lo") < F.col("_end")))
    a, z = F.min("_v"), F.max("_v")
    return picked.groupBy(*keys).agg(F.when(a == z, a).otherwise(a + (z - a) * F.lit(0.5)).alias(out))


def activity_metrics(df: DataFrame, keys: list[str], vote: str, score: str, playtime: str,
                     median_out: str = "median_playtime_at_review_min") -> DataFrame:
    """The daily review aggregate of the reference, per ``keys``.

    ``total``: count(*); ``positive``: sum(iff(vote,1,0)); ``negative``:
    sum(iff(vote,0,1)) so a NULL vote counts as negative; ``avg`` of the
    score (NULLs ignored); exact median of the playtime.
    """
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reviews_total"),
        F.sum(iff(vote, 1, 0)).cast("bigint").alias("reviews_positive"),
        F.sum(iff(vote, 0, 1)).cast("bigint").alias("reviews_negative"),
        F.avg(score).alias("avg_weighted_vote_score"))
    med = exact_median(df, keys, playtime, out=median_out)
    return agg.join(med, on=keys, how="left")
