"""Mergeable daily state: stored partial aggregates of reviews per (appid, day).

A day's counts, sums and playtime histogram are kept as rows (appid, review_date, playtime)
with the number of reviews, of positive and negative ones, and the sum and number of
scores. All of these are sums, so a batch is merged by adding its rows: a new review adds
its share, a replaced one takes its old share away. Work follows the batch and the stored
rows of the days it touches; no review is read again. Scores are summed as decimals, so
that what is added and taken away again leaves nothing. The median comes from the
histogram, dealt by ranges of its values (``weighted_median``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.semantics import iff
from strata.operators.aggregates import weighted_median
from strata.operators.bloom import key_filter
from strata.operators.incremental import SnapshotTable

KEYS = ["appid", "review_date"]
_SUMS = ["n", "positive", "negative", "score_sum", "score_n"]


def partials(reviews: DataFrame, sign: int = 1) -> DataFrame:
    """Partial aggregates of silver reviews, to be added (``sign`` 1) or taken away (-1)."""
    s = F.lit(sign).cast("bigint")
    score = F.col("weighted_vote_score").cast("decimal(38,15)")
    return reviews.groupBy("appid", F.to_date("created_at").alias("review_date"), F.col("playtime_at_review_min").alias("playtime")).agg(
        F.sum(s).alias("n"), F.sum(iff("voted_up", 1, 0) * s).cast("bigint").alias("positive"),
        F.sum(iff("voted_up", 0, 1) * s).cast("bigint").alias("negative"),
        F.coalesce(F.sum(score * s).cast("decimal(38,15)"), F.lit(0).cast("decimal(38,15)")).alias("score_sum"),
        F.sum(F.when(score.isNotNull(), s).otherwise(0)).cast("bigint").alias("score_n"))


class DailyState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = SnapshotTable(spark, root, key=[*KEYS, "playtime"], partition_by="review_date")

    def merged(self, delta: DataFrame, days: list[str]) -> DataFrame:
        """The stored rows of ``days`` with ``delta`` added."""
        rows = self.table.read(days).unionByName(delta) if self.table.exists() else delta
        total = rows.groupBy(*KEYS, "playtime").agg(*[F.sum(c).cast(delta.schema[c].dataType).alias(c) for c in _SUMS])
        return total.where("n <> 0").select(*delta.columns)

    def merge(self, added: DataFrame, removed: DataFrame | None = None, meta: dict | None = None) -> list[str]:
        """Add the share of ``added`` reviews, take away that of ``removed`` ones; returns
        the days that were touched."""
        delta = partials(added)
        if removed is not None:
            delta = delta.unionByName(partials(removed, -1))
        name = F.coalesce(F.col("review_date").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        days = [r[0] for r in delta.select(name).distinct().collect()]  # partition names only
        if days or meta:
            self.table.replace_partitions(self.merged(delta, days), days, meta)
        return sorted(days)

    def follow(self, reviews: SnapshotTable, keys: DataFrame | None = None) -> list[str]:
        """Bring the state up to date with a table of reviews: from the version it last
        followed to the newest, over the partitions that differ and (if given) the changed
        ``keys``. If that version is gone, the state is built anew. Returns touched days."""
        now = reviews.current()
        if now is None:
            return []
        cur = self.table.current()
        before = reviews.manifest(cur["meta"].get("commit", 0)) if cur else None
        meta = {"commit": now["commit"]}
        if before is None:
            return self.table.replace(partials(reviews.read(at=now)), meta)["partitions"]
        if before["commit"] == now["commit"]:
            return []
        changed = [p for p in {*before["partitions"], *now["partitions"]} if before["partitions"].get(p) != now["partitions"].get(p)]
        old, new = reviews.read(changed, at=before), reviews.read(changed, at=now)
        if keys is not None:
            test = key_filter(keys, reviews.keys, keys.count())
            old, new = (df.where(test).join(keys, reviews.keys, "left_semi") for df in (old, new))
        return self.merge(new, old, meta)

    def daily(self, days: list[str] | None = None) -> DataFrame:
        """The daily review aggregate (see ``activity_metrics``) of all or some days."""
        rows = self.table.read(days)
        agg = rows.groupBy(*KEYS).agg(
            F.sum("n").alias("reviews_total"), F.sum("positive").alias("reviews_positive"), F.sum("negative").alias("reviews_negative"),
            (F.sum("score_sum").cast("double") / F.nullif(F.sum("score_n"), F.lit(0))).alias("avg_weighted_vote_score"))
        values = rows.where("playtime is not null").select(*KEYS, F.col("playtime").cast("double").alias("_v"), F.col("n").alias("_c"))
        return agg.join(weighted_median(values, KEYS, "median_playtime_at_review_min"), KEYS, "left")
