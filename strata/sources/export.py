"""Exports and operational gates: ordered CSV samples, counts, freshness, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _csv_safe(df: DataFrame) -> DataFrame:
    """CSV rejects VARIANT / nested columns: serialize them as JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.VariantType, T.StructType, T.ArrayType, T.MapType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def export_csv(df: DataFrame, path: str, order: list[Column], limit: int | None = None) -> None:
    """Ordered sample export with a header row.

    With a limit the plan is a top-k (``TakeOrderedAndProject``) and one file
    is written; without, a range-partitioned sort writes files in order.
    """
    out = _csv_safe(df).orderBy(*order)
    if limit is not None:
        out = out.limit(limit).coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``UNION ALL`` of labelled row counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness(df: DataFrame, ts: str = "_loaded_at") -> DataFrame:
    """``COUNT(*), MAX(ts)`` in one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(ts).alias("latest"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """File listing gate (path, length, modification time); content is never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                 .select("path", "length", "modificationTime"))


def todays_top(report: DataFrame, day=None, k: int = 10) -> DataFrame:
    """Deployment gate: the day's top ``k`` games by chart rank.

    ``day`` defaults to ``current_date()``; tests pass a fixed date.
    """
    d = F.current_date() if day is None else F.lit(day).cast("date")
    return (report.where(F.col("activity_date") == d)
                  .orderBy(F.col("chart_rank").asc_nulls_last(), F.col("game_name").asc_nulls_last())
                  .limit(k))


def export_samples(report: DataFrame, dim: DataFrame, fact_review: DataFrame, out_dir: str) -> None:
    """The three sample exports: report (latest 300 rows), dimension, top reviews."""
    export_csv(report, f"{out_dir}/sample_daily_game_performance",
               [F.col("activity_date").desc_nulls_first(), F.col("chart_rank").asc_nulls_last(),
                F.col("game_name").asc_nulls_last()], limit=300)
    export_csv(dim.select("game_key", "game_name", "primary_developer", "primary_publisher",
                          "primary_genre", "is_free", "price_currency", "price_final", "release_date",
                          "metacritic_score", "total_recommendations", "has_store_page"),
               f"{out_dir}/sample_dim_game",
               [F.col("total_recommendations").desc_nulls_last(), F.col("game_key").asc_nulls_last()])
    export_csv(fact_review.select("review_id", "game_key", "review_date", "review_language",
                                  "is_positive", "votes_up", "votes_funny", "playtime_at_review_hrs",
                                  "steam_purchase", "written_during_early_access",
                                  "review_length_chars"),
               f"{out_dir}/sample_fact_review",
               [F.col("votes_up").desc_nulls_first(), F.col("review_id").asc_nulls_last()], limit=200)
