"""Gold models: game dimension, daily performance fact, review fact, report.

* ``dim_game``: spine = every app ever seen on the chart (not the details),
  left-joined to its latest successful details; placeholder name and
  ``has_store_page = false`` when none exist.
* ``fact_daily_game_performance``: chart rows left-joined to the same-day
  player count and the pre-aggregated same-day reviews. Counts default to
  0, while the ratio / average / median stay NULL for review-less days.
* ``fact_review``: event-grain projection of silver reviews (text length
  only, never the text).
* ``rpt_daily_game_performance``: fact joined to the dimension at read time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.semantics import (div0, flag, hours_from_minutes, placeholder_name,
                                        report_round, try_date)
from strata.constants import MEDIAN_SCALE
from strata.functions.variant import vget
from strata.operators.aggregates import activity_metrics
from strata.operators.dedup import latest_by


def dim_game(most_played: DataFrame, app_details: DataFrame) -> DataFrame:
    spine = most_played.select("appid").distinct()
    latest = latest_by(app_details, ["appid"], [("extracted_at", "desc")],
                       [("_loaded_at", "desc")])
    d = latest.alias("d")
    return (spine.alias("s").join(d, F.col("s.appid") == F.col("d.appid"), "left")
            .select(F.col("s.appid").alias("game_key"),
                    placeholder_name(F.col("d.game_name"), F.col("s.appid")).alias("game_name"),
                    F.col("d.app_type"), F.col("d.is_free"),
                    vget(F.col("d.developers"), "$[0]", "string").alias("primary_developer"),
                    vget(F.col("d.publishers"), "$[0]", "string").alias("primary_publisher"),
                    vget(F.col("d.genres"), "$[0].description", "string").alias("primary_genre"),
                    F.col("d.genres"), F.col("d.price_currency"), F.col("d.price_final"),
                    F.col("d.discount_percent"),
                    try_date(F.col("d.release_date_raw")).alias("release_date"),
                    F.col("d.metacritic_score"), F.col("d.total_recommendations"),
                    F.col("d.short_description"),
                    F.col("d.appid").isNotNull().alias("has_store_page"),
                    F.col("d.extracted_at").alias("attributes_as_of")))


def review_daily(reviews: DataFrame, **median_kw) -> DataFrame:
    """Reviews per (appid, created_at::date)."""
    r = reviews.withColumn("review_date", F.to_date("created_at"))
    return activity_metrics(r, ["appid", "review_date"], "voted_up", "weighted_vote_score",
                            "playtime_at_review_min", **median_kw)


def fact_daily_game_performance(most_played: DataFrame, player_counts: DataFrame,
                                reviews: DataFrame, **median_kw) -> DataFrame:
    return daily_fact(most_played, player_counts, review_daily(reviews, **median_kw))


def daily_fact(most_played: DataFrame, player_counts: DataFrame, daily: DataFrame) -> DataFrame:
    """The daily fact from reviews that are already aggregated by day."""
    chart = most_played.select(F.col("chart_date").alias("activity_date"),
                               F.col("appid").alias("game_key"),
                               "chart_rank", "last_week_rank", "peak_in_game")
    counts = player_counts.select(F.col("snapshot_date").alias("activity_date"),
                                  F.col("appid").alias("game_key"),
                                  F.col("player_count").alias("snapshot_player_count"))
    agg = daily.select(
        F.col("review_date").alias("activity_date"), F.col("appid").alias("game_key"),
        F.col("reviews_total").alias("_total"), F.col("reviews_positive").alias("_pos"),
        F.col("reviews_negative").alias("_neg"), "avg_weighted_vote_score",
        "median_playtime_at_review_min")
    keys = ["activity_date", "game_key"]
    j = chart.join(counts, keys, "left").join(agg, keys, "left")
    return j.select(
        *keys, "chart_rank", "last_week_rank", "peak_in_game", "snapshot_player_count",
        F.coalesce("_total", F.lit(0)).cast("bigint").alias("reviews_total"),
        F.coalesce("_pos", F.lit(0)).cast("bigint").alias("reviews_positive"),
        F.coalesce("_neg", F.lit(0)).cast("bigint").alias("reviews_negative"),
        "avg_weighted_vote_score",
        F.col("median_playtime_at_review_min").cast(f"decimal(38,{MEDIAN_SCALE})")
        .alias("median_playtime_at_review_min"),
        div0("_pos", "_total").alias("positive_review_ratio"))


def fact_review(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id", F.col("appid").alias("game_key"), "author_steamid", "created_at",
        F.to_date("created_at").alias("review_date"), "updated_at", "review_language",
        F.col("voted_up").alias("is_positive"), flag("voted_up").alias("positive_flag"),
        "votes_up", "votes_funny", "weighted_vote_score", "comment_count",
        "playtime_at_review_min",
        hours_from_minutes("playtime_at_review_min").alias("playtime_at_review_hrs"),
        "author_playtime_forever_min", "author_num_games_owned", "author_num_reviews",
        "steam_purchase", "received_for_free", "written_during_early_access",
        "primarily_steam_deck",
        F.length("review_text").cast("bigint").alias("review_length_chars"),
        "extracted_at")


def rpt_daily_game_performance(fact: DataFrame, dim: DataFrame) -> DataFrame:
    f, g = fact.alias("f"), dim.alias("g")
    return (f.join(g, F.col("g.game_key") == F.col("f.game_key"), "inner")
             .select("f.activity_date", "f.chart_rank", "f.last_week_rank", "g.game_name",
                     "g.primary_developer", "g.primary_publisher", "g.primary_genre",
                     "g.is_free", "g.has_store_page", "f.peak_in_game",
                     "f.snapshot_player_count", "f.reviews_total", "f.reviews_positive",
                     "f.reviews_negative",
                     report_round(F.col("f.positive_review_ratio")).alias("positive_review_ratio"),
                     report_round(F.col("f.avg_weighted_vote_score")).alias("avg_weighted_vote_score"),
                     "f.median_playtime_at_review_min"))
