"""Silver models: typed, deduplicated views over the bronze VARIANT tables.

Each model is a declarative path/type map plus one latest-wins dedup. Ties
on the ordering keys are broken by ``_file`` and ``_loaded_at`` so results
are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.semantics import minor_units_to_amount
from strata.functions.variant import project_paths, vget
from strata.operators.dedup import latest_by

_TIES = [("_file", "desc"), ("_loaded_at", "desc")]

# The silver column <- (raw JSON path, type) contract of each
# model, in the order of the models' columns. ---------------------------------
MOST_PLAYED = {
    "appid": ("$.appid", "bigint_half_up"),
    "chart_rank": ("$.rank", "bigint_half_up"),
    "last_week_rank": ("$.last_week_rank", "bigint_half_up"),
    "peak_in_game": ("$.peak_in_game", "bigint_half_up"),
    "rollup_date": ("$.rollup_date", "epoch"),
    "extracted_at": ("$._extracted_at", "timestamp"),
}

PLAYER_COUNTS = {
    "appid": ("$.appid", "bigint_half_up"),
    "player_count": ("$.player_count", "bigint_half_up"),
    "api_result": ("$.result", "bigint_half_up"),
    "extracted_at": ("$._extracted_at", "timestamp"),
    "snapshot_date": ("$._extracted_at", "date"),
}

REVIEWS = {
    "review_id": ("$.recommendationid", "string"),
    "appid": ("$.appid", "bigint_half_up"),
    "author_steamid": ("$.author.steamid", "string"),
    "author_num_games_owned": ("$.author.num_games_owned", "bigint_half_up"),
    "author_num_reviews": ("$.author.num_reviews", "bigint_half_up"),
    "author_playtime_forever_min": ("$.author.playtime_forever", "bigint_half_up"),
    "playtime_at_review_min": ("$.author.playtime_at_review", "bigint_half_up"),
    "playtime_last_two_weeks_min": ("$.author.playtime_last_two_weeks", "bigint_half_up"),
    "review_language": ("$.language", "string"),
    "review_text": ("$.review", "string"),
    "created_at": ("$.timestamp_created", "epoch"),
    "updated_at": ("$.timestamp_updated", "epoch"),
    "voted_up": ("$.voted_up", "boolean"),
    "votes_up": ("$.votes_up", "bigint_half_up"),
    "votes_funny": ("$.votes_funny", "bigint_half_up"),
    "weighted_vote_score": ("$.weighted_vote_score", "double"),
    "comment_count": ("$.comment_count", "bigint_half_up"),
    "steam_purchase": ("$.steam_purchase", "boolean"),
    "received_for_free": ("$.received_for_free", "boolean"),
    "written_during_early_access": ("$.written_during_early_access", "boolean"),
    "primarily_steam_deck": ("$.primarily_steam_deck", "boolean"),
    "extracted_at": ("$._extracted_at", "timestamp"),
}

APP_DETAILS = {
    "appid": ("$.appid", "bigint_half_up"),
    "fetch_success": ("$.success", "boolean"),
    "game_name": ("$.data.name", "string"),
    "app_type": ("$.data.type", "string"),
    "is_free": ("$.data.is_free", "boolean"),
    "developers": ("$.data.developers", "variant"),
    "publishers": ("$.data.publishers", "variant"),
    "genres": ("$.data.genres", "variant"),
    "categories": ("$.data.categories", "variant"),
    "price_currency": ("$.data.price_overview.currency", "string"),
    "discount_percent": ("$.data.price_overview.discount_percent", "bigint_half_up"),
    "release_date_raw": ("$.data.release_date.date", "string"),
    "metacritic_score": ("$.data.metacritic.score", "bigint_half_up"),
    "total_recommendations": ("$.data.recommendations.total", "bigint_half_up"),
    "required_age": ("$.data.required_age", "string"),
    "short_description": ("$.data.short_description", "string"),
    "extracted_at": ("$._extracted_at", "timestamp"),
}
# ------------------------------------------------------------------------------


def silver_most_played(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """Daily chart: one row per (appid, chart_date), latest extraction wins."""
    src = project_paths(bronze, "payload", MOST_PLAYED, keep=["_file", "_loaded_at"], strict=strict)
    src = src.withColumn("chart_date", F.to_date("extracted_at"))
    return latest_by(src, ["appid", "chart_date"], [("extracted_at", "desc")], _TIES)


def silver_player_counts(bronze: DataFrame, strict: bool = True, keep_file: bool = False) -> DataFrame:
    """One snapshot per (appid, snapshot_date)."""
    src = project_paths(bronze, "payload", PLAYER_COUNTS, keep=["_file", "_loaded_at"], strict=strict)
    out = latest_by(src, ["appid", "snapshot_date"], [("extracted_at", "desc")], _TIES)
    return out if keep_file else out.drop("_file")


def silver_reviews(bronze: DataFrame, strict: bool = True, keep_file: bool = False) -> DataFrame:
    """One row per review_id: newest update, then newest extraction."""
    src = project_paths(bronze, "payload", REVIEWS, keep=["_file", "_loaded_at"], strict=strict)
    out = latest_by(src, ["review_id"], [("updated_at", "desc"), ("extracted_at", "desc")], _TIES)
    return out if keep_file else out.drop("_file")


def silver_app_details(bronze: DataFrame, strict: bool = True, keep_file: bool = False) -> DataFrame:
    """Successful detail fetches only (filter *before* dedup), one per (appid, day)."""
    src = (bronze.select(
        *[vget("payload", p, t, strict).alias(n) for n, (p, t) in APP_DETAILS.items()],
        minor_units_to_amount(vget("payload", "$.data.price_overview.final", "bigint_half_up", strict))
        .alias("price_final"),
        "_file", "_loaded_at"))
    src = src.where(F.col("fetch_success"))
    out = latest_by(src, ["appid", F.to_date("extracted_at")], [("extracted_at", "desc")], _TIES)
    return out if keep_file else out.drop("_file")
