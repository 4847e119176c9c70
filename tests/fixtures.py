"""Hand-written NDJSON fixtures with the edge rows of FIXTURES.md §2."""

from __future__ import annotations

import datetime as dt
import json
import os

UTC = dt.timezone.utc


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s).replace(tzinfo=UTC)


def epoch(s: str) -> int:
    return int(ts(s).timestamp())


def iso(s: str) -> str:
    return ts(s).isoformat(timespec="microseconds")


def write(root: str, dataset: str, extracted: str, records: list[dict], part: int | None = None,
          source: str = "src") -> str:
    t = ts(extracted)
    suffix = f"_part{part:02d}" if part is not None else ""
    rel = f"{dataset}/ingest_date={t:%Y-%m-%d}/{dataset}_{t:%Y%m%dT%H%M%S}{suffix}.ndjson"
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    stamp = {"_extracted_at": iso(extracted), "_source": source}
    with open(path, "w", encoding="utf-8") as f:
        for r in records:
            f.write(json.dumps({**stamp, **r}, ensure_ascii=False) + "\n")
    return path


D1 = "2024-03-01 06:00:00"
D1B = "2024-03-01 07:00:00"
D2 = "2024-03-02 06:00:00"


def review(rid, appid, created, updated, voted, playtime, score, text="ok", **extra):
    r = {"appid": appid, "recommendationid": rid,
         "author": {"steamid": f"u{rid}", "num_games_owned": 3, "num_reviews": 1,
                    "playtime_forever": playtime + 10, "playtime_at_review": playtime,
                    "playtime_last_two_weeks": 5},
         "language": "english", "review": text, "timestamp_created": epoch(created),
         "votes_up": 1, "votes_funny": 0, "weighted_vote_score": score, "comment_count": 0,
         "steam_purchase": True, "received_for_free": False,
         "written_during_early_access": False, "primarily_steam_deck": False}
    if updated is not None:
        r["timestamp_updated"] = epoch(updated)
    if voted is not None:
        r["voted_up"] = voted
    r.update(extra)
    return r


def write_pipeline_fixture(raw: str) -> None:
    rollup = epoch("2024-02-29 00:00:00")
    write(raw, "most_played", D1, [
        {"appid": 10, "rank": 1, "last_week_rank": 2, "peak_in_game": 1000, "rollup_date": rollup},
        {"appid": 20, "rank": 2, "last_week_rank": 1, "peak_in_game": 900, "rollup_date": rollup},
        {"appid": 30, "rank": 3, "last_week_rank": -1, "peak_in_game": 800, "rollup_date": rollup},
        {"appid": 40, "rank": 127, "last_week_rank": 4, "peak_in_game": 700, "rollup_date": rollup}])
    # same app re-extracted later the same day: later extraction wins
    write(raw, "most_played", D1B, [
        {"appid": 10, "rank": 5, "last_week_rank": 2, "peak_in_game": 1100, "rollup_date": rollup}])
    write(raw, "most_played", D2, [
        {"appid": 10, "rank": 1, "last_week_rank": 5, "peak_in_game": 1200, "rollup_date": None},
        {"appid": 20, "rank": 2, "last_week_rank": 2, "peak_in_game": 950, "rollup_date": None}])

    write(raw, "player_counts", D1, [
        {"appid": 10, "player_count": 1000, "result": 1},
        {"appid": 20, "player_count": 500, "result": 1},
        {"appid": 40, "player_count": None, "result": 42}])
    write(raw, "player_counts", D2, [{"appid": 10, "player_count": 2000, "result": 1}])

    write(raw, "reviews", D1, [
        review("r1", 10, "2024-03-01 01:00:00", "2024-03-01 01:00:00", True, 100, "0.502"),
        review("r2", 10, "2024-03-01 23:59:59", "2024-03-01 23:59:59", None, 200, 0.1),
        review("r5", 10, "2024-03-01 05:00:00", "2024-03-01 05:00:00", True, 301, 0.3, text="a😀é"),
        review("r4", 20, "2024-03-01 03:00:00", "2024-03-01 03:00:00", True, 50, 0.9)], part=0)
    write(raw, "reviews", D1, [
        review("r6", 10, "2024-03-01 04:00:00", "2024-03-01 04:00:00", True, 400, 0.4)], part=1)
    write(raw, "reviews", D2, [
        # r1 edited: newer update wins (vote flips to negative)
        review("r1", 10, "2024-03-01 01:00:00", "2024-03-01 20:00:00", False, 100, 0.6),
        review("r3", 10, "2024-03-02 00:00:00", "2024-03-02 00:00:00", True, 10, 0.7),
        # r4 again without timestamp_updated: NULL sorts first on DESC and wins
        review("r4", 20, "2024-03-01 03:00:00", None, False, 50, 0.8)])

    good10 = {"name": "Alpha", "type": "game", "is_free": False,
              "developers": ["DevA", "DevB"], "publishers": ["PubA"],
              "genres": [{"id": "1", "description": "Action"}, {"id": "2", "description": "Indie"}],
              "categories": [{"id": 2, "description": "Single-player"}],
              "price_overview": {"currency": "USD", "final": 499, "discount_percent": 0},
              "release_date": {"date": "8 Nov, 2013"}, "metacritic": {"score": 85},
              "recommendations": {"total": 1000}, "required_age": 18, "short_description": "A"}
    good20 = {"name": "Beta", "type": "game", "is_free": True, "developers": [], "publishers": [],
              "genres": [], "release_date": {"date": "Aug 21, 2012"}, "required_age": "0"}
    write(raw, "app_details", D1, [
        {"appid": 10, "success": True, "data": good10},
        {"appid": 20, "success": True, "data": good20},
        {"appid": 30, "success": False, "data": None},
        {"appid": 77, "success": True, "data": {"name": "Never charted"}}])
    write(raw, "app_details", D2, [
        {"appid": 10, "success": False, "error": "HTTP 500"},
        {"appid": 20, "success": True, "data": {**good20, "release_date": {"date": "21 Aug, 2012"}}}])
