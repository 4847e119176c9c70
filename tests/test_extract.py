"""Landed API responses -> stamped NDJSON landing -> bronze -> gold."""

import datetime as dt
import json

from pyspark.sql import functions as F

from strata.plans.build import build, gold_tables, load_raw
from strata.plans.extract import land_run, shape_run
from strata.sources.catalog import Lake

RUN = dt.datetime(2024, 3, 2, 6, 0)
NOW = int(dt.datetime(2024, 3, 2, 5, 0, tzinfo=dt.timezone.utc).timestamp())


def test_extract_run_end_to_end(spark, tmp_path):
    chart = {"response": {"rollup_date": NOW, "ranks": [
        {"appid": 10, "rank": 1, "last_week_rank": 1, "peak_in_game": 100},
        {"appid": 20, "rank": 2, "last_week_rank": -1, "peak_in_game": 90},
        {"appid": 30, "rank": 3, "last_week_rank": 2, "peak_in_game": 80}]}}
    rows = [
        ("most_played", 0, 0, None, json.dumps(chart), None),
        ("player_counts", 10, 0, None, json.dumps({"response": {"player_count": 5, "result": 1}}), None),
        ("player_counts", 20, 0, None, None, "HTTP 404"),
        ("player_counts", 99, 0, None, json.dumps({"response": {"player_count": 1, "result": 1}}), None),
        ("reviews", 10, 0, "*", json.dumps({"cursor": "c1", "reviews": [
            {"recommendationid": "a", "timestamp_created": NOW, "voted_up": True, "language": "english",
             "review": "héllo", "author": {"steamid": "s", "playtime_at_review": 60}},
            {"recommendationid": "b", "timestamp_created": NOW - 90000, "voted_up": False}]}), None),
        ("app_details", 10, 0, None, json.dumps({"10": {"success": True, "data": {
            "name": "Alpha", "developers": ["D"], "genres": [{"description": "Action"}],
            "price_overview": {"currency": "EUR", "final": 1999}}}}), None),
        ("app_details", 20, 0, None, json.dumps({"20": {"success": False}}), None),
    ]
    responses = (spark.createDataFrame(rows, "dataset string, appid long, page_no int, cursor string, "
                                             "body string, error string")
                 .withColumn("body", F.parse_json("body"))
                 .withColumn("run_ts", F.lit(RUN).cast("timestamp")))
    recs = shape_run(responses, top_n=2, chunk_size=1)
    lake = Lake(str(tmp_path / "lake"))
    land_run(lake, recs)
    loaded = load_raw(spark, lake)
    assert {k: v.rows for k, v in loaded.items()} == {
        "most_played": 2, "player_counts": 1, "reviews": 1, "app_details": 2}
    files = [r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(lake.landing).select("path").collect()]
    assert any("/reviews/ingest_date=2024-03-02/part=00/" in f for f in files)
    assert any("/app_details/ingest_date=2024-03-02/part=01/" in f for f in files)
    _, checks = build(spark, lake)
    assert [c.name for c in checks if not c.passed] == []
    g = gold_tables(spark, lake)
    dim = {r.game_key: r for r in g["dim_game"].collect()}
    assert set(dim) == {10, 20}
    assert (dim[10].game_name, dim[10].primary_genre, str(dim[10].price_final)) == ("Alpha", "Action", "19.990000")
    assert (dim[20].game_name, dim[20].has_store_page) == ("Unknown (20)", False)
    fr = g["fact_review"].collect()
    assert [(r.review_id, r.game_key, r.review_length_chars, str(r.playtime_at_review_hrs)) for r in fr] == [
        ("a", 10, 5, "1.0")]
    fd = {r.game_key: r for r in g["fact_daily_game_performance"].collect()}
    assert fd[10].snapshot_player_count == 5 and fd[20].snapshot_player_count is None
