"""End to end: NDJSON landing -> bronze -> silver -> gold, with the edge rows."""

import datetime as dt
from decimal import Decimal

import pytest

from strata.plans.build import build, gold_tables, load_raw, run_history
from strata.sources.bronze import ingest, read_bronze
from strata.sources.catalog import Lake
from strata.streaming.ledger import load_history
from tests.fixtures import D2, review, write, write_pipeline_fixture


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    write_pipeline_fixture(lake.landing)
    first = load_raw(spark, lake)
    again = load_raw(spark, lake)
    results, checks = build(spark, lake)
    return lake, first, again, results, checks


def test_files_load_once(built):
    _, first, again, _, _ = built
    assert {k: v.rows for k, v in first.items()} == {
        "most_played": 7, "player_counts": 4, "reviews": 8, "app_details": 6}
    assert all(v.rows == 0 for v in again.values())


def test_bronze_lineage(spark, built):
    lake = built[0]
    b = read_bronze(spark, lake.bronze("reviews")).select("_file", "_loaded_at").collect()
    files = {r._file for r in b}
    assert "reviews/ingest_date=2024-03-01/reviews_20240301T060000_part01.ndjson" in files
    assert all(r._loaded_at is not None for r in b)
    hist = load_history(spark, lake).collect()
    assert sum(r.rows for r in hist) == 25


def test_all_model_tests_pass(built):
    _, _, _, results, checks = built
    assert [c.name for c in checks if not c.passed] == []
    assert len(checks) == 17
    assert all(r.status == "SUCCEEDED" for r in results)


def test_dim_game(spark, built):
    dim = {r.game_key: r for r in gold_tables(spark, built[0])["dim_game"].collect()}
    assert set(dim) == {10, 20, 30, 40}  # never-charted 77 absent, charted without details kept
    a = dim[10]
    assert (a.game_name, a.primary_developer, a.primary_publisher, a.primary_genre) == (
        "Alpha", "DevA", "PubA", "Action")
    assert a.price_final == Decimal("4.990000") and a.price_currency == "USD"
    assert a.release_date == dt.date(2013, 11, 8) and a.has_store_page is True
    assert a.attributes_as_of == dt.datetime(2024, 3, 1, 6, 0)  # failed D2 fetch ignored
    b = dim[20]
    assert (b.primary_developer, b.primary_genre, b.price_final) == (None, None, None)
    assert b.release_date == dt.date(2012, 8, 21)
    for k in (30, 40):
        assert dim[k].game_name == f"Unknown ({k})" and dim[k].has_store_page is False


def test_fact_daily(spark, built):
    f = {(r.activity_date.day, r.game_key): r
         for r in gold_tables(spark, built[0])["fact_daily_game_performance"].collect()}
    assert len(f) == 6
    r = f[(1, 10)]
    assert (r.chart_rank, r.snapshot_player_count) == (5, 1000)  # later extraction wins
    assert (r.reviews_total, r.reviews_positive, r.reviews_negative) == (4, 2, 2)  # NULL vote negative
    assert r.avg_weighted_vote_score == pytest.approx(0.35)
    assert r.median_playtime_at_review_min == Decimal("250.500")
    assert r.positive_review_ratio == 0.5
    r = f[(1, 20)]
    assert (r.reviews_total, r.reviews_positive, r.positive_review_ratio) == (1, 0, 0.0)  # NULL update won
    for key in [(1, 30), (1, 40), (2, 20)]:
        r = f[key]
        assert (r.reviews_total, r.reviews_positive, r.reviews_negative) == (0, 0, 0)
        assert r.positive_review_ratio is None and r.median_playtime_at_review_min is None
    assert f[(1, 40)].snapshot_player_count is None and f[(1, 40)].chart_rank == 127
    assert f[(1, 30)].last_week_rank == -1
    r = f[(2, 10)]  # created 00:00:00 on day 2 belongs to day 2
    assert (r.reviews_total, r.positive_review_ratio, r.snapshot_player_count) == (1, 1.0, 2000)


def test_fact_review(spark, built):
    fr = {r.review_id: r for r in gold_tables(spark, built[0])["fact_review"].collect()}
    assert set(fr) == {"r1", "r2", "r3", "r4", "r5", "r6"}
    assert (fr["r1"].is_positive, fr["r1"].positive_flag) == (False, 0)
    assert (fr["r2"].is_positive, fr["r2"].positive_flag) == (None, 0)
    assert fr["r5"].review_length_chars == 3
    assert fr["r1"].playtime_at_review_hrs == Decimal("1.7")
    assert fr["r1"].weighted_vote_score == 0.6
    assert fr["r2"].review_date == dt.date(2024, 3, 1)


def test_report_view(spark, built):
    rpt = gold_tables(spark, built[0])["rpt_daily_game_performance"].collect()
    assert len(rpt) == 6 and all(r.game_name for r in rpt)
    top = [r for r in rpt if r.activity_date == dt.date(2024, 3, 1) and r.chart_rank == 5][0]
    assert top.positive_review_ratio == Decimal("0.500")
    assert top.avg_weighted_vote_score == Decimal("0.350")


def test_run_history(spark, built):
    h = run_history(spark, built[0]).collect()
    assert {r.model for r in h} >= {"dim_game", "fact_review", "fact_daily_game_performance",
                                    "tests (silver)", "tests (gold)", "tests (report)"}


def test_rebuild_is_idempotent(spark, built):
    lake = built[0]
    before = sorted(map(tuple, gold_tables(spark, lake)["fact_daily_game_performance"].collect()))
    build(spark, lake)
    after = sorted(map(tuple, gold_tables(spark, lake)["fact_daily_game_performance"].collect()))
    assert before == after


@pytest.mark.parametrize("mode,expected", [("strict", 6), ("loaded_at", 7)])
def test_late_part_of_same_run(spark, tmp_path, mode, expected):
    lake = Lake(str(tmp_path / "lake"))
    write_pipeline_fixture(lake.landing)
    load_raw(spark, lake)
    build(spark, lake, review_mode=mode)
    # a late part of the D2 run lands after the build, with the same stamp
    write(lake.landing, "reviews", D2, [review("r9", 10, "2024-03-02 01:00:00", "2024-03-02 01:00:00",
                                               True, 5, 0.5)], part=7)
    load_raw(spark, lake)
    build(spark, lake, review_mode=mode)
    g = gold_tables(spark, lake)
    assert g["fact_review"].count() == expected
    day2 = [r for r in g["fact_daily_game_performance"].collect()
            if r.activity_date == dt.date(2024, 3, 2) and r.game_key == 10][0]
    assert day2.reviews_total == 2  # the daily fact reads silver: counted in both modes


def test_malformed_line_strict_and_lenient(spark, tmp_path):
    raw = tmp_path / "raw" / "most_played" / "ingest_date=2024-03-01"
    raw.mkdir(parents=True)
    (raw / "most_played_20240301T060000.ndjson").write_text('{"appid": 1}\n{not json\n\n{"appid": 2}\n')
    root = str(tmp_path)
    with pytest.raises(Exception):
        ingest(spark, f"{root}/raw/most_played", f"{root}/bronze_s", f"{root}/chk_s", strict=True)
    res = ingest(spark, f"{root}/raw/most_played", f"{root}/bronze_l", f"{root}/chk_l", strict=False,
                 quarantine=f"{root}/quarantine")
    assert res.rows == 2
    q = spark.read.parquet(f"{root}/quarantine").collect()
    assert [r.line for r in q] == ["{not json"]


def test_views_exports_and_gates(spark, built, tmp_path):
    from strata.plans.build import register_views
    from strata.sources.export import (export_samples, freshness, list_files, table_counts,
                                       todays_top)
    lake = built[0]
    names = register_views(spark, lake)
    assert "rpt_daily_game_performance" in names and "silver_reviews" in names
    top = spark.sql("SELECT * FROM rpt_daily_game_performance "
                    "ORDER BY activity_date DESC NULLS FIRST, chart_rank ASC NULLS LAST LIMIT 300").collect()
    assert top[0].activity_date == dt.date(2024, 3, 2) and top[0].chart_rank == 1
    g = gold_tables(spark, lake)
    gate = todays_top(g["rpt_daily_game_performance"], day="2024-03-01", k=2).collect()
    assert [r.chart_rank for r in gate] == [2, 3]
    export_samples(g["rpt_daily_game_performance"], g["dim_game"], g["fact_review"], str(tmp_path / "x"))
    dim_csv = spark.read.option("header", True).csv(str(tmp_path / "x" / "sample_dim_game")).collect()
    assert [r.game_key for r in dim_csv][:1] == ["10"] and len(dim_csv) == 4
    files = list_files(spark, lake.landing).collect()
    assert len(files) == 10 and all(f.length > 0 for f in files)
    counts = {r.table_name: r.row_count for r in table_counts(
        {ds: read_bronze(spark, lake.bronze(ds)) for ds in ("reviews", "most_played")}).collect()}
    assert counts == {"reviews": 8, "most_played": 7}
    fr = freshness(read_bronze(spark, lake.bronze("reviews"))).first()
    assert fr.row_count == 8 and fr.latest is not None


def test_touched_days_equal_full_rebuild(spark, tmp_path):
    lakes = {m: Lake(str(tmp_path / m)) for m in ("full", "touched")}
    for mode, lake in lakes.items():
        write_pipeline_fixture(lake.landing)
        load_raw(spark, lake)
        build(spark, lake, daily_mode=mode, run_tests=False)
        # new data touching one old day (r1 edited again) and a new day
        write(lake.landing, "reviews", "2024-03-03 06:00:00", [
            review("r1", 10, "2024-03-01 01:00:00", "2024-03-02 23:00:00", True, 100, 0.9),
            review("r8", 20, "2024-03-01 02:00:00", "2024-03-01 02:00:00", True, 7, 0.2)])
        write(lake.landing, "most_played", "2024-03-03 06:00:00", [
            {"appid": 20, "rank": 1, "last_week_rank": 2, "peak_in_game": 1, "rollup_date": None}])
        load_raw(spark, lake)
        build(spark, lake, daily_mode=mode, run_tests=False)
    got = {m: sorted(map(tuple, gold_tables(spark, l)["fact_daily_game_performance"].collect()))
           for m, l in lakes.items()}
    assert got["full"] == got["touched"] and len(got["full"]) == 7
    from strata.operators.incremental import SnapshotTable
    t = SnapshotTable(spark, lakes["touched"].gold("fact_daily_game_performance"), partition_by="activity_date")
    parts = t.current()["partitions"]
    # only the touched days were rewritten; 2024-03-02 is carried over
    assert parts["2024-03-01"] == 2 and parts["2024-03-03"] == 2 and parts["2024-03-02"] == 1


def test_incremental_silver_equals_views(spark, tmp_path):
    """Incremental silver + touched days give the same gold as full rebuilds."""
    modes = {"views": dict(), "incremental": dict(silver_mode="incremental", daily_mode="touched")}
    lakes = {m: Lake(str(tmp_path / m)) for m in modes}
    for m, lake in lakes.items():
        write_pipeline_fixture(lake.landing)
        load_raw(spark, lake)
        _, checks = build(spark, lake, **modes[m])
        assert [c.name for c in checks if not c.passed] == []
        write(lake.landing, "reviews", "2024-03-03 06:00:00", [
            review("r1", 10, "2024-03-01 01:00:00", "2024-03-02 23:00:00", True, 100, 0.9),
            review("r4", 20, "2024-03-01 03:00:00", "2024-03-02 23:00:00", True, 50, 0.1),
            review("r8", 20, "2024-03-03 02:00:00", "2024-03-03 02:00:00", None, 7, 0.2)])
        write(lake.landing, "most_played", "2024-03-03 06:00:00", [
            {"appid": 20, "rank": 1, "last_week_rank": 2, "peak_in_game": 1, "rollup_date": None},
            {"appid": 50, "rank": 2, "last_week_rank": -1, "peak_in_game": 2, "rollup_date": None}])
        write(lake.landing, "app_details", "2024-03-03 06:00:00", [
            {"appid": 20, "success": False, "error": "HTTP 429"},
            {"appid": 50, "success": True, "data": {"name": "Gamma", "developers": ["G"]}}])
        load_raw(spark, lake)
        build(spark, lake, **modes[m])
    got = {}
    for m, lake in lakes.items():
        g = gold_tables(spark, lake)
        got[m] = {n: sorted(map(repr, g[n].drop("genres").collect() if "genres" in g[n].columns
                                else g[n].collect()))
                  for n in ("dim_game", "fact_review", "fact_daily_game_performance")}
    for n in got["views"]:
        assert got["views"][n] == got["incremental"][n], n
    assert len(got["views"]["fact_daily_game_performance"]) == 8


def test_build_with_only_the_chart(spark, tmp_path):
    """Datasets that never received a file are empty tables, not errors."""
    lake = Lake(str(tmp_path / "lake"))
    write(lake.landing, "most_played", "2024-03-01 06:00:00",
          [{"appid": 1, "rank": 1, "last_week_rank": -1, "peak_in_game": 5, "rollup_date": None}])
    load_raw(spark, lake)
    _, checks = build(spark, lake)
    assert [c.name for c in checks if not c.passed] == []
    g = gold_tables(spark, lake)
    assert [r.game_name for r in g["dim_game"].collect()] == ["Unknown (1)"]
    r = g["fact_daily_game_performance"].first()
    assert (r.reviews_total, r.snapshot_player_count, r.positive_review_ratio) == (0, None, None)
    assert g["fact_review"].count() == 0


def test_uncommitted_batch_is_invisible(spark, built):
    """A batch folder still being written (no _SUCCESS) is not read by consumers."""
    import os
    from strata.sources.bronze import committed_batches
    lake = built[0]
    src = lake.bronze("reviews")
    before = read_bronze(spark, src).count()
    ids = committed_batches(spark, src)
    part = f"{src}/batch_id=999"
    read_bronze(spark, src, batches=ids[:1]).write.parquet(part)
    os.remove(os.path.join(part, "_SUCCESS"))
    assert committed_batches(spark, src) == ids
    assert read_bronze(spark, src).count() == before


@pytest.mark.parametrize("modes", [dict(), dict(silver_mode="incremental", daily_mode="touched",
                                                review_mode="loaded_at")])
def test_duplicate_and_reordered_files_do_not_change_gold(spark, tmp_path, modes):
    """A file landed twice under another name, and files loaded in another
    order and in separate runs, give the same gold tables."""
    import glob
    import shutil
    ref_lake = Lake(str(tmp_path / "ref"))
    write_pipeline_fixture(ref_lake.landing)
    load_raw(spark, ref_lake)
    build(spark, ref_lake, **modes)

    lake = Lake(str(tmp_path / "dup"))
    staging = str(tmp_path / "staging")
    write_pipeline_fixture(staging)
    files = sorted(glob.glob(f"{staging}/**/*.ndjson", recursive=True), reverse=True)
    for i, f in enumerate(files):  # newest files first, one load + build per four files
        rel = f[len(staging) + 1:]
        dst = f"{lake.landing}/{rel}"
        import os
        os.makedirs(os.path.dirname(dst), exist_ok=True)
        shutil.copy(f, dst)
        if i == 0:
            shutil.copy(f, dst.replace(".ndjson", "_copy.ndjson"))
        if i % 4 == 3 or i == len(files) - 1:
            load_raw(spark, lake)
            # until all have arrived, reviews may lack their game: a test rightly stops such a build
            build(spark, lake, run_tests=i == len(files) - 1, **modes)

    def snap(l):
        # float sums depend on row order: compare doubles to 12 decimals
        g = gold_tables(spark, l)
        rnd = lambda r: tuple(round(v, 12) if isinstance(v, float) else v for v in r)
        return {n: sorted(map(repr, map(rnd, g[n].drop("genres").collect() if "genres" in g[n].columns
                                        else g[n].collect())))
                for n in ("dim_game", "fact_daily_game_performance")}
    a, b = snap(lake), snap(ref_lake)
    for n in a:
        assert sorted(set(a[n]) ^ set(b[n])) == [], n


def test_ingest_archives_loaded_files(spark, tmp_path):
    import glob
    import time
    root = str(tmp_path)
    write(f"{root}/raw", "most_played", "2024-03-01 06:00:00",
          [{"appid": 1, "rank": 1, "last_week_rank": 1, "peak_in_game": 1, "rollup_date": None}])
    write(f"{root}/raw", "most_played", "2024-03-02 06:00:00",
          [{"appid": 2, "rank": 1, "last_week_rank": 1, "peak_in_game": 1, "rollup_date": None}])
    kw = dict(stage_root=f"{root}/raw", archive_dir=f"{root}/archive", max_files_per_trigger=1)
    first = ingest(spark, f"{root}/raw/most_played", f"{root}/bronze", f"{root}/chk", **kw)
    assert first.rows == 2
    # files of committed batches are moved out of the landing folder (cleanup is asynchronous)
    for _ in range(20):
        if not glob.glob(f"{root}/raw/most_played/**/*.ndjson", recursive=True):
            break
        ingest(spark, f"{root}/raw/most_played", f"{root}/bronze", f"{root}/chk", **kw)
        time.sleep(0.5)
    assert len(glob.glob(f"{root}/archive/**/*.ndjson", recursive=True)) >= 1
    assert read_bronze(spark, f"{root}/bronze").count() == 2
