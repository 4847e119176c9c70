"""Merged daily state, compacted bronze, tests on deltas, and models in the catalog."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import activity_metrics
from strata.operators.daily_state import DailyState
from strata.operators.incremental import SnapshotTable
from strata.operators.quality import changed_rows, rows_of_changed_keys
from strata.plans import analogs, state_queries
from strata.plans.build import build, commits, gold_tables, load_raw, stored_models
from strata.sources.bronze import committed_batches, committed_units, compact_bronze, read_bronze
from strata.sources.catalog import Lake
from strata.sources.views import publish, publish_star

SF = "/root/testdata/sf0.001"
REVIEW = "review_id string, appid bigint, created_at timestamp, voted_up boolean, weighted_vote_score double, playtime_at_review_min bigint"


def review(i, app, day, vote=True, score=0.5, play=10):
    return (f"r{i}", app, dt.datetime(2024, 1, day, 5) if day else None, vote, score, play)


def plain(spark, rows):
    df = spark.createDataFrame(rows, REVIEW).withColumn("review_date", F.to_date("created_at"))
    return as_rows(activity_metrics(df.where("review_date is not null"), ["appid", "review_date"], "voted_up", "weighted_vote_score", "playtime_at_review_min"))


def as_rows(df):
    return sorted((r.appid, r.review_date, r.reviews_total, r.reviews_positive, r.reviews_negative,
                   r.avg_weighted_vote_score and round(r.avg_weighted_vote_score, 9), r.median_playtime_at_review_min) for r in df.collect())


def test_state_equals_the_whole_computation(spark, tmp_root):
    state = DailyState(spark, tmp_root)
    first = [review(i, i % 3, 1 + i % 4, [True, False, None][i % 3], None if i % 7 == 0 else i / 10, None if i % 5 == 0 else i) for i in range(60)]
    more = [review(100 + i, i % 2, 2, True, 0.1, 7) for i in range(20)]
    as_df = lambda rows: spark.createDataFrame(rows, REVIEW)
    assert state.merge(as_df(first)) == [f"2024-01-0{d}" for d in (1, 2, 3, 4)]
    assert as_rows(state.daily()) == plain(spark, first)
    # new reviews, and ten old ones with another vote, score, playtime and day
    changed = [review(i, i % 3, 3, False, 9.25, 1000 + i) for i in range(10)]
    assert state.merge(as_df(more + changed), as_df(first[:10])) == [f"2024-01-0{d}" for d in (1, 2, 3, 4)]
    assert as_rows(state.daily()) == plain(spark, first[10:] + changed + more)
    # a day whose reviews all go disappears; a review without a time belongs to no day
    day4 = [r for r in first[10:] if r[2].day == 4]
    assert state.merge(as_df([review(500, 1, None)]), as_df(day4)) == ["2024-01-04", "__HIVE_DEFAULT_PARTITION__"]
    assert "2024-01-04" not in state.table.current()["partitions"]
    left = [r for r in first[10:] if r[2].day != 4] + changed + more
    assert as_rows(state.daily([f"2024-01-0{d}" for d in (1, 2, 3)])) == plain(spark, left)


def test_state_follows_a_table_and_reads_the_changed_days_only(spark, tmp_root):
    t = SnapshotTable(spark, f"{tmp_root}/reviews", key="review_id", partition_by="day")
    as_df = lambda rows: spark.createDataFrame(rows, REVIEW).withColumn("day", F.to_date("created_at"))
    state = DailyState(spark, f"{tmp_root}/state")
    assert state.follow(t) == []
    rows = [review(i, i % 3, 1 + i % 5) for i in range(50)]
    t.upsert(as_df(rows), mode="newer")
    assert len(state.follow(t)) == 5 and state.follow(t) == []
    new = [review(0, 0, 1, False, 2.5, 99), review(70, 1, 2)]
    t.upsert(as_df(new), mode="newer")
    assert state.follow(t, as_df(new).select("review_id")) == ["2024-01-01", "2024-01-02"]
    assert as_rows(state.daily()) == plain(spark, rows[1:] + new)
    # the merge reads the touched days of the state, the daily rows of a day that day
    files = state.merged(state.table.read(["2024-01-01"]), ["2024-01-01"]).inputFiles()
    assert files and all("review_date=2024-01-01" in f for f in files)
    # versions that are gone: built anew
    for n in range(4):
        t.upsert(as_df([review(80 + n, 1, 3)]), mode="newer")
    assert len(state.follow(t, as_df(new).select("review_id"))) == 5
    assert as_rows(state.daily()) == plain(spark, rows[1:] + new + [review(80 + n, 1, 3) for n in range(4)])


def _batches(spark, root, ids):
    for b in ids:
        spark.createDataFrame([(f'{{"b": {b}, "n": {n}}}', f"f{b}") for n in range(3)], "j string, _file string") \
            .select(F.parse_json("j").alias("payload"), "_file", F.current_timestamp().alias("_loaded_at")).coalesce(1) \
            .write.mode("overwrite").parquet(f"{root}/batch_id={b}")


def _read(spark, root, **kw):
    return sorted((r.batch_id, r.j) for r in read_bronze(spark, root, **kw).select("batch_id", F.to_json("payload").alias("j")).collect())


def test_compaction_loses_and_doubles_nothing(spark, tmp_root, monkeypatch):
    _batches(spark, tmp_root, range(6))
    whole = _read(spark, tmp_root)
    assert len(whole) == 18
    # broken off while it writes: no _SUCCESS, nothing counts
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda self, path: os.makedirs(path) or (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        compact_bronze(spark, tmp_root)
    monkeypatch.undo()
    assert _read(spark, tmp_root) == whole
    made = compact_bronze(spark, tmp_root)
    assert [(u.first, u.last) for u in made] == [(0, 4)]
    # the old folders are still there, and don't count
    assert os.path.isdir(f"{tmp_root}/batch_id=0") and [(u.first, u.last) for u in committed_units(spark, tmp_root)] == [(0, 4), (5, 5)]
    assert _read(spark, tmp_root) == whole and committed_batches(spark, tmp_root) == list(range(6))
    assert _read(spark, tmp_root, after_batch=2) == [r for r in whole if r[0] > 2]
    assert _read(spark, tmp_root, batches=[0, 3, 5]) == [r for r in whole if r[0] in (0, 3, 5)]
    # the next one removes them, and packs what came since
    _batches(spark, tmp_root, (6, 7))
    compact_bronze(spark, tmp_root)
    assert not os.path.isdir(f"{tmp_root}/batch_id=0")
    assert [(u.first, u.last) for u in committed_units(spark, tmp_root)] == [(0, 6), (7, 7)]
    assert len(_read(spark, tmp_root)) == 24 and [r for r in _read(spark, tmp_root) if r[0] < 6] == whole


def test_compaction_keeps_folders_below_their_bound(spark, tmp_root):
    _batches(spark, tmp_root, range(5))
    one = sum(os.path.getsize(f"{tmp_root}/batch_id=0/{f}") for f in os.listdir(f"{tmp_root}/batch_id=0"))
    made = compact_bronze(spark, tmp_root, keep=0, most_bytes=int(2.5 * one))
    assert [(u.first, u.last) for u in made] == [(0, 1), (2, 3)]
    shutil.rmtree(f"{tmp_root}/batch_id=4")
    _batches(spark, tmp_root, (6,))  # a gap is never packed over
    assert compact_bronze(spark, tmp_root, keep=0) == [] or all(not (u.first <= 4 <= u.last) for u in committed_units(spark, tmp_root))
    assert committed_batches(spark, tmp_root) == [0, 1, 2, 3, 6]


@pytest.fixture(scope="module")
def lake(spark):
    return analogs._incremental_lake(spark, SF)


def test_delta_tests_read_what_changed(spark):
    faulty, since = state_queries._faulty(spark, SF)
    t = stored_models(spark, faulty)["fact_review"]
    changed = changed_rows(t, since["fact_review"])
    assert all(f.split("review_date=")[1][:10] >= "2024-01-16" for f in changed.inputFiles())
    assert changed.count() < t.read().count()
    other = stored_models(spark, faulty)["silver_reviews"]
    assert changed_rows(other, since["silver_reviews"]).count() == 0  # nothing new, nothing read
    twice = t.read().limit(1)
    few = rows_of_changed_keys(t, twice)
    assert few.select("review_id").distinct().count() == 1


def test_builds_with_delta_tests(spark):
    root = Lake(state_queries.scratch_path(spark, "delta-build"))
    records = analogs._api_shaped(spark, SF)
    for drop in (True, False):
        split = F.col("_ts") < F.lit("2024-01-16").cast("timestamp_ntz")
        analogs._land(root, {ds: df.where(split if drop else ~split) for ds, df in records.items() if ds != "app_details" or drop})
        load_raw(spark, root)
        _, checks = build(spark, root, test_mode="delta", daily_mode="state")
        assert len(checks) == 17 and all(c.passed for c in checks)
    assert min(commits(spark, root).values()) >= 1
    with pytest.raises(ValueError):
        build(spark, root, daily_mode="state", silver_mode="view")


def test_models_by_sql_from_another_session(spark, lake):
    names = publish(spark, lake, "by_sql")
    assert len(names) == 8
    other = spark.newSession()
    for name, df in gold_tables(spark, lake).items():
        got = other.sql(f"SELECT * FROM by_sql.{name}")
        columns = [c for c in df.columns if df.schema[c].dataType.simpleString() != "variant"]
        assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, df.select(columns).collect())), name
    day = other.sql("SELECT count(*) FROM by_sql.fact_review WHERE review_date = date'2024-01-20'")
    assert all("review_date=2024-01-20" in f for f in day.inputFiles()) or "PartitionFilters: [isnotnull(review_date" in day._jdf.queryExecution().executedPlan().toString()
    assert "/bronze/" not in other.sql("SELECT * FROM by_sql.silver_reviews")._jdf.queryExecution().toString()
    publish(spark, lake, "by_sql")  # again, after a build


def test_a_null_day_is_a_partition(spark, tmp_root):
    from strata.sources.views import _publish
    t = SnapshotTable(spark, tmp_root, key="id", partition_by="d")
    t.replace(spark.createDataFrame([(1, None), (2, dt.date(2024, 1, 1))], "id int, d date"))
    spark.sql("CREATE DATABASE IF NOT EXISTS with_null")
    _publish(spark, "with_null.t", t)
    assert sorted((r.id, r.d) for r in spark.table("with_null.t").collect()) == [(1, None), (2, dt.date(2024, 1, 1))]


def test_the_bucketed_report_has_no_exchange(spark, lake):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rpt = publish_star(spark, lake, "star", 4)
        rows = rpt.collect()
        plan = rpt._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert sorted(map(str, rows)) == sorted(map(str, gold_tables(spark, lake)["rpt_daily_game_performance"].collect()))
