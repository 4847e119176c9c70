"""Event-time streams, pipe status and observed counts."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import state_queries
from strata.plans.build import load_raw
from strata.plans.extract import extract_log, land_counted, land_run, shape_run
from strata.plans.lake_queries import _two_runs
from strata.sources.catalog import Lake
from strata.streaming.status import pipe_status, status_log
from strata.streaming.windows import count_days, day_counts, keep_first, kept_rows, stream_runs

SF = "/root/testdata/sf0.001"
SCHEMA = "id bigint, at timestamp, k string"


def land(root, name, rows):
    os.makedirs(f"{root}/raw", exist_ok=True)
    with open(f"{root}/raw/{name}.json", "w") as f:
        f.writelines(json.dumps({"id": i, "at": at and f"2024-01-{at}", "k": k}) + "\n" for i, at, k in rows)


def days(spark, root):
    return sorted((r.day.day, str(r.k), r.n) for r in day_counts(spark, f"{root}/out").collect())


def test_day_counts_with_late_rows(spark, tmp_root):
    run = lambda: count_days(spark, f"{tmp_root}/raw", SCHEMA, f"{tmp_root}/_chk", f"{tmp_root}/out", "at", ("k",), "2 days")
    land(tmp_root, "a", [(1, "01 10:00:00", "x"), (2, "01 11:00:00", "x"), (3, "05 12:00:00", None), (4, None, "x")])
    first = run()
    assert (first.rows, first.timed, first.counted, first.late) == (4, 3, 3, 0)
    # the watermark stands at the 3rd, noon: the 2nd is over, the 3rd is not
    land(tmp_root, "b", [(5, "02 23:00:00", "x"), (6, "03 01:00:00", "x"), (7, "05 13:00:00", None), (8, "09 00:00:00", "x")])
    second = run()
    assert (second.rows, second.counted, second.late) == (4, 3, 1)
    assert second.watermark.startswith("2024-01-07T00:00:00")
    assert days(spark, tmp_root) == [(1, "x", 2), (3, "x", 1), (5, "None", 2), (9, "x", 1)]
    third = run()  # nothing new landed
    assert (third.rows, third.counted, third.late) == (0, 0, 0)
    log = {r.run: (r.rows, r.late) for r in stream_runs(spark, f"{tmp_root}/out").collect()}
    assert log[first.run] == (4, 0) and log[second.run] == (4, 1)


def test_day_counts_in_many_batches_equal_the_batch_count(spark, tmp_root):
    rows = [(i, f"{1 + i // 40:02d} {i % 24:02d}:00:00", "xyz"[i % 3]) for i in range(400)]
    for n in range(8):
        land(tmp_root, f"f{n}", rows[n * 50:(n + 1) * 50])
    done = count_days(spark, f"{tmp_root}/raw", SCHEMA, f"{tmp_root}/_chk", f"{tmp_root}/out", "at", ("k",), "3 days", files_per_batch=1)
    batch = spark.read.schema(SCHEMA).json(f"{tmp_root}/raw").groupBy(F.day("at").alias("d"), "k").count().collect()
    assert days(spark, tmp_root) == sorted((r.d, r.k, r["count"]) for r in batch)
    assert done.rows == done.counted == 400 and done.state_rows <= 5 * 3  # closed days have left the state


def test_overlapping_extractions_and_their_state(spark, tmp_root):
    runs = state_queries.overlap_runs(spark, SF, tmp_root)
    ev = spark.read.parquet(f"{SF}/events.parquet")
    kept = kept_rows(spark, f"{tmp_root}/out", state_queries.EVENT)
    assert kept.count() == ev.count() == kept.select("event_id").distinct().count() == sum(r.counted for r in runs)
    assert sum(r.late for r in runs) == sum(r.rows for r in runs) - ev.count()
    # a key stays for the delay behind the watermark, itself a delay behind: two days of six
    two_days = ev.groupBy(F.to_date("ts")).count().agg(F.max("count")).first()[0] * 3
    assert all(0 < r.state_rows <= two_days for r in runs)


def test_repeats_in_one_file_and_rows_without_time(spark, tmp_root):
    land(tmp_root, "a", [(1, "01 10:00:00", "x"), (1, "01 10:00:00", "y"), (2, None, "x"), (None, "01 10:00:00", "z"), (None, "01 10:00:00", "z")])
    done = keep_first(spark, f"{tmp_root}/raw", SCHEMA, f"{tmp_root}/_chk", f"{tmp_root}/out", ["id"], "at")
    assert sorted(str(r.id) for r in kept_rows(spark, f"{tmp_root}/out", SCHEMA).collect()) == ["1", "None"]
    assert (done.rows, done.timed, done.counted, done.late) == (5, 4, 2, 2)
    assert kept_rows(spark, f"{tmp_root}/none", SCHEMA).count() == 0


def test_pipe_status_over_a_failed_load(spark, tmp_root):
    lake = Lake(tmp_root)
    folder = f"{lake.raw('reviews')}/ingest_date=2024-01-01"
    os.makedirs(folder)
    assert {r.dataset: r.state for r in pipe_status(spark, lake).collect()} == dict.fromkeys(
        ("most_played", "player_counts", "reviews", "app_details"), "NEVER RUN")
    with open(f"{folder}/good.ndjson", "w") as f:
        f.write('{"a": 1}\n{"a": 2}\n')
    load_raw(spark, lake, datasets=("reviews",))
    with open(f"{folder}/bad.ndjson", "w") as f:
        f.write('{"a": 3}\n{broken\n')
    with pytest.raises(Exception, match="MALFORMED"):
        load_raw(spark, lake, datasets=("reviews",))
    row = pipe_status(spark, lake, ("reviews",)).first()
    assert (row.state, row.loaded_files, row.loaded_rows, row.pending_files) == ("FAILED", 1, 2, 1)
    assert row.lag_seconds >= 0 and "MALFORMED" in row.last_error
    with open(f"{folder}/bad.ndjson", "w") as f:  # mended: the same file is loaded now
        f.write('{"a": 3}\n')
    load_raw(spark, lake, datasets=("reviews",))
    row = pipe_status(spark, lake, ("reviews",)).first()
    assert (row.state, row.last_rows, row.loaded_rows, row.pending_files, row.lag_seconds) == ("SUCCEEDED", 1, 3, 0, None)
    assert "MALFORMED" in row.last_error and row.last_error_at is not None
    assert status_log(spark, lake).count() == 3


def test_run_counts_take_no_second_job(spark, tmp_root):
    shaped = shape_run(_two_runs(spark, SF), top_n=1 << 30, chunk_size=3, datasets=("most_played", "player_counts"))
    runs = [dt.datetime(2024, 3, d, 6) for d in (1, 2, 3)]
    sc, jobs = spark.sparkContext, {}
    for name, land_all in (("plain", lambda: land_run(Lake(f"{tmp_root}/a"), shaped)),
                           ("counted", lambda: land_counted(Lake(f"{tmp_root}/b"), shaped, runs))):
        sc.setJobGroup(f"{tmp_root}-{name}", name)
        out = land_all()
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(f"{tmp_root}-{name}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["counted"] == jobs["plain"] + 1  # the one that writes the log
    landed = {ds: df.groupBy("run_ts").count().collect() for ds, df in shaped.items()}
    expected = {(r.run_ts, ds): r["count"] for ds, rows in landed.items() for r in rows}
    assert {(run, ds): n for run, ds, n, _ in out if n} == expected
    assert [n for run, _, n, _ in out if run == runs[2]] == [0, 0]
    assert extract_log(spark, Lake(f"{tmp_root}/b")).count() == 6
