"""Arrival-driven build: audit rows, no run without data, replay after a failure."""

import pytest

from strata.plans.build import build, gold_tables, load_raw
from strata.sources.catalog import Lake
from strata.streaming.arrival import run_on_arrival, trigger_log
from tests.fixtures import D2, review, write, write_pipeline_fixture


def test_arrival_build_and_retry(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    write_pipeline_fixture(lake.landing)
    load_raw(spark, lake)
    built = []

    def do_build(s, l, run_id):
        built.append(run_id)
        build(s, l, run_id, run_tests=False)

    run_on_arrival(spark, lake, do_build)
    log = trigger_log(spark, lake).collect()
    assert len(log) == 1
    r = log[0]
    assert (r.new_most_played, r.new_player_counts, r.new_reviews, r.new_app_details) == (7, 4, 8, 6)
    assert gold_tables(spark, lake)["fact_review"].count() == 6

    # no new rows: no batch, no build
    run_on_arrival(spark, lake, do_build)
    assert len(built) == 1 and trigger_log(spark, lake).count() == 1

    # new file; the first build attempt fails -> the same batch is replayed
    write(lake.landing, "reviews", "2024-03-03 06:00:00",
          [review("r7", 10, "2024-03-03 01:00:00", "2024-03-03 01:00:00", True, 5, 0.5)])
    load_raw(spark, lake)

    def failing(s, l, run_id):
        raise RuntimeError("warehouse unavailable")

    with pytest.raises(Exception):
        run_on_arrival(spark, lake, failing)
    run_on_arrival(spark, lake, do_build)
    log = sorted(trigger_log(spark, lake).collect(), key=lambda x: x.batch_id)
    assert len(log) == 2 and log[1].new_reviews == 1 and log[1].new_most_played == 0
    assert built[-1] == f"batch-{log[1].batch_id:06d}"
    assert gold_tables(spark, lake)["fact_review"].count() == 7


def test_debounced_arrival_mode(spark, tmp_path):
    """A processing-time trigger: files landing within one interval give one build."""
    lake = Lake(str(tmp_path / "lake"))
    write_pipeline_fixture(lake.landing)
    ingest_q = {}
    from strata.sources.bronze import ingest
    for ds in ("most_played", "player_counts", "reviews", "app_details"):
        ingest_q[ds] = ingest(spark, lake.raw(ds), lake.bronze(ds), lake.ingest_checkpoint(ds),
                              stage_root=lake.landing, ledger=lake.load_ledger(ds),
                              processing_time="1 second")
    built = []
    q = run_on_arrival(spark, lake, lambda s, l, r: built.append(r) or build(s, l, r, run_tests=False),
                       processing_time="1 second")
    try:
        for iq in ingest_q.values():
            iq.processAllAvailable()
        q.processAllAvailable()
    finally:
        q.stop()
        for iq in ingest_q.values():
            iq.stop()
    log = trigger_log(spark, lake).collect()
    assert sum(r.new_reviews for r in log) == 8 and len(built) == len(log) >= 1
    assert gold_tables(spark, lake)["fact_review"].count() == 6


def test_failed_data_test_keeps_the_offset(spark, tmp_path):
    """A build whose tests fail raises: what depends on the model is not built, and the
    arrival stream comes back to the same batch."""
    from strata.operators.quality import ChecksFailed
    from strata.plans.build import run_history
    lake = Lake(str(tmp_path / "lake"))
    write_pipeline_fixture(lake.landing)
    write(lake.landing, "most_played", "2024-03-03 06:00:00", [
        {"_extracted_at": "2024-03-03T06:00:00+00:00", "_source": "x", "rank": 1}])  # no appid
    load_raw(spark, lake)
    tried = []
    for _ in range(2):
        with pytest.raises(Exception):
            run_on_arrival(spark, lake, lambda s, l, run_id: tried.append(run_id) or build(s, l, run_id))
    assert len(tried) == 2 and tried[0] == tried[1]
    assert "fact_review" not in gold_tables(spark, lake)
    with pytest.raises(ChecksFailed, match="silver_most_played.appid"):
        build(spark, lake, "by-hand")
    assert {(r.model, r.status) for r in run_history(spark, lake).collect() if r.run_id == "by-hand"} == {
        ("silver (incremental)", "SUCCEEDED"), ("tests (silver)", "FAILED")}
