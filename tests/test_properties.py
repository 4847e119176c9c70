"""Property and invariant tests."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.responses import keep_reviews

RUN = dt.datetime(2024, 3, 2, 6, 0)
CUT = int(dt.datetime(2024, 3, 1, 6, 0, tzinfo=dt.timezone.utc).timestamp())

review = st.tuples(st.sampled_from("abcdefgh"),
                   st.one_of(st.none(), st.integers(CUT - 3, CUT + 3)))
page = st.one_of(st.just("error"),
                 st.tuples(st.lists(review, max_size=4),
                           st.sampled_from(["next", "same", "missing"])))


def simulate(pages, max_pages):
    """The paging loop, page by page, as a plain Python reference."""
    kept, seen, cursor = [], set(), "c0"
    for no, p in enumerate(pages[:max_pages]):
        if p == "error":
            break
        items, nxt = p
        if not items:
            break
        crossed = False
        for rid, created in items:
            if rid in seen:
                continue
            seen.add(rid)
            if (created or 0) < CUT:
                crossed = True
                continue
            kept.append((rid, no))
        nc = {"next": f"c{no + 1}", "same": cursor, "missing": None}[nxt]
        if crossed or nc is None or nc == cursor:
            break
        cursor = nc
    return sorted(kept)


def to_items(pages):
    rows = []
    for no, p in enumerate(pages):
        cursor = f"c{no}"
        if p == "error":
            rows.append((no, 0, cursor, None, "HTTP 500", None, None))
            continue
        items, nxt = p
        nc = {"next": f"c{no + 1}", "same": cursor, "missing": None}[nxt]
        if not items:
            rows.append((no, 0, cursor, nc, None, None, None))
        for pos, (rid, created) in enumerate(items):
            rows.append((no, pos, cursor, nc, None, rid, created))
    return rows


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(pages=st.lists(page, min_size=1, max_size=6), max_pages=st.integers(1, 6))
def test_paging_rules_match_the_loop(spark, pages, max_pages):
    df = (spark.createDataFrame(to_items(pages), "page_no int, pos int, cursor string, next_cursor string, "
                                                 "error string, recommendationid string, timestamp_created long")
          .withColumn("run_ts", F.lit(RUN).cast("timestamp")).withColumn("appid", F.lit(1).cast("long")))
    got = sorted((r.recommendationid, r.page_no) for r in keep_reviews(df, 24, max_pages).collect())
    assert got == simulate(pages, max_pages)


def test_pipeline_invariants(spark):
    """§1.7 invariants on the full pipeline over the test tables."""
    from strata.plans.analogs import _pipeline_lake
    from strata.plans.build import gold_tables
    g = gold_tables(spark, _pipeline_lake(spark, "/root/testdata/sf0.001"))
    f = g["fact_daily_game_performance"]
    bad = f.where((F.col("reviews_positive") + F.col("reviews_negative") != F.col("reviews_total"))
                  | ((F.col("reviews_total") == 0) != F.col("positive_review_ratio").isNull())
                  | ((F.col("reviews_total") == 0) != F.col("median_playtime_at_review_min").isNull()))
    assert bad.isEmpty()
    assert f.join(g["dim_game"], "game_key", "left_anti").isEmpty()
    assert g["dim_game"].where(F.col("has_store_page").isNull() | F.col("game_name").isNull()).isEmpty()
    assert g["rpt_daily_game_performance"].count() == f.count()
