import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata.operators.responses import (chart_work_list, details_envelope, flatten_chart,
                                        flatten_review_pages, project_player_counts, run_counts,
                                        scope_to_chart, stamp)

RUN = dt.datetime(2024, 3, 2, 6, 0)
CUT = int(dt.datetime(2024, 3, 1, 6, 0, tzinfo=dt.timezone.utc).timestamp())


def resp(spark, rows, schema="appid long, page_no int, cursor string, body string, error string"):
    df = spark.createDataFrame(rows, schema)
    return df.select(F.lit(RUN).cast("timestamp").alias("run_ts"), "*").withColumn("body", F.parse_json("body"))


def test_chart_flatten_top_n_and_guard(spark):
    body = json.dumps({"response": {"ranks": [{"appid": a, "rank": i + 1, "last_week_rank": -1,
                                               "peak_in_game": 5} for i, a in enumerate([7, 3, 9])],
                                    "rollup_date": 1700000000}})
    r = resp(spark, [(0, 0, None, body, None)])
    out = flatten_chart(r, top_n=2).collect()
    assert [(x.pos, x.appid, x.rank, x.rollup_date) for x in out] == [(0, 7, 1, 1700000000), (1, 3, 2, 1700000000)]
    assert json.loads(flatten_chart(r, top_n=1).select(F.to_json("record").alias("j")).first().j) == {
        "appid": 7, "rank": 1, "last_week_rank": -1, "peak_in_game": 5, "rollup_date": 1700000000}
    with pytest.raises(Exception, match="no ranks"):
        flatten_chart(resp(spark, [(0, 0, None, '{"response": {"ranks": []}}', None)]), top_n=2).collect()
    work = chart_work_list(flatten_chart(r, top_n=3), chunk_size=2).collect()
    assert sorted((w.dataset, w.part, w.appid) for w in work if w.dataset == "reviews") == [
        ("reviews", 0, 3), ("reviews", 0, 7), ("reviews", 1, 9)]
    scoped = scope_to_chart(spark.createDataFrame([(3,), (4,)], "appid long"), flatten_chart(r, top_n=3))
    assert [x.appid for x in scoped.collect()] == [3]


def test_player_counts_and_details(spark):
    pc = resp(spark, [(1, 0, None, '{"response": {"player_count": 5, "result": 1}}', None),
                      (2, 0, None, '{"response": {}}', None), (3, 0, None, None, "404")])
    got = sorted((r.appid, r.player_count, r.result) for r in project_player_counts(pc).collect())
    assert got == [(1, 5, 1), (2, None, None)]
    det = resp(spark, [(10, 0, None, '{"10": {"success": true, "data": {"name": "A"}}}', None),
                       (11, 0, None, '{"11": {"success": false}}', None),
                       (12, 0, None, '{"99": {"success": true, "data": {"name": "B"}}}', None),
                       (13, 0, None, None, "timeout")])
    d = {r.appid: r for r in details_envelope(det).collect()}
    assert d[10].success is True and json.loads(d[10].data.toJson())["name"] == "A"
    assert (d[11].success, d[11].data) == (False, None)
    assert (d[12].success, d[12].data) == (False, None)
    assert (d[13].success, d[13].error) == (False, "timeout")
    assert run_counts(spark.createDataFrame([("a",), ("a",), ("b",)], "dataset string")).count() == 2


def test_stamp_precedence(spark):
    df = spark.createDataFrame([('{"x": 1}',), ('{"_source": "mine"}',), ('{"_source": null}',)], "s string")
    df = df.select(F.parse_json("s").alias("rec"), F.lit("2024-03-02T06:00:00+00:00").alias("ts"))
    got = [(r._source, r._extracted_at) for r in stamp(df, "rec", "appreviews", "ts").collect()]
    assert got == [("appreviews", "2024-03-02T06:00:00+00:00"), ("mine", "2024-03-02T06:00:00+00:00"),
                   (None, "2024-03-02T06:00:00+00:00")]


def _page(reviews, cursor):
    return json.dumps({"reviews": reviews, "cursor": cursor})


def _rev(rid, created):
    r = {"recommendationid": rid}
    if created is not None:
        r["timestamp_created"] = created
    return r


def test_review_paging_rules(spark):
    rows = [
        # app 1: overlap between pages, exact-cutoff kept, older one stops paging after page 1
        (1, 0, "*", _page([_rev("a", CUT + 10), _rev("b", CUT + 5)], "c1"), None),
        (1, 1, "c1", _page([_rev("b", CUT + 5), _rev("c", CUT), _rev("d", CUT - 1), _rev("e", CUT + 1)], "c2"), None),
        (1, 2, "c2", _page([_rev("f", CUT + 100)], "c3"), None),
        # app 2: missing timestamp counts as 0 -> dropped and stops paging
        (2, 0, "*", _page([_rev("g", None), _rev("h", CUT + 1)], "c1"), None),
        (2, 1, "c1", _page([_rev("i", CUT + 1)], "c2"), None),
        # app 3: a failed page stops before it
        (3, 0, "*", _page([_rev("j", CUT + 1)], "c1"), None),
        (3, 1, "c1", None, "HTTP 500"),
        (3, 2, "c2", _page([_rev("k", CUT + 1)], "c3"), None),
        # app 4: repeated cursor stops after the page; empty page stops before it
        (4, 0, "*", _page([_rev("l", CUT + 1)], "*"), None),
        (4, 1, "*", _page([_rev("m", CUT + 1)], "c2"), None),
        (5, 0, "*", _page([_rev("n", CUT + 1)], "c1"), None),
        (5, 1, "c1", _page([], "c2"), None),
        (5, 2, "c2", _page([_rev("o", CUT + 1)], "c3"), None),
        # app 6: missing cursor stops after the page
        (6, 0, "*", json.dumps({"reviews": [_rev("p", CUT + 1)]}), None),
        (6, 1, "c1", _page([_rev("q", CUT + 1)], "c2"), None),
    ]
    out = flatten_review_pages(resp(spark, rows), lookback_hours=24).collect()
    got = sorted((r.appid, r.recommendationid, r.page_no) for r in out)
    assert got == [(1, "a", 0), (1, "b", 0), (1, "c", 1), (1, "e", 1), (2, "h", 0), (3, "j", 0),
                   (4, "l", 0), (5, "n", 0), (6, "p", 0)]


def test_review_page_cap(spark):
    rows = [(1, p, f"c{p}", _page([_rev(f"r{p}", CUT + 1)], f"c{p + 1}"), None) for p in range(5)]
    out = flatten_review_pages(resp(spark, rows), lookback_hours=24, max_pages=3).collect()
    assert sorted(r.page_no for r in out) == [0, 1, 2]
