import random
import statistics

import pytest
from pyspark.sql import functions as F

from strata.operators.aggregates import activity_metrics, exact_median


def _data(seed=7):
    rnd = random.Random(seed)
    rows = []
    # a hot group holding a third of all rows, many distinct values
    for _ in range(1500):
        rows.append(("hot", rnd.choice([rnd.uniform(-1e6, 1e6), float(rnd.randint(0, 50)), 1e-300])))
    for g in range(200):
        n = rnd.randint(1, 12)
        for _ in range(n):
            rows.append((f"g{g}", rnd.choice([float(rnd.randint(0, 20)), rnd.uniform(0, 5), None])))
    rows.append(("only_null", None))
    return rows


def _expected(rows):
    groups = {}
    for k, v in rows:
        groups.setdefault(k, [])
        if v is not None:
            groups[k].append(v)
    out = {}
    for k, vs in groups.items():
        if vs:
            s = sorted(vs)
            lo, hi = s[(len(s) - 1) // 2], s[len(s) // 2]
            out[k] = lo if lo == hi else lo + (hi - lo) * 0.5
    return out


def test_exact_median_matches_brute_force(spark):
    rows = _data() + [("inf", v) for v in (float("inf"), float("-inf"), 1.0)] + [("infs", float("inf"))] * 2
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in exact_median(df, ["k"], "v").collect()}
    exp = _expected(rows)
    assert set(got) == set(exp)
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12, abs=1e-300), k


def test_median_agrees_with_builtin(spark):
    rows = [(k, float(v)) for k, v in _data(11) if v is not None]
    df = spark.createDataFrame(rows, "k string, v double")
    ours = {r.k: r.median for r in exact_median(df, ["k"], "v").collect()}
    builtin = {r.k: r.m for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    for k in builtin:
        assert ours[k] == pytest.approx(builtin[k], rel=1e-12)


def test_activity_metrics_null_vote_is_negative(spark):
    df = spark.createDataFrame([(1, True, 0.5, 10), (1, None, None, 20), (1, False, 0.1, 31), (1, True, 0.2, 40)],
                               "app int, vote boolean, score double, play bigint")
    r = activity_metrics(df, ["app"], "vote", "score", "play").first()
    assert (r.reviews_total, r.reviews_positive, r.reviews_negative) == (4, 2, 2)
    assert r.avg_weighted_vote_score == pytest.approx(0.8 / 3)
    assert r.median_playtime_at_review_min == 25.5


def test_hot_group_spans_many_tasks(spark):
    """One group with nine tenths of the values: no task ranks more than its range."""
    df = spark.range(60000).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("k"), F.rand(3).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as large data would be dealt
    try:
        plan = exact_median(df, ["k"], "v")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {r.k: r.median for r in plan.collect()}
    assert got[0] == pytest.approx(df.where("k = 0").agg(F.median("v")).first()[0], rel=1e-12)
    placed = plan.inputFiles()[0].rsplit("/", 1)[0]
    pieces = spark.read.parquet(placed).groupBy("_piece").count().collect()
    assert len(pieces) > 1 and max(r["count"] for r in pieces) < 60000 * 0.6
