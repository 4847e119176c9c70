import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions.semantics import (asc, desc, div0, flag, hours_from_minutes, iff,
                                        minor_units_to_amount, placeholder_name, report_round,
                                        try_date)


def test_div0_and_iff(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (None, 2), (1, None), (None, 0)], "a int, b int")
    got = [r[0] for r in df.select(div0("a", "b")).collect()]
    assert got == [0.0, 0.5, None, None, None]
    row = spark.range(1).select(iff(F.lit(None).cast("boolean"), F.lit("a"), F.lit("b")).alias("x"),
                                flag(F.lit(None).cast("boolean")).alias("f"),
                                flag(F.lit(True)).alias("t")).first()
    assert (row.x, row.f, row.t) == ("b", 0, 1)


def test_rounding_and_money(spark):
    df = spark.createDataFrame([(0.0005, 499, 125), (2.0 / 3, 1, 301)], "x double, m bigint, mins bigint")
    rows = df.select(report_round("x").alias("r"), minor_units_to_amount("m").alias("p"),
                     hours_from_minutes("mins").alias("h")).collect()
    assert rows[0].r == Decimal("0.001") and rows[1].r == Decimal("0.667")
    assert rows[0].p == Decimal("4.990000") and rows[1].p == Decimal("0.010000")
    assert rows[0].h == Decimal("2.1") and rows[1].h == Decimal("5.0")


def test_try_date_formats(spark):
    texts = ["8 Nov, 2013", "09 Nov, 2013", "21 Aug, 2012", "Aug 21, 2012", "2013", "Coming soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(try_date("s")).collect()]
    assert got == [dt.date(2013, 11, 8), dt.date(2013, 11, 9), dt.date(2012, 8, 21), None, None, None, None]


def test_placeholder_and_length(spark):
    df = spark.createDataFrame([(None, 1329410, "a😀é"), ("X", 2, "")], "n string, k bigint, t string")
    rows = df.select(placeholder_name("n", "k").alias("n"), F.length("t").alias("l")).collect()
    assert [r.n for r in rows] == ["Unknown (1329410)", "X"]
    assert [r.l for r in rows] == [3, 0]


def test_null_ordering(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r.v for r in df.orderBy(desc("v")).collect()] == [None, 3, 1]
    assert [r.v for r in df.orderBy(asc("v")).collect()] == [1, 3, None]


def test_cluster_settings_scale_with_input():
    from strata.session import cluster_settings
    small = cluster_settings(1 << 20, executor_cores=8)
    big = cluster_settings(100 << 40, executor_cores=8000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    assert big["spark.sql.adaptive.enabled"] == "true"
