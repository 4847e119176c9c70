import pytest
from pyspark.sql import functions as F

from strata.functions.variant import explode_array, explode_object, project_paths, vget
from strata.operators.dedup import first_occurrence, latest_by


def _docs(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "s string").select(F.parse_json("s").alias("v"))


def test_paths_casts_and_missing(spark):
    df = _docs(spark, ['{"a": {"b": {"c": 7}}, "arr": ["x", "y"], "objs": [{"d": "z"}], '
                       '"n": "0.502", "age": 18, "e": 1700000000, "iso": "2024-03-01T06:00:00.123456+00:00"}'])
    spec = {"c": ("$.a.b.c", "bigint"), "first": ("$.arr[0]", "string"), "oob": ("$.arr[5]", "string"),
            "d": ("$.objs[0].d", "string"), "n": ("$.n", "double"), "age": ("$.age", "string"),
            "e": ("$.e", "epoch"), "iso": ("$.iso", "timestamp"), "missing": ("$.zz", "bigint"),
            "sub": ("$.arr", "variant")}
    r = project_paths(df, "v", spec).first()
    assert (r.c, r.first, r.oob, r.d, r.n, r.age, r.missing) == (7, "x", None, "z", 0.502, "18", None)
    assert r.iso.microsecond == 123456
    assert r.sub is not None


def test_strict_vs_lenient_cast(spark):
    df = _docs(spark, ['{"k": "not a number"}'])
    assert project_paths(df, "v", {"k": ("$.k", "bigint")}, strict=False).first().k is None
    with pytest.raises(Exception):
        project_paths(df, "v", {"k": ("$.k", "bigint")}, strict=True).collect()


def test_explode_array_and_object(spark):
    df = _docs(spark, ['{"r": [{"id": 1}, {"id": 2}], "o": {"12": 1, "3": 2}}'])
    a = explode_array(df, "v", "$.r").select("pos", vget("item", "$.id", "bigint").alias("id")).collect()
    assert [(x.pos, x.id) for x in a] == [(0, 1), (1, 2)]
    o = explode_object(df, "v", "$.o").select("key").collect()
    assert sorted(x.key for x in o) == ["12", "3"]


def test_latest_by_nulls_first_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 10, "f1"), ("a", None, 5, "f2"), ("b", 2, 1, "f1"),
                                ("b", 2, 1, "f2"), ("c", 3, None, "f1"), ("c", 3, 4, "f2")],
                               "k string, upd int, ext int, f string")
    out = latest_by(df, ["k"], [("upd", "desc"), ("ext", "desc")], [("f", "desc")])
    got = {r.k: (r.upd, r.ext, r.f) for r in out.collect()}
    assert got == {"a": (None, 5, "f2"), "b": (2, 1, "f2"), "c": (3, None, "f1")}


def test_latest_by_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    plan = latest_by(df, ["k"], [("t", "desc")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_first_occurrence(spark):
    df = spark.createDataFrame([("x", 1, 0), ("x", 0, 3), ("y", 2, 1)], "id string, page int, pos int")
    got = {r.id: (r.page, r.pos) for r in first_occurrence(df, ["id"], ["page", "pos"]).collect()}
    assert got == {"x": (0, 3), "y": (2, 1)}


def test_integer_cast_rounding_option(spark):
    df = _docs(spark, ['{"a": 1.5, "b": -2.5, "c": "3.5", "d": 7}'])
    r = project_paths(df, "v", {k: (f"$.{k}", "bigint_half_up") for k in "abcd"}).first()
    assert (r.a, r.b, r.c, r.d) == (2, -3, 4, 7)
    t = project_paths(df, "v", {"a": ("$.a", "bigint")}).first()
    assert t.a == 1  # the plain cast truncates
