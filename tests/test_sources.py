import datetime as dt
import glob
import json

from pyspark.sql import functions as F

from strata.sources.ndjson import object_key, to_ndjson, write_ndjson


def test_object_key_layout(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 1, 6, 5, 9), 3), (dt.datetime(2024, 3, 1, 6, 5, 9), None)],
                               "ts timestamp, part int")
    keys = [r[0] for r in df.select(object_key("reviews", "ts", "part")).collect()]
    assert keys == ["raw/reviews/ingest_date=2024-03-01/reviews_20240301T060509_part03.ndjson",
                    "raw/reviews/ingest_date=2024-03-01/reviews_20240301T060509.ndjson"]


def test_ndjson_keeps_unicode_and_microseconds(spark):
    df = spark.createDataFrame([("héllo 😀", dt.datetime(2024, 3, 1, 6, 0, 0, 123456))], "t string, ts timestamp")
    line = to_ndjson(df).first().value
    assert "héllo 😀" in line
    assert json.loads(line)["ts"] == "2024-03-01T06:00:00.123456+00:00"


def test_write_ndjson_partitions_and_skips_empty(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 1, 6), 0), (2, dt.datetime(2024, 3, 2, 6), 1)],
                               "appid long, ts timestamp, part int")
    assert write_ndjson(df.limit(0), root, "x", "ts") is None
    assert not glob.glob(f"{root}/x/**", recursive=True)
    write_ndjson(df, root, "x", "ts", ["appid"], part="part")
    files = sorted(glob.glob(f"{root}/x/*/*/*.txt"))
    assert [f.split("/x/")[1].rsplit("/", 1)[0] for f in files] == [
        "ingest_date=2024-03-01/part=00", "ingest_date=2024-03-02/part=01"]
    lines = [json.loads(x) for f in files for x in open(f)]
    assert sorted(x["appid"] for x in lines) == [1, 2]
