"""Driver queries on whole lakes: arrivals, merges, extraction, gates and ledgers.

Each lands records derived from the test tables and runs the library's own
functions on them; ``ORACLES`` states the same results in DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.variant import vget
from strata.operators.incremental import SnapshotTable
from strata.plans import analogs
from strata.plans.analogs import RUN_TS, table
from strata.plans.oracles import _with
from strata.session import scratch_path
from strata.sources import export
from strata.sources.bronze import ingest, read_bronze
from strata.sources.catalog import DATASETS, Lake, source
from strata.sources.ndjson import object_key, write_ndjson
from strata.streaming.ledger import load_history

_SPLIT = "2024-01-16"
_PAGED = 50


def _landed_halves(spark: SparkSession, sf_dir: str, name: str):
    """A lake, and a function that lands and loads its first or second half."""
    from strata.plans.build import load_raw
    lake, records = Lake(scratch_path(spark, name)), analogs._api_shaped(spark, sf_dir)
    split = F.lit(_SPLIT).cast("timestamp_ntz")

    def land(first: bool) -> None:
        run = {ds: df.where((F.col("_ts") < split) == first) for ds, df in records.items() if ds != "app_details"}
        if first:
            run["app_details"] = records["app_details"]
        analogs._land(lake, run)
        load_raw(spark, lake, datasets=tuple(run))

    return lake, land


def incremental_concurrent_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch lands while a build runs; the next build must take it up whole. Users whose
    first chart row is in that batch have reviews before it."""
    from strata.operators.quality import UNCHARTED
    from strata.plans.build import bronze_batches, build, gold_tables
    lake, land = _landed_halves(spark, sf_dir, "concurrent")
    land(True)
    listed = bronze_batches(spark, lake)
    land(False)  # committed after the build has listed its batches
    build(spark, lake, batches=listed, warn=(UNCHARTED,))
    build(spark, lake, warn=(UNCHARTED,))
    rpt = gold_tables(spark, lake)["rpt_daily_game_performance"]
    return rpt.select(*[F.col(c).cast("double").alias(c) if c in (
        "positive_review_ratio", "avg_weighted_vote_score", "median_playtime_at_review_min") else F.col(c) for c in rpt.columns])


def merge_key_moves_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged orders, some of which move to another partition day: one row for each key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "year").alias("day"), "o_totalprice",
                                                   F.col("o_orderkey").alias("version"))
    moved = orders.where(F.col("o_orderkey") % 7 == 0) \
        .select("o_orderkey", F.add_months("day", 12).alias("day"), (F.col("o_totalprice") + 1).alias("o_totalprice"),
                (F.col("o_orderkey") + (1 << 40)).alias("version"))
    t = SnapshotTable(spark, scratch_path(spark, "moves"), key="o_orderkey", partition_by="day")
    t.upsert(orders, hw_column="version")  # a high-water mark of whole numbers
    t.upsert(moved, hw_column="version")
    t.upsert(orders.withColumn("o_totalprice", F.lit(0.0)), hw_column="version")  # below the mark: skipped
    return t.read().select("o_orderkey", "day", "o_totalprice")


def object_key_wide_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys with chunk numbers from one digit to all that are needed."""
    o = table(spark, sf_dir, "orders").withColumn("ts", F.lit(RUN_TS).cast("timestamp"))
    keyed = o.select("o_orderkey", object_key("orders", "ts", F.floor(F.col("o_orderkey") / 40).cast("int")).alias("object_key"))
    return keyed.groupBy("object_key").agg(F.count("*").alias("n"))


#: Charted apps of one landed chart response, and reviews of one landed page.
_CHARTED, _PAGE = 64, 20


def _two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses of two runs with overlapping charts and reviews whose fields
    collide with the stamps. Every user is in one run at least, a third is in both; a
    run's chart comes in responses of ``_CHARTED`` ids, an app's reviews in pages."""
    ev = table(spark, sf_dir, "events").where("event_type in ('purchase', 'click')")
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    pages = ev.select("user_id", "event_id", "event_type", F.floor(number / _PAGE).cast("int").alias("page_no")) \
        .groupBy("user_id", "page_no").agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))).alias("e"))
    apps = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    runs = F.explode(F.array(*[F.struct(F.lit(i).alias("run"), F.lit(f"2024-03-0{i} 06:00:00").cast("timestamp").alias("run_ts")) for i in (1, 2)]))

    def in_runs(df: DataFrame) -> DataFrame:
        return df.select("*", runs.alias("r")).select("*", "r.run", "r.run_ts").where(F.col("user_id") % 3 != F.col("run"))

    none = F.lit(None).cast("string")
    landed = lambda df, ds, app, page, cursor, body: df.select(
        F.lit(ds).alias("dataset"), app.cast("bigint").alias("appid"), page.cast("int").alias("page_no"), "run_ts",
        cursor.alias("cursor"), F.parse_json(F.to_json(body)).alias("body"), none.alias("error"))
    epoch = F.unix_seconds("run_ts")
    reviews = F.transform("e", lambda x: F.struct(
        x.event_id.cast("string").alias("recommendationid"), epoch.alias("timestamp_created"),
        F.when(x.event_type == "click", F.lit("own")).alias("_source"), F.when(x.event_type == "click", F.lit(-1)).alias("appid")))
    at = lambda page: F.concat(F.lit("c"), page.cast("string"))
    read = landed(in_runs(pages), "reviews", F.col("user_id"), F.col("page_no"), at(F.col("page_no")),
                  F.struct(reviews.alias("reviews"), at(F.col("page_no") + 1).alias("cursor")))
    counts = landed(in_runs(apps), "player_counts", F.col("user_id"), F.lit(0), none,
                    F.struct(F.struct(F.col("n").alias("player_count"), F.lit(1).alias("result")).alias("response")))
    ranks = in_runs(apps).groupBy("run_ts", F.floor(F.col("user_id") / _CHARTED).alias("g")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("user_id").alias("appid"), F.col("user_id").alias("rank"), F.lit("kept").alias("extra")))).alias("ranks"))
    chart = landed(ranks, "most_played", F.lit(0), F.lit(0), none, F.struct(F.struct("ranks", F.lit(7).alias("rollup_date")).alias("response")))
    return chart.unionByName(read).unionByName(counts)


def extract_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs shaped and landed end to end, read back from bronze."""
    from strata.plans.build import load_raw
    from strata.plans.extract import land_run, shape_run
    lake = Lake(scratch_path(spark, "two-runs"))
    responses = _two_runs(spark, sf_dir)
    chosen = ("most_played", "player_counts", "reviews")
    land_run(lake, shape_run(responses, top_n=1 << 30, chunk_size=3, datasets=chosen))
    load_raw(spark, lake, datasets=chosen)
    parts = []
    for ds, name in (("most_played", "$.rank"), ("player_counts", "$.player_count"), ("reviews", "$.recommendationid")):
        b = source(spark, lake, ds)
        parts.append(b.select(
            F.lit(ds).alias("dataset"), F.to_date(F.substring(vget("payload", "$._extracted_at", "string"), 1, 10)).alias("run_date"),
            vget("payload", "$.appid", "bigint").alias("appid"), vget("payload", "$._source", "string").alias("source"),
            vget("payload", name, "string").alias("value"), vget("payload", "$.extra", "string").alias("extra"),
            F.regexp_extract("_file", r"part=(\d+)/", 1).alias("part")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def quarantine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines go to quarantine, the rest is loaded, in lenient mode."""
    root = scratch_path(spark, "quarantine")
    ev = table(spark, sf_dir, "events").withColumn("line", F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("{broken "), F.col("event_id").cast("string")))
                                                   .otherwise(F.to_json(F.struct("event_id"))))
    write_ndjson(ev, f"{root}/raw", "events", "ts", json_text="line")
    ingest(spark, f"{root}/raw/events", f"{root}/bronze", f"{root}/_chk", stage_root=f"{root}/raw", strict=False, quarantine=f"{root}/bad")
    good = read_bronze(spark, f"{root}/bronze").select(F.lit("loaded").alias("kind"), vget("payload", "$.event_id", "bigint").alias("event_id"),
                                                       F.col("_loaded_at").isNotNull().alias("stamped"))
    bad = spark.read.parquet(f"{root}/bad").select(F.lit("quarantined").alias("kind"),
                                                   F.regexp_extract("line", r"(\d+)$", 1).cast("bigint").alias("event_id"),
                                                   F.col("_loaded_at").isNotNull().alias("stamped"))
    return good.unionByName(bad)


def load_history_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded by files of the last two hours, and of a window before all of them."""
    lake = analogs._pipeline_lake(spark, sf_dir)
    recent = load_history(spark, lake, since="2 HOURS").groupBy("dataset").agg(F.sum("rows").cast("bigint").alias("loaded_rows"))
    before = load_history(spark, lake).where(F.col("_loaded_at") > F.current_timestamp()).groupBy("dataset") \
        .agg(F.sum("rows").cast("bigint").alias("loaded_rows"))
    return recent.unionByName(before)


def run_history_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest 20 entries of the run ledger: models, states, counts."""
    from strata.plans.build import run_history
    return run_history(spark, analogs._pipeline_lake(spark, sf_dir)).select(
        "model", "status", "rows", (F.col("ended_at") >= F.col("started_at")).alias("ordered"))


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed date folders by file listing (content unread)."""
    lake = analogs._pipeline_lake(spark, sf_dir)
    listed = export.list_files(spark, f"{lake.landing}/most_played").where(F.col("length") > 0)
    return listed.select(F.regexp_extract("path", r"ingest_date=([0-9-]+)", 1).cast("date").alias("ingest_date")).distinct()


def model_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 17 data tests, counted by ``run_checks`` on tables with planted faults."""
    from strata.operators.quality import model_checks, run_checks
    from strata.plans.build import gold_tables, silver_models
    lake = analogs._pipeline_lake(spark, sf_dir)
    tables = {**silver_models(spark, lake), **gold_tables(spark, lake)}
    reviews = tables["fact_review"]
    tables["fact_review"] = reviews.withColumn("game_key", F.when(F.col("review_id").cast("bigint") % 10 > 0, F.col("game_key"))) \
        .unionByName(reviews.where(F.col("review_id").cast("bigint") % 100 == 1))
    rows = [(r.name, r.failures) for r in run_checks(model_checks(), tables)]  # 17 counts
    return spark.createDataFrame(rows, "name string, failures bigint")


def _sample(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str]) -> DataFrame:
    from strata.plans.build import gold_tables
    g = gold_tables(spark, analogs._pipeline_lake(spark, sf_dir))
    out = scratch_path(spark, "samples")
    export.export_samples(g["rpt_daily_game_performance"], g["dim_game"], g["fact_review"], out)
    whole = {"sample_dim_game": g["dim_game"], "sample_fact_review": g["fact_review"]}[name]
    head = spark.read.option("header", True).csv(f"{out}/{name}").columns
    kinds = {f.name: f.dataType for f in whole.schema.fields}
    flat = lambda t: t if isinstance(t, (T.LongType, T.IntegerType, T.BooleanType, T.DateType, T.DoubleType)) else T.StringType()
    read = spark.read.schema(T.StructType([T.StructField(c, flat(kinds[c])) for c in head])).option("header", True).csv(f"{out}/{name}")
    return read.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])


def export_dim_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension's sample export, read back."""
    return _sample(spark, sf_dir, "sample_dim_game", {
        "game_key": "bigint", "game_name": "string", "total_recommendations": "bigint", "has_store_page": "boolean"})


def export_review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top reviews' sample export, read back. No record has votes, so ids decide."""
    return _sample(spark, sf_dir, "sample_fact_review", {"review_id": "string", "game_key": "bigint", "review_date": "date", "is_positive": "boolean"})


def cast_fractional_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chart model on fractional ranks: an integer cast rounds half away from zero."""
    from strata.plans.silver import silver_most_played
    ev = table(spark, sf_dir, "events").where("event_type = 'view'")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    body = F.to_json(F.struct(F.col("event_id").alias("appid"), (F.floor(F.col("value") * 2) / 2).alias("rank"),
                              (-F.floor(F.col("value") * 2) / 2).alias("last_week_rank"), stamp.alias("_extracted_at")))
    bronze = ev.select(F.parse_json(body).alias("payload"), F.lit("f").alias("_file"), F.current_timestamp().alias("_loaded_at"))
    return silver_most_played(bronze).select("appid", "chart_rank", "last_week_rank")


def cast_lenient_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chart model in lenient mode: a value that can't be cast is NULL."""
    from strata.plans.silver import silver_most_played
    ev = table(spark, sf_dir, "events").where("event_type = 'view'")
    rank = F.when(F.col("event_id") % 3 == 0, F.lit("not a number")).otherwise(F.col("event_id").cast("string"))
    body = F.to_json(F.struct(F.col("event_id").alias("appid"), rank.alias("rank"),
                              F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("_extracted_at")))
    bronze = ev.select(F.parse_json(body).alias("payload"), F.lit("f").alias("_file"), F.current_timestamp().alias("_loaded_at"))
    return silver_most_played(bronze, strict=False).select("appid", "chart_rank")


QUERIES = {
    "incremental_concurrent_arrival": incremental_concurrent_arrival,
    "merge_key_moves_day": merge_key_moves_day,
    "object_key_wide_parts": object_key_wide_parts,
    "extract_two_runs": extract_two_runs,
    "quarantine_lines": quarantine_lines,
    "load_history_window": load_history_window,
    "run_history": run_history_q,
    "file_listing": file_listing,
    "model_tests": model_tests,
    "export_dim_sample": export_dim_sample,
    "export_review_sample": export_review_sample,
    "cast_fractional_int": cast_fractional_int,
    "cast_lenient_null": cast_lenient_null,
}

_RUNS = f"""
WITH app AS (
  SELECT user_id, run, count(*) AS n
  FROM events, (SELECT unnest([1, 2]) AS run) r
  WHERE event_type IN ('purchase', 'click') AND user_id % 3 <> run
  GROUP BY user_id, run),
placed AS (SELECT *, (row_number() OVER (PARTITION BY run, user_id // {_CHARTED} ORDER BY user_id) - 1) // 3 AS part FROM app)"""

_FAULTS = [
    ("not_null:silver_most_played.appid", "0"), ("not_null:silver_most_played.chart_rank", "0"),
    ("unique:silver_reviews.review_id", "0"), ("not_null:silver_reviews.review_id", "0"),
    ("not_null:silver_reviews.appid", "0"), ("not_null:silver_app_details.appid", "0"),
    ("not_null:silver_player_counts.appid", "0"), ("unique:dim_game.game_key", "0"), ("not_null:dim_game.game_key", "0"),
    ("unique:fact_review.review_id", "(SELECT count(*) FROM r WHERE event_id % 100 = 1)"),
    ("not_null:fact_review.review_id", "0"),
    ("not_null:fact_review.game_key", "(SELECT count(*) FROM r WHERE event_id % 10 = 0)"),
    ("relationships:fact_review.game_key->dim_game.game_key",
     "(SELECT count(*) FROM (SELECT user_id FROM r WHERE event_id % 10 > 0 UNION ALL SELECT user_id FROM r WHERE event_id % 100 = 1) x "
     "WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'view'))"),
    ("not_null:fact_daily_game_performance.game_key", "0"), ("not_null:fact_daily_game_performance.activity_date", "0"),
    ("not_null:rpt_daily_game_performance.game_name", "0"), ("grain:fact_daily_game_performance(activity_date,game_key)", "0")]
_CHECKS = ", ".join(f"('{n}', {k})" for n, k in _FAULTS)
_CHECK_NAMES = [n for n, _ in _FAULTS]

ORACLES = {
    "incremental_concurrent_arrival": _with("SELECT * FROM rpt"),
    "merge_key_moves_day": """
SELECT o_orderkey, CAST(date_trunc('year', o_orderdate) + CASE WHEN o_orderkey % 7 = 0 THEN INTERVAL 1 YEAR ELSE INTERVAL 0 YEAR END
       AS DATE) AS day,
       CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders""",
    "object_key_wide_parts": """
SELECT 'raw/orders/ingest_date=2024-01-31/orders_20240131T060000_part' || printf('%02d', CAST(floor(o_orderkey / 40) AS INTEGER))
       || '.ndjson' AS object_key, count(*) AS n
FROM orders GROUP BY 1""",
    "extract_two_runs": _RUNS + """
SELECT 'most_played' AS dataset, DATE '2024-03-01' + (run - 1) AS run_date, user_id AS appid, 'GetMostPlayedGames' AS source,
       CAST(user_id AS VARCHAR) AS value, 'kept' AS extra, '' AS part FROM placed
UNION ALL
SELECT 'player_counts', DATE '2024-03-01' + (run - 1), user_id, 'GetNumberOfCurrentPlayers', CAST(n AS VARCHAR), NULL,
       printf('%02d', CAST(part AS INTEGER)) FROM placed
UNION ALL
SELECT 'reviews', DATE '2024-03-01' + (p.run - 1), CASE WHEN event_type = 'click' THEN -1 ELSE p.user_id END,
       CASE WHEN event_type = 'click' THEN 'own' ELSE 'appreviews' END, CAST(event_id AS VARCHAR), NULL,
       printf('%02d', CAST(part AS INTEGER))
FROM placed p JOIN events e ON e.user_id = p.user_id AND event_type IN ('purchase', 'click')""",
    "quarantine_lines": """
SELECT CASE WHEN event_id % 9 = 0 THEN 'quarantined' ELSE 'loaded' END AS kind, event_id, TRUE AS stamped FROM events""",
    "load_history_window": """
SELECT dataset, CAST(count(*) AS BIGINT) AS loaded_rows FROM (
  SELECT CASE event_type WHEN 'view' THEN 'most_played' WHEN 'signup' THEN 'player_counts' ELSE 'reviews' END AS dataset FROM events
  UNION ALL SELECT 'app_details' FROM customer) x
GROUP BY dataset""",
    "file_listing": "SELECT DISTINCT CAST(ts AS DATE) AS ingest_date FROM events WHERE event_type = 'view'",
    "model_tests": f"""
WITH r AS (SELECT event_id, user_id FROM events WHERE event_type IN ('purchase', 'click', 'error'))
SELECT name, CAST(failures AS BIGINT) AS failures FROM (VALUES {_CHECKS}) t(name, failures)""",
    "export_dim_sample": _with("SELECT game_key, game_name, total_recommendations, has_store_page FROM dim"),
    "export_review_sample": """
SELECT CAST(event_id AS VARCHAR) AS review_id, user_id AS game_key, CAST(ts AS DATE) AS review_date,
       CASE WHEN event_type = 'purchase' THEN TRUE WHEN event_type = 'click' THEN FALSE END AS is_positive
FROM events WHERE event_type IN ('purchase', 'click', 'error') ORDER BY CAST(event_id AS VARCHAR) LIMIT 200""",
    "cast_fractional_int": """
SELECT event_id AS appid, CAST(floor(floor(value * 2) / 2 + 0.5) AS BIGINT) AS chart_rank,
       -CAST(floor(floor(value * 2) / 2 + 0.5) AS BIGINT) AS last_week_rank
FROM events WHERE event_type = 'view'""",
    "cast_lenient_null": """
SELECT event_id AS appid, CASE WHEN event_id % 3 <> 0 THEN event_id END AS chart_rank FROM events WHERE event_type = 'view'""",
    "run_history": _with("""
SELECT model, 'SUCCEEDED' AS status, CAST(n AS BIGINT) AS "rows", TRUE AS ordered FROM (
  SELECT 'dim_game' AS model, (SELECT count(*) FROM dim) AS n
  UNION ALL SELECT 'fact_review', (SELECT count(*) FROM events WHERE event_type IN ('purchase', 'click', 'error'))
  UNION ALL SELECT 'fact_daily_game_performance', (SELECT count(*) FROM rpt)
  UNION ALL SELECT 'silver_most_played', (SELECT count(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events WHERE event_type = 'view') a)
  UNION ALL SELECT 'silver_player_counts', (SELECT count(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events WHERE event_type = 'signup') b)
  UNION ALL SELECT 'silver_reviews', (SELECT count(*) FROM events WHERE event_type IN ('purchase', 'click', 'error'))
  UNION ALL SELECT 'silver_app_details', (SELECT count(*) FROM customer WHERE c_mktsegment <> 'MACHINERY')
  UNION ALL SELECT 'tests (silver)', 7 UNION ALL SELECT 'tests (gold)', 9 UNION ALL SELECT 'tests (report)', 1) x"""),
}
