"""Driver queries on state: event-time streams, pipe status, observed counts, merged
daily aggregates, and the run rules (guards, empty runs, shared history, replay).

As in ``lake_queries``, each lands records derived from the test tables and runs the
library's own functions on them; ``ORACLES`` states the same results in DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import analogs
from strata.plans.analogs import table
from strata.plans.lake_queries import _CHECK_NAMES, _RUNS, _two_runs
from strata.plans.oracles import ORACLES as _PLAIN
from strata.plans.oracles import _with
from strata.session import scratch_path
from strata.sources.catalog import DATASETS, Lake
from strata.sources.ndjson import write_ndjson

_DECIMALS = ("positive_review_ratio", "avg_weighted_vote_score", "median_playtime_at_review_min")
EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, run int"

# Three deliveries. An event belongs to the one of its third of January 2024; of every ten,
# one comes a delivery late and one only with the last. The watermark is eight days behind.
_DELAY = "8 days"
_BASE = "CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END"
_DELIVERED = f"CASE WHEN event_id % 10 = 7 THEN 3 WHEN event_id % 10 = 3 THEN least(3, {_BASE} + 1) ELSE {_BASE} END"


def _deliver(df: DataFrame, root: str, run: int) -> None:
    """Land one delivery's events (column ``run``) as NDJSON."""
    stamped = df.where(F.col("run") == run).withColumn("at", F.timestamp_seconds(F.lit(1_710_000_000 + run)))
    write_ndjson(stamped.withColumn("ts", F.col("ts").cast("timestamp")), f"{root}/raw", "events", "at",
                 ["event_id", "ts", "user_id", "event_type", "run"])


def stream_day_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and type from three deliveries, with late ones; and, per delivery,
    how many came behind the watermark."""
    from strata.streaming.windows import count_days, day_counts
    root = scratch_path(spark, "day-bucket")
    ev = table(spark, sf_dir, "events").withColumn("run", F.expr(_DELIVERED))
    late = []
    for run in (1, 2, 3):
        _deliver(ev, root, run)
        done = count_days(spark, f"{root}/raw/events", EVENT, f"{root}/_chk", f"{root}/out", "ts", ("event_type",), _DELAY)
        late.append((run, done.late))
    days = day_counts(spark, f"{root}/out")
    return days.select(F.lit("counted").alias("kind"), F.lit(0).alias("run"), "day", "event_type", "n").unionByName(
        spark.createDataFrame(late, "run int, n bigint").select(
            F.lit("late").alias("kind"), "run", F.lit(None).cast("date").alias("day"), F.lit(None).cast("string").alias("event_type"), "n"))


# Five extractions of six days each, which also hold the day before; the fifth lands the
# first one's rows once more.
_RUN_OF = "least(5, (day(ts) - 1) // 6 + 1)"


def _extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("base", F.expr(_RUN_OF.replace("//", "div")).cast("int"))
    again = ev.where((F.col("base") < 5) & (F.expr("(day(ts) - 1) % 6 = 5"))).withColumn("run", F.col("base") + 1)
    old = ev.where("base = 1").withColumn("run", F.lit(5))
    return ev.withColumn("run", F.col("base")).unionByName(again).unionByName(old)


def overlap_runs(spark: SparkSession, sf_dir: str, root: str) -> list:
    from strata.streaming.windows import keep_first
    ev, runs = _extractions(spark, sf_dir), []
    for run in range(1, 6):
        _deliver(ev, root, run)
        runs.append(keep_first(spark, f"{root}/raw/events", EVENT, f"{root}/_chk", f"{root}/out", ["event_id"], "ts", "24 hours"))
    return runs


def stream_overlap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once, from the first of the overlapping extractions that hold it."""
    from strata.streaming.windows import kept_rows
    root = scratch_path(spark, "overlap")
    overlap_runs(spark, sf_dir, root)
    return kept_rows(spark, f"{root}/out", EVENT).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "run")


def pipe_status_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipes after two ingests, the second with a malformed line among the reviews."""
    from strata.plans.build import load_raw
    from strata.streaming.status import pipe_status
    lake, records = Lake(scratch_path(spark, "pipes")), analogs._api_shaped(spark, sf_dir)
    early = F.col("_ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    chosen = DATASETS[:3]
    analogs._land(lake, {ds: records[ds].where(early) for ds in chosen})
    load_raw(spark, lake, datasets=chosen)
    analogs._land(lake, {ds: records[ds].where(~early) for ds in chosen})
    spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.mode("append").text(f"{lake.raw('reviews')}/ingest_date=2024-02-01")
    try:
        load_raw(spark, lake, datasets=chosen)
    except Exception as e:  # the strict load of the reviews has to fail
        if "MALFORMED" not in str(e):
            raise
    return pipe_status(spark, lake).select("dataset", "state", F.when(F.col("state") == "SUCCEEDED", F.col("last_rows")).alias("last_rows"),
                                           "loaded_rows", (F.col("pending_files") > 0).alias("pending"),
                                           F.coalesce(F.col("lag_seconds") >= 0, F.lit(False)).alias("lagging"),
                                           F.coalesce(F.contains("last_error", F.lit("MALFORMED")), F.lit(False)).alias("failed_on_line"))


def extract_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary: records landed per run and dataset, counted while written."""
    from strata.plans.extract import extract_log, land_counted, shape_run
    lake = Lake(scratch_path(spark, "run-counts"))
    shaped = shape_run(_two_runs(spark, sf_dir), top_n=1 << 30, chunk_size=3, datasets=DATASETS[:3])
    land_counted(lake, shaped, [dt.datetime(2024, 3, d, 6) for d in (1, 2, 3)])
    return extract_log(spark, lake).select(F.to_date("run_ts").alias("run_date"), "dataset", "records")


def daily_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily fact from partial aggregates merged over three drops. Every eleventh
    review of the first two drops is extracted again with the third, with another vote,
    score and playtime than before."""
    from strata.plans.build import build, gold_tables, load_raw
    lake, records = Lake(scratch_path(spark, "daily-state")), analogs._api_shaped(spark, sf_dir)
    reviews = records["reviews"]
    again = (F.col("recommendationid").cast("bigint") % 11 == 0) & (F.col("_ts") < F.lit("2024-01-21").cast("timestamp_ntz"))
    first = reviews.where(again).withColumn("timestamp_updated", F.col("timestamp_updated") - 10) \
        .withColumn("voted_up", ~F.coalesce("voted_up", F.lit(False))).withColumn("weighted_vote_score", F.col("weighted_vote_score") + 1) \
        .withColumn("author", F.struct(F.col("author.steamid").alias("steamid"), (F.col("author.playtime_at_review") + 5).alias("playtime_at_review")))
    third = lambda df: F.expr(_BASE.replace("ts <", "_ts <"))
    for drop in (1, 2, 3):
        own = third(reviews) == drop
        landed = {ds: records[ds].where(own) for ds in ("most_played", "player_counts")}
        landed["reviews"] = reviews.where(own & ~again).unionByName(first.where(own).select(reviews.columns)) if drop < 3 \
            else reviews.where(own | again)
        analogs._land(lake, landed)
        load_raw(spark, lake, datasets=tuple(landed))
        build(spark, lake, daily_mode="state", run_tests=False)
    return gold_tables(spark, lake)["fact_daily_game_performance"].select(
        "activity_date", "game_key", "chart_rank", "last_week_rank", "peak_in_game",
        "snapshot_player_count", "reviews_total", "reviews_positive", "reviews_negative",
        F.round("avg_weighted_vote_score", 6).alias("avg_weighted_vote_score"),
        F.col("median_playtime_at_review_min").cast("double").alias("median_playtime_at_review_min"),
        "positive_review_ratio")


def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per delivery from a bronze table of many batches that was compacted, went on
    growing and was compacted again."""
    from strata.functions.variant import vget
    from strata.sources.bronze import compact_bronze, ingest, read_bronze
    root = scratch_path(spark, "compacted")
    ev = _extractions(spark, sf_dir)
    for run in range(1, 6):
        _deliver(ev, root, run)
        ingest(spark, f"{root}/raw/events", f"{root}/bronze", f"{root}/_chk", stage_root=f"{root}/raw", max_files_per_trigger=2)
        if run in (2, 4):
            compact_bronze(spark, f"{root}/bronze")
    b = read_bronze(spark, f"{root}/bronze")
    return b.select(vget("payload", "$.event_id", "bigint").alias("event_id"), vget("payload", "$.run", "int").alias("run"),
                    F.regexp_extract("_file", r"ingest_date=([0-9-]+)", 1).alias("ingest_date"))


def _faulty(spark: SparkSession, sf_dir: str):
    """A built lake whose review fact then gets planted faults in the days from the 16th on."""
    from strata.plans.build import build, commits, load_raw, stored_models
    lake = Lake(scratch_path(spark, "delta-tests"))
    analogs._land(lake, analogs._api_shaped(spark, sf_dir))
    load_raw(spark, lake)
    build(spark, lake, run_tests=False)
    since = commits(spark, lake)
    t = stored_models(spark, lake)["fact_review"]
    late = t.read().where("review_date >= date'2024-01-16'")
    number = F.col("review_id").cast("bigint")
    bad = late.withColumn("game_key", F.when(number % 10 > 0, F.col("game_key"))).unionByName(late.where(number % 100 == 1))
    t.replace_partitions(bad, [p for p in t.current()["partitions"] if p >= "2024-01-16"])
    return lake, since


def model_tests_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 17 data tests on what a commit with planted faults has changed."""
    from strata.operators.quality import model_checks, run_checks_delta
    from strata.plans.build import gold_tables, stored_models
    lake, since = _faulty(spark, sf_dir)
    stored = stored_models(spark, lake)
    tables = {**{n: t.read() for n, t in stored.items()}, **gold_tables(spark, lake)}
    rows = [(r.name, r.failures) for r in run_checks_delta(model_checks(), tables, stored, since)]
    return spark.createDataFrame(rows, "name string, failures bigint")


def report_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over fact and dimension that are co-located by game."""
    from strata.sources.views import publish_star
    lake = analogs._pipeline_lake(spark, sf_dir)
    rpt = publish_star(spark, lake, "star_" + uuid.uuid4().hex[:12], 8)
    return rpt.select(*[F.col(c).cast("double").alias(c) if c in _DECIMALS else F.col(c) for c in rpt.columns])


def views_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight models by plain SQL, from another session."""
    from strata.sources.views import publish
    database = "models_" + uuid.uuid4().hex[:12]
    names = publish(spark, analogs._incremental_lake(spark, sf_dir), database)
    other = spark.newSession()
    counts = " UNION ALL ".join(f"SELECT '{n}' AS model, count(*) AS n FROM {database}.{n}" for n in names)
    by_day = f"""
SELECT concat('rpt ', r.activity_date) AS model, count(*) AS n FROM {database}.rpt_daily_game_performance r
WHERE r.activity_date >= date'2024-01-20' GROUP BY r.activity_date"""
    rows = other.sql(f"{counts} UNION ALL {by_day}")
    return rows


def _charts(ev: DataFrame) -> DataFrame:
    """A landed chart response for each block of 64 users."""
    ranks = ev.where("event_type = 'view'").groupBy(F.floor(F.col("user_id") / 64).alias("g"), "user_id").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("g").agg(F.sort_array(F.collect_list(F.struct(F.col("user_id").alias("appid"), F.col("n").alias("rank")))).alias("ranks"))
    body = F.struct(F.struct("ranks", F.lit(7).alias("rollup_date")).alias("response"))
    return ranks.select(F.lit("most_played").alias("dataset"), F.lit(0).cast("bigint").alias("appid"), F.lit(0).alias("page_no"),
                        F.lit(analogs.RUN_TS).cast("timestamp").alias("run_ts"), F.lit(None).cast("string").alias("cursor"),
                        F.parse_json(F.to_json(body)).alias("body"), F.lit(None).cast("string").alias("error"))


def chart_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose chart responses all have ranks is landed; one with an empty response
    fails, and nothing of it is landed."""
    from strata import fs
    from strata.plans.extract import land_counted, shape_run
    good = _charts(table(spark, sf_dir, "events"))
    empty = good.limit(1).withColumn("body", F.parse_json(F.lit('{"response": {"ranks": []}}')))
    rows = []
    for kind, responses in (("good", good), ("with an empty response", good.unionByName(empty))):
        lake = Lake(scratch_path(spark, "guard"))
        try:
            n, state = land_counted(lake, shape_run(responses, top_n=1 << 30, datasets=("most_played",)),
                                    [dt.datetime.fromisoformat(analogs.RUN_TS)])[0][2], "landed"
        except Exception as e:
            if "no ranks" not in str(e):
                raise
            n, state = 0, "failed"
        files = fs.glob(spark, f"{lake.raw('most_played')}/*/*.txt") + fs.glob(spark, f"{lake.raw('most_played')}/*.txt")
        rows.append((kind, state, n, bool(files)))
    return spark.createDataFrame(rows, "kind string, state string, records bigint, files boolean")


def empty_run_no_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing for each event type; a type without events leaves no file or folder."""
    from strata import fs
    root, ev, rows = scratch_path(spark, "empty-run"), table(spark, sf_dir, "events"), []
    for kind in ("view", "click", "signup", "purchase", "error", "refund"):
        path = write_ndjson(ev.where(F.col("event_type") == kind), f"{root}/raw", kind, "ts", ["event_id", "ts"])
        rows.append((kind, path is not None, fs.exists(spark, f"{root}/raw/{kind}")))
    landed = spark.createDataFrame(rows, "event_type string, landed boolean, folder boolean")
    files = spark.read.option("recursiveFileLookup", "true").text(f"{root}/raw") \
        .groupBy(F.regexp_extract(F.col("_metadata.file_path"), "/raw/([a-z]+)/", 1).alias("event_type")).agg(F.count(F.lit(1)).alias("lines"))
    return landed.join(files, "event_type", "left").select("event_type", "landed", "folder", F.coalesce("lines", F.lit(0)).alias("lines"))


def shared_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill, a continuous ingest and a second backfill over one load history: each
    file is loaded once, by whichever comes first."""
    from strata.sources.bronze import ingest, read_bronze, read_ledger
    root = scratch_path(spark, "history")
    ev = _extractions(spark, sf_dir).where("run = base")
    kw = dict(stage_root=f"{root}/raw", ledger=f"{root}/ledger")
    args = (spark, f"{root}/raw/events", f"{root}/bronze", f"{root}/_chk")
    by = []
    for runs, mode in (((1, 2), "backfill"), ((3, 4), "continuous"), ((5,), "backfill again")):
        for run in runs:
            _deliver(ev, root, run)
        if mode == "continuous":
            q = ingest(*args, processing_time="1 second", **kw)
            try:
                q.processAllAvailable()
            finally:
                q.stop()
        else:
            ingest(*args, **kw)
        by.append((mode, read_bronze(spark, f"{root}/bronze").count()))
    ledger = read_ledger(spark, f"{root}/ledger")
    once = ledger.groupBy("_file").count().agg(F.max("count")).first()[0]
    return spark.createDataFrame(by, "mode string, loaded bigint").withColumn("times_per_file", F.lit(once).cast("bigint"))


def replay_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build fails on arrival: the offset stays, the next start gets the same batch, and a
    third has nothing to do. Three loads before a start are one build (debounce)."""
    from strata.plans.build import load_raw
    from strata.streaming.arrival import run_on_arrival, trigger_log
    lake, records, builds = Lake(scratch_path(spark, "replay")), analogs._api_shaped(spark, sf_dir), []
    third = F.expr(_BASE.replace("ts <", "_ts <"))

    def load(drop: int) -> None:
        analogs._land(lake, {"reviews": records["reviews"].where(third == drop)})
        load_raw(spark, lake, datasets=("reviews",))

    def fail(*_) -> None:
        builds.append("failed")
        raise RuntimeError("planned failure")

    load(1)
    try:
        run_on_arrival(spark, lake, fail)
    except Exception as e:
        if "planned failure" not in str(e):
            raise
    load(2)
    load(3)
    for _ in range(2):
        run_on_arrival(spark, lake, lambda s, l, run_id: builds.append(run_id))
    log = trigger_log(spark, lake).select(F.col("new_reviews"), F.lit(builds.count("failed")).alias("failed"),
                                          F.lit(len(builds) - builds.count("failed")).alias("succeeded"))
    # the replayed batch holds what was there at the failure; all that came since is one batch more
    return log


def top_reviews_by_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample export of the 200 reviews with the most votes, ties by id, read back."""
    from strata.plans import gold
    from strata.plans.silver import silver_reviews
    from strata.sources import export
    raw = analogs._api_shaped(spark, sf_dir)["reviews"].withColumn("votes_up", F.col("recommendationid").cast("bigint") * 7919 % 1000)
    bronze = raw.select(F.parse_json(F.to_json(F.struct(*[c for c in raw.columns if c != "_ts"]))).alias("payload"),
                        F.lit("f").alias("_file"), F.current_timestamp().alias("_loaded_at"))
    fact = gold.fact_review(silver_reviews(bronze))
    daily, dim = analogs._star(spark, sf_dir)
    out = scratch_path(spark, "votes")
    export.export_samples(gold.rpt_daily_game_performance(daily, dim), dim, fact, out)
    return spark.read.schema("review_id string, game_key bigint, review_date date, review_language string, is_positive boolean, votes_up bigint") \
        .option("header", True).option("enforceSchema", True).csv(f"{out}/sample_fact_review").select("review_id", "game_key", "votes_up")


def run_history_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run ledger of a build for each day: the latest 20 entries, newest first."""
    from strata.plans.build import RunResult, _log_run, run_history
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each day
    lake = Lake(scratch_path(spark, "ledger"))
    for r in days:
        at = dt.datetime.combine(r.d, dt.time(6))
        _log_run(spark, lake, f"{r.d}", [RunResult(m, "SUCCEEDED", r.n, at, at) for m in ("fact_review", "dim_game")])
    found = run_history(spark, lake)
    place = F.monotonically_increasing_id()  # one sorted partition
    return found.coalesce(1).select((place + 1).alias("place"), "run_id", "model", "rows")


QUERIES = {
    "chart_guard": chart_guard,
    "empty_run_no_file": empty_run_no_file,
    "shared_load_history": shared_load_history,
    "replay_offsets": replay_offsets,
    "top_reviews_by_votes": top_reviews_by_votes,
    "run_history_limit": run_history_limit,
    "bronze_compacted": bronze_compacted,
    "model_tests_delta": model_tests_delta,
    "report_bucketed": report_bucketed,
    "views_by_sql": views_by_sql,
    "daily_state_merge": daily_state_merge,
    "stream_day_bucket": stream_day_bucket,
    "stream_overlap_dedup": stream_overlap_dedup,
    "pipe_status": pipe_status_q,
    "extract_run_counts": extract_run_counts,
}

_DAYS = f"""
WITH d AS (SELECT *, {_DELIVERED} AS run FROM events),
m AS (SELECT run, max(date_trunc('millisecond', ts)) - INTERVAL 8 DAY AS mark FROM d GROUP BY run),
k AS (SELECT d.*, coalesce(CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(mark) FROM m WHERE m.run < d.run), FALSE) AS late FROM d)"""

_LATE = [("not_null:fact_review.game_key", "(SELECT count(*) FROM r WHERE event_id % 10 = 0)"),
         ("unique:fact_review.review_id", "(SELECT count(*) FROM r WHERE event_id % 100 = 1)"),
         ("relationships:fact_review.game_key->dim_game.game_key",
          "(SELECT count(*) FROM (SELECT user_id FROM r WHERE event_id % 10 > 0 UNION ALL SELECT user_id FROM r WHERE event_id % 100 = 1) x "
          "WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'view'))")]

ORACLES = {
    "chart_guard": """
SELECT 'good' AS kind, 'landed' AS state, count(DISTINCT user_id) AS records, TRUE AS files FROM events WHERE event_type = 'view'
UNION ALL SELECT 'with an empty response', 'failed', 0, FALSE""",
    "empty_run_no_file": """
SELECT k.event_type, count(e.event_id) > 0 AS landed, count(e.event_id) > 0 AS folder, count(e.event_id) AS lines
FROM (SELECT unnest(['view', 'click', 'signup', 'purchase', 'error', 'refund']) AS event_type) k
LEFT JOIN events e ON e.event_type = k.event_type GROUP BY k.event_type""",
    "shared_load_history": f"""
WITH e AS (SELECT {_RUN_OF} AS base FROM events)
SELECT mode, (SELECT count(*) FROM e WHERE base <= upto) AS loaded, CAST(1 AS BIGINT) AS times_per_file
FROM (VALUES ('backfill', 2), ('continuous', 4), ('backfill again', 5)) t(mode, upto)""",
    "replay_offsets": f"""
WITH r AS (SELECT {_BASE} AS drop FROM events WHERE event_type IN ('purchase', 'click', 'error'))
SELECT count(*) AS new_reviews, 1 AS failed, 2 AS succeeded FROM r GROUP BY drop = 1""",
    "top_reviews_by_votes": """
SELECT CAST(event_id AS VARCHAR) AS review_id, user_id AS game_key, event_id * 7919 % 1000 AS votes_up
FROM events WHERE event_type IN ('purchase', 'click', 'error') ORDER BY votes_up DESC, CAST(event_id AS VARCHAR) LIMIT 200""",
    "run_history_limit": """
SELECT row_number() OVER (ORDER BY d DESC, model) AS place, CAST(d AS VARCHAR) AS run_id, model, n AS "rows"
FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) x, (SELECT unnest(['fact_review', 'dim_game']) AS model) m
ORDER BY d DESC, model LIMIT 20""",
    "bronze_compacted": f"""
WITH e AS (SELECT *, {_RUN_OF} AS base FROM events)
SELECT event_id, CAST(run AS INTEGER) AS run, '2024-03-09' AS ingest_date FROM (
  SELECT event_id, base AS run FROM e
  UNION ALL SELECT event_id, base + 1 FROM e WHERE base < 5 AND (day(ts) - 1) % 6 = 5
  UNION ALL SELECT event_id, 5 FROM e WHERE base = 1) x""",
    "model_tests_delta": f"""
WITH r AS (SELECT event_id, user_id FROM events WHERE event_type IN ('purchase', 'click', 'error') AND ts >= TIMESTAMP '2024-01-16'),
p AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {k})" for n, k in _LATE)}) t(name, failures)),
a AS (SELECT unnest([{", ".join(f"'{n}'" for n in _CHECK_NAMES)}]) AS name)
SELECT a.name, CAST(coalesce(p.failures, 0) AS BIGINT) AS failures FROM a LEFT JOIN p ON p.name = a.name""",
    "report_bucketed": _PLAIN["medallion_report"],
    "views_by_sql": _with("""
SELECT 'dim_game' AS model, count(*) AS n FROM dim
UNION ALL SELECT 'fact_review', count(*) FROM rv UNION ALL SELECT 'silver_reviews', count(*) FROM rv
UNION ALL SELECT 'fact_daily_game_performance', count(*) FROM fact UNION ALL SELECT 'rpt_daily_game_performance', count(*) FROM rpt
UNION ALL SELECT 'silver_most_played', count(*) FROM chart UNION ALL SELECT 'silver_player_counts', count(*) FROM counts
UNION ALL SELECT 'silver_app_details', count(*) FROM details
UNION ALL SELECT 'rpt ' || CAST(activity_date AS VARCHAR), count(*) FROM rpt WHERE activity_date >= DATE '2024-01-20' GROUP BY activity_date"""),
    "daily_state_merge": _PLAIN["daily_fact"],
    "stream_day_bucket": _DAYS + """
SELECT 'counted' AS kind, 0 AS run, CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM k WHERE NOT late GROUP BY ALL
UNION ALL
SELECT 'late', run, NULL, NULL, count(*) FILTER (WHERE late) FROM k GROUP BY run""",
    "stream_overlap_dedup": f"SELECT event_id, ts, user_id, CAST({_RUN_OF} AS INTEGER) AS run FROM events",
    "pipe_status": """
WITH r AS (SELECT CASE event_type WHEN 'view' THEN 'most_played' WHEN 'signup' THEN 'player_counts' ELSE 'reviews' END AS dataset,
                  ts < TIMESTAMP '2024-01-16' AS early FROM events)
SELECT dataset, CASE dataset WHEN 'reviews' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
       CASE WHEN dataset <> 'reviews' THEN count(*) FILTER (WHERE NOT early) END AS last_rows,
       CASE dataset WHEN 'reviews' THEN count(*) FILTER (WHERE early) ELSE count(*) END AS loaded_rows,
       dataset = 'reviews' AS pending, dataset = 'reviews' AS lagging, dataset = 'reviews' AS failed_on_line
FROM r GROUP BY dataset
UNION ALL SELECT 'app_details', 'NEVER RUN', NULL, 0, FALSE, FALSE, FALSE""",
    "extract_run_counts": _RUNS + """,
c AS (SELECT run, 'most_played' AS dataset, count(*) AS n FROM placed GROUP BY run
      UNION ALL SELECT run, 'player_counts', count(*) FROM placed GROUP BY run
      UNION ALL SELECT run, 'reviews', CAST(sum(n) AS BIGINT) FROM placed GROUP BY run)
SELECT DATE '2024-03-01' + (r.run - 1) AS run_date, d.dataset, coalesce(c.n, 0) AS records
FROM (SELECT unnest([1, 2, 3]) AS run) r, (SELECT unnest(['most_played', 'player_counts', 'reviews']) AS dataset) d
LEFT JOIN c ON c.run = r.run AND c.dataset = d.dataset""",
}
