"""The model DAG: bronze -> silver -> gold, then the data tests.

Order (from the model dependencies): the four silver models; ``dim_game``
(chart + details); ``fact_review`` (reviews, incremental);
``fact_daily_game_performance`` (chart + counts + reviews); the report is a
join evaluated at read time. Silver models that feed two gold models are
written once per run (a written table cuts the lineage and survives lost
executors) instead of being recomputed per consumer.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fs
from strata.functions.variant import vget
from strata.operators.daily_state import DailyState
from strata.operators.incremental import SnapshotTable
from strata.operators.quality import CheckResult, ChecksFailed, changed_rows, model_checks, run_checks, run_checks_delta
from strata.plans import gold, silver
from strata.session import ensure_session
from strata.sources.bronze import IngestResult, committed_batches, ingest, read_bronze
from strata.sources.catalog import DATASETS, Lake
from strata.streaming.status import log_status, run_status

RUN_LEDGER_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("detail", T.StringType()),
])


@dataclass
class RunResult:
    model: str
    status: str
    rows: int | None
    started_at: dt.datetime
    ended_at: dt.datetime
    detail: str = ""


def load_raw(spark: SparkSession, lake: Lake, datasets=DATASETS, strict: bool = True,
             max_files_per_trigger: int | None = None, archive: bool = False) -> dict[str, IngestResult]:
    """Load every new landing file of each dataset into bronze (once per file).

    ``archive`` moves loaded files to ``<root>/archive/<dataset>`` so the
    landing listing stays proportional to new files.
    """
    started, at = {}, _utcnow()
    for ds in datasets:
        fs.mkdirs(spark, lake.raw(ds))
        started[ds] = ingest(spark, lake.raw(ds), lake.bronze(ds), lake.ingest_checkpoint(ds),
                             stage_root=lake.landing, strict=strict,
                             quarantine=None if strict else lake.quarantine(ds),
                             ledger=lake.load_ledger(ds), max_files_per_trigger=max_files_per_trigger,
                             wait=False, archive_dir=f"{lake.root}/archive/{ds}" if archive else None)
    # the four tables ingest concurrently; every query is awaited (errors surface)
    errors, states = [], []
    for ds, (q, _) in started.items():
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001
            errors.append(e)
        states.append(run_status(ds, q, at))
    log_status(spark, lake, states)
    if errors:
        raise errors[0]
    return {ds: get() for ds, (_, get) in started.items()}


Batches = dict[str, list[int]]


def bronze_batches(spark: SparkSession, lake: Lake) -> Batches:
    """The committed batches of each dataset, listed once: everything a build
    reads or marks as consumed goes by this list, so a batch that lands while
    the build runs is left, whole, to the next one."""
    return {ds: committed_batches(spark, lake.bronze(ds)) for ds in DATASETS}


def silver_models(spark: SparkSession, lake: Lake, batches: Batches | None = None) -> dict[str, DataFrame]:
    batches = bronze_batches(spark, lake) if batches is None else batches
    b = {ds: read_bronze(spark, lake.bronze(ds), batches=batches[ds]) for ds in DATASETS}
    return {
        "silver_most_played": silver.silver_most_played(b["most_played"]),
        "silver_player_counts": silver.silver_player_counts(b["player_counts"]),
        "silver_reviews": silver.silver_reviews(b["reviews"]),
        "silver_app_details": silver.silver_app_details(b["app_details"]),
    }


_TIES = [("_file", "desc"), ("_loaded_at", "desc")]

#: silver model -> (bronze dataset, model, key columns, partition column, merge order)
SILVER_TABLES = {
    "silver_most_played": ("most_played", lambda b: silver.silver_most_played(b),
                           ["appid", "chart_date"], "chart_date", [("extracted_at", "desc")] + _TIES),
    "silver_player_counts": ("player_counts", lambda b: silver.silver_player_counts(b, keep_file=True),
                             ["appid", "snapshot_date"], "snapshot_date", [("extracted_at", "desc")] + _TIES),
    "silver_reviews": ("reviews", lambda b: silver.silver_reviews(b, keep_file=True)
                       .withColumn("created_date", F.to_date("created_at")),
                       ["review_id"], "created_date",
                       [("updated_at", "desc"), ("extracted_at", "desc")] + _TIES),
    "silver_app_details": ("app_details", lambda b: silver.silver_app_details(b, keep_file=True)
                           .withColumn("extracted_date", F.to_date("extracted_at")),
                           ["appid", "extracted_date"], "extracted_date", [("extracted_at", "desc")] + _TIES),
}


def incremental_silver(spark: SparkSession, lake: Lake, threads: int = 4,
                       batches: Batches | None = None) -> dict[str, DataFrame]:
    """Silver as versioned tables merged from the new bronze batches only.

    Each table remembers the last bronze batch it consumed; the next build
    reads ``batch_id > last`` (partition pruning on bronze), deduplicates
    those rows and merges them: a stored row is replaced only by a row that
    comes first in the model's order, so the result equals the view over all
    of bronze, while the work follows the new data.
    """
    batches = bronze_batches(spark, lake) if batches is None else batches

    def one(name: str) -> DataFrame:
        ds, model, keys, part, order = SILVER_TABLES[name]
        t = SnapshotTable(spark, lake.silver_table(name), key=keys, partition_by=part)
        cur = t.current()
        last = cur["meta"].get("bronze_batch", -1) if cur else -1
        new = [b for b in batches[ds] if b > last]
        if new:
            t.upsert(model(read_bronze(spark, lake.bronze(ds), batches=new)), mode="newer",
                     order=order, meta_update={"bronze_batch": max(new)})
        if not t.exists():
            return model(read_bronze(spark, lake.bronze(ds), batches=[]))  # empty bronze: empty model
        return t.read()

    with ThreadPoolExecutor(max_workers=threads) as pool:
        return dict(zip(SILVER_TABLES, pool.map(one, SILVER_TABLES)))


def _materialize(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _utcnow() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def build(spark: SparkSession, lake: Lake, run_id: str | None = None,
          review_mode: str = "loaded_at", run_tests: bool = True,
          threads: int = 4, daily_mode: str = "touched",
          silver_mode: str = "incremental", batches: Batches | None = None,
          test_mode: str = "all", warn: tuple[str, ...] = ()) -> tuple[list[RunResult], list[CheckResult]]:
    """Run every model in dependency order, each layer followed by its data tests.

    A failing test stops what depends on the model: the run is logged and
    ``ChecksFailed`` is raised, so an arrival stream keeps its offset and comes
    back to the same batch.

    By default a build follows the new data: ``silver_mode="incremental"`` merges
    new bronze batches into silver tables, ``daily_mode="touched"`` recomputes
    the days that received new rows (``"state"`` does so from merged partial
    aggregates, without reading a day's reviews again; it needs incremental silver),
    ``review_mode="loaded_at"`` merges late files too. ``"view"``, ``"full"`` and ``"strict"`` (skip files that carry an
    already seen stamp) are the reference's behaviour. ``batches`` is a listing made
    earlier (``bronze_batches``); batches committed since are left to the next build.
    ``test_mode="delta"`` tests what this build has changed (``run_checks_delta``).
    ``warn`` names data tests that only warn: they are run, counted and returned, and a
    failing one is named in the run's log, but doesn't end the build.
    """
    if daily_mode == "state" and silver_mode != "incremental":
        raise ValueError('daily_mode="state" follows the incremental silver tables')
    ensure_session(spark)
    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6]
    batches = bronze_batches(spark, lake) if batches is None else batches
    results: list[RunResult] = []
    checks: list[CheckResult] = []
    since = commits(spark, lake) if test_mode == "delta" else {}

    def step(model: str, fn):
        t0 = _utcnow()
        try:
            rows = fn()
            results.append(RunResult(model, "SUCCEEDED", rows, t0, _utcnow()))
        except Exception as e:  # noqa: BLE001 - logged, then re-raised
            results.append(RunResult(model, "FAILED", None, t0, _utcnow(), str(e)))
            _log_run(spark, lake, run_id, results)
            raise

    def tested(layer: str, tables: dict[str, DataFrame], of: set[str]) -> None:
        """The data tests of the tables ``of`` this layer; a failure ends the build."""
        if not run_tests:
            return
        t0 = _utcnow()
        chosen = [c for c in model_checks() if c.table in of and c.table in tables]
        if test_mode == "delta":
            found = run_checks_delta(chosen, tables, {n: t for n, t in stored_models(spark, lake).items() if n in tables}, since, threads)
        else:
            found = run_checks(chosen, tables, threads=threads)
        checks.extend(found)
        failed = [c for c in found if not c.passed and c.name not in warn]
        warned = [f"warning: {c.name} ({c.failures})" for c in found if not c.passed and c.name in warn]
        results.append(RunResult(f"tests ({layer})", "FAILED" if failed else "SUCCEEDED", len(found), t0, _utcnow(),
                                 ",".join([c.name for c in failed] + warned)))
        if failed:
            _log_run(spark, lake, run_id, results)
            raise ChecksFailed(failed)

    if silver_mode == "incremental":
        s: dict[str, DataFrame] = {}
        step("silver (incremental)", lambda: s.update(incremental_silver(spark, lake, threads, batches)))
    else:
        s = silver_models(spark, lake, batches)
        with ThreadPoolExecutor(max_workers=threads) as pool:  # read by models and tests: written once
            futures = [pool.submit(step, n, lambda n=n: s.update(
                {n: _materialize(spark, s[n], lake.silver(n, run_id))}) or s[n].count()) for n in list(s)]
            for f in futures:
                f.result()
    tested("silver", s, set(s))
    most_played, reviews = s["silver_most_played"], s["silver_reviews"]

    dim_t = SnapshotTable(spark, lake.gold("dim_game"))
    fr_t = SnapshotTable(spark, lake.gold("fact_review"), key="review_id", partition_by="review_date")
    fd_t = SnapshotTable(spark, lake.gold("fact_daily_game_performance"), key="game_key",
                         partition_by="activity_date")
    if review_mode == "strict":
        fr_src = gold.fact_review(reviews)
        fr_job = lambda: fr_t.upsert(fr_src, mode="strict")["rows"]
    else:
        # Only bronze batches not yet consumed are deduplicated and merged; a
        # stored review is replaced only by a newer version, so late files count.
        cur = fr_t.current()
        last = cur["meta"].get("bronze_batch", -1) if cur else -1
        new = [b for b in batches["reviews"] if b > last]
        fr_src = gold.fact_review(silver.silver_reviews(
            read_bronze(spark, lake.bronze("reviews"), batches=new)))
        fr_job = lambda: fr_t.upsert(
            fr_src, mode="newer", order=[("updated_at", "desc"), ("extracted_at", "desc")],
            meta_update={"bronze_batch": max(new)} if new else None)["rows"]
    jobs = {
        "dim_game": lambda: dim_t.replace(gold.dim_game(most_played, s["silver_app_details"]))["rows"],
        "fact_review": fr_job,
        "fact_daily_game_performance": lambda: _build_daily(
            spark, lake, fd_t, most_played, s["silver_player_counts"], reviews, daily_mode, batches),
    }
    # independent models run side by side (dbt's ``threads``); Spark schedules
    # their jobs concurrently on the cluster
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = [pool.submit(step, name, fn) for name, fn in jobs.items()]
        for f in futures:
            f.result()
    made = gold_tables(spark, lake)
    tested("gold", made, set(jobs))
    if test_mode == "delta" and "rpt_daily_game_performance" in made:  # the report of the days that changed
        daily = changed_rows(stored_models(spark, lake)["fact_daily_game_performance"], since.get("fact_daily_game_performance"))
        made["rpt_daily_game_performance"] = gold.rpt_daily_game_performance(daily, made["dim_game"])
    tested("report", made, set(made) - set(jobs))
    _log_run(spark, lake, run_id, results)
    if silver_mode != "incremental":  # this run's copies have served
        for n in s:
            fs.delete(spark, lake.silver(n, run_id))
    return results, checks


_DAILY_INPUTS = {
    # dataset -> the day a new bronze row can change in the daily fact
    "most_played": lambda b: F.to_date(vget("payload", "$._extracted_at", "timestamp")),
    "player_counts": lambda b: vget("payload", "$._extracted_at", "date"),
    "reviews": lambda b: F.to_date(vget("payload", "$.timestamp_created", "epoch")),
}


def _build_daily(spark: SparkSession, lake: Lake, table: SnapshotTable, most_played: DataFrame,
                 player_counts: DataFrame, reviews: DataFrame, mode: str, listed: Batches) -> int:
    """Daily fact: a full rebuild, or (``mode="touched"``) only the days that
    received new bronze rows since the last build, or (``mode="state"``) the same
    days from stored review aggregates, into which the new batches are merged.

    A day's fact row depends only on chart, snapshot and review rows of that
    same day (reviews by creation day; a re-extracted review keeps it), so
    recomputing the touched days gives the same table as a full rebuild
    while the work follows the new data.
    """
    batches = {ds: listed[ds] for ds in _DAILY_INPUTS}
    consumed = {ds: max(b) if b else -1 for ds, b in batches.items()}
    cur = table.current()
    last = (cur or {}).get("meta", {}).get("bronze_batch")
    if mode == "state" and last is None:
        _daily_state(spark, lake).follow(_silver_reviews(spark, lake))
    if mode == "full" or last is None:
        return table.replace(gold.fact_daily_game_performance(most_played, player_counts, reviews),
                             meta={"bronze_batch": consumed})["rows"]
    days = None
    for ds, ids in batches.items():
        new = read_bronze(spark, lake.bronze(ds), batches=[b for b in ids if b > last.get(ds, -1)])
        d = new.select(_DAILY_INPUTS[ds](new).alias("d"))
        days = d if days is None else days.union(d)
    touched = sorted(r.d for r in days.where(F.col("d").isNotNull()).distinct().collect())  # days only
    if mode == "state":
        return _merge_daily(spark, lake, table, most_played, player_counts, touched,
                            [b for b in batches["reviews"] if b > last.get("reviews", -1)], consumed)
    if not touched:
        return 0
    fact = gold.fact_daily_game_performance(
        most_played.where(F.col("chart_date").isin(touched)),
        player_counts.where(F.col("snapshot_date").isin(touched)),
        reviews.where((F.col("created_date") if "created_date" in reviews.columns
                       else F.to_date("created_at")).isin(touched)))
    return table.replace_partitions(fact, [str(d) for d in touched], meta={"bronze_batch": consumed})["rows"]


def _silver_reviews(spark: SparkSession, lake: Lake) -> SnapshotTable:
    _, _, keys, part, _ = SILVER_TABLES["silver_reviews"]
    return SnapshotTable(spark, lake.silver_table("silver_reviews"), key=keys, partition_by=part)


def _daily_state(spark: SparkSession, lake: Lake) -> DailyState:
    return DailyState(spark, lake.daily_state)


def _merge_daily(spark: SparkSession, lake: Lake, table: SnapshotTable, most_played: DataFrame, player_counts: DataFrame,
                 touched: list, review_batches: list[int], consumed: dict) -> int:
    """The touched days of the daily fact from merged review state: the new batches'
    reviews are the only ones that are read."""
    new = read_bronze(spark, lake.bronze("reviews"), batches=review_batches)
    keys = new.select(vget("payload", "$.recommendationid", "string").alias("review_id")).where("review_id is not null").distinct()
    state = _daily_state(spark, lake)
    moved = state.follow(_silver_reviews(spark, lake), keys)
    days = sorted({str(d) for d in touched} | {d for d in moved if d[:1].isdigit()})
    if not days:
        return 0
    as_dates = [dt.date.fromisoformat(d) for d in days]
    fact = gold.daily_fact(most_played.where(F.col("chart_date").isin(as_dates)),
                           player_counts.where(F.col("snapshot_date").isin(as_dates)), state.daily(days))
    return table.replace_partitions(fact, days, meta={"bronze_batch": consumed})["rows"]


def stored_models(spark: SparkSession, lake: Lake) -> dict[str, SnapshotTable]:
    """The versioned tables of all models that have been built."""
    tables = {n: SnapshotTable(spark, lake.silver_table(n), key=keys, partition_by=part)
              for n, (_, _, keys, part, _) in SILVER_TABLES.items()}
    tables["dim_game"] = SnapshotTable(spark, lake.gold("dim_game"), key="game_key")
    tables["fact_review"] = SnapshotTable(spark, lake.gold("fact_review"), key="review_id", partition_by="review_date")
    tables["fact_daily_game_performance"] = SnapshotTable(spark, lake.gold("fact_daily_game_performance"),
                                                          key=["activity_date", "game_key"], partition_by="activity_date")
    return {n: t for n, t in tables.items() if t.exists()}


def commits(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """The newest commit of each stored model."""
    return {n: t.current()["commit"] for n, t in stored_models(spark, lake).items()}


def gold_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Current gold tables plus the report view (joined at read time)."""
    out = {}
    for name in ("dim_game", "fact_review", "fact_daily_game_performance"):
        t = SnapshotTable(spark, lake.gold(name), partition_by={
            "fact_review": "review_date", "fact_daily_game_performance": "activity_date"}.get(name))
        if t.exists():
            out[name] = t.read()
    if "dim_game" in out and "fact_daily_game_performance" in out:
        out["rpt_daily_game_performance"] = gold.rpt_daily_game_performance(
            out["fact_daily_game_performance"], out["dim_game"])
    return out


def _log_run(spark: SparkSession, lake: Lake, run_id: str, results: list[RunResult]) -> None:
    rows = [(r.model, r.status, r.rows, r.started_at, r.ended_at, r.detail) for r in results]
    (spark.createDataFrame(rows, RUN_LEDGER_SCHEMA)
          .write.mode("overwrite").parquet(f"{lake.run_ledger}/run_id={run_id}"))


def run_history(spark: SparkSession, lake: Lake, limit: int = 20) -> DataFrame:
    """Latest runs first (task history)."""
    sch = T.StructType(RUN_LEDGER_SCHEMA.fields + [T.StructField("run_id", T.StringType())])
    return (spark.read.schema(sch).parquet(lake.run_ledger)
                 .orderBy(F.col("started_at").desc_nulls_first(), F.col("model").asc_nulls_last())
                 .limit(limit))


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Register silver models and gold tables as temp views for SQL users.

    Silver views are lazy DataFrames (recomputed on read, like views); the
    report view re-joins fact and dimension on every read so it cannot
    drift from the dimension.
    """
    names = []
    for name, df in {**silver_models(spark, lake), **gold_tables(spark, lake)}.items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
