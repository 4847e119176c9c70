"""Pipe status: what each dataset's ingest last did, and what it still has to do.

Every ingest run leaves one row for each dataset: state, batches, rows read, time spent in
batches and the error that ended it, from the streaming query's own progress. The status
joins the last run of each dataset with its load ledger and a listing of its landing
folder: files that are landed but not in the ledger are pending, and the age of the oldest
of them is the lag. File contents are not read.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fs
from strata.operators.dedup import latest_by
from strata.sources.bronze import read_ledger, relative_file
from strata.sources.catalog import DATASETS, Lake

STATUS_SCHEMA = "dataset string, state string, batches bigint, rows bigint, batch_ms bigint, error string, " \
    "started_at timestamp, ended_at timestamp"


def run_status(dataset: str, query, started_at: dt.datetime) -> tuple:
    """The status row of an ended streaming query."""
    done = [p for p in query.recentProgress if p.numInputRows]
    failed = query.exception()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return (dataset, "FAILED" if failed else "SUCCEEDED", len(done), sum(p.numInputRows for p in done),
            sum(p.durationMs.get("triggerExecution", 0) for p in done), str(failed) if failed else None, started_at, now)


def log_status(spark: SparkSession, lake: Lake, rows: list[tuple]) -> None:
    """Append one run's rows (a row for each dataset)."""
    spark.createDataFrame(rows, STATUS_SCHEMA).coalesce(1).write.parquet(f"{lake.status_log}/run={uuid.uuid4().hex}")


def status_log(spark: SparkSession, lake: Lake) -> DataFrame:
    if not fs.list_dirs(spark, lake.status_log):
        return spark.createDataFrame([], STATUS_SCHEMA)
    return spark.read.schema(STATUS_SCHEMA).option("recursiveFileLookup", "true").parquet(lake.status_log)


def _pending(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    """Landed files of a dataset that its ledger doesn't list: count and oldest time."""
    from strata.sources.export import list_files
    fs.mkdirs(spark, lake.raw(dataset))  # nothing landed yet: nothing pending
    landed = list_files(spark, lake.raw(dataset)).where(F.col("length") > 0) \
        .select(relative_file(F.col("path"), lake.landing).alias("_file"), "modificationTime")
    loaded = read_ledger(spark, lake.load_ledger(dataset)).select("_file")
    return landed.join(loaded, "_file", "left_anti").agg(
        F.count(F.lit(1)).alias("pending_files"), F.min("modificationTime").alias("oldest")).withColumn("dataset", F.lit(dataset))


def pipe_status(spark: SparkSession, lake: Lake, datasets: tuple[str, ...] = DATASETS) -> DataFrame:
    """One row for each dataset: ``state``, ``last_rows``, ``last_batches`` and ``batch_ms``
    of its last run, ``loaded_files`` and ``loaded_rows`` in all, ``pending_files``,
    ``lag_seconds`` of the oldest pending file, the newest error ever and when it came."""
    log = status_log(spark, lake)
    last = latest_by(log, ["dataset"], [("started_at", "desc")])
    errors = latest_by(log.where(F.col("error").isNotNull()), ["dataset"], [("started_at", "desc")]) \
        .select("dataset", F.col("error").alias("last_error"), F.col("ended_at").alias("last_error_at"))
    loaded = pending = None
    for ds in datasets:
        n = read_ledger(spark, lake.load_ledger(ds)).agg(F.count(F.lit(1)).alias("loaded_files"),
                                                         F.coalesce(F.sum("rows"), F.lit(0)).alias("loaded_rows")).withColumn("dataset", F.lit(ds))
        p = _pending(spark, lake, ds)
        loaded, pending = (n, p) if loaded is None else (loaded.unionByName(n), pending.unionByName(p))
    names = spark.createDataFrame([(d,) for d in datasets], "dataset string")
    lag = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("oldest")
    return names.join(last, "dataset", "left").join(errors, "dataset", "left").join(loaded, "dataset").join(pending, "dataset") \
        .select("dataset", F.coalesce("state", F.lit("NEVER RUN")).alias("state"), F.col("rows").alias("last_rows"),
                F.col("batches").alias("last_batches"), "batch_ms", "loaded_files", "loaded_rows", "pending_files",
                F.when(F.col("pending_files") > 0, lag).alias("lag_seconds"), "last_error", "last_error_at")
