"""Build-on-arrival: the change streams of the four bronze tables drive the model DAG.

One streaming query unions the change streams of the four bronze tables
(each tagged with its name). A micro-batch exists only when at least one table received rows
(the OR of the four has-data predicates); ``foreachBatch`` then appends the
audit row (batch id, time, new rows per table) and runs the build. The
offsets are committed only after the batch function returns, so a failed
build is replayed with the same batch id and rows; the audit row is keyed
by batch id, so the replay overwrites it instead of duplicating it.

``processing_time="900 seconds"`` gives the debounce: all files of a daily
run that land within the interval trigger one build.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fs
from strata.sources.bronze import LEDGER_SCHEMA
from strata.sources.catalog import DATASETS, Lake

TRIGGER_LOG_SCHEMA = T.StructType(
    [T.StructField("batch_id", T.LongType()), T.StructField("triggered_at", T.TimestampType())]
    + [T.StructField(f"new_{ds}", T.LongType()) for ds in DATASETS])


def bronze_changes(spark: SparkSession, lake: Lake) -> DataFrame:
    """Append-only change stream over all bronze tables: ``(table_name, rows)``.

    It follows each table's load ledger, which an ingest batch writes only
    after its bronze folder is committed: every change the stream reports is
    already readable by the build it triggers.
    """
    streams = []
    for ds in DATASETS:
        fs.mkdirs(spark, lake.load_ledger(ds))
        s = (spark.readStream.schema(LEDGER_SCHEMA).parquet(lake.load_ledger(ds))
                  .select(F.lit(ds).alias("table_name"), "rows"))
        streams.append(s)
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def run_on_arrival(spark: SparkSession, lake: Lake, build_fn: Callable[[SparkSession, Lake, str], object],
                   processing_time: str | None = None):
    """Start the arrival stream. Without ``processing_time`` it drains what is
    there (``availableNow``) and returns; otherwise the running query is returned."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        counts = {r["table_name"]: r["n"] for r in
                  batch.groupBy("table_name").agg(F.sum("rows").alias("n")).collect()}  # <= 4 rows
        row = [(batch_id, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                *[int(counts.get(ds, 0)) for ds in DATASETS])]
        (spark.createDataFrame(row, TRIGGER_LOG_SCHEMA)
              .write.mode("overwrite").parquet(f"{lake.trigger_log}/batch={batch_id}"))
        build_fn(spark, lake, f"batch-{batch_id:06d}")

    w = (bronze_changes(spark, lake).writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", lake.arrival_checkpoint))
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def trigger_log(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(TRIGGER_LOG_SCHEMA).parquet(lake.trigger_log)
