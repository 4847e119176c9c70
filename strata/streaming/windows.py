"""Event-time streams over landed files: day buckets and overlap-tolerant dedup.

Both are keyed state behind a watermark, so their state follows the watermark's delay and
not the history. Each call drains what has landed (``availableNow``) and returns what it
did; the checkpoint remembers files, offsets, watermark and state between calls, and a
batch that is replayed after a lost executor or driver overwrites what it wrote before.

* ``count_days`` counts rows by ``window(time, '1 day')`` and keys. Every batch emits the
  buckets it changed with their whole counts, which are merged into a versioned table. A
  row whose day ended before the watermark is dropped by the state store; such rows are
  counted (rows read with a time, less the growth of all buckets) and logged with the run.
* ``keep_first`` keeps the first row of each key (``dropDuplicatesWithinWatermark``): what
  two overlapping extractions both hold is kept once, and a file that is landed again
  behind the watermark adds nothing.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fs
from strata.operators.incremental import SnapshotTable
from strata.sources.bronze import committed_batches

RUN_SCHEMA = "run bigint, rows bigint, timed bigint, counted bigint, late bigint, state_rows bigint, watermark string"


@dataclass
class StreamRun:
    """One drain: rows read, those with a time, those that were counted or kept, those
    behind the watermark, rows in the state store, and the watermark at its end."""

    run: int
    rows: int
    timed: int
    counted: int
    late: int
    state_rows: int
    watermark: str | None


def _landed(spark: SparkSession, landing: str, schema: T.StructType | str, time: str, delay: str,
            files_per_batch: int | None) -> DataFrame:
    """New files as rows, observed as they are read, with the watermark on ``time``."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    rows = reader.json(landing).observe("read", F.count(F.lit(1)).alias("rows"), F.count(F.col(time)).alias("timed"))
    return rows.withWatermark(time, delay)


def _drain(writer, checkpoint: str) -> tuple[int, int, int, int, str | None]:
    """Run until everything landed is read: last batch id, rows, rows with a time, state
    rows and watermark."""
    rows = timed = state = 0
    last, mark = -1, None
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    seen: set[int] = set()
    while True:
        ended = q.awaitTermination(1)  # progress is kept for a bounded number of batches: read it on the way
        for p in q.recentProgress:
            if p.batchId in seen:
                continue
            seen.add(p.batchId)
            last = max(last, p.batchId)
            if "read" in p.observedMetrics:
                rows, timed = rows + p.observedMetrics["read"].rows, timed + p.observedMetrics["read"].timed
            state = sum(o.numRowsTotal for o in p.stateOperators)
            mark = p.eventTime.get("watermark", mark)
        if ended:
            return last, rows, timed, state, mark


def _log(spark: SparkSession, out: str, run: StreamRun) -> StreamRun:
    spark.createDataFrame([astuple(run)], RUN_SCHEMA).write.mode("overwrite").parquet(f"{out}/_runs/run={run.run}")
    return run


def stream_runs(spark: SparkSession, out: str) -> DataFrame:
    """The log of all drains into ``out``."""
    return spark.read.schema(RUN_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{out}/_runs")


def _day_table(spark: SparkSession, out: str) -> SnapshotTable:
    """Keyed by day and ``bucket``, the keys as text: null keys are buckets like others."""
    return SnapshotTable(spark, f"{out}/days", key=["day", "bucket"], partition_by="day")


def day_counts(spark: SparkSession, out: str) -> DataFrame:
    """``day``, the keys and ``n``, as ``count_days`` left them."""
    return _day_table(spark, out).read().drop("bucket", "batch")


def count_days(spark: SparkSession, landing: str, schema: T.StructType | str, checkpoint: str, out: str, time: str,
               keys: tuple[str, ...] = (), delay: str = "1 day", files_per_batch: int | None = None) -> StreamRun:
    """Count new rows per day of ``time`` (and ``keys``) into ``out`` (read them with ``day_counts``).

    A row without a time belongs to no day (``rows`` less ``timed``).
    """
    table = _day_table(spark, out)

    def total() -> int:
        return table.read().agg(F.sum("n")).first()[0] or 0 if table.exists() else 0

    def merge(batch: DataFrame, batch_id: int) -> None:
        bucket = F.to_json(F.struct(*keys)) if keys else F.lit("")
        days = batch.select(F.to_date("w.start").alias("day"), bucket.alias("bucket"), *keys, "n",
                            F.lit(batch_id).cast("bigint").alias("batch"))
        table.upsert(days, mode="newer", order=[("batch", "desc")])

    before = total()
    counted = _landed(spark, landing, schema, time, delay, files_per_batch) \
        .groupBy(F.window(time, "1 day").alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    last, rows, timed, state, mark = _drain(counted.writeStream.outputMode("update").foreachBatch(merge), checkpoint)
    grown = total() - before
    return _log(spark, out, StreamRun(last, rows, timed, grown, timed - grown, state, mark))


def keep_first(spark: SparkSession, landing: str, schema: T.StructType | str, checkpoint: str, out: str, key: list[str],
               time: str, delay: str = "24 hours", files_per_batch: int | None = None) -> StreamRun:
    """Append the first row of each key to ``out`` (read it with ``kept_rows``).

    A repeat is recognised if its time is at most ``delay`` behind the newest time read
    before; a row further behind is dropped as late. So of each key one row is kept as
    long as its first row isn't late itself. Rows without a time are dropped.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    def total() -> int:
        return kept_rows(spark, out, schema).count()

    before = total()
    first = _landed(spark, landing, schema, time, delay, files_per_batch).where(F.col(time).isNotNull()) \
        .dropDuplicatesWithinWatermark(key)
    last, rows, timed, state, mark = _drain(first.writeStream.outputMode("append").foreachBatch(append), checkpoint)
    kept = total() - before
    return _log(spark, out, StreamRun(last, rows, timed, kept, timed - kept, state, mark))


def kept_rows(spark: SparkSession, out: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all committed batches."""
    ids = committed_batches(spark, out) if fs.exists(spark, out) else []
    reader = spark.read.schema(schema)
    if not ids:
        empty = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return spark.createDataFrame([], empty)
    return reader.parquet(*[f"{out}/batch_id={b}" for b in ids])
