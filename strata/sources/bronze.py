"""Bronze ingest: NDJSON files -> ``(payload VARIANT, _file, _loaded_at)``.

A Structured Streaming file source over the landing folder; its checkpoint
remembers every file already read, so a file is loaded once no matter how
often the ingest runs (``availableNow`` for batch-style runs, a processing
time trigger for continuous arrival). Each micro-batch is written to its
own ``batch_id=N`` folder with overwrite, so a replayed batch (after a lost
executor or driver) rewrites the same folder instead of duplicating rows.

Strict mode fails the batch on a malformed line (``parse_json``), like a
bulk load that aborts on error; lenient mode sends unparsable lines to a
quarantine table and loads the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRONZE_SCHEMA = T.StructType([
    T.StructField("payload", T.VariantType()),
    T.StructField("_file", T.StringType()),
    T.StructField("_loaded_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("_file", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("_loaded_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])


@dataclass
class IngestResult:
    batches: int
    rows: int


def relative_file(path_col, stage_root: str):
    """``_metadata.file_path`` relative to the stage root.

    Scheme and authority are stripped from both, then exactly the root's path.
    """
    bare = lambda c: F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?/*", "/")
    root = bare(F.lit(stage_root.rstrip("/") + "/"))
    path = bare(path_col)
    return F.when(F.startswith(path, root), F.substring(path, F.length(root) + 1, F.length(path))).otherwise(path)


def _parse(lines: DataFrame, strict: bool) -> DataFrame:
    parse = F.parse_json if strict else F.try_parse_json
    return lines.select(parse(F.col("value")).alias("payload"), "value", "_file")


def ingest(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
           stage_root: str | None = None, strict: bool = True, quarantine: str | None = None,
           ledger: str | None = None, available_now: bool = True,
           processing_time: str | None = None, max_files_per_trigger: int | None = None,
           wait: bool = True, archive_dir: str | None = None, max_file_age: str | None = None):
    """Load every not-yet-loaded NDJSON file under ``landing`` into ``bronze``.

    With ``wait=False`` the started query and a result getter are returned,
    so several tables can ingest concurrently. ``archive_dir`` moves every
    loaded file out of the landing folder once its batch is committed, so the
    per-trigger listing covers new files only, not years of history;
    ``max_file_age`` bounds how old a file may be to be considered.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    root = stage_root or landing
    lines = (reader.load(landing)
                   .select("value", relative_file(F.col("_metadata.file_path"), root).alias("_file"))
                   .where(F.length(F.trim(F.col("value"))) > 0))
    stats = {"batches": 0, "rows": 0}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = _parse(batch, strict).withColumn("_loaded_at", F.current_timestamp())
        if not strict:
            bad = parsed.where(F.col("payload").isNull())
            if quarantine:
                (bad.select(F.col("value").alias("line"), "_file", "_loaded_at")
                    .write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}"))
            parsed = parsed.where(F.col("payload").isNotNull())
        seen = Observation()
        good = parsed.select("payload", "_file", "_loaded_at").observe(seen, F.count(F.lit(1)).alias("rows"))
        good.write.mode("overwrite").parquet(f"{bronze}/batch_id={batch_id}")
        if ledger:  # reads the two narrow columns of what was written
            written = spark.read.schema(BRONZE_SCHEMA).parquet(f"{bronze}/batch_id={batch_id}")
            (written.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"),
                                          F.max("_loaded_at").alias("_loaded_at"))
                    .write.mode("overwrite").parquet(f"{ledger}/batch_id={batch_id}"))
        stats["batches"] += 1
        stats["rows"] += seen.get["rows"]

    w = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    if processing_time:
        return q  # caller owns the running query
    if not wait:
        return q, lambda: IngestResult(**stats)
    q.awaitTermination()
    return IngestResult(**stats)


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    from strata import fs
    if not fs.list_dirs(spark, path):  # nothing loaded yet: an empty table
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


@dataclass(frozen=True)
class Unit:
    """A committed bronze folder: one batch, or a compacted range of batches."""

    first: int
    last: int
    path: str

    @property
    def compacted(self) -> bool:
        return "/batches=" in self.path


def committed_units(spark: SparkSession, bronze: str, covered: bool = False) -> list[Unit]:
    """The folders that make up the table, in order of their batches (one listing).

    A folder counts once it is fully committed (``_SUCCESS`` present), so a folder still
    being written is invisible, and a consumer that tracks the last batch it read can never
    skip part of one. A folder within a compacted range is superseded; ``covered`` returns
    those instead.
    """
    from strata import fs
    found = []
    for p in fs.glob(spark, f"{bronze.rstrip('/')}/{{batch_id,batches}}=*/_SUCCESS"):
        path = p.rsplit("/", 1)[0]
        ends = path.rsplit("=", 1)[1].split("-")
        found.append(Unit(int(ends[0]), int(ends[-1]), path))
    found.sort(key=lambda u: (u.first, -u.last, not u.compacted))
    top, under = [], []
    for u in found:
        (under if top and u.last <= top[-1].last else top).append(u)
    return under if covered else top


def committed_batches(spark: SparkSession, bronze: str) -> list[int]:
    """Ids of all committed batches."""
    return [b for u in committed_units(spark, bronze) for b in range(u.first, u.last + 1)]


def read_bronze(spark: SparkSession, bronze: str, after_batch: int | None = None,
                batches: list[int] | None = None) -> DataFrame:
    """The bronze table: every committed batch, or those after ``after_batch``.

    Only the folders that hold selected batches are read; a compacted one is filtered by
    ``batch_id`` if only some of its batches are wanted.
    """
    units = committed_units(spark, bronze)
    wanted = None if batches is None else set(batches)
    chosen = lambda b: (wanted is None or b in wanted) and (after_batch is None or b > after_batch)
    singles, out = [], None
    for u in units:
        ids = [b for b in range(u.first, u.last + 1) if chosen(b)]
        if not ids:
            continue
        if not u.compacted:
            singles.append(u.path)
            continue
        part = spark.read.schema(BRONZE_SCHEMA).parquet(u.path)
        if len(ids) < u.last - u.first + 1:  # ids of a consumer are a run, but need not be
            run = F.col("batch_id").between(ids[0], ids[-1])
            part = part.where(run if len(ids) == ids[-1] - ids[0] + 1 else F.col("batch_id").isin(ids))
        out = part if out is None else out.unionByName(part)
    if singles:
        part = spark.read.schema(BRONZE_SCHEMA).option("basePath", bronze.rstrip("/")).parquet(*singles)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], BRONZE_SCHEMA) if out is None else out


#: A compacted folder holds about this much, in files of about that much.
COMPACTED_BYTES, FILE_BYTES = 8 << 30, 256 << 20


def compact_bronze(spark: SparkSession, bronze: str, keep: int = 1, most_bytes: int = COMPACTED_BYTES) -> list[Unit]:
    """Rewrite runs of neighbouring folders into few larger ones; the newest ``keep`` batches
    stay as they are. Returns the new folders.

    Neighbours are packed in order until a folder would exceed ``most_bytes``. A new folder
    counts from its ``_SUCCESS`` on, at which moment the folders it covers stop counting;
    they are deleted by the next compaction, so builds that listed them before can end. So
    a compaction that is broken off at any point loses and doubles nothing, and the next
    one takes it up again.
    """
    from strata import fs
    for u in committed_units(spark, bronze, covered=True):
        fs.delete(spark, u.path)
    units = committed_units(spark, bronze)
    units = units[:max(0, len(units) - keep)]
    bins: list[list[Unit]] = []
    held = 0
    for u in units:
        size = fs.size(spark, u.path)
        if bins and u.first == bins[-1][-1].last + 1 and held + size <= most_bytes:
            bins[-1].append(u)
            held += size
        else:
            bins.append([u])
            held = size
    made = []
    for group in bins:
        if len(group) == 1:
            continue
        new = Unit(group[0].first, group[-1].last, f"{bronze.rstrip('/')}/batches={group[0].first}-{group[-1].last}")
        rows = read_bronze(spark, bronze, batches=list(range(new.first, new.last + 1)))
        files = max(1, -(-sum(fs.size(spark, u.path) for u in group) // FILE_BYTES))
        rows.repartitionByRange(files, "batch_id", "_file", F.xxhash64(F.to_json("payload"))) \
            .write.mode("overwrite").parquet(new.path)
        made.append(new)
    return made


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Load history: one row per loaded file (rows, load time, batch)."""
    return _read(spark, ledger, LEDGER_SCHEMA)
