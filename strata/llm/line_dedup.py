"""Line dedup over levelled sorted runs of line hashes (DataFrame operations only).

Documents come in batches of ascending ``doc_id``. A run is a bucketed, sorted table of
the line keys (128-bit hashes) that one or more batches met first, with the ``doc_id``
that met them. Each new batch reduces its lines to one row for each key, merge-joins
that with the runs, and writes its step: keys without a match are the batch's own new
run, keys with a match were seen before. When a level has ``fanout`` runs they are
compacted into one run of the next level, so a batch meets a few runs only. A run is
bucketed like the batch's shuffle, which brings the step to its buckets; compaction
reads runs bucket by bucket, so no run is ever shuffled again. The tables leave the
catalog at the end.

A key is repeated if a batch's step says so; lines of repeated keys outside the key's
first document go. Texts are shuffled once, when the positions to drop meet them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BLANKS, ascii_lower, shuffle_partitions, stored
from strata.session import checkpoint_root

#: Keys shorter than this many code points never count as repeated.
MIN_CHARS = 10
#: Batches of a one-off run, and runs of a level that are compacted.
BATCHES, FANOUT = 4, 2
KEY = ["_h1", "_h2"]
#: A null ``doc_id`` counts as the largest.
LAST_ID = (1 << 63) - 1


class Runs:
    """The runs by level, newest last; each is a bucketed table in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout, self.levels, self.names = spark, fanout, [[]], []
        self.buckets = shuffle_partitions(spark)

    def _write(self, rows: DataFrame) -> DataFrame:
        """``rows`` as a bucketed, sorted table; they come by the buckets' hash already."""
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        self.names.append(name)
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).format("parquet") \
            .option("path", f"{checkpoint_root(self.spark)}/strata/{name}").saveAsTable(name)
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> DataFrame:
        """Merge a batch's lines (``_id`` and key) with the runs; its step: a row for each
        key with its ``owner``, whether the key is ``fresh``, and ``repeated``."""
        step = lines.groupBy(*KEY).agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
        seen = []
        for run in (r for level in self.levels for r in level):
            seen.append(f"_seen{len(seen)}")
            step = step.join(run.hint("merge").withColumnRenamed("owner", seen[-1]), KEY, "left")
        before = F.coalesce(*[F.col(c) for c in seen], F.lit(None).cast("bigint"))
        owner = F.coalesce(before, F.col("_first"))
        step = self._write(step.select(*KEY, owner.alias("owner"), before.isNull().alias("fresh"),
                                       (owner != F.col("_last")).alias("repeated")))
        self.levels[0].append(step.where("fresh").select(*KEY, "owner"))
        self._compact()
        return step

    def _compact(self) -> None:
        for at, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                rows = level[0]
                for run in level[1:]:
                    rows = rows.unionByName(run)
                if at + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[at + 1].append(self._write(rows))
                self.levels[at] = []

    def drop(self) -> None:
        """Take the runs' tables out of the catalog, once nothing reads them any more."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels, self.names = [[]], []


def _identified(docs: DataFrame) -> DataFrame:
    """``rest`` (all columns but the text), the text, and what tells rows apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("rest"), text.alias("_text"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("_id"), F.xxhash64(text).alias("_th"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``rest``, ``text`` (null: empty) without repeated lines, ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space and with A-Z lower-cased. All
    lines of a key of at least ``min_chars`` code points go, but for those in the
    smallest ``doc_id`` that holds it. A null ``doc_id`` counts as the largest; rows that
    share a ``doc_id`` count as one document. ``rest`` holds the other columns as they are.
    """
    spark = docs.sparkSession
    ided = _identified(docs)
    key = ascii_lower(F.btrim("_line", F.lit(BLANKS)))
    lines = ided.select("_id", "_th", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line")) \
        .select("_id", "_th", "_pos", key.alias("_key")).where(F.char_length("_key") >= min_chars) \
        .select("_id", "_th", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    cuts = ided.agg(F.percentile_approx("_id", [k / batches for k in range(1, batches)])).first()[0] or []
    batch = sum([(F.col("_id") > F.lit(c)).cast("int") for c in cuts], F.lit(0))
    lines = stored(spark, lines.withColumn("_batch", batch), "lines", "_batch")
    runs, repeated = Runs(spark, fanout), None
    for b in range(batches):
        step = runs.add(lines.where(F.col("_batch") == b)).where("repeated").select(*KEY, "owner")
        repeated = step if repeated is None else repeated.unionByName(step)
    owners = stored(spark, repeated.groupBy(*KEY).agg(F.min("owner").alias("owner")), "line-owners")
    runs.drop()
    dropped = lines.join(owners, KEY).where(F.col("_id") != F.col("owner")) \
        .groupBy("_id", "_th").agg(F.collect_set("_pos").alias("_gone"))
    parts = F.split("_text", "\n")
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.filter(parts, lambda line, at: ~F.array_contains(F.col("_gone"), at)), "\n"))
    return ided.join(dropped, ["_id", "_th"], "left").select(
        "rest", kept.alias("text"), F.size(parts).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_dropped"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs).select(F.col("rest.doc_id").cast("bigint").alias("doc_id"), "n_lines", "n_dropped",
                                            F.sha2(F.col("text"), 256).alias("kept_sha256"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; ``n_chars`` is that of the new text.

    Null texts become empty ones; a document whose lines were all repeated stays, as an empty
    text; repeated rows are one document to the rule and stay a row each."""
    found = drop_repeated_lines(docs)
    now = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return found.select(*[now.get(c, F.col(f"rest.{c}") if c != "text" else None).alias(c) for c in docs.columns])


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i, list_extract(parts, i) AS line,
         translate(trim(list_extract(parts, i), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
owners AS (
  SELECT k, min(doc_id) AS owner FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE owner IS NOT NULL AND owner <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN owners USING (k) GROUP BY doc_id
"""
