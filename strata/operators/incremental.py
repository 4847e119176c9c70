"""Incremental upsert into a versioned Parquet snapshot table.

There is no MERGE on plain Parquet, so an upsert writes a new *version*
that contains only the partitions it touches; untouched partitions are
carried over by reference in a small manifest (one entry per partition
value, e.g. per review date).

Layout::

    root/snapshot_version=000003/review_date=2024-01-05/part-....parquet
    root/_manifest/v=000003.claim  the folder number 3 is taken
    root/_manifest/v=000003.json   the third commit: {"version": 3, "partitions": {"2024-01-05": 3, ...}, ...}

A version is visible only once its manifest exists, so a failed or retried
job never exposes half-written data, and the table being read is never
overwritten in place. Manifests are numbered by commit, and a commit creates
the file that follows the one it started from: of two writers that started from
the same one, only the first can. The second one's upsert is done again on
the new state; its ``replace`` and ``replace_partitions`` fail with
``ConcurrentUpdate``, since what they were computed from is out of date.
Two high-water modes:

* ``strict``: only source rows with ``hw_column > max(target.hw_column)``
  (default 1970-01-01) are merged; a matched key is replaced by the source
  row, unmatched keys are inserted, nothing is deleted. Late files that
  carry an already-seen stamp are skipped (reference behaviour).
* ``loaded_at``: only source rows loaded after the last consumed load time
  are merged, and a target row is replaced only when the source row is
  newer by ``order``; late files are kept.

Where a key may have moved to another partition, the target's key column is
searched through a Bloom filter of the source's keys and their range: the range
reaches the Parquet scan, the filter drops other keys before anything is
shuffled.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fs
from strata.constants import HIGH_WATER_DEFAULT as _EPOCH
from strata.operators.bloom import key_filter
from strata.operators.dedup import latest_by

_NULL_PART = "__HIVE_DEFAULT_PARTITION__"
_VDIR = "snapshot_version"


def _number(path: str) -> int:
    """The number in a manifest's or claim's name."""
    return int(path.rsplit("v=", 1)[1].split(".")[0])


class ConcurrentUpdate(RuntimeError):
    """Another writer committed since this one started; nothing was changed."""


class SnapshotTable:
    #: Times that an upsert is done again after another writer's commit.
    REBASES = 5

    def __init__(self, spark: SparkSession, root: str, key: str | list[str] | None = None,
                 partition_by: str | None = None, keep_versions: int = 3):
        self.spark, self.root, self.part = spark, root.rstrip("/"), partition_by
        self.keep_versions = keep_versions
        self.keys = [key] if isinstance(key, str) else list(key or [])
        self.key = self.keys[0] if len(self.keys) == 1 else None

    # -- metadata -----------------------------------------------------------
    def _manifest_dir(self) -> str:
        return f"{self.root}/_manifest"

    def _versions(self) -> list[int]:
        names = fs.list_dirs(self.spark, self.root)
        return sorted(int(n[len(_VDIR) + 1:]) for n in names if n.startswith(_VDIR + "="))

    def _manifests(self) -> list[str]:
        return sorted(fs.glob(self.spark, f"{self._manifest_dir()}/v=*.json"))

    def current(self) -> dict | None:
        """The newest committed manifest, or None before the first run."""
        for path in reversed(self._manifests()):
            text = fs.read_text(self.spark, path)
            if text:
                try:
                    return {"commit": _number(path), **json.loads(text)}
                except ValueError:
                    continue
        return None

    def manifest(self, commit: int) -> dict | None:
        """The manifest of an earlier commit, if it is still kept."""
        path = f"{self._manifest_dir()}/v={commit:06d}.json"
        text = fs.read_text(self.spark, path)
        return {"commit": commit, **json.loads(text)} if text else None

    def exists(self) -> bool:
        return self.current() is not None

    def folder(self, version: int, partition: str | None = None) -> str:
        """Where a version, or a partition written by it, lies."""
        path = f"{self.root}/{_VDIR}={version:06d}"
        return path if partition is None else f"{path}/{self.part}={partition}"

    # -- reads --------------------------------------------------------------
    def read(self, partitions: list[str] | None = None, at: dict | None = None) -> DataFrame:
        """The table, or some of its partitions; ``at`` is a manifest from ``current``."""
        m = at or self.current()
        if m is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        schema = T.StructType.fromJson(json.loads(m["schema"]))
        wanted = m["partitions"] if partitions is None else \
            {p: m["partitions"][p] for p in partitions if p in m["partitions"]}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        if self.part is None:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{_VDIR}={wanted['']:06d}")
        paths = [f"{self.root}/{_VDIR}={ver:06d}/{self.part}={p}" for p, ver in sorted(wanted.items())]
        read_schema = T.StructType(list(schema.fields) + [T.StructField(_VDIR, T.StringType())])
        df = (self.spark.read.schema(read_schema).option("basePath", self.root).parquet(*paths))
        return df.select(*[F.col(f.name) for f in schema.fields])

    # -- writes -------------------------------------------------------------
    def _claim(self) -> int:
        """The next folder number, taken by creating its claim file."""
        taken = [_number(p) for p in fs.glob(self.spark, f"{self._manifest_dir()}/v=*.claim")]
        version = max([0, *self._versions(), *taken]) + 1
        fs.write_text(self.spark, f"{self._manifest_dir()}/v={version:06d}.claim", "", overwrite=False)
        return version

    def _write_version(self, df: DataFrame, version: int, **marks: Column) -> tuple[list[str], dict]:
        """The partitions written, and the number of ``rows`` and other aggregates, observed
        while they were written."""
        path = f"{self.root}/{_VDIR}={version:06d}"
        seen = Observation()
        aggs = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in marks.items()]]
        if self.part is None:
            df.observe(seen, *aggs).write.mode("overwrite").parquet(path)
            return [""], seen.get
        # Rebalanced by the partition value: adaptive execution packs small dates and splits
        # a hot one over several writers, by the sizes of what was shuffled. ``df`` is
        # evaluated once (a range partitioning evaluates it once more, to sample). Sorted
        # by key, so that a search for keys skips pages.
        order = [F.col(self.part)] + [F.col(k) for k in self.keys]
        (df.hint("rebalance", F.col(self.part)).observe(seen, *aggs).sortWithinPartitions(*order)
           .write.mode("overwrite").partitionBy(self.part).parquet(path))
        prefix = f"{self.part}="
        return [n[len(prefix):] for n in fs.list_dirs(self.spark, path) if n.startswith(prefix)], seen.get

    def _commit(self, version: int, base: dict | None, partitions: dict, schema: T.StructType, meta: dict) -> None:
        """Create the manifest that follows ``base``; fails if another writer has."""
        fs.mkdirs(self.spark, f"{self.root}/{_VDIR}={version:06d}")  # a version may hold no files
        body = {"version": version, "partitions": partitions, "schema": schema.json(), "meta": meta}
        number = base["commit"] + 1 if base else 1
        path = f"{self._manifest_dir()}/v={number:06d}.json"
        taken = [p for p in self._manifests() if _number(p) >= number]
        try:
            if taken:
                raise ConcurrentUpdate(taken[-1])
            fs.write_text(self.spark, path, json.dumps(body), overwrite=False)
        except Exception as e:
            if isinstance(e, ConcurrentUpdate) or fs.exists(self.spark, path):
                fs.delete(self.spark, f"{self.root}/{_VDIR}={version:06d}")
                raise ConcurrentUpdate(f"{path} was committed meanwhile") from e
            raise
        self._drop_superseded()

    def _drop_superseded(self) -> None:
        """Remove manifests older than the newest ``keep_versions``, their claims, and the
        folders that only they refer to (found in the manifests, without a listing)."""
        committed = self._manifests()
        old, kept = committed[:-self.keep_versions], committed[-self.keep_versions:]
        if not old:
            return
        body = lambda path: json.loads(fs.read_text(self.spark, path) or '{"partitions": {}, "version": 0}')
        wanted = {(v, p) for m in map(body, kept) for p, v in [*m["partitions"].items(), (None, m["version"])]}
        used = {v for v, _ in wanted}
        for path in old:
            m = body(path)
            for p, v in [*m["partitions"].items(), (None, m["version"])]:
                if v not in used:
                    fs.delete(self.spark, f"{self.root}/{_VDIR}={v:06d}")
                elif p and (v, p) not in wanted:
                    fs.delete(self.spark, f"{self.root}/{_VDIR}={v:06d}/{self.part}={p}")
            fs.delete(self.spark, path)
        for path in fs.glob(self.spark, f"{self._manifest_dir()}/v=*.claim"):
            if _number(path) < min(used):
                fs.delete(self.spark, path)

    def replace(self, df: DataFrame, meta: dict | None = None) -> dict:
        """Full rebuild: a new version holding exactly ``df``."""
        base = self.current()
        version = self._claim()
        written, seen = self._write_version(df, version)
        self._commit(version, base, {p: version for p in written}, df.schema, meta or {})
        return {"version": version, "partitions": written, "rows": seen["rows"]}

    def replace_partitions(self, df: DataFrame, partitions: list[str], meta: dict | None = None) -> dict:
        """Rewrite only ``partitions`` with the rows of ``df`` (which must lie in
        them); every other partition is carried over by reference. A listed
        partition without rows disappears."""
        cur = self.current()
        if cur is None:
            return self.replace(df, meta)
        version = self._claim()
        written, seen = self._write_version(df, version)
        drop = set(partitions)
        parts = {p: v for p, v in cur["partitions"].items() if p not in drop}
        parts.update({p: version for p in written})
        self._commit(version, cur, parts, df.schema, meta if meta is not None else cur["meta"])
        return {"version": version, "partitions": sorted(drop), "rows": seen["rows"]}

    def upsert(self, source: DataFrame, mode: str = "strict", hw_column: str = "extracted_at",
               loaded_column: str = "_loaded_at", order: list | None = None,
               meta_update: dict | None = None) -> dict:
        """Merge ``source`` on the key columns; returns a small summary.

        ``mode="newer"`` merges the source as given (the caller selected the new
        rows) and keeps every column: a target row is replaced only when the
        source row comes first by ``order`` (ties go to the source).

        The selected and deduplicated source is written once and read by every
        step of the merge; a table's first rows are written in place. A key may change partition: unless the partition
        column is part of the key, a semi join over the target's key and
        partition columns finds where matched keys are now.
        """
        if mode not in ("strict", "loaded_at", "newer"):
            raise ValueError(f"unknown mode {mode}")
        for turn in range(self.REBASES + 1):
            try:
                return self._upsert(source, mode, hw_column, loaded_column, order, meta_update)
            except ConcurrentUpdate:  # another writer came first: merge into what it left
                if turn == self.REBASES:
                    raise

    def _upsert(self, source: DataFrame, mode: str, hw_column: str, loaded_column: str, order: list | None,
                meta_update: dict | None) -> dict:
        keys = self.keys
        cur = self.current()
        meta = dict(cur["meta"]) if cur else {}
        src = source
        if cur is not None and mode == "strict":
            src = self._above(src, hw_column, meta.get("hw"))
        elif cur is not None and mode == "loaded_at":
            src = self._above(src, loaded_column, meta.get("loaded_hw"))
        if order:
            src = latest_by(src, keys, order)
        version = self._claim()
        if cur is None and mode != "loaded_at":  # nothing to merge into
            return self._first(src, version, {**meta, **(meta_update or {})}, hw_column)
        staging = f"{self.root}/_staging/v={version:06d}"
        schema = src.schema
        src.write.mode("overwrite").parquet(staging)
        try:
            return self._merge(self.spark.read.schema(schema).parquet(staging), cur, meta, version, mode,
                               hw_column, loaded_column, order, meta_update)
        finally:
            fs.delete(self.spark, staging)

    def _first(self, src: DataFrame, version: int, meta: dict, hw_column: str) -> dict:
        """The first rows of a table, written straight to its first version."""
        marks = {"hw": F.max(hw_column).cast("string")} if hw_column in src.columns else {}
        written, seen = self._write_version(src, version, **marks)
        written = written if seen["rows"] else []
        hw = {} if seen.get("hw") is None else {"hw": seen["hw"]}
        self._commit(version, None, {p: version for p in written}, src.schema, {**hw, **meta})
        return {"version": version, "rows": seen["rows"], "partitions": written}

    @staticmethod
    def _above(src: DataFrame, column: str, mark: str | None) -> DataFrame:
        """Rows above a stored mark, compared as values of the column's own type."""
        kind = src.schema[column].dataType
        if mark is None and isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            mark = _EPOCH
        return src if mark is None else src.where(F.col(column) > F.lit(mark).cast(kind))

    def _merge(self, src: DataFrame, cur: dict | None, meta: dict, version: int, mode: str, hw_column: str,
               loaded_column: str, order: list | None, meta_update: dict | None) -> dict:
        keys = self.keys
        out_cols = [c for c in src.columns if not (mode == "loaded_at" and c == loaded_column)]

        def mark(column: str, old: str | None):
            kind = src.schema[column].dataType
            return F.greatest(F.max(column), F.lit(old).cast(kind)).cast("string")

        # one pass over the staged source for the new high-water marks
        aggs = [F.count(F.lit(1)).alias("n")]
        if hw_column in src.columns:
            aggs.append(mark(hw_column, meta.get("hw")).alias("hw"))
        if mode == "loaded_at":
            aggs.append(mark(loaded_column, meta.get("loaded_hw")).alias("loaded_hw"))
        agg = src.agg(*aggs).first().asDict()
        n = agg.pop("n")
        new_meta = {**meta, **{k: v for k, v in agg.items() if v is not None}, **(meta_update or {})}
        src_rows = src.select(*out_cols)
        if n == 0:  # the same partitions; on a first run, an empty table with the schema
            parts, schema = ({}, src_rows.schema) if cur is None else \
                (cur["partitions"], T.StructType.fromJson(json.loads(cur["schema"])))
            if cur is None or new_meta != meta:
                self._commit(version, cur, parts, schema, new_meta)
            return {"version": version if cur is None else cur["version"], "rows": 0, "partitions": []}
        if cur is None:
            written, _ = self._write_version(src_rows, version)
            self._commit(version, cur, {p: version for p in written}, src_rows.schema, new_meta)
            return {"version": version, "rows": n, "partitions": written}

        src_keys = src_rows.select(*keys)
        if self.part is None:
            affected = [""]
        else:
            part_str = F.coalesce(F.col(self.part).cast("string"), F.lit(_NULL_PART))
            parts_df = src_rows.select(part_str)
            if self.part not in keys:  # matched keys may sit in any partition: find theirs
                hit = self.candidates(src_keys, n, cur).join(src_keys, keys, "left_semi")
                parts_df = parts_df.union(hit.select(part_str))
            affected = [r[0] for r in parts_df.distinct().collect()]  # partition names only
        touched = [p for p in affected if p in cur["partitions"]]
        target_aff = self.read(touched, at=cur)
        kept = target_aff.join(src_keys, keys, "left_anti")
        if mode == "strict":
            winners = src_rows
        else:
            old = target_aff.join(src_keys, keys, "left_semi").withColumn("_src", F.lit(0))
            cand = old.unionByName(src_rows.withColumn("_src", F.lit(1)))
            winners = latest_by(cand, keys, list(order or []) + [("_src", "desc")]).drop("_src")
        written, _ = self._write_version(kept.unionByName(winners), version)
        parts = {p: v for p, v in cur["partitions"].items() if p not in set(affected)}
        parts.update({p: version for p in written})
        self._commit(version, cur, parts, src_rows.schema, new_meta)
        return {"version": version, "rows": n, "partitions": sorted(affected)}

    def candidates(self, src_keys: DataFrame, n: int, at: dict | None = None) -> DataFrame:
        """Key and partition columns of the target rows that may match one of ``n`` source
        keys: none that matches is missing, few others are left."""
        return self.read(at=at).where(key_filter(src_keys, self.keys, n)).select(*self.keys, self.part)
