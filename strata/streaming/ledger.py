"""Load history views over the ingest ledger (rows per file, recent loads)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.bronze import read_ledger
from strata.sources.catalog import DATASETS, Lake


def load_history(spark: SparkSession, lake: Lake, since: str | None = None) -> DataFrame:
    """All loaded files of every dataset; ``since`` is an interval, e.g. ``'2 HOURS'``."""
    parts = [read_ledger(spark, lake.load_ledger(ds)).withColumn("dataset", F.lit(ds)) for ds in DATASETS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if since:
        out = out.where(F.col("_loaded_at") >= F.expr(f"current_timestamp() - INTERVAL {since}"))
    return out
