"""The extraction job over landed API responses (one or more runs, every dataset).

Input: ``responses(dataset, appid, page_no, run_ts, cursor, body VARIANT, error)``.
Output: the stamped raw records of each dataset, written to the landing folder
as NDJSON in the raw layout with a chunk number per fanned-out worker. Each
run's own chart decides its scope: only apps on that chart are kept for the
run's other datasets.

A record is ``map<string,variant>``: the stamps first, then the record's own
fields, which win over them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.constants import CHUNK_SIZE, DATASETS, REVIEW_LOOKBACK_HOURS, SOURCE_NAMES, TOP_N
from strata.functions.variant import vget
from strata.operators.responses import (chart_work_list, details_envelope, flatten_chart,
                                        flatten_review_pages, project_player_counts,
                                        scope_to_chart, spread)
from strata.sources.catalog import Lake
from strata.sources.ndjson import JSON_OPTIONS, write_ndjson

_RUN_APP = ["run_ts", "appid"]


def _fields(*columns: Column | str) -> Column:
    """Columns as an untyped record; a NULL stays as a JSON null."""
    text = F.to_json(F.struct(*columns), {**JSON_OPTIONS, "ignoreNullFields": "false"})
    return F.variant_get(F.parse_json(text), "$", "map<string,variant>")


def _stamped(df: DataFrame, dataset: str, record: Column, *first: str) -> DataFrame:
    """``run_ts``, ``part`` and the ``record`` under its stamps (and ``first`` columns)."""
    at = F.date_format("run_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("_extracted_at")
    stamps = _fields(at, F.lit(SOURCE_NAMES[dataset]).alias("_source"), *first)
    return df.select("run_ts", "part", spread(stamps, record).alias("record"))


def shape_run(responses: DataFrame, top_n: int = TOP_N, chunk_size: int = CHUNK_SIZE,
              lookback_hours: int = REVIEW_LOOKBACK_HOURS,
              datasets: tuple[str, ...] = DATASETS) -> dict[str, DataFrame]:
    """Per selected dataset: ``(run_ts, part, record)`` over all runs in ``responses``."""
    chart = flatten_chart(responses.where(F.col("dataset") == "most_played"), top_n=top_n)
    parts = chart_work_list(chart, chunk_size, datasets=("reviews",)).groupBy(*_RUN_APP).agg(F.min("part").alias("part"))

    def of(dataset: str) -> DataFrame:
        return scope_to_chart(responses.where(F.col("dataset") == dataset), parts, _RUN_APP)

    def charted() -> DataFrame:
        return _stamped(chart.withColumn("part", F.lit(None).cast("int")), "most_played", F.col("record"))

    def counts() -> DataFrame:
        found = project_player_counts(of("player_counts")).join(parts, _RUN_APP)
        return _stamped(found, "player_counts", _fields("appid", "player_count", "result"))

    def reviews() -> DataFrame:
        found = flatten_review_pages(of("reviews"), lookback_hours=lookback_hours).join(parts, _RUN_APP)
        return _stamped(found, "reviews", vget("review", "$", "map<string,variant>"), "appid")

    def details() -> DataFrame:
        found = details_envelope(of("app_details")).join(parts, _RUN_APP)
        # the error is a field of failed requests only
        record = spread(_fields("appid", "success", "data"), F.when(
            F.col("error").isNotNull(), _fields("error")).otherwise(F.map_from_arrays(
                F.array().cast("array<string>"), F.array().cast("array<variant>"))))
        return _stamped(found, "app_details", record)

    shaped = {"most_played": charted, "player_counts": counts, "reviews": reviews, "app_details": details}
    return {name: shaped[name]() for name in DATASETS if name in datasets}


def land_run(lake: Lake, records: dict[str, DataFrame]) -> dict[str, str | None]:
    """Write each dataset's records as NDJSON under the landing folder (skip empty)."""
    return {name: _land(lake, name, df) for name, df in records.items()}


def _land(lake: Lake, name: str, df: DataFrame, **kw) -> str | None:
    return write_ndjson(df.withColumn("_line", F.to_json("record")), lake.landing, name, "run_ts",
                        part=None if name == "most_played" else "part", json_text="_line", **kw)


EXTRACT_SCHEMA = "run_ts timestamp, dataset string, records bigint, path string"


def land_counted(lake: Lake, records: dict[str, DataFrame], runs: list[dt.datetime]) -> list[tuple]:
    """``land_run`` with the run summary: (run, dataset, records, path) for each of ``runs``
    and dataset, counted while the records are written, and added to the extraction log.

    A run without records of a dataset is listed with 0; its ``path`` is the dataset's
    landing folder, or null if nothing was ever landed.
    """
    summary = []
    for name, df in records.items():
        seen = Observation()
        counts = {f"n{i}": F.count_if(F.col("_ts") == F.lit(r).cast("timestamp")) for i, r in enumerate(runs)}
        path = _land(lake, name, df, counts=counts, seen=seen)
        summary += [(r, name, seen.get[f"n{i}"], path) for i, r in enumerate(runs)]
    if summary:
        spark = next(iter(records.values())).sparkSession
        spark.createDataFrame(summary, EXTRACT_SCHEMA).coalesce(1).write.parquet(f"{lake.extract_log}/run={uuid.uuid4().hex}")
    return summary


def extract_log(spark: SparkSession, lake: Lake) -> DataFrame:
    """The summaries of all extraction runs."""
    return spark.read.schema(EXTRACT_SCHEMA).option("recursiveFileLookup", "true").parquet(lake.extract_log)
