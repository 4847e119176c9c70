"""The lake layout and the source registry.

One root folder (on shared storage) holds every layer::

    raw/<dataset>/ingest_date=YYYY-MM-DD/...ndjson   landing (stage root)
    bronze/<dataset>/batch_id=N/                      VARIANT documents
    silver/<model>/run=<id>/                          materialized once per build
    gold/<model>/snapshot_version=N/ + _manifest/     versioned gold tables
    state/daily_reviews/                              mergeable partial aggregates
    ops/{load_ledger,quarantine,run_ledger,trigger_log,pipe_status,extract_log}/
    _checkpoints/{ingest/<dataset>,arrival}/          stream offsets
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.constants import DATASETS  # noqa: F401  (re-exported)

#: Registered source names -> datasets.
SOURCES = {
    "MOST_PLAYED": "most_played",
    "PLAYER_COUNTS": "player_counts",
    "REVIEWS": "reviews",
    "APP_DETAILS": "app_details",
}


@dataclass(frozen=True)
class Lake:
    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/raw"

    def raw(self, dataset: str) -> str:
        return f"{self.landing}/{dataset}"

    def bronze(self, dataset: str) -> str:
        return f"{self.root}/bronze/{dataset}"

    def ingest_checkpoint(self, dataset: str) -> str:
        return f"{self.root}/_checkpoints/ingest/{dataset}"

    def load_ledger(self, dataset: str) -> str:
        return f"{self.root}/ops/load_ledger/{dataset}"

    def quarantine(self, dataset: str) -> str:
        return f"{self.root}/ops/quarantine/{dataset}"

    def silver(self, model: str, run_id: str) -> str:
        return f"{self.root}/silver/{model}/run={run_id}"

    def silver_table(self, model: str) -> str:
        return f"{self.root}/silver_tables/{model}"

    @property
    def daily_state(self) -> str:
        return f"{self.root}/state/daily_reviews"

    def gold(self, model: str) -> str:
        return f"{self.root}/gold/{model}"

    @property
    def status_log(self) -> str:
        return f"{self.root}/ops/pipe_status"

    @property
    def extract_log(self) -> str:
        return f"{self.root}/ops/extract_log"

    @property
    def run_ledger(self) -> str:
        return f"{self.root}/ops/run_ledger"

    @property
    def trigger_log(self) -> str:
        return f"{self.root}/ops/trigger_log"

    @property
    def arrival_checkpoint(self) -> str:
        return f"{self.root}/_checkpoints/arrival"


def source(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """``source(<raw schema>, NAME)``: the bronze table registered under NAME."""
    from strata.sources.bronze import read_bronze
    return read_bronze(spark, lake.bronze(SOURCES[name.upper()]))
