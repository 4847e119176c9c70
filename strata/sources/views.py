"""The models in the session catalog: SQL from any session, without a DataFrame at hand.

``publish`` registers every stored model as an external table over the Parquet folders of
its newest version: a partitioned model gets one catalog partition for each day, located in
the version folder that holds it, so SQL prunes days from the catalog without a listing,
and nothing is copied. The report is a SQL view over fact and dimension, joined at read
time. All sessions of the application see them (a session with a metastore: all
applications); ``publish`` after a build points them to the new versions.

``publish_star`` writes fact and dimension bucketed and sorted by ``game_key``. Each joins
the other bucket by bucket: the report then needs no shuffle, whatever the tables' size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.operators.incremental import SnapshotTable
from strata.plans.build import gold_tables, stored_models
from strata.sources.catalog import Lake

#: Partitions added by one statement.
BATCH = 500
_NULL = "__HIVE_DEFAULT_PARTITION__"
FACT, DIM, REPORT = "fact_daily_game_performance", "dim_game", "rpt_daily_game_performance"

#: The report's columns: ``gold.rpt_daily_game_performance`` in SQL.
_ROUND = "cast(round(cast(f.{c} as decimal(38,6)), 3) as decimal(38,3)) AS {c}"
_REPORT = f"""SELECT f.activity_date, f.chart_rank, f.last_week_rank, g.game_name, g.primary_developer, g.primary_publisher,
  g.primary_genre, g.is_free, g.has_store_page, f.peak_in_game, f.snapshot_player_count, f.reviews_total, f.reviews_positive,
  f.reviews_negative, {_ROUND.format(c='positive_review_ratio')}, {_ROUND.format(c='avg_weighted_vote_score')},
  f.median_playtime_at_review_min
FROM {{fact}} f JOIN {{dim}} g ON g.game_key = f.game_key"""


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _publish(spark: SparkSession, name: str, table: SnapshotTable) -> None:
    """One stored model as an external table of the catalog."""
    m = table.current()
    schema = table.read(at=m).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if table.part is None:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION {_text(table.folder(m['partitions']['']))}")
        return
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{table.part}`) LOCATION {_text(table.root)}")
    parts = sorted(m["partitions"].items())
    for at in range(0, len(parts), BATCH):
        added = " ".join(f"PARTITION (`{table.part}` = {'null' if p == _NULL else _text(p)}) LOCATION {_text(table.folder(v, p))}"
                         for p, v in parts[at:at + BATCH])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")


def publish(spark: SparkSession, lake: Lake, database: str) -> list[str]:
    """Register all built models in ``database``; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, table in stored_models(spark, lake).items():
        _publish(spark, f"{database}.{name}", table)
        names.append(name)
    if {FACT, DIM} <= set(names):
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{REPORT} AS " + _REPORT.format(fact=f"{database}.{FACT}", dim=f"{database}.{DIM}"))
        names.append(REPORT)
    return names


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """``df`` as a catalog table, one file for each of ``buckets`` buckets of ``key``, sorted."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key) \
        .format("parquet").option("path", path).saveAsTable(name)


def publish_star(spark: SparkSession, lake: Lake, database: str, buckets: int) -> DataFrame:
    """Fact and dimension co-located by ``game_key``, and the report over them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = gold_tables(spark, lake)
    for name in (FACT, DIM):
        save_bucketed(made[name], f"{database}.{name}_bucketed", f"{lake.root}/bucketed/{name}", "game_key", buckets)
    view = f"{database}.{REPORT}_bucketed"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS " + _REPORT.format(fact=f"{database}.{FACT}_bucketed", dim=f"{database}.{DIM}_bucketed"))
    return spark.table(view)
