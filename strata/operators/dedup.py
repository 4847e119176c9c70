"""Latest-wins deduplication (``QUALIFY row_number() OVER (...) = 1``).

Spark plans ``row_number() = 1`` with a partial ``WindowGroupLimit`` before
the shuffle, so every map task forwards at most one row per key: a key that
owns a third of the input still reaches its reducer as one row per map
partition. ``max_by`` is not a substitute: it skips NULL order keys, while
the reference sorts NULL first on DESC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.semantics import order_spec

_RN = "__strata_rn"


def latest_by(df: DataFrame, keys: list[str | Column], order: list,
              tie_breakers: list | None = None) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` (+ tie-breakers).

    ``order`` is ``[(column, "desc" | "asc"), ...]`` using the reference's
    NULL placement, or ready-made Columns.
    """
    spec = order_spec(list(order) + list(tie_breakers or []))
    w = Window.partitionBy(*keys).orderBy(*spec)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def first_occurrence(df: DataFrame, keys: list[str | Column], position: list) -> DataFrame:
    """First row per key in ascending ``position`` order (cursor-overlap dedup)."""
    return latest_by(df, keys, [(p, "asc") for p in position])
