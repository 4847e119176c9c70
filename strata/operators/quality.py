"""Data-quality checks that return their violating rows.

Contract (as in dbt): a check is a DataFrame of violations; it passes when
that DataFrame is empty. All checks are single aggregates or anti joins, so
they run distributed and never gather a table on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.bloom import key_filter


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``<column>_nulls`` for every column, in a single scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def unique(df: DataFrame, keys: list[str] | str, count_col: str = "duplicate_rows") -> DataFrame:
    """Key values occurring more than once; NULL keys are ignored (dbt semantics)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    present = df.where(cond)
    return (present.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
                   .where(F.col(count_col) > 1))


def grain(df: DataFrame, keys: list[str], count_col: str = "duplicate_rows") -> DataFrame:
    """Singular grain test: ``group by keys having count(*) > 1`` (NULLs included)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no match in the parent."""
    p = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
    return child.where(F.col(column).isNotNull()).join(p, on=column, how="left_anti")


@dataclass
class Check:
    """A named check of ``table``: ``build(tables) -> violations``. ``not_null`` names
    the column of a plain NULL check, which is counted with the table's others."""

    name: str
    table: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    not_null: str | None = None


@dataclass
class CheckResult:
    name: str
    failures: int
    sample: list = field(default_factory=list)

    @property
    def passed(self) -> bool:
        return self.failures == 0


class ChecksFailed(RuntimeError):
    """A model's data tests failed; what depends on the model is not built."""

    def __init__(self, failed: list[CheckResult]):
        super().__init__("data tests failed: " + ", ".join(f"{c.name} ({c.failures})" for c in failed))
        self.failed = failed


def run_checks(checks: list[Check], tables: dict[str, DataFrame], sample: int = 5,
               threads: int = 4) -> list[CheckResult]:
    """Evaluate every check (``threads`` at a time); only a bounded sample of
    violations reaches the driver. All NULL checks of a table are one scan."""
    from concurrent.futures import ThreadPoolExecutor
    by_table: dict[str, list[str]] = {}
    for c in checks:
        if c.not_null:
            by_table.setdefault(c.table, []).append(c.not_null)

    def nulls(table: str) -> dict[str, int]:
        found = null_counts(tables[table], by_table[table]).first().asDict()
        return {c: found[f"{c}_nulls"] for c in by_table[table]}

    def other(chk: Check) -> int:
        return chk.build(tables).count()

    with ThreadPoolExecutor(max_workers=threads) as pool:
        counted = {t: pool.submit(nulls, t) for t in by_table}
        rest = {c.name: pool.submit(other, c) for c in checks if not c.not_null}
        n = {c.name: counted[c.table].result()[c.not_null] if c.not_null else rest[c.name].result() for c in checks}
    return [CheckResult(c.name, n[c.name], c.build(tables).limit(sample).collect() if n[c.name] else []) for c in checks]


def changed_rows(table, since: int | None) -> DataFrame:
    """The partitions of a versioned table that differ from its commit ``since`` (all of
    them if that commit is no longer kept)."""
    before = table.manifest(since) if since else None
    now = table.current()
    if before is None or table.part is None:
        return table.read(at=now)
    return table.read([p for p, v in now["partitions"].items() if before["partitions"].get(p) != v], at=now)


def rows_of_changed_keys(table, changed: DataFrame) -> DataFrame:
    """All rows of a versioned table that have a key of the ``changed`` rows: the scan of
    its other partitions is cut down by the keys' range and a Bloom filter."""
    if table.part is None or table.part in table.keys:  # equal keys are in one partition
        return changed
    keys = changed.select(*table.keys)
    return table.read().where(key_filter(keys, table.keys, changed.count())).join(keys.distinct(), table.keys, "left_semi")


def run_checks_delta(checks: list[Check], tables: dict[str, DataFrame], stored: dict, since: dict[str, int],
                     threads: int = 4) -> list[CheckResult]:
    """``run_checks`` on what changed: the partitions that each table of ``stored`` (versioned
    tables by name) has rewritten after its commit in ``since``.

    Row checks, the grain (whose keys hold the partition) and references see the changed
    partitions only; a duplicate may lie in any other partition, so uniqueness sees all rows
    of the changed keys. References are checked from the child's side: a parent that loses
    rows needs ``run_checks``. Tables not in ``stored`` are checked whole. Faults in
    partitions that didn't change were found when they were written.
    """
    changed = {n: changed_rows(t, since.get(n)) for n, t in stored.items()}
    whole = {n: df for n, df in tables.items() if n not in changed}
    alike = [c for c in checks if c.name.startswith("unique:")]
    keyed = {c.table: rows_of_changed_keys(stored[c.table], changed[c.table]) for c in alike if c.table in stored}
    parents = {n: tables[n] for n in changed if stored[n].part is None and n in tables}
    found = {r.name: r for r in run_checks(alike, {**whole, **changed, **keyed}, threads=threads)}
    found |= {r.name: r for r in run_checks([c for c in checks if c not in alike], {**whole, **changed, **parents}, threads=threads)}
    return [found[c.name] for c in checks]


#: The reference's known edge case: a review whose game has not (yet) been on a chart. No
#: model depends on both of the test's tables, so a caller may let it only warn.
UNCHARTED = "relationships:fact_review.game_key->dim_game.game_key"


def model_checks() -> list[Check]:
    """The 17 column / singular tests declared for the silver and gold models."""
    nn = lambda t, c: Check(f"not_null:{t}.{c}", t, lambda ts: not_null(ts[t], c), c)
    uq = lambda t, c: Check(f"unique:{t}.{c}", t, lambda ts: unique(ts[t], c))
    return [
        nn("silver_most_played", "appid"),
        nn("silver_most_played", "chart_rank"),
        uq("silver_reviews", "review_id"),
        nn("silver_reviews", "review_id"),
        nn("silver_reviews", "appid"),
        nn("silver_app_details", "appid"),
        nn("silver_player_counts", "appid"),
        uq("dim_game", "game_key"),
        nn("dim_game", "game_key"),
        uq("fact_review", "review_id"),
        nn("fact_review", "review_id"),
        nn("fact_review", "game_key"),
        Check(UNCHARTED, "fact_review",
              lambda ts: relationships(ts["fact_review"], "game_key", ts["dim_game"], "game_key")),
        nn("fact_daily_game_performance", "game_key"),
        nn("fact_daily_game_performance", "activity_date"),
        nn("rpt_daily_game_performance", "game_name"),
        Check("grain:fact_daily_game_performance(activity_date,game_key)", "fact_daily_game_performance",
              lambda ts: grain(ts["fact_daily_game_performance"], ["activity_date", "game_key"])),
    ]
