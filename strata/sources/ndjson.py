"""NDJSON sink and the raw landing layout.

Layout: ``raw/<dataset>/ingest_date=YYYY-MM-DD/<dataset>_<YYYYmmddTHHMMSS>[_partNN].ndjson``.
Records are serialized with ``to_json`` (UTF-8, non-ASCII kept as is), one
object per line. An empty result writes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata import fs
from strata.constants import LANDING_DATE_FORMAT, LANDING_STAMP_FORMAT, PART_DIGITS


def part_number(part: Column) -> Column:
    """A chunk number with at least ``PART_DIGITS`` digits, never cut."""
    return F.format_string(f"%0{PART_DIGITS}d", part.cast("bigint"))


def object_key(dataset: str, ts: Column | str, part: Column | str | None = None) -> Column:
    """The landing object key for a record extracted at ``ts`` (UTC)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    suffix = F.lit("")
    if part is not None:
        p = F.col(part) if isinstance(part, str) else part
        suffix = F.when(p.isNull(), F.lit("")).otherwise(
            F.concat(F.lit("_part"), part_number(p)))
    return F.concat(F.lit(f"raw/{dataset}/ingest_date="), F.date_format(t, LANDING_DATE_FORMAT),
                    F.lit(f"/{dataset}_"), F.date_format(t, LANDING_STAMP_FORMAT), suffix,
                    F.lit(".ndjson"))


#: Timestamps keep microseconds and an explicit offset (producers write UTC).
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def record_json(columns: list[str]) -> Column:
    """One record as a JSON object (non-ASCII kept, micro-second stamps)."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), JSON_OPTIONS)


def to_ndjson(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON object per row in a single ``value`` column."""
    cols = columns or df.columns
    return df.select(record_json(cols).alias("value"))


def write_ndjson(df: DataFrame, root: str, dataset: str, ts: str,
                 columns: list[str] | None = None, part: str | None = None,
                 json_text: str | None = None, counts: dict[str, Column] | None = None,
                 seen: Observation | None = None) -> str | None:
    """Write records under ``root/<dataset>/ingest_date=...[/part=NN]/``; skip when empty.

    ``ts`` is the extraction stamp that names the date folder; ``part`` the
    optional chunk number of a fanned-out run. ``json_text`` names a column
    that already holds each record's JSON text (written as is). ``counts`` are aggregates
    over ``ts``, observed in ``seen`` while the records are written.
    """
    cols = columns or df.columns
    out = f"{root.rstrip('/')}/{dataset}"
    folders = [F.date_format(F.col(ts), LANDING_DATE_FORMAT).alias("ingest_date")]
    if part:
        folders.append(F.when(F.col(part).isNotNull(), part_number(F.col(part))).alias("part"))
    names = ["ingest_date", "part"][:len(folders)]
    body = F.col(json_text) if json_text else record_json(cols)
    lines = df.select(*folders, body.alias("value"), F.col(ts).alias("_ts"))
    # Rebalanced by folder: adaptive execution packs small folders and splits one that
    # holds most of the rows over several writers. The records are evaluated once (a range
    # partitioning evaluates them once more, to sample).
    dealt = lines.hint("rebalance", *[F.col(n) for n in names])
    if counts:  # after the exchange, where a lost map task can't count twice
        dealt = dealt.observe(seen, *[c.alias(n) for n, c in counts.items()])
    dealt.drop("_ts").write.mode("append").partitionBy(*names).text(out)
    landed = any(n.startswith("ingest_date=") for n in fs.list_dirs(df.sparkSession, out))
    if not landed:  # nothing has ever been written: leave no empty folder behind
        fs.delete(df.sparkSession, out)
    return out if landed else None
