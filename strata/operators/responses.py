"""Record shaping over landed API responses.

The HTTP client itself is not part of the engine; what it computes from the
responses is table work, expressed here over a landed responses table
``(dataset, appid, page_no, run_ts, body VARIANT, error)``. Every step is a
per-row expression, an explode of one response, a partial aggregate or a
join against a per-app table, so nothing ever gathers a whole app's data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import CHUNK_SIZE, DATASETS, REVIEW_LOOKBACK_HOURS
from strata.functions.variant import explode_array, vget


def stamp(df: DataFrame, record: str, source: str, extracted_at: Column | str) -> DataFrame:
    """Add ``_extracted_at`` / ``_source`` stamps; keys already in the record win.

    A key that is present with a JSON null still wins (its value is NULL),
    exactly like spreading the record after the stamps.
    """
    ts = F.col(extracted_at) if isinstance(extracted_at, str) else extracted_at
    out = df
    for name, default in (("_extracted_at", ts.cast("string")), ("_source", F.lit(source))):
        present = vget(record, f"$.{name}").isNotNull()
        out = out.withColumn(name, F.when(present, vget(record, f"$.{name}", "string"))
                                      .otherwise(default))
    return out


def flatten_chart(responses: DataFrame, top_n: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per chart entry: the first ``top_n`` by array position.

    ``record`` holds every field of the entry, with ``rollup_date`` of the
    response copied onto it; the known fields are typed columns beside it. A
    response without ranks fails the query, so nothing is published from it.
    """
    rows = explode_array(responses, "body", "$.response.ranks", pos="pos", value="entry", outer=True)
    guarded = F.coalesce(F.col("pos"), F.raise_error(F.lit("chart response returned no ranks")).cast("int"))
    rollup = F.map_from_entries(F.array(F.struct(
        F.lit("rollup_date").alias("k"), vget("body", "$.response.rollup_date").alias("v"))))
    return (rows.where(guarded < top_n)
                .select(*keep, "run_ts", "pos",
                        vget("entry", "$.appid", "bigint").alias("appid"),
                        vget("entry", "$.rank", "bigint").alias("rank"),
                        vget("entry", "$.last_week_rank", "bigint").alias("last_week_rank"),
                        vget("entry", "$.peak_in_game", "bigint").alias("peak_in_game"),
                        vget("body", "$.response.rollup_date", "bigint").alias("rollup_date"),
                        spread(vget("entry", "$", "map<string,variant>"), rollup).alias("record")))


def spread(first: Column, then: Column) -> Column:
    """``{**first, **then}`` of two ``map<string,variant>``: the later one wins."""
    return F.map_concat(F.map_filter(first, lambda k, _: ~F.map_contains_key(then, k)), then)


def project_player_counts(responses: DataFrame) -> DataFrame:
    """``{appid, player_count, result}``; failed calls are dropped, missing keys NULL."""
    return (responses.where(F.col("error").isNull())
                     .select("run_ts", "appid",
                             vget("body", "$.response.player_count", "bigint").alias("player_count"),
                             vget("body", "$.response.result", "bigint").alias("result")))


def details_envelope(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Look the body up by ``str(appid)``; ``data`` only when ``success``.

    A failed request becomes ``success = false`` with its error message.
    """
    entry = F.try_element_at(vget("body", "$", "map<string,variant>"), F.col("appid").cast("string"))
    ok = F.col("error").isNull()
    success = F.coalesce(vget(entry, "$.success", "boolean"), F.lit(False))
    return responses.select(
        *keep, "run_ts", "appid",
        F.when(ok, success).otherwise(F.lit(False)).alias("success"),
        F.when(ok & success, vget(entry, "$.data")).alias("data"),
        F.col("error"))


def review_page_items(pages: DataFrame) -> DataFrame:
    """Explode landed review pages into item rows (one per review).

    ``pages``: ``(run_ts, appid, page_no, cursor, body, error)`` with
    ``body = {"reviews": [...], "cursor": "..."}``. An empty or failed page
    keeps one row with a NULL review so the paging rules can see it.
    """
    items = explode_array(pages, "body", "$.reviews", pos="pos", value="review", outer=True)
    return items.select(
        "run_ts", "appid", "page_no", "pos", "cursor",
        vget("body", "$.cursor", "string").alias("next_cursor"), "error",
        vget("review", "$.recommendationid", "string").alias("recommendationid"),
        vget("review", "$.timestamp_created", "bigint").alias("timestamp_created"),
        "review")


def keep_reviews(items: DataFrame, lookback_hours: int = REVIEW_LOOKBACK_HOURS,
                 max_pages: int | None = None) -> DataFrame:
    """Reviews the newest-first paging loop keeps, from item rows.

    ``items``: ``(run_ts, appid, page_no, pos, cursor, next_cursor, error,
    recommendationid, timestamp_created, ...)``; a row with a NULL
    ``recommendationid`` only marks an empty or failed page. Per (run, app):

    * a review id already seen earlier (by page, then position) is skipped
      before anything else is looked at;
    * paging stops *after* the first page holding a first-seen review older
      than the cutoff, or whose next cursor is missing or repeats the current one;
    * paging stops *before* a failed or empty page (and at ``max_pages``, if
      given: landed pages need no bound);
    * a review is kept when ``timestamp_created >= run_ts - lookback``; a
      missing timestamp counts as 0.

    Repeats go by a window on the review id, pages are partial aggregates, and
    items meet the kept pages on (run, app, page): no step has a key larger
    than one page, however many reviews an app has.
    """
    cutoff = F.unix_seconds(F.col("run_ts").cast("timestamp")) - F.lit(lookback_hours * 3600)
    seen_as = F.coalesce(F.concat(F.lit("r"), F.col("recommendationid")), F.concat(F.lit("p"), F.col("page_no").cast("string")))
    order = Window.partitionBy("run_ts", "appid", seen_as).orderBy(F.col("page_no").asc(), F.col("pos").asc())
    x = (items.withColumn("_is_item", F.col("recommendationid").isNotNull())
              .withColumn("_first", F.col("_is_item") & (F.row_number().over(order) == 1))
              .withColumn("_recent", F.coalesce(F.col("timestamp_created"), F.lit(0)) >= cutoff))
    per_page = x.groupBy("run_ts", "appid", "page_no").agg(
        F.count_if(F.col("_is_item")).alias("_n"),
        F.count_if(F.col("_first") & ~F.col("_recent")).alias("_old"),
        F.max(F.col("error").isNotNull()).alias("_failed"),
        F.max(F.col("next_cursor").isNull() | (F.col("next_cursor") == F.col("cursor"))).alias("_last"))
    stops = per_page.groupBy("run_ts", "appid").agg(
        F.min(F.when((F.col("_old") > 0) | F.col("_last"), F.col("page_no"))).alias("_stop_incl"),
        F.min(F.when(F.col("_failed") | (F.col("_n") == 0), F.col("page_no"))).alias("_stop_excl"))
    read = (per_page.join(stops, ["run_ts", "appid"])
            .where((F.col("_stop_incl").isNull() | (F.col("page_no") <= F.col("_stop_incl")))
                   & (F.col("_stop_excl").isNull() | (F.col("page_no") < F.col("_stop_excl")))))
    if max_pages is not None:
        read = read.where(F.col("page_no") < max_pages)
    kept = x.where(F.col("_first") & F.col("_recent")).drop("_is_item", "_first", "_recent")
    return kept.join(read.select("run_ts", "appid", "page_no"), ["run_ts", "appid", "page_no"], "left_semi") \
        .select(items.columns)


def flatten_review_pages(pages: DataFrame, lookback_hours: int = REVIEW_LOOKBACK_HOURS,
                         max_pages: int | None = None) -> DataFrame:
    """Landed review pages -> kept reviews (see ``keep_reviews``)."""
    return keep_reviews(review_page_items(pages), lookback_hours, max_pages)


def chart_work_list(chart: DataFrame, chunk_size: int = CHUNK_SIZE,
                    datasets: tuple[str, ...] = DATASETS[1:]) -> DataFrame:
    """Fan-out work list: ``part = floor(pos / chunk_size)`` per dataset (and run).

    ``chart`` carries the array position ``pos`` of each app, so the chunk
    number is a per-row expression (no global window).
    """
    run = ["run_ts"] if "run_ts" in chart.columns else []
    return chart.select(*run, F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset"),
                        F.floor(F.col("pos") / chunk_size).cast("int").alias("part"),
                        "appid", "pos")


def scope_to_chart(df: DataFrame, chart: DataFrame, key: str | list[str] = "appid") -> DataFrame:
    """Only apps on the chart are extracted (semi join on ``key``)."""
    keys = [key] if isinstance(key, str) else key
    return df.join(chart.select(*keys), keys, "left_semi")


def run_counts(records: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Record counts per dataset for the run summary."""
    return records.groupBy(dataset).agg(F.count(F.lit(1)).alias("records"))
