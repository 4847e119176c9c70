"""Driver queries: every operator exercised on the shared test tables.

The reference's own inputs (game-platform API documents) are not among the
test tables, so each operator runs on an analog built from them: ``events``
plays reviews / chart rows / snapshots, ``customer`` plays store details,
``orders`` / ``lineitem`` / ``documents`` / ``labels`` play the rest. The
analogs feed the *same* library code as the medallion pipeline (silver and
gold models, operators), over whole tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names and types match the DuckDB oracle in ``strata.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.semantics import asc, desc, minor_units_to_amount, placeholder_name, try_date
from strata.functions.variant import vget
from strata.operators import quality
from strata.operators.aggregates import activity_metrics
from strata.operators.dedup import latest_by
from strata.operators.incremental import SnapshotTable
from strata.operators.responses import (chart_work_list, details_envelope, flatten_chart,
                                        keep_reviews, scope_to_chart, stamp)
from strata.plans import gold
from strata.session import ensure_session, scratch_path
from strata.sources import export
from strata.sources.bronze import ingest, read_bronze, read_ledger
from strata.sources.catalog import Lake
from strata.sources.ndjson import object_key, write_ndjson

# Fixed parameters of the analogs (dates inside the events table's range).
RUN_TS = "2024-01-31 06:00:00"
REPORT_DAY = "2024-01-15"
DETAILS_TS = "2024-02-01 06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(c):
    return c.cast("timestamp_ntz")


# ---------------------------------------------------------------- variant paths
def variant_project(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("doc"))
    return ev.select("event_id", vget("doc", "$.k", "bigint").alias("k"),
                     vget("doc", "$.k", "string").alias("k_text"),
                     vget("doc", "$.missing", "bigint").alias("missing"))


def variant_nested_array(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    doc = F.to_json(F.struct(
        F.struct(F.col("o_orderkey").alias("key"),
                 F.struct(F.col("c_custkey").alias("id"),
                          F.struct(F.col("n_name").alias("name"),
                                   F.col("n_regionkey").alias("region")).alias("nation"))
                 .alias("customer")).alias("order"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.array(F.struct(F.col("o_orderpriority").alias("prio"),
                         F.col("o_totalprice").alias("price"))).alias("lines")))
    d = j.select("o_orderkey", F.parse_json(doc).alias("doc"))
    return d.select("o_orderkey",
                    vget("doc", "$.order.customer.nation.name", "string").alias("nation_name"),
                    vget("doc", "$.order.customer.nation.region", "bigint").alias("region_key"),
                    vget("doc", "$.tags[0]", "string").alias("first_tag"),
                    vget("doc", "$.lines[0].prio", "string").alias("line_prio"),
                    vget("doc", "$.lines[0].price", "double").alias("line_price"),
                    vget("doc", "$.tags[5]", "string").alias("out_of_range"),
                    vget("doc", "$.lines[0].nothing", "string").alias("missing_field"))


def cast_types(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    doc = F.to_json(F.struct(
        F.unix_seconds(ts).alias("epoch"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("iso"),
        F.col("value").cast("string").alias("num"),
        (F.col("event_type") == "purchase").alias("flag"),
        F.col("user_id").alias("age")))
    d = ev.select("event_id", F.parse_json(doc).alias("doc"))
    return d.select("event_id",
                    _ntz(vget("doc", "$.epoch", "epoch")).alias("from_epoch"),
                    _ntz(vget("doc", "$.iso", "timestamp")).alias("from_iso"),
                    vget("doc", "$.iso", "date").alias("iso_date"),
                    vget("doc", "$.num", "double").alias("num"),
                    vget("doc", "$.flag", "boolean").alias("flag"),
                    vget("doc", "$.age", "string").alias("age_text"))


# ---------------------------------------------------------------- latest-wins
_EV_COLS = ["event_id", "user_id", "day", "ts", "event_type", "value"]


def latest_per_key_day(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return latest_by(ev, ["user_id", "day"], [("ts", "desc")]).select(*_EV_COLS)


def latest_per_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return latest_by(ev, ["user_id"], [("ts", "desc")]).select(*_EV_COLS)


def dedup_two_keys(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]
    return latest_by(li, ["l_orderkey", "l_linenumber"], [("l_shipdate", "desc")],
                     [(c, "desc") for c in rest])


def filter_then_latest(spark, sf_dir):
    ev = (table(spark, sf_dir, "events")
          .withColumn("fetch_success", F.col("event_type") != "error")
          .where("fetch_success").withColumn("day", F.to_date("ts")))
    return latest_by(ev, ["user_id", "day"], [("ts", "desc")]).select(*_EV_COLS)


def latest_nulls_first(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    key = F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("ts"))
    return latest_by(ev, ["user_id"], [(key, "desc"), ("event_id", "desc")]).select(*_EV_COLS)


# ---------------------------------------------------------------- star schema analog
def _chart(ev: DataFrame) -> DataFrame:
    """silver_most_played shape: latest ``view`` event per (user, day)."""
    v = (ev.where(F.col("event_type") == "view")
           .select(F.col("user_id").alias("appid"), F.to_date("ts").alias("chart_date"),
                   F.col("ts").alias("extracted_at"),
                   F.floor("value").cast("bigint").alias("chart_rank"),
                   F.col("event_id").alias("last_week_rank"),
                   F.col("user_id").alias("peak_in_game")))
    return latest_by(v, ["appid", "chart_date"], [("extracted_at", "desc")])


def _counts(ev: DataFrame) -> DataFrame:
    """silver_player_counts shape: latest ``signup`` event per (user, day)."""
    s = (ev.where(F.col("event_type") == "signup")
           .select(F.col("user_id").alias("appid"), F.to_date("ts").alias("snapshot_date"),
                   F.col("ts").alias("extracted_at"),
                   F.floor("value").cast("bigint").alias("player_count")))
    return latest_by(s, ["appid", "snapshot_date"], [("extracted_at", "desc")])


def _reviews(ev: DataFrame) -> DataFrame:
    """silver_reviews shape: purchase = positive, click = negative, error = NULL vote."""
    vote = (F.when(F.col("event_type") == "purchase", F.lit(True))
             .when(F.col("event_type") == "click", F.lit(False)))
    return (ev.where(F.col("event_type").isin("purchase", "click", "error"))
              .select(F.col("user_id").alias("appid"), F.col("ts").alias("created_at"),
                      vote.alias("voted_up"), F.col("value").alias("weighted_vote_score"),
                      F.floor("value").cast("bigint").alias("playtime_at_review_min")))


def _details(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """silver_app_details shape from customers (MACHINERY = failed fetch)."""
    j = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    layout = (F.when(F.col("c_nationkey") < 10, F.date_format(F.lit("2013-11-08").cast("date"), "d MMM, yyyy"))
               .otherwise(F.lit("Coming soon")))
    d = j.select(
        F.col("c_custkey").alias("appid"),
        (F.col("c_mktsegment") != "MACHINERY").alias("fetch_success"),
        F.col("c_name").alias("game_name"), F.lit("game").alias("app_type"),
        (F.col("c_acctbal") < 0).alias("is_free"),
        F.parse_json(F.to_json(F.array("c_mktsegment"))).alias("developers"),
        F.parse_json(F.lit("[]")).alias("publishers"),
        F.parse_json(F.to_json(F.array(F.struct(F.col("n_name").alias("description"))))).alias("genres"),
        F.lit("USD").alias("price_currency"),
        minor_units_to_amount(F.col("c_acctbal") * 100).alias("price_final"),
        F.lit(0).cast("bigint").alias("discount_percent"),
        layout.alias("release_date_raw"),
        F.col("c_nationkey").cast("bigint").alias("metacritic_score"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("total_recommendations"),
        F.col("n_name").alias("short_description"),
        F.lit(DETAILS_TS).cast("timestamp").alias("extracted_at"),
        F.lit(DETAILS_TS).cast("timestamp").alias("_loaded_at"))
    return d.where("fetch_success")


def _star(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    chart = _chart(ev)
    fact = gold.fact_daily_game_performance(chart, _counts(ev), _reviews(ev))
    dim = gold.dim_game(chart, _details(table(spark, sf_dir, "customer"),
                                        table(spark, sf_dir, "nation")))
    return fact, dim


def spine_left_join_dim(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    spine = o.select(F.col("o_custkey").alias("custkey")).distinct()
    j = spine.join(c, spine.custkey == c.c_custkey, "left")
    return j.select("custkey", placeholder_name("c_name", "custkey").alias("name"),
                    "c_mktsegment", "c_acctbal", F.col("c_custkey").isNotNull().alias("has_store_page"))


def daily_aggregate(spark, sf_dir):
    r = _reviews(table(spark, sf_dir, "events")).withColumn("day", F.to_date("created_at"))
    m = activity_metrics(r, ["appid", "day"], "voted_up", "weighted_vote_score",
                         "weighted_vote_score", median_out="median_value")
    return m.select(F.col("appid").alias("user_id"), "day",
                    F.col("reviews_total").alias("n_events"),
                    F.col("reviews_positive").alias("n_positive"),
                    F.col("reviews_negative").alias("n_negative"),
                    F.round("avg_weighted_vote_score", 6).alias("avg_value"),
                    F.round("median_value", 6).alias("median_value"))


def daily_fact(spark, sf_dir):
    fact, _ = _star(spark, sf_dir)
    return fact.select(
        "activity_date", "game_key", "chart_rank", "last_week_rank", "peak_in_game",
        "snapshot_player_count", "reviews_total", "reviews_positive", "reviews_negative",
        F.round("avg_weighted_vote_score", 6).alias("avg_weighted_vote_score"),
        F.col("median_playtime_at_review_min").cast("double").alias("median_playtime_at_review_min"),
        "positive_review_ratio")


def _report(spark, sf_dir):
    fact, dim = _star(spark, sf_dir)
    rpt = gold.rpt_daily_game_performance(fact, dim)
    return rpt.select(*[F.col(c).cast("double").alias(c) if c in (
        "positive_review_ratio", "avg_weighted_vote_score", "median_playtime_at_review_min")
        else F.col(c) for c in rpt.columns])


def report_flat(spark, sf_dir):
    return _report(spark, sf_dir)


def dim_game_analog(spark, sf_dir):
    _, dim = _star(spark, sf_dir)
    return dim.select("game_key", "game_name", "primary_developer", "primary_publisher",
                      "primary_genre", "is_free", "price_currency",
                      F.col("price_final").cast("double").alias("price_final"),
                      "release_date", "metacritic_score", "total_recommendations",
                      "has_store_page")


def review_fact_project(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    silver_like = j.select(
        F.col("doc_id").cast("string").alias("review_id"), F.col("doc_id").alias("appid"),
        F.col("source").alias("author_steamid"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
        F.col("lang").alias("review_language"), (F.col("quality") == 1).alias("voted_up"),
        F.lit(0).cast("bigint").alias("votes_up"), F.lit(0).cast("bigint").alias("votes_funny"),
        F.col("toxic").cast("double").alias("weighted_vote_score"),
        F.lit(0).cast("bigint").alias("comment_count"),
        F.col("n_chars").alias("playtime_at_review_min"),
        F.lit(None).cast("bigint").alias("author_playtime_forever_min"),
        F.lit(None).cast("bigint").alias("author_num_games_owned"),
        F.lit(None).cast("bigint").alias("author_num_reviews"),
        F.lit(None).cast("boolean").alias("steam_purchase"),
        F.lit(None).cast("boolean").alias("received_for_free"),
        F.lit(None).cast("boolean").alias("written_during_early_access"),
        F.lit(None).cast("boolean").alias("primarily_steam_deck"),
        F.col("text").alias("review_text"),
        F.lit(None).cast("timestamp").alias("extracted_at"))
    f = gold.fact_review(silver_like)
    return f.select("review_id", "game_key", "review_language", "is_positive", "positive_flag",
                    F.col("playtime_at_review_hrs").cast("double").alias("playtime_at_review_hrs"),
                    "review_length_chars")


def money_division(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cents = (F.col("c_acctbal") * 100).cast("decimal(38,0)")
    return c.select("c_custkey", cents.cast("bigint").alias("minor_units"),
                    minor_units_to_amount(F.col("c_acctbal") * 100).cast("double").alias("price_final"))


def try_parse_date(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = (F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "d MMM, yyyy"))
            .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MMM d, yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy")))
    return o.select("o_orderkey", raw.alias("release_text"),
                    try_date(raw).alias("release_date"))


# ---------------------------------------------------------------- incremental
def _event_batch(ev: DataFrame, lo: str | None, hi: str | None, stamp_ts: str,
                 loaded: str | None = None, bump: tuple[str, str] | None = None) -> DataFrame:
    cond = F.lit(True)
    if lo:
        cond = cond & (F.col("ts") >= F.lit(lo).cast("timestamp_ntz"))
    if hi:
        cond = cond & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))
    value = F.col("value")
    if bump:
        in_bump = (F.col("ts") >= F.lit(bump[0]).cast("timestamp_ntz")) & \
                  (F.col("ts") < F.lit(bump[1]).cast("timestamp_ntz"))
        value = F.when(in_bump, F.col("value") + 1000).otherwise(F.col("value"))
    cols = [F.col("event_id"), F.to_date("ts").alias("event_date"), F.col("user_id"),
            F.col("event_type"), value.alias("value"),
            F.lit(stamp_ts).cast("timestamp").alias("extracted_at")]
    if loaded:
        cols.append(F.lit(loaded).cast("timestamp").alias("_loaded_at"))
    return ev.where(cond).select(*cols)


def _final(tbl: SnapshotTable) -> DataFrame:
    df = tbl.read()
    return df.select("event_id", "event_date", "user_id", "event_type", "value",
                     _ntz(F.col("extracted_at")).alias("extracted_at"))


def incremental_upsert(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    t = SnapshotTable(spark, scratch_path(spark, "upsert"), key="event_id", partition_by="event_date")
    t.upsert(_event_batch(ev, None, "2024-01-16", "2024-01-16 06:00:00"))
    t.upsert(_event_batch(ev, "2024-01-11", None, "2024-01-31 06:00:00",
                          bump=("2024-01-11", "2024-01-16")))
    return _final(t)


def _late(spark, sf_dir, mode: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    t = SnapshotTable(spark, scratch_path(spark, f"late-{mode}"), key="event_id",
                      partition_by="event_date")
    kw = {"mode": mode, "order": [("extracted_at", "desc")]}
    t.upsert(_event_batch(ev, None, "2024-01-16", "2024-01-16 06:00:00", "2024-01-16 06:05:00"), **kw)
    t.upsert(_event_batch(ev, "2024-01-16", "2024-01-24", "2024-01-31 06:00:00", "2024-01-31 06:05:00"), **kw)
    # the late part of the same run carries the same extraction stamp
    t.upsert(_event_batch(ev, "2024-01-24", None, "2024-01-31 06:00:00", "2024-01-31 06:20:00"), **kw)
    return _final(t)


def incremental_late_strict(spark, sf_dir):
    return _late(spark, sf_dir, "strict")


def incremental_late_loaded(spark, sf_dir):
    return _late(spark, sf_dir, "loaded_at")


# ---------------------------------------------------------------- quality
def quality_unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _orders_with_customer(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    return o.join(c, o.o_custkey == c.c_custkey, "left")


def quality_not_null(spark, sf_dir):
    return quality.not_null(_orders_with_customer(spark, sf_dir), "c_name").select("o_orderkey", "o_custkey")


def quality_null_counts(spark, sf_dir):
    return quality.null_counts(_orders_with_customer(spark, sf_dir),
                               ["c_name", "c_acctbal", "o_totalprice"])


def quality_relationships(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return quality.relationships(d, "doc_id", table(spark, sf_dir, "labels"), "doc_id")


def quality_grain(spark, sf_dir):
    return quality.grain(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


# ---------------------------------------------------------------- gates
_COUNTED = ("events", "orders", "lineitem", "customer")


def union_counts(spark, sf_dir):
    return export.table_counts({t: table(spark, sf_dir, t) for t in _COUNTED})


def scalar_counts(spark, sf_dir):
    frames = {t: table(spark, sf_dir, t) for t in _COUNTED}
    sql = "SELECT " + ", ".join(f"(SELECT count(*) FROM {{{t}}}) AS n_{t}" for t in _COUNTED)
    return spark.sql(sql, **frames)


def freshness(spark, sf_dir):
    return export.freshness(table(spark, sf_dir, "events"), "ts")


def topk_day(spark, sf_dir):
    return export.todays_top(_report(spark, sf_dir), day=REPORT_DAY) \
        .select("activity_date", "chart_rank", "game_name", "reviews_total")


def topk_nulls_last(spark, sf_dir):
    dim = dim_game_analog(spark, sf_dir)
    return dim.orderBy(F.col("total_recommendations").desc_nulls_last(), asc("game_key")).limit(50) \
        .select("game_key", "game_name", "total_recommendations", "has_store_page")


def topk_limit(spark, sf_dir):
    rpt = _report(spark, sf_dir)
    return rpt.orderBy(desc("activity_date"), asc("chart_rank"), asc("game_name")).limit(300)


# ---------------------------------------------------------------- response shaping
def chart_flatten_topn(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    n = (F.floor(F.col("value") / 100) + 1).cast("int")
    ranks = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        (F.col("user_id") * 10 + i).alias("appid"), (i + 1).alias("rank"),
        i.alias("last_week_rank"), F.col("event_id").alias("peak_in_game")))
    body = F.to_json(F.struct(F.struct(ranks.alias("ranks"),
                                       F.unix_seconds(F.col("ts").cast("timestamp")).alias("rollup_date"))
                              .alias("response")))
    responses = ev.select("event_id", F.col("ts").alias("run_ts"), F.parse_json(body).alias("body"))
    flat = flatten_chart(responses, top_n=3, keep=("event_id",))
    return flat.select("event_id", F.col("pos").cast("bigint").alias("pos"), "appid", "rank",
                       "peak_in_game", "rollup_date")


def _review_items(ev: DataFrame) -> DataFrame:
    """Landed review pages as item rows: one page per day back from the run."""
    run_ts = F.lit(RUN_TS).cast("timestamp")
    base_page = F.datediff(F.to_date(run_ts), F.to_date("ts"))
    dup = F.explode(F.when(F.hour("ts") < 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    x = ev.select("*", dup.alias("_shift")).withColumn("page_no", base_page + F.col("_shift"))
    is_error = F.col("event_type") == "error"
    return x.select(
        run_ts.alias("run_ts"), F.col("user_id").alias("appid"), "page_no",
        F.col("event_id").alias("pos"),
        F.concat(F.lit("c"), F.col("page_no").cast("string")).alias("cursor"),
        F.when(F.col("page_no") < 30, F.concat(F.lit("c"), (F.col("page_no") + 1).cast("string")))
         .alias("next_cursor"),
        F.when(is_error, F.lit("HTTP 500")).alias("error"),
        F.when(~is_error, F.col("event_id").cast("string")).alias("recommendationid"),
        F.when(~is_error & (F.col("event_type") != "signup"),
               F.unix_seconds(F.col("ts").cast("timestamp"))).alias("timestamp_created"))


def page_flatten_cutoff(spark, sf_dir):
    kept = keep_reviews(_review_items(table(spark, sf_dir, "events")), lookback_hours=24 * 7)
    return kept.select("appid", F.col("page_no").cast("bigint").alias("page_no"), "recommendationid",
                       F.col("timestamp_created").alias("created"))


def details_envelope_q(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    entry = F.struct((F.col("c_mktsegment") != "MACHINERY").alias("success"),
                     F.struct(F.col("c_name").alias("name"),
                              F.col("c_mktsegment").alias("segment")).alias("data"))
    key = F.when(F.col("c_nationkey") == 0, F.col("c_custkey") + 1).otherwise(F.col("c_custkey"))
    body = F.parse_json(F.to_json(F.create_map(key.cast("string"), entry)))
    failed = F.col("c_acctbal") < 0
    responses = c.select(F.lit(RUN_TS).cast("timestamp").alias("run_ts"),
                         F.col("c_custkey").alias("appid"),
                         F.when(~failed, body).alias("body"),
                         F.when(failed, F.lit("HTTP 503")).alias("error"))
    d = details_envelope(responses)
    return d.select("appid", "success", vget("data", "$.name", "string").alias("game_name"), "error")


def driver_scope_chunks(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    counts = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    top = counts.orderBy(desc("n_events"), asc("user_id")).limit(100)
    # numbered after the limit: a window over at most 100 rows
    from pyspark.sql import Window
    chart = top.select(F.col("user_id").alias("appid"), "n_events",
                       (F.row_number().over(Window.orderBy(desc("n_events"), asc("user_id"))) - 1)
                       .cast("bigint").alias("pos"))
    work = chart_work_list(chart, chunk_size=50)
    scoped = (scope_to_chart(ev.withColumnRenamed("user_id", "appid"), chart)
              .groupBy("appid").agg(F.count(F.lit(1)).alias("n_events")))
    return work.join(scoped, "appid").select("dataset", "part", "appid", "pos", "n_events")


def stamp_metadata(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    rec = (F.when(F.col("event_type") == "signup",
                  F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"_source":"upstream"}')))
            .when(F.col("event_type") == "view",
                  F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"_source":null}')))
            .when(F.col("event_type") == "click",
                  F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                           F.lit(',"_extracted_at":"upstream-ts"}')))
            .otherwise(F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit("}"))))
    df = ev.select("event_id", F.parse_json(rec).alias("record"),
                   F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("run_ts"))
    return stamp(df, "record", "events", "run_ts").select("event_id", "_source", "_extracted_at")


# ---------------------------------------------------------------- landing / bronze
_EVENT_JSON = ["event_id", "ts", "user_id", "event_type", "value", "props"]
# Lakes built by the landing / pipeline queries, reused within one session.
_LAKES: dict[tuple, str] = {}


def _land_and_ingest(spark, sf_dir):
    """Land the events as NDJSON and ingest them twice (once per session and scale)."""
    key = (spark.sparkContext.applicationId, sf_dir, "events")
    if key in _LAKES:
        return _LAKES[key], None
    root = scratch_path(spark, "lake")
    ev = table(spark, sf_dir, "events")
    write_ndjson(ev, f"{root}/raw", "events", "ts", _EVENT_JSON)
    kw = dict(stage_root=f"{root}/raw", ledger=f"{root}/ledger/events")
    first = ingest(spark, f"{root}/raw/events", f"{root}/bronze/events", f"{root}/_chk/events", **kw)
    again = ingest(spark, f"{root}/raw/events", f"{root}/bronze/events", f"{root}/_chk/events", **kw)
    if again.rows:
        raise AssertionError(f"second ingest loaded {again.rows} rows; files must load once")
    _LAKES[key] = root
    return root, first


def stream_ingest_once(spark, sf_dir):
    root, _ = _land_and_ingest(spark, sf_dir)
    b = read_bronze(spark, f"{root}/bronze/events")
    return b.select(vget("payload", "$.event_id", "bigint").alias("event_id"),
                    vget("payload", "$.ts", "string").cast("timestamp_ntz").alias("ts"),
                    vget("payload", "$.user_id", "bigint").alias("user_id"),
                    vget("payload", "$.event_type", "string").alias("event_type"),
                    vget("payload", "$.value", "double").alias("value"),
                    vget("payload", "$.props", "string").alias("props"),
                    F.regexp_extract("_file", r"ingest_date=([0-9-]+)", 1).cast("date").alias("ingest_date"))


def load_ledger(spark, sf_dir):
    root, _ = _land_and_ingest(spark, sf_dir)
    led = read_ledger(spark, f"{root}/ledger/events")
    return (led.groupBy(F.regexp_extract("_file", r"ingest_date=([0-9-]+)", 1).cast("date")
                        .alias("ingest_date"))
               .agg(F.sum("rows").cast("bigint").alias("loaded_rows")))


def export_ndjson_roundtrip(spark, sf_dir):
    """Orders landed as one extraction run, fanned out in chunks of 500 keys (part
    numbers of two digits and more)."""
    root = scratch_path(spark, "export")
    o = (table(spark, sf_dir, "orders")
         .withColumn("_extracted_at", F.lit(RUN_TS).cast("timestamp"))
         .withColumn("part", F.floor(F.col("o_orderkey") / 500).cast("int")))
    o = o.withColumn("object_key", object_key("orders", "_extracted_at", "part"))
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus",
            "_extracted_at", "object_key"]
    write_ndjson(o, root, "orders", "_extracted_at", cols, part="part")
    back = spark.read.text(f"{root}/orders").select(F.parse_json("value").alias("r"), "ingest_date")
    return back.select(vget("r", "$.o_orderkey", "bigint").alias("o_orderkey"),
                       vget("r", "$.o_custkey", "bigint").alias("o_custkey"),
                       vget("r", "$.o_totalprice", "double").alias("o_totalprice"),
                       vget("r", "$.o_orderdate", "string").cast("timestamp_ntz").alias("o_orderdate"),
                       vget("r", "$.o_orderstatus", "string").alias("o_orderstatus"),
                       _ntz(vget("r", "$._extracted_at", "timestamp")).alias("extracted_at"),
                       vget("r", "$.object_key", "string").alias("object_key"),
                       F.col("ingest_date").cast("date").alias("ingest_date"))


# ---------------------------------------------------------------- full pipeline


def _iso(ts):
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def _api_shaped(spark, sf_dir) -> dict[str, DataFrame]:
    """Raw records in the API shapes, derived from the test tables."""
    ev = table(spark, sf_dir, "events")
    stamp = [F.col("ts").alias("_ts"), _iso(F.col("ts")).alias("_extracted_at")]
    most_played = ev.where(F.col("event_type") == "view").select(
        *stamp, F.lit("GetMostPlayedGames").alias("_source"), F.col("user_id").alias("appid"),
        F.floor("value").alias("rank"), F.col("event_id").alias("last_week_rank"),
        F.col("user_id").alias("peak_in_game"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("rollup_date"))
    player_counts = ev.where(F.col("event_type") == "signup").select(
        *stamp, F.lit("GetNumberOfCurrentPlayers").alias("_source"), F.col("user_id").alias("appid"),
        F.floor("value").alias("player_count"), F.lit(1).alias("result"))
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    reviews = ev.where(F.col("event_type").isin("purchase", "click", "error")).select(
        *stamp, F.lit("appreviews").alias("_source"), F.col("user_id").alias("appid"),
        F.col("event_id").cast("string").alias("recommendationid"),
        F.struct(F.col("user_id").cast("string").alias("steamid"),
                 F.floor("value").alias("playtime_at_review")).alias("author"),
        F.lit("english").alias("language"), F.col("props").alias("review"),
        epoch.alias("timestamp_created"), epoch.alias("timestamp_updated"),
        F.when(F.col("event_type") == "purchase", F.lit(True))
         .when(F.col("event_type") == "click", F.lit(False)).alias("voted_up"),
        F.col("value").alias("weighted_vote_score"))
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    ok = F.col("c_mktsegment") != "MACHINERY"
    release = (F.when(F.col("c_nationkey") < 10, F.date_format(F.lit("2013-11-08").cast("date"), "d MMM, yyyy"))
                .otherwise(F.lit("Coming soon")))
    data = F.struct(
        F.col("c_name").alias("name"), F.lit("game").alias("type"),
        (F.col("c_acctbal") < 0).alias("is_free"),
        F.array("c_mktsegment").alias("developers"),
        F.array().cast("array<string>").alias("publishers"),
        F.array(F.struct(F.col("n_name").alias("description"))).alias("genres"),
        F.struct(F.lit("USD").alias("currency"),
                 (F.col("c_acctbal") * 100).cast("decimal(38,0)").cast("bigint").alias("final"))
         .alias("price_overview"),
        F.struct(release.alias("date")).alias("release_date"),
        F.struct(F.col("c_nationkey").alias("score")).alias("metacritic"),
        F.struct(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("total")).alias("recommendations"),
        F.col("n_name").alias("short_description"))
    details_ts = F.lit(DETAILS_TS).cast("timestamp")
    app_details = c.join(n, c.c_nationkey == n.n_nationkey).select(
        details_ts.alias("_ts"), _iso(details_ts).alias("_extracted_at"),
        F.lit("appdetails").alias("_source"), F.col("c_custkey").alias("appid"),
        ok.alias("success"), F.when(ok, data).alias("data"))
    return {"most_played": most_played, "player_counts": player_counts, "reviews": reviews,
            "app_details": app_details}


def _land(lake, records: dict[str, DataFrame]) -> None:
    """Write each dataset's NDJSON landing files (datasets side by side)."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=4) as pool:
        for f in [pool.submit(write_ndjson, df, lake.landing, ds, "_ts", [c for c in df.columns if c != "_ts"])
                  for ds, df in records.items()]:
            f.result()


def _pipeline_lake(spark, sf_dir):
    """Land, ingest and build once per session and scale; later calls reuse it. Reviews of
    a user who has no chart row are left in place, with a warning in the run's log."""
    from strata.operators.quality import UNCHARTED
    from strata.plans.build import build, load_raw
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        from strata.streaming.arrival import run_on_arrival
        lake = Lake(scratch_path(spark, "medallion"))
        _land(lake, _api_shaped(spark, sf_dir))
        load_raw(spark, lake)
        # the build runs as the arrival stream's micro-batch (audit row + models)
        run_on_arrival(spark, lake, lambda s, l, run_id: build(
            s, l, run_id, silver_mode="view", daily_mode="full", review_mode="strict", warn=(UNCHARTED,)))
        _LAKES[key] = lake.root
    return Lake(_LAKES[key])


def _incremental_lake(spark, sf_dir):
    """The same records landed in two runs (split at 2024-01-16) and built
    incrementally: silver merged from new bronze batches, touched days only. A review may
    come with the first run and its user's first chart row with the second."""
    from strata.operators.quality import UNCHARTED
    from strata.plans.build import build, load_raw
    key = (spark.sparkContext.applicationId, sf_dir, "incremental")
    if key not in _LAKES:
        lake = Lake(scratch_path(spark, "medallion-inc"))
        split = F.lit("2024-01-16").cast("timestamp_ntz")
        records = _api_shaped(spark, sf_dir)
        for first in (True, False):
            run = {ds: (df.where(F.col("_ts") < split) if first else df.where(F.col("_ts") >= split))
                   for ds, df in records.items()}
            run["app_details"] = records["app_details"] if first else records["app_details"].limit(0)
            _land(lake, run)
            load_raw(spark, lake)
            build(spark, lake, warn=(UNCHARTED,))
        _LAKES[key] = lake.root
    return Lake(_LAKES[key])


def medallion_incremental_report(spark, sf_dir):
    """The report after two incremental runs; must equal the full computation."""
    from strata.plans.build import gold_tables
    rpt = gold_tables(spark, _incremental_lake(spark, sf_dir))["rpt_daily_game_performance"]
    return rpt.select(*[F.col(c).cast("double").alias(c) if c in (
        "positive_review_ratio", "avg_weighted_vote_score", "median_playtime_at_review_min")
        else F.col(c) for c in rpt.columns])


def medallion_report(spark, sf_dir):
    """The reporting view of the full pipeline: NDJSON -> bronze -> silver -> gold."""
    from strata.plans.build import gold_tables
    rpt = gold_tables(spark, _pipeline_lake(spark, sf_dir))["rpt_daily_game_performance"]
    return rpt.select(*[F.col(c).cast("double").alias(c) if c in (
        "positive_review_ratio", "avg_weighted_vote_score", "median_playtime_at_review_min")
        else F.col(c) for c in rpt.columns])


def arrival_audit(spark, sf_dir):
    """New rows per bronze table recorded by the arrival-triggered builds."""
    from strata.streaming.arrival import trigger_log
    log = trigger_log(spark, _pipeline_lake(spark, sf_dir))
    return log.agg(*[F.sum(f"new_{ds}").cast("bigint").alias(f"new_{ds}")
                     for ds in ("most_played", "player_counts", "reviews", "app_details")],
                   F.count(F.lit(1)).alias("builds"))


def export_report_sample(spark, sf_dir):
    """The report's sample export (latest 300 rows, ordered) as CSV, read back."""
    from strata.plans.build import gold_tables
    from strata.sources.export import export_samples
    g = gold_tables(spark, _pipeline_lake(spark, sf_dir))
    out = scratch_path(spark, "samples")
    export_samples(g["rpt_daily_game_performance"], g["dim_game"], g["fact_review"], out)
    decimals = ("positive_review_ratio", "avg_weighted_vote_score", "median_playtime_at_review_min")
    schema = T.StructType([T.StructField(f.name, T.DoubleType() if f.name in decimals else f.dataType)
                           for f in g["rpt_daily_game_performance"].schema.fields])
    return spark.read.schema(schema).option("header", True).csv(f"{out}/sample_daily_game_performance")


def medallion_fact_review(spark, sf_dir):
    """The incremental review fact of the full pipeline."""
    from strata.plans.build import gold_tables
    fr = gold_tables(spark, _pipeline_lake(spark, sf_dir))["fact_review"]
    return fr.select("review_id", "game_key", "review_date", "is_positive", "positive_flag",
                     "weighted_vote_score", "playtime_at_review_min",
                     F.col("playtime_at_review_hrs").cast("double").alias("playtime_at_review_hrs"),
                     "review_length_chars", _ntz(F.col("created_at")).alias("created_at"))


QUERIES = {
    "variant_project": variant_project,
    "variant_nested_array": variant_nested_array,
    "cast_types": cast_types,
    "latest_per_key_day": latest_per_key_day,
    "latest_per_key": latest_per_key,
    "dedup_two_keys": dedup_two_keys,
    "filter_then_latest": filter_then_latest,
    "latest_nulls_first": latest_nulls_first,
    "spine_left_join_dim": spine_left_join_dim,
    "daily_aggregate": daily_aggregate,
    "daily_fact": daily_fact,
    "report_flat": report_flat,
    "dim_game_analog": dim_game_analog,
    "review_fact_project": review_fact_project,
    "money_division": money_division,
    "try_parse_date": try_parse_date,
    "incremental_upsert": incremental_upsert,
    "incremental_late_strict": incremental_late_strict,
    "incremental_late_loaded": incremental_late_loaded,
    "quality_unique": quality_unique,
    "quality_not_null": quality_not_null,
    "quality_null_counts": quality_null_counts,
    "quality_relationships": quality_relationships,
    "quality_grain": quality_grain,
    "union_counts": union_counts,
    "scalar_counts": scalar_counts,
    "freshness": freshness,
    "topk_day": topk_day,
    "topk_nulls_last": topk_nulls_last,
    "topk_limit": topk_limit,
    "chart_flatten_topn": chart_flatten_topn,
    "page_flatten_cutoff": page_flatten_cutoff,
    "details_envelope": details_envelope_q,
    "driver_scope_chunks": driver_scope_chunks,
    "stamp_metadata": stamp_metadata,
    "stream_ingest_once": stream_ingest_once,
    "export_ndjson_roundtrip": export_ndjson_roundtrip,
    "load_ledger": load_ledger,
    "medallion_report": medallion_report,
    "medallion_fact_review": medallion_fact_review,
    "medallion_incremental_report": medallion_incremental_report,
    "arrival_audit": arrival_audit,
    "export_report_sample": export_report_sample,
}
