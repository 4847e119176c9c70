"""DuckDB SQL oracles for the driver queries (same column names and types).

Each entry is an independent SQL statement of what the matching query in
``strata.plans.analogs`` computes, runnable on the test tables registered
as views. NULL ordering is always spelled out.
"""

from __future__ import annotations

_LATEST = "QUALIFY row_number() OVER (PARTITION BY {p} ORDER BY {o}) = 1"

_STAR = """
chart AS (
  SELECT user_id AS appid, CAST(ts AS DATE) AS chart_date, CAST(floor(value) AS BIGINT) AS chart_rank,
         event_id AS last_week_rank, user_id AS peak_in_game
  FROM events WHERE event_type = 'view'
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC NULLS FIRST) = 1),
counts AS (
  SELECT user_id AS appid, CAST(ts AS DATE) AS snapshot_date, CAST(floor(value) AS BIGINT) AS player_count
  FROM events WHERE event_type = 'signup'
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC NULLS FIRST) = 1),
rv AS (
  SELECT user_id AS appid, CAST(ts AS DATE) AS review_date, value AS score,
         CAST(floor(value) AS BIGINT) AS playtime,
         CASE WHEN event_type = 'purchase' THEN TRUE WHEN event_type = 'click' THEN FALSE END AS voted_up
  FROM events WHERE event_type IN ('purchase', 'click', 'error')),
agg AS (
  SELECT appid, review_date, count(*) AS total,
         sum(CASE WHEN voted_up THEN 1 ELSE 0 END) AS pos,
         sum(CASE WHEN voted_up THEN 0 ELSE 1 END) AS neg,
         avg(score) AS avg_score, median(playtime) AS med
  FROM rv GROUP BY appid, review_date),
fact AS (
  SELECT chart.chart_date AS activity_date, chart.appid AS game_key, chart.chart_rank,
         chart.last_week_rank, chart.peak_in_game, counts.player_count AS snapshot_player_count,
         CAST(coalesce(agg.total, 0) AS BIGINT) AS reviews_total,
         CAST(coalesce(agg.pos, 0) AS BIGINT) AS reviews_positive,
         CAST(coalesce(agg.neg, 0) AS BIGINT) AS reviews_negative,
         agg.avg_score AS avg_weighted_vote_score,
         CAST(agg.med AS DECIMAL(38,3)) AS median_playtime_at_review_min,
         CASE WHEN agg.total IS NULL OR agg.pos IS NULL THEN NULL WHEN agg.total = 0 THEN 0.0
              ELSE CAST(agg.pos AS DOUBLE) / CAST(agg.total AS DOUBLE) END AS positive_review_ratio
  FROM chart
  LEFT JOIN counts ON counts.appid = chart.appid AND counts.snapshot_date = chart.chart_date
  LEFT JOIN agg ON agg.appid = chart.appid AND agg.review_date = chart.chart_date),
details AS (
  SELECT c.c_custkey AS appid, c.c_name AS game_name, c.c_acctbal < 0 AS is_free,
         c.c_mktsegment AS primary_developer, n.n_name AS primary_genre, 'USD' AS price_currency,
         CAST(CAST(c.c_acctbal * 100 AS DECIMAL(38,0)) AS DOUBLE) / 100 AS price_final,
         CASE WHEN c.c_nationkey < 10 THEN DATE '2013-11-08' END AS release_date,
         CAST(c.c_nationkey AS BIGINT) AS metacritic_score,
         CASE WHEN c.c_acctbal >= 0 THEN c.c_custkey END AS total_recommendations
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_mktsegment <> 'MACHINERY'),
dim AS (
  SELECT s.appid AS game_key,
         coalesce(d.game_name, 'Unknown (' || CAST(s.appid AS VARCHAR) || ')') AS game_name,
         d.primary_developer, CAST(NULL AS VARCHAR) AS primary_publisher, d.primary_genre,
         d.is_free, d.price_currency, d.price_final, d.release_date, d.metacritic_score,
         d.total_recommendations, d.appid IS NOT NULL AS has_store_page
  FROM (SELECT DISTINCT appid FROM chart) s LEFT JOIN details d ON d.appid = s.appid),
rpt AS (
  SELECT f.activity_date, f.chart_rank, f.last_week_rank, g.game_name, g.primary_developer,
         g.primary_publisher, g.primary_genre, g.is_free, g.has_store_page, f.peak_in_game,
         f.snapshot_player_count, f.reviews_total, f.reviews_positive, f.reviews_negative,
         CAST(CAST(round(CAST(f.positive_review_ratio AS DECIMAL(38,6)), 3) AS DECIMAL(38,3)) AS DOUBLE)
           AS positive_review_ratio,
         CAST(CAST(round(CAST(f.avg_weighted_vote_score AS DECIMAL(38,6)), 3) AS DECIMAL(38,3)) AS DOUBLE)
           AS avg_weighted_vote_score,
         CAST(f.median_playtime_at_review_min AS DOUBLE) AS median_playtime_at_review_min
  FROM fact f JOIN dim g ON g.game_key = f.game_key)
"""


def _with(body: str) -> str:
    return "WITH " + _STAR + body


_EV = "event_id, user_id, CAST(ts AS DATE) AS day, ts, event_type, value"

_VOTE_REVIEWS = """
SELECT user_id, CAST(ts AS DATE) AS day, value,
       CASE WHEN event_type = 'purchase' THEN TRUE WHEN event_type = 'click' THEN FALSE END AS vote
FROM events WHERE event_type IN ('purchase', 'click', 'error')"""

_PAGES = """
WITH base AS (
  SELECT e.*, s.shift FROM events e, (SELECT unnest([0, 1]) AS shift) s
  WHERE s.shift = 0 OR hour(e.ts) < 3),
items AS (
  SELECT user_id AS appid, datediff('day', CAST(ts AS DATE), DATE '2024-01-31') + shift AS page_no,
         event_id AS pos,
         CASE WHEN event_type = 'error' THEN 'HTTP 500' END AS error,
         CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS rid,
         CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(epoch_us(ts) // 1000000 AS BIGINT) END AS created
  FROM base),
items2 AS (
  SELECT *, 'c' || CAST(page_no AS VARCHAR) AS cursor,
         CASE WHEN page_no < 30 THEN 'c' || CAST(page_no + 1 AS VARCHAR) END AS next_cursor,
         coalesce(created, 0) AS c0,
         CAST(epoch_us(TIMESTAMP '2024-01-31 06:00:00') // 1000000 AS BIGINT) - 168 * 3600 AS cutoff,
         rid IS NOT NULL AND row_number() OVER (
           PARTITION BY appid, rid ORDER BY page_no ASC NULLS LAST, pos ASC NULLS LAST) = 1 AS first_seen
  FROM items),
pages AS (
  SELECT appid, page_no, count_if(rid IS NOT NULL) AS n,
         count_if(first_seen AND c0 < cutoff) AS old,
         bool_or(error IS NOT NULL) AS failed,
         bool_or(next_cursor IS NULL OR next_cursor = cursor) AS last_page
  FROM items2 GROUP BY appid, page_no),
stops AS (
  SELECT appid, min(CASE WHEN old > 0 OR last_page THEN page_no END) AS stop_incl,
         min(CASE WHEN failed OR n = 0 THEN page_no END) AS stop_excl
  FROM pages GROUP BY appid),
kept AS (
  SELECT i.* FROM items2 i JOIN stops s ON s.appid = i.appid
  WHERE i.first_seen
    AND (s.stop_incl IS NULL OR i.page_no <= s.stop_incl)
    AND (s.stop_excl IS NULL OR i.page_no < s.stop_excl)),
firsts AS (SELECT * FROM kept)
SELECT appid, CAST(page_no AS BIGINT) AS page_no, rid AS recommendationid, created
FROM firsts WHERE c0 >= cutoff"""

_LATE = """
SELECT event_id, CAST(ts AS DATE) AS event_date, user_id, event_type, value,
       CASE WHEN ts < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-01-16 06:00:00'
            ELSE TIMESTAMP '2024-01-31 06:00:00' END AS extracted_at
FROM events"""

_ORDERS_CUSTOMER = """
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') c
  ON o.o_custkey = c.c_custkey"""

_COUNTED = ("events", "orders", "lineitem", "customer")

_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]

ORACLES: dict[str, str] = {
    "variant_project": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract_string(props, '$.missing') AS BIGINT) AS missing
FROM events""",
    "variant_nested_array": """
SELECT o.o_orderkey, n.n_name AS nation_name, CAST(n.n_regionkey AS BIGINT) AS region_key,
       o.o_orderstatus AS first_tag, o.o_orderpriority AS line_prio, o.o_totalprice AS line_price,
       CAST(NULL AS VARCHAR) AS out_of_range, CAST(NULL AS VARCHAR) AS missing_field
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "cast_types": """
SELECT event_id, date_trunc('second', ts) AS from_epoch, ts AS from_iso,
       CAST(ts AS DATE) AS iso_date, value AS num, event_type = 'purchase' AS flag,
       CAST(user_id AS VARCHAR) AS age_text
FROM events""",
    "latest_per_key_day": f"SELECT {_EV} FROM events "
                          + _LATEST.format(p="user_id, CAST(ts AS DATE)", o="ts DESC NULLS FIRST"),
    "latest_per_key": f"SELECT {_EV} FROM events "
                      + _LATEST.format(p="user_id", o="ts DESC NULLS FIRST"),
    "dedup_two_keys": "SELECT * FROM lineitem " + _LATEST.format(
        p="l_orderkey, l_linenumber",
        o=", ".join(["l_shipdate DESC NULLS FIRST"] + [f"{c} DESC NULLS FIRST" for c in _LI_REST])),
    "filter_then_latest": f"SELECT {_EV} FROM events WHERE event_type <> 'error' "
                          + _LATEST.format(p="user_id, CAST(ts AS DATE)", o="ts DESC NULLS FIRST"),
    "latest_nulls_first": f"SELECT {_EV} FROM events " + _LATEST.format(
        p="user_id",
        o="CASE WHEN event_type = 'signup' THEN NULL ELSE ts END DESC NULLS FIRST, event_id DESC NULLS FIRST"),
    "spine_left_join_dim": """
SELECT s.custkey, coalesce(c.c_name, 'Unknown (' || CAST(s.custkey AS VARCHAR) || ')') AS name,
       c.c_mktsegment, c.c_acctbal, c.c_custkey IS NOT NULL AS has_store_page
FROM (SELECT DISTINCT o_custkey AS custkey FROM orders) s
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') c ON s.custkey = c.c_custkey""",
    "daily_aggregate": f"""
SELECT user_id, day, count(*) AS n_events,
       CAST(sum(CASE WHEN vote THEN 1 ELSE 0 END) AS BIGINT) AS n_positive,
       CAST(sum(CASE WHEN vote THEN 0 ELSE 1 END) AS BIGINT) AS n_negative,
       round(avg(value), 6) AS avg_value, round(median(value), 6) AS median_value
FROM ({_VOTE_REVIEWS}) r GROUP BY user_id, day""",
    "daily_fact": _with("""
SELECT activity_date, game_key, chart_rank, last_week_rank, peak_in_game, snapshot_player_count,
       reviews_total, reviews_positive, reviews_negative,
       round(avg_weighted_vote_score, 6) AS avg_weighted_vote_score,
       CAST(median_playtime_at_review_min AS DOUBLE) AS median_playtime_at_review_min,
       positive_review_ratio
FROM fact"""),
    "report_flat": _with("SELECT * FROM rpt"),
    "dim_game_analog": _with("SELECT * FROM dim"),
    "review_fact_project": """
SELECT CAST(d.doc_id AS VARCHAR) AS review_id, d.doc_id AS game_key, d.lang AS review_language,
       (l.quality = 1) AS is_positive, CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS positive_flag,
       ((d.n_chars * 10 + 30) // 60) / 10.0 AS playtime_at_review_hrs,
       CAST(length(d.text) AS BIGINT) AS review_length_chars
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "money_division": """
SELECT c_custkey, CAST(CAST(c_acctbal * 100 AS DECIMAL(38,0)) AS BIGINT) AS minor_units,
       CAST(CAST(c_acctbal * 100 AS DECIMAL(38,0)) AS DOUBLE) / 100 AS price_final
FROM customer""",
    "try_parse_date": """
SELECT o_orderkey, release_text, CAST(try_strptime(release_text, '%d %b, %Y') AS DATE) AS release_date
FROM (SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%-d %b, %Y')
                  WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%b %-d, %Y')
                  ELSE strftime(o_orderdate, '%Y') END AS release_text
      FROM orders) t""",
    "incremental_upsert": """
SELECT event_id, CAST(ts AS DATE) AS event_date, user_id, event_type,
       CASE WHEN ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-16' THEN value + 1000
            ELSE value END AS value,
       CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN TIMESTAMP '2024-01-31 06:00:00'
            ELSE TIMESTAMP '2024-01-16 06:00:00' END AS extracted_at
FROM events""",
    "incremental_late_strict": _LATE + " WHERE ts < TIMESTAMP '2024-01-24'",
    "incremental_late_loaded": _LATE,
    "quality_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS duplicate_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "quality_not_null": "SELECT o.o_orderkey, o.o_custkey " + _ORDERS_CUSTOMER + " WHERE c.c_name IS NULL",
    "quality_null_counts": "SELECT CAST(count_if(c.c_name IS NULL) AS BIGINT) AS c_name_nulls, "
                           "CAST(count_if(c.c_acctbal IS NULL) AS BIGINT) AS c_acctbal_nulls, "
                           "CAST(count_if(o.o_totalprice IS NULL) AS BIGINT) AS o_totalprice_nulls "
                           + _ORDERS_CUSTOMER,
    "quality_relationships": """
SELECT d.doc_id, d.lang FROM documents d
WHERE d.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "quality_grain": """
SELECT o_custkey, o_orderdate, count(*) AS duplicate_rows FROM orders
GROUP BY o_custkey, o_orderdate HAVING count(*) > 1""",
    "union_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED),
    "scalar_counts": "SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS n_{t}" for t in _COUNTED),
    "freshness": "SELECT count(*) AS row_count, max(ts) AS latest FROM events",
    "topk_day": _with("""
SELECT activity_date, chart_rank, game_name, reviews_total FROM rpt
WHERE activity_date = DATE '2024-01-15'
ORDER BY chart_rank ASC NULLS LAST, game_name ASC NULLS LAST LIMIT 10"""),
    "topk_nulls_last": _with("""
SELECT game_key, game_name, total_recommendations, has_store_page FROM dim
ORDER BY total_recommendations DESC NULLS LAST, game_key ASC NULLS LAST LIMIT 50"""),
    "topk_limit": _with("""
SELECT * FROM rpt
ORDER BY activity_date DESC NULLS FIRST, chart_rank ASC NULLS LAST, game_name ASC NULLS LAST LIMIT 300"""),
    "chart_flatten_topn": """
SELECT event_id, pos, user_id * 10 + pos AS appid, pos + 1 AS rank, event_id AS peak_in_game,
       CAST(epoch_us(ts) // 1000000 AS BIGINT) AS rollup_date
FROM (SELECT *, unnest(range(0, least(CAST(floor(value / 100) AS BIGINT) + 1, 3))) AS pos
      FROM events) t""",
    "page_flatten_cutoff": _PAGES,
    "details_envelope": """
SELECT c_custkey AS appid,
       CASE WHEN c_acctbal < 0 OR c_nationkey = 0 THEN FALSE ELSE c_mktsegment <> 'MACHINERY' END AS success,
       CASE WHEN c_acctbal >= 0 AND c_nationkey <> 0 AND c_mktsegment <> 'MACHINERY' THEN c_name END
         AS game_name,
       CASE WHEN c_acctbal < 0 THEN 'HTTP 503' END AS error
FROM customer""",
    "driver_scope_chunks": """
WITH c AS (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id
           ORDER BY n_events DESC NULLS FIRST, user_id ASC NULLS LAST LIMIT 100),
r AS (SELECT user_id, n_events,
             CAST(row_number() OVER (ORDER BY n_events DESC NULLS FIRST, user_id ASC NULLS LAST) - 1 AS BIGINT) AS pos
      FROM c)
SELECT unnest(['player_counts', 'reviews', 'app_details']) AS dataset,
       CAST(floor(pos / 50) AS INTEGER) AS part, user_id AS appid, pos, n_events
FROM r""",
    "stamp_metadata": """
SELECT event_id,
       CASE WHEN event_type = 'signup' THEN 'upstream' WHEN event_type = 'view' THEN NULL
            ELSE 'events' END AS _source,
       CASE WHEN event_type = 'click' THEN 'upstream-ts'
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS _extracted_at
FROM events""",
    "stream_ingest_once": """
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS ingest_date FROM events""",
    "export_ndjson_roundtrip": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus,
       TIMESTAMP '2024-01-31 06:00:00' AS extracted_at,
       'raw/orders/ingest_date=2024-01-31/orders_20240131T060000_part'
         || printf('%02d', CAST(floor(o_orderkey / 500) AS INTEGER)) || '.ndjson' AS object_key,
       DATE '2024-01-31' AS ingest_date
FROM orders""",
    "medallion_report": _with("SELECT * FROM rpt"),
    "medallion_incremental_report": _with("SELECT * FROM rpt"),
    "medallion_fact_review": """
SELECT CAST(event_id AS VARCHAR) AS review_id, user_id AS game_key, CAST(ts AS DATE) AS review_date,
       CASE WHEN event_type = 'purchase' THEN TRUE WHEN event_type = 'click' THEN FALSE END AS is_positive,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS positive_flag,
       value AS weighted_vote_score, CAST(floor(value) AS BIGINT) AS playtime_at_review_min,
       ((CAST(floor(value) AS BIGINT) * 10 + 30) // 60) / 10.0 AS playtime_at_review_hrs,
       CAST(length(props) AS BIGINT) AS review_length_chars,
       date_trunc('second', ts) AS created_at
FROM events WHERE event_type IN ('purchase', 'click', 'error')""",
    "export_report_sample": _with("""
SELECT * FROM rpt
ORDER BY activity_date DESC NULLS FIRST, chart_rank ASC NULLS LAST, game_name ASC NULLS LAST LIMIT 300"""),
    "arrival_audit": """
SELECT CAST(count_if(event_type = 'view') AS BIGINT) AS new_most_played,
       CAST(count_if(event_type = 'signup') AS BIGINT) AS new_player_counts,
       CAST(count_if(event_type IN ('purchase', 'click', 'error')) AS BIGINT) AS new_reviews,
       (SELECT count(*) FROM customer) AS new_app_details,
       CAST(1 AS BIGINT) AS builds
FROM events""",
    "load_ledger": """
SELECT CAST(ts AS DATE) AS ingest_date, count(*) AS loaded_rows FROM events GROUP BY 1""",
}
