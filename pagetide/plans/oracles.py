"""DuckDB statements of the registered queries, written from the rules and not from the Spark code.

The fold in particular is stated here as the sequential rule itself, one version after the other, by a recursive query.
"""

from __future__ import annotations

REVIEWS = """
reviews AS (
    SELECT CAST(d.doc_id AS VARCHAR) AS recommendationid, 'run-' || CAST(d.doc_id % 7 AS VARCHAR) AS run_id,
        d.source AS app_id, CASE WHEN d.lang = 'es' THEN NULL ELSE d.lang END AS language,
        CASE WHEN d.doc_id % 50 = 0 THEN '' ELSE d.text END AS review, coalesce(l.quality, 0) = 1 AS voted_up,
        CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE 1600000000 + (d.doc_id * 7919) % 1000000 END AS timestamp_updated,
        d.n_chars AS votes_up, d.n_chars % 5 AS votes_funny
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""

APPS = """
apps AS (SELECT DISTINCT source AS app_id, upper(source) AS app_name FROM documents WHERE source <> 'src7')"""

PAGES = """
pages_raw AS (
    SELECT event_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, user_id, value,
        strftime(ts, '%Y%m%d') AS run_id, CAST(user_id AS VARCHAR) AS app_id,
        CAST(extract('hour' FROM ts) * 60 + extract('minute' FROM ts) + 1 AS INTEGER) AS page_number,
        CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS fetched_at
    FROM events
),
report AS (
    SELECT *, run_id || ':' || app_id || ':' || lpad(CAST(page_number AS VARCHAR), 4, '0') AS page_key,
        CASE WHEN event_type = 'click' THEN NULL ELSE 'App ' || app_id END AS app_name,
        CASE WHEN k % 13 = 0 THEN NULL ELSE 'c' || CAST(k % 4 AS VARCHAR) END AS next_cursor,
        CASE event_type WHEN 'error' THEN 'fetch_error' WHEN 'signup' THEN 'empty' ELSE 'fetched' END AS status,
        CAST(CASE WHEN event_type <> 'error' THEN 200 WHEN k % 10 = 9 THEN 429 ELSE 500 END AS INTEGER) AS status_code,
        CASE WHEN event_type = 'error' THEN NULL ELSE '/landed/' || run_id || '/app_' || app_id || '_page_'
            || lpad(CAST(page_number AS VARCHAR), 4, '0') || '.json' END AS raw_json_path,
        k * 100 AS response_bytes,
        CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE k END AS review_count,
        k + 4294967296 AS total_reviews,
        CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE epoch_s END AS max_timestamp_updated,
        CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE epoch_s - k END AS min_timestamp_updated,
        CAST(1 + k % 3 AS INTEGER) AS attempt_count,
        CASE event_type WHEN 'error' THEN 'fetch_error' WHEN 'signup' THEN 'empty_page'
            WHEN 'purchase' THEN 'caught_up_to_existing_reviews' WHEN 'view' THEN 'page_cap_reached' END AS terminal_reason
    FROM pages_raw
)"""

STATE = """
state AS (
    SELECT CAST(c_custkey AS VARCHAR) AS app_id,
        CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE 1704000000 + c_custkey * 1000 END AS complete_through_timestamp_updated,
        c_acctbal < 0 AS backlogged, '20231231' AS last_run_id,
        CASE WHEN c_acctbal >= 0 THEN '20231231' END AS last_successful_run_id,
        CASE WHEN c_acctbal >= 0 THEN 'empty_page' ELSE 'fetch_error' END AS last_terminal_reason,
        c_custkey AS last_seen_max_timestamp_updated, CAST(NULL AS BIGINT) AS last_seen_min_timestamp_updated,
        CAST(c_nationkey AS BIGINT) AS last_page_count, CAST(NULL AS BIGINT) AS last_review_count
    FROM customer
)"""

TARGETS = """
targets AS (
    SELECT c_custkey + 2 AS row_number, c_name AS app_name,
        CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN 'id-' || CAST(c_custkey AS VARCHAR)
            ELSE CAST(c_custkey AS VARCHAR) END AS app_id,
        CASE WHEN c_nationkey = 13 THEN 'maybe' WHEN c_mktsegment = 'BUILDING' THEN 'true'
            WHEN c_mktsegment = 'MACHINERY' THEN '0' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'yes'
            WHEN c_mktsegment = 'FURNITURE' THEN 'inactive' END AS word,
        CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE 'nation ' || CAST(c_nationkey AS VARCHAR) END AS notes
    FROM customer
),
checked AS (
    SELECT *, CASE WHEN word IS NULL OR word IN ('true', 'yes') THEN true WHEN word IN ('0', 'inactive') THEN false END AS active,
        CASE WHEN app_id IS NULL THEN 'app_id is required' WHEN app_id LIKE 'id-%' THEN 'app_id must be numeric'
            WHEN word = 'maybe' THEN 'Invalid boolean value: maybe' END AS reject_reason
    FROM targets
)"""

PAYLOAD = """
placed AS (
    SELECT *, 'run-' || CAST(doc_id % 7 AS VARCHAR) AS run_id, source AS app_id, CAST(doc_id // 200 + 1 AS INTEGER) AS page_number,
        CAST(row_number() OVER (PARTITION BY doc_id % 7, source, doc_id // 200 ORDER BY doc_id) - 1 AS INTEGER) AS pos
    FROM documents
)"""


def _versions(key: str) -> str:
    return PAGES + f""",
versions AS (
    SELECT event_id, run_id, app_id, page_key AS source_page_key, {key} AS recommendationid,
        CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN '' ELSE event_type END AS review,
        CASE WHEN k % 23 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS timestamp_updated
    FROM report
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY recommendationid ORDER BY event_id) AS rn
    FROM versions WHERE recommendationid IS NOT NULL
),
fold AS (
    SELECT recommendationid, rn, event_id, coalesce(timestamp_updated, 0) AS cur_ts, review AS cur_text,
        'inserted' AS outcome, CAST(NULL AS BIGINT) AS previous_timestamp_updated
    FROM numbered WHERE rn = 1
    UNION ALL
    SELECT n.recommendationid, n.rn, n.event_id,
        CASE WHEN coalesce(n.timestamp_updated, 0) > f.cur_ts OR n.review IS DISTINCT FROM f.cur_text
            THEN coalesce(n.timestamp_updated, 0) ELSE f.cur_ts END,
        n.review,
        CASE WHEN coalesce(n.timestamp_updated, 0) > f.cur_ts OR n.review IS DISTINCT FROM f.cur_text
            THEN 'updated' ELSE 'unchanged' END,
        f.cur_ts
    FROM fold f JOIN numbered n ON n.recommendationid = f.recommendationid AND n.rn = f.rn + 1
),
judged AS (
    SELECT v.*, f.outcome, f.previous_timestamp_updated FROM fold f JOIN versions v ON v.event_id = f.event_id
),
current_reviews AS (
    SELECT recommendationid, run_id, app_id, review, timestamp_updated, source_page_key
    FROM judged WHERE outcome <> 'unchanged'
    QUALIFY row_number() OVER (PARTITION BY recommendationid ORDER BY event_id DESC) = 1
),
changes AS (
    SELECT run_id, recommendationid, app_id, outcome AS change_type, previous_timestamp_updated,
        timestamp_updated AS new_timestamp_updated, source_page_key
    FROM judged WHERE outcome <> 'unchanged'
    QUALIFY row_number() OVER (PARTITION BY run_id, recommendationid ORDER BY event_id DESC) = 1
)"""


_KEY = "CASE WHEN k = 99 THEN NULL ELSE CAST(user_id * 10 + k % 10 AS VARCHAR) END"
VERSIONS = _versions(_KEY)
SKEWED = _versions(f"CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE {_KEY} END")

PROGRESS = """
progress AS (
    SELECT run_id, app_id, max(max_timestamp_updated) AS max_seen, min(min_timestamp_updated) AS min_seen,
        count(*) AS page_count, CAST(sum(review_count) AS BIGINT) AS review_count,
        (SELECT coalesce(x.terminal_reason, 'unknown') FROM report x WHERE x.event_id = max(r.event_id)) AS terminal_reason
    FROM report r GROUP BY run_id, app_id
),
judged_progress AS (
    SELECT *, terminal_reason IN ('caught_up_to_existing_reviews', 'empty_page', 'missing_next_cursor') AS complete
    FROM progress
),
history AS (
    SELECT p.app_id,
        greatest(coalesce(s.complete_through_timestamp_updated, 0), coalesce(max(CASE WHEN complete THEN coalesce(max_seen, 0) END)
            OVER (PARTITION BY p.app_id ORDER BY p.run_id), 0)) AS complete_through_timestamp_updated,
        NOT complete AS backlogged, p.run_id AS last_run_id,
        coalesce(last_value(CASE WHEN complete THEN p.run_id END IGNORE NULLS)
            OVER (PARTITION BY p.app_id ORDER BY p.run_id), s.last_successful_run_id) AS last_successful_run_id,
        p.terminal_reason AS last_terminal_reason, max_seen AS last_seen_max_timestamp_updated,
        min_seen AS last_seen_min_timestamp_updated, p.page_count AS last_page_count, p.review_count AS last_review_count
    FROM judged_progress p LEFT JOIN state s ON s.app_id = p.app_id
),
updated AS (SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY last_run_id DESC) = 1),
advanced AS (
    SELECT * FROM updated
    UNION ALL
    SELECT app_id, coalesce(complete_through_timestamp_updated, 0), backlogged, last_run_id, last_successful_run_id,
        last_terminal_reason, last_seen_max_timestamp_updated, last_seen_min_timestamp_updated, last_page_count,
        coalesce(last_review_count, 0)
    FROM state WHERE app_id NOT IN (SELECT app_id FROM updated)
)"""

CHAIN = """
chained AS (
    SELECT *, CASE WHEN row_number() OVER w = 1 THEN '*' ELSE coalesce(lag(next_cursor) OVER w, '') END AS cursor,
        CASE WHEN event_type = 'error' THEN 'fetch_error' ELSE 'fetched' END AS raw_status
    FROM report WINDOW w AS (PARTITION BY run_id, app_id ORDER BY page_number, event_id)
)"""

_REASON = """CASE
    WHEN raw_status = 'fetched' AND {mark} > 0 AND review_count > 0 AND coalesce(max_timestamp_updated, 0) <= {mark}
        THEN 'caught_up_to_existing_reviews'
    WHEN raw_status <> 'fetched' THEN 'fetch_error'
    WHEN review_count = 0 THEN 'empty_page'
    WHEN page_number >= 1200 THEN 'page_cap_reached'
    WHEN coalesce(next_cursor, '') = '' THEN 'missing_next_cursor'
    WHEN next_cursor = cursor THEN 'cursor_not_advancing' END"""


def _with(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(parts) + "\n"


_FLAG = "CASE WHEN voted_up THEN 'recommended' ELSE 'not_recommended' END"
_FETCH = """count(*) AS page_count, CAST(sum(review_count) AS BIGINT) AS review_count,
    count(*) FILTER (WHERE status = 'fetched') AS fetched_pages, count(*) FILTER (WHERE status = 'empty') AS empty_pages,
    count(*) FILTER (WHERE status = 'fetch_error') AS fetch_errors,
    count(*) FILTER (WHERE status_code = 429) AS rate_limited_pages"""
_PAGE_COLUMNS = """page_key, run_id, app_id, page_number, CAST(NULL AS VARCHAR) AS request_url, CAST(NULL AS VARCHAR) AS cursor,
    next_cursor, status, status_code, fetched_at, raw_json_path, response_bytes, review_count, total_reviews,
    CAST(NULL AS BIGINT) AS total_positive, CAST(NULL AS BIGINT) AS total_negative, max_timestamp_updated,
    min_timestamp_updated, attempt_count, error_message, terminal_reason"""
_VERSION_COLUMNS = "SELECT recommendationid, run_id, app_id, review, timestamp_updated, source_page_key FROM current_reviews"
_ISO_UPDATED = "strftime(make_timestamp(timestamp_updated * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'"

ORACLES: dict[str, str] = {}

ORACLES["app_review_counts"] = _with(REVIEWS, APPS) + """
SELECT r.app_id, a.app_name, count(*) AS review_count FROM reviews r LEFT JOIN apps a ON a.app_id = r.app_id
GROUP BY r.app_id, a.app_name ORDER BY review_count DESC, r.app_id"""

ORACLES["recommendation_distribution"] = _with(REVIEWS) + f"""
SELECT {_FLAG} AS recommendation, count(*) AS review_count FROM reviews GROUP BY voted_up"""

ORACLES["quality_missing"] = _with(REVIEWS) + """
SELECT count(*) FILTER (WHERE review IS NULL OR review = '') AS missing_review_text,
    count(*) FILTER (WHERE language IS NULL) AS missing_language FROM reviews"""

ORACLES["run_scope"] = _with(REVIEWS) + """
SELECT 'one' AS scope, count(*) AS row_count FROM reviews WHERE run_id = 'run-3'
UNION ALL SELECT 'blank', count(*) FROM reviews UNION ALL SELECT 'none', count(*) FROM reviews"""

ORACLES["recent_reviews_topk"] = _with(REVIEWS) + f"""
SELECT app_id, recommendationid, {_ISO_UPDATED} AS updated_at_iso, voted_up, review, timestamp_updated FROM reviews
ORDER BY timestamp_updated DESC NULLS FIRST, recommendationid LIMIT 25"""

ORACLES["table_counts"] = _with(REVIEWS, APPS, PAGES) + """
SELECT 'apps' AS table_name, count(*) AS row_count FROM apps UNION ALL SELECT 'pages', count(*) FROM report
UNION ALL SELECT 'reviews', count(*) FROM reviews UNION ALL SELECT 'runs', count(DISTINCT run_id) FROM report"""

ORACLES["duplicate_keys"] = _with(VERSIONS, recursive=True) + """
SELECT recommendationid, count(*) AS rows FROM versions WHERE recommendationid IS NOT NULL
GROUP BY recommendationid HAVING count(*) > 1"""

ORACLES["export_reviews"] = _with(REVIEWS, APPS) + f"""
SELECT r.recommendationid, r.run_id, r.app_id, a.app_name, language, review, voted_up,
    CAST(NULL AS BIGINT) AS timestamp_created, timestamp_updated, CAST(NULL AS VARCHAR) AS created_at_iso,
    {_ISO_UPDATED} AS updated_at_iso, votes_up, votes_funny, CAST(NULL AS DOUBLE) AS weighted_vote_score,
    CAST(0 AS BIGINT) AS comment_count, false AS steam_purchase, false AS received_for_free,
    false AS written_during_early_access, false AS primarily_steam_deck, CAST(NULL AS BIGINT) AS playtime_forever,
    CAST(NULL AS BIGINT) AS playtime_last_two_weeks, CAST(NULL AS BIGINT) AS playtime_at_review,
    CAST(NULL AS BIGINT) AS last_played, CAST(NULL AS VARCHAR) AS collected_at, CAST(NULL AS VARCHAR) AS source_page_key
FROM reviews r LEFT JOIN apps a ON a.app_id = r.app_id
ORDER BY r.app_id, timestamp_updated DESC NULLS FIRST, r.recommendationid"""

ORACLES["reviews_join_pages"] = _with(REVIEWS, PAGES) + """
SELECT r.run_id, count(*) AS joined_rows, max(r.votes_funny) AS max_votes_funny, max(p.total_reviews) AS max_total_reviews
FROM reviews r JOIN (SELECT 'run-' || CAST(event_id % 7 AS VARCHAR) AS run_id, total_reviews FROM report) p
    ON p.run_id = r.run_id GROUP BY r.run_id"""

ORACLES["fk_violations"] = _with(REVIEWS, APPS) + """
SELECT recommendationid, run_id, app_id, timestamp_updated FROM reviews
WHERE app_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM apps a WHERE a.app_id = reviews.app_id)"""

ORACLES["fk_violation_counts"] = _with(REVIEWS, APPS) + """
SELECT app_id, count(*) AS rows FROM reviews
WHERE app_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM apps a WHERE a.app_id = reviews.app_id) GROUP BY app_id"""

ORACLES["fk_valid"] = _with(REVIEWS, APPS) + """
SELECT recommendationid, run_id, app_id, review FROM reviews
WHERE EXISTS (SELECT 1 FROM apps a WHERE a.app_id = reviews.app_id)"""

ORACLES["fk_quarantine"] = _with(REVIEWS, APPS) + """
SELECT r.run_id, count(*) AS rows, CASE WHEN a.app_id IS NULL THEN 'aside' ELSE 'kept' END AS part
FROM reviews r LEFT JOIN apps a ON a.app_id = r.app_id GROUP BY ALL"""

ORACLES["check_violations"] = """
SELECT event_id, strftime(ts, '%Y%m%d') AS run_id, event_type AS change_type FROM events
WHERE event_type NOT IN ('signup', 'click', 'view')"""

ORACLES["not_null_violations"] = _with(REVIEWS) + """
SELECT 'recommendationid' AS column_name, count(*) FILTER (WHERE recommendationid IS NULL) AS null_rows FROM reviews
UNION ALL SELECT 'run_id', count(*) FILTER (WHERE run_id IS NULL) FROM reviews
UNION ALL SELECT 'app_id', count(*) FILTER (WHERE app_id IS NULL) FROM reviews
UNION ALL SELECT 'language', count(*) FILTER (WHERE language IS NULL) FROM reviews
UNION ALL SELECT 'review', count(*) FILTER (WHERE review IS NULL) FROM reviews
UNION ALL SELECT 'timestamp_updated', count(*) FILTER (WHERE timestamp_updated IS NULL) FROM reviews
UNION ALL SELECT 'created_at_iso', count(*) FROM reviews"""

ORACLES["schema_conform"] = _with(PAGES) + """
SELECT page_key, run_id, app_id, page_number, CAST(NULL AS VARCHAR) AS request_url, CAST(NULL AS VARCHAR) AS cursor,
    CAST(NULL AS VARCHAR) AS next_cursor, status, CAST(NULL AS INTEGER) AS status_code, CAST(NULL AS VARCHAR) AS fetched_at,
    CAST(NULL AS VARCHAR) AS raw_json_path, CAST(0 AS BIGINT) AS response_bytes, review_count,
    CAST(NULL AS BIGINT) AS total_reviews, CAST(NULL AS BIGINT) AS total_positive, CAST(NULL AS BIGINT) AS total_negative,
    max_timestamp_updated, CAST(NULL AS BIGINT) AS min_timestamp_updated, CAST(1 AS INTEGER) AS attempt_count,
    CAST(NULL AS VARCHAR) AS error_message, CAST(NULL AS VARCHAR) AS terminal_reason FROM report"""

ORACLES["validation_report"] = _with(REVIEWS, APPS, VERSIONS, STATE, recursive=True) + f"""
SELECT 'counts' AS section, 'apps' AS name, CAST(NULL AS VARCHAR) AS label, count(*) AS value FROM apps
UNION ALL SELECT 'counts', 'review_pages', NULL, count(*) FROM report
UNION ALL SELECT 'counts', 'reviews', NULL, count(*) FROM reviews
UNION ALL SELECT 'counts', 'review_changes', NULL, count(*) FROM changes
UNION ALL SELECT 'counts', 'sync_states', NULL, count(*) FROM state
UNION ALL SELECT 'quality', 'missing_review_text', NULL, count(*) FROM reviews WHERE review IS NULL OR review = ''
UNION ALL SELECT 'quality', 'missing_language', NULL, count(*) FROM reviews WHERE language IS NULL
UNION ALL SELECT 'quality', 'duplicate_recommendationids', NULL, count(*) - count(DISTINCT recommendationid) FROM reviews
UNION ALL SELECT 'recommendation_distribution', {_FLAG}, NULL, count(*) FROM reviews GROUP BY voted_up
UNION ALL SELECT 'app_review_counts', r.app_id, a.app_name, count(*) FROM reviews r LEFT JOIN apps a ON a.app_id = r.app_id
    GROUP BY r.app_id, a.app_name
UNION ALL SELECT 'page_status_counts', status, NULL, count(*) FROM report GROUP BY status
UNION ALL SELECT 'change_counts', change_type, NULL, count(*) FROM changes GROUP BY change_type
UNION ALL SELECT 'sync_state', 'state_count', NULL, count(*) FROM state
UNION ALL SELECT 'sync_state', 'backlogged_count', NULL, count(*) FROM state WHERE backlogged
UNION ALL SELECT 'sync_state', 'complete_count', NULL, count(*) FROM state WHERE NOT backlogged"""

# Pages came in two loads, those of odd events last.
ORACLES["validation_report_incremental"] = _with(VERSIONS, STATE, recursive=True) + """,
page AS (SELECT * FROM report
    QUALIFY row_number() OVER (PARTITION BY run_id, app_id, page_number ORDER BY event_id % 2 DESC, event_id DESC) = 1)
SELECT 'counts' AS section, 'apps' AS name, CAST(NULL AS VARCHAR) AS label, count(DISTINCT app_id) AS value FROM report
UNION ALL SELECT 'counts', 'review_pages', NULL, count(*) FROM page
UNION ALL SELECT 'counts', 'reviews', NULL, count(*) FROM current_reviews
UNION ALL SELECT 'counts', 'review_changes', NULL, count(*) FROM changes
UNION ALL SELECT 'counts', 'sync_states', NULL, count(*) FROM state
UNION ALL SELECT 'quality', 'missing_review_text', NULL, count(*) FROM current_reviews WHERE review IS NULL OR review = ''
UNION ALL SELECT 'quality', 'missing_language', NULL, count(*) FROM current_reviews
UNION ALL SELECT 'quality', 'duplicate_recommendationids', NULL, 0
UNION ALL SELECT 'recommendation_distribution', 'not_recommended', NULL, count(*) FROM current_reviews HAVING count(*) > 0
UNION ALL SELECT 'app_review_counts', app_id, 'App ' || app_id, count(*) FROM current_reviews GROUP BY app_id
UNION ALL SELECT 'page_status_counts', status, NULL, count(*) FROM page GROUP BY status
UNION ALL SELECT 'change_counts', change_type, NULL, count(*) FROM changes GROUP BY change_type
UNION ALL SELECT 'sync_state', 'state_count', NULL, count(*) FROM state
UNION ALL SELECT 'sync_state', 'backlogged_count', NULL, count(*) FROM state WHERE backlogged
UNION ALL SELECT 'sync_state', 'complete_count', NULL, count(*) FROM state WHERE NOT backlogged"""

ORACLES["page_status_counts"] = _with(PAGES) + "SELECT status, count(*) AS page_count FROM report GROUP BY status"

ORACLES["fetch_summary"] = _with(PAGES) + f"SELECT {_FETCH} FROM report"

ORACLES["terminal_reasons"] = _with(PAGES) + """
SELECT terminal_reason, count(*) AS page_count FROM report WHERE terminal_reason IS NOT NULL GROUP BY terminal_reason"""

ORACLES["capped_apps"] = "SELECT DISTINCT CAST(user_id AS VARCHAR) AS app_id FROM events WHERE event_type = 'view'"

ORACLES["unique_apps"] = "SELECT DISTINCT CAST(user_id AS VARCHAR) AS app_id FROM events"

ORACLES["app_extremes"] = _with(PAGES, STATE, PROGRESS) + """
SELECT run_id, app_id, max_seen, min_seen, page_count, review_count FROM progress"""

ORACLES["last_terminal"] = _with(PAGES, STATE, PROGRESS) + """
SELECT run_id, app_id, terminal_reason, complete FROM judged_progress"""

ORACLES["page_filter"] = _with(PAGES) + """
SELECT event_id, run_id, app_id, status, raw_json_path FROM report WHERE event_type <> 'error'"""

ORACLES["page_status"] = _with(PAGES) + """,
raw AS (SELECT *, CASE WHEN k % 7 > 1 AND status_code = 200 THEN 'fetched' ELSE 'fetch_error' END AS raw_status FROM report)
SELECT event_id, raw_status, CASE WHEN raw_status = 'fetched' AND review_count = 0 THEN 'empty' ELSE raw_status END AS status,
    status_code <> 200 AS retryable FROM raw"""

ORACLES["terminal_reason"] = _with(PAGES, CHAIN) + f"""
SELECT event_id, {_REASON.format(mark='1704900000')} AS terminal_reason FROM chained"""

ORACLES["page_caught_up"] = _with(PAGES, STATE) + """,
marked AS (SELECT r.*, coalesce(s.complete_through_timestamp_updated, 0) AS high_water
    FROM report r LEFT JOIN state s ON s.app_id = r.app_id)
SELECT event_id, app_id, high_water,
    high_water > 0 AND review_count > 0 AND coalesce(max_timestamp_updated, 0) <= high_water AS caught_up FROM marked"""

ORACLES["page_extremes"] = _with(PAYLOAD) + """
SELECT run_id, app_id, page_number,
    CASE WHEN page_number % 4 = 3 OR page_number % 10 = 9 THEN 'fetch_error' ELSE 'fetched' END AS raw_status,
    'c' || CAST(page_number AS VARCHAR) AS next_cursor, CAST(count(*) AS INTEGER) AS review_count,
    4294967295 AS total_reviews, max(1600000000 + doc_id * 37) FILTER (WHERE doc_id % 11 <> 0) AS max_timestamp_updated,
    min(1600000000 + doc_id * 37) FILTER (WHERE doc_id % 11 <> 0) AS min_timestamp_updated
FROM placed GROUP BY run_id, app_id, page_number"""

ORACLES["cursor_chain"] = _with(PAGES, CHAIN) + "SELECT event_id, run_id, app_id, cursor, next_cursor FROM chained"

ORACLES["cursor_chain_skewed"] = _with(PAGES) + """,
skewed AS (SELECT event_id, page_number, next_cursor, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE run_id END AS run_id,
    CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE app_id END AS app_id FROM report)
SELECT event_id, run_id, app_id, next_cursor,
    CASE WHEN row_number() OVER w = 1 THEN '*' ELSE coalesce(lag(next_cursor) OVER w, '') END AS cursor
FROM skewed WINDOW w AS (PARTITION BY run_id, app_id ORDER BY page_number, event_id)"""

ORACLES["delta_stop"] = _with(PAGES, STATE, CHAIN) + f""",
marked AS (SELECT c.*, coalesce(s.complete_through_timestamp_updated, 0) AS high_water
    FROM chained c LEFT JOIN state s ON s.app_id = c.app_id),
ended AS (SELECT event_id, run_id, app_id, page_number, raw_status, review_count, {_REASON.format(mark='high_water')} AS reason FROM marked)
SELECT event_id, run_id, app_id, page_number, reason AS terminal_reason,
    CASE WHEN raw_status = 'fetched' AND review_count = 0 THEN 'empty' ELSE raw_status END AS status
FROM ended e WHERE NOT EXISTS (SELECT 1 FROM ended x WHERE x.run_id = e.run_id AND x.app_id = e.app_id
    AND x.reason IS NOT NULL AND x.page_number < e.page_number)"""

ORACLES["page_key"] = _with(PAGES) + """
SELECT event_id, page_key, run_id || ':' || app_id || ':'
    || CASE WHEN event_id * 7 < 10000 THEN lpad(CAST(event_id * 7 AS VARCHAR), 4, '0') ELSE CAST(event_id * 7 AS VARCHAR) END
    AS long_page_key FROM report"""

ORACLES["upsert_reviews"] = _with(VERSIONS, recursive=True) + _VERSION_COLUMNS
ORACLES["upsert_reviews_two_loads"] = ORACLES["upsert_reviews"]
ORACLES["stream_upsert"] = ORACLES["upsert_reviews"]
ORACLES["upsert_reviews_skewed"] = _with(SKEWED, recursive=True) + _VERSION_COLUMNS

ORACLES["upsert_outcomes"] = _with(VERSIONS, recursive=True) + """
SELECT run_id, outcome, count(*) AS rows FROM judged GROUP BY run_id, outcome"""

ORACLES["review_changes"] = _with(VERSIONS, recursive=True) + "SELECT * FROM changes"
ORACLES["review_changes_skewed"] = _with(SKEWED, recursive=True) + "SELECT * FROM changes"

ORACLES["change_counts"] = _with(VERSIONS, recursive=True) + """
SELECT change_type, count(*) AS change_count FROM changes GROUP BY change_type"""

ORACLES["upsert_pages"] = _with(PAGES) + f""",
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY run_id, app_id, page_number ORDER BY event_type = 'purchase', event_id DESC) AS rank,
        bool_or(event_type = 'purchase') OVER (PARTITION BY run_id, app_id, page_number) AS was_stored FROM report
)
SELECT {_PAGE_COLUMNS} FROM (SELECT * REPLACE (CASE WHEN was_stored THEN 'old:' ELSE '' END || page_key AS page_key),
    CASE WHEN event_type = 'error' THEN 'failed again' END AS error_message FROM ranked WHERE rank = 1)"""

ORACLES["upsert_apps"] = _with(PAGES, TARGETS) + """,
first_page AS (SELECT run_id, app_id, app_name FROM report
    QUALIFY row_number() OVER (PARTITION BY run_id, app_id ORDER BY event_id) = 1),
named AS (
    SELECT f.run_id, f.app_id, coalesce(t.app_name, f.app_name) AS app_name, coalesce(t.active, true) AS active, t.notes
    FROM first_page f LEFT JOIN checked t ON t.app_id = f.app_id AND t.reject_reason IS NULL
),
seen AS (
    SELECT app_id, arg_max(app_name, run_id) FILTER (WHERE app_name IS NOT NULL) AS app_name, bool_or(active) AS active,
        max(notes) AS notes, min(run_id) AS first_seen_run_id, max(run_id) AS last_seen_run_id
    FROM named GROUP BY app_id
),
stored AS (
    SELECT CAST(c_custkey AS VARCHAR) AS app_id, 'Old ' || c_name AS app_name FROM customer
)
SELECT coalesce(n.app_id, o.app_id) AS app_id, coalesce(n.app_name, o.app_name) AS app_name, coalesce(n.active, false) AS active,
    coalesce(n.notes, CASE WHEN o.app_id IS NOT NULL THEN 'old note' END) AS notes,
    CASE WHEN o.app_id IS NOT NULL THEN '20230101' ELSE n.first_seen_run_id END AS first_seen_run_id,
    coalesce(n.last_seen_run_id, '20230102') AS last_seen_run_id
FROM seen n FULL OUTER JOIN stored o ON o.app_id = n.app_id"""

_RUN_REST = """CAST(0 AS BIGINT) AS app_count, CAST(NULL AS VARCHAR) AS targets_path, CAST(0 AS BIGINT) AS reviews_inserted,
    CAST(0 AS BIGINT) AS reviews_updated, CAST(0 AS BIGINT) AS duplicates_skipped"""

ORACLES["upsert_runs"] = _with(REVIEWS, PAGES) + f"""
SELECT run_id, CAST(NULL AS VARCHAR) AS raw_dir, 'first' AS loaded_at, CAST(0 AS BIGINT) AS page_count, count(*) AS review_count,
    CAST(0 AS BIGINT) AS fetch_errors, CAST(0 AS BIGINT) AS rate_limited_pages, {_RUN_REST} FROM reviews GROUP BY run_id
UNION ALL
SELECT run_id, '/landed', 'second', count(*), CAST(sum(review_count) AS BIGINT),
    count(*) FILTER (WHERE status = 'fetch_error'), count(*) FILTER (WHERE status_code = 429), {_RUN_REST}
FROM report GROUP BY run_id"""

ORACLES["snapshot_import"] = _with(PAGES) + f""",
worded AS (SELECT *, CASE WHEN event_type = 'error' THEN '  failed ' || chr(9) || ' again ' END AS error_message FROM report),
stored AS (SELECT {_PAGE_COLUMNS}
    FROM (SELECT * REPLACE (CASE WHEN k % 2 = 0 THEN 'old:' || page_key ELSE page_key END AS page_key) FROM worded)
    QUALIFY row_number() OVER (PARTITION BY page_key ORDER BY event_id DESC) = 1),
snap AS (SELECT {_PAGE_COLUMNS} FROM (SELECT * REPLACE ('imported' AS status) FROM worded)
    QUALIFY row_number() OVER (PARTITION BY page_key ORDER BY event_id DESC) = 1)
SELECT s.* REPLACE (o.max_timestamp_updated AS max_timestamp_updated, o.min_timestamp_updated AS min_timestamp_updated)
FROM snap s LEFT JOIN stored o ON o.page_key = s.page_key
UNION ALL
SELECT o.* FROM stored o WHERE o.page_key NOT IN (SELECT page_key FROM snap)"""

ORACLES["load_summary"] = _with(VERSIONS, recursive=True) + """,
merged AS (SELECT run_id, count(*) FILTER (WHERE outcome = 'inserted') AS reviews_inserted,
    count(*) FILTER (WHERE outcome = 'updated') AS reviews_updated,
    count(*) FILTER (WHERE outcome = 'unchanged') AS duplicates_skipped FROM judged GROUP BY run_id)
SELECT r.run_id, count(DISTINCT r.app_id) AS apps_upserted, count(*) AS pages_upserted, count(*) AS reviews_seen,
    any_value(m.reviews_inserted) AS reviews_inserted, any_value(m.reviews_updated) AS reviews_updated,
    any_value(m.duplicates_skipped) AS duplicates_skipped
FROM report r JOIN merged m ON m.run_id = r.run_id GROUP BY r.run_id"""

ORACLES["high_water_marks"] = _with(STATE) + """
SELECT u.app_id, coalesce(s.complete_through_timestamp_updated, 0) AS high_water
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS app_id FROM events) u LEFT JOIN state s ON s.app_id = u.app_id"""

ORACLES["sync_states"] = _with(STATE) + """
SELECT u.app_id, coalesce(s.complete_through_timestamp_updated, 0) AS complete_through_timestamp_updated,
    coalesce(s.backlogged, true) AS backlogged, s.last_run_id, s.last_successful_run_id, s.last_terminal_reason,
    s.last_seen_max_timestamp_updated, s.last_seen_min_timestamp_updated, coalesce(s.last_page_count, 0) AS last_page_count,
    coalesce(s.last_review_count, 0) AS last_review_count
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS app_id FROM events) u LEFT JOIN state s ON s.app_id = u.app_id"""

ORACLES["sync_state_advance"] = _with(PAGES, STATE, PROGRESS) + "SELECT * FROM advanced"
ORACLES["sync_state_history"] = _with(PAGES, STATE, PROGRESS) + "SELECT * FROM history"

ORACLES["sync_state_summary"] = _with(STATE) + """
SELECT count(*) AS state_count, count(*) FILTER (WHERE backlogged) AS backlogged_count,
    count(*) FILTER (WHERE NOT backlogged) AS complete_count FROM state"""

ORACLES["sync_state_list"] = _with(STATE) + """
SELECT app_id, coalesce(complete_through_timestamp_updated, 0) AS complete_through_timestamp_updated, backlogged,
    last_terminal_reason, last_run_id, last_successful_run_id, last_seen_max_timestamp_updated, last_page_count,
    CAST(0 AS BIGINT) AS last_review_count FROM state ORDER BY backlogged DESC, app_id"""

ORACLES["sync_update_summary"] = _with(PAGES, STATE, PROGRESS) + """
SELECT 'states_updated' AS section, CAST(NULL AS VARCHAR) AS name, count(*) AS value FROM updated
UNION ALL SELECT 'terminal_reasons', last_terminal_reason, count(*) FROM updated GROUP BY last_terminal_reason
UNION ALL SELECT CASE WHEN backlogged THEN 'backlogged_apps' ELSE 'complete_apps' END, app_id, 0 FROM updated
UNION ALL SELECT 'watermarks', app_id, complete_through_timestamp_updated FROM updated"""

ORACLES["backlogged_apps"] = _with(PAGES, STATE, PROGRESS) + """
SELECT app_id, last_terminal_reason FROM advanced WHERE backlogged"""

ORACLES["targets_validate"] = _with(TARGETS) + """
SELECT app_id, app_name, active, notes, row_number, reject_reason FROM checked"""

ORACLES["targets_active"] = _with(TARGETS) + """
SELECT app_id, app_name, notes FROM checked WHERE reject_reason IS NULL AND active"""

ORACLES["parse_bool"] = _with(TARGETS) + """
SELECT row_number, active AS parsed, CASE WHEN word IS NULL THEN false ELSE active END AS or_false FROM checked"""

ORACLES["payload_parse"] = _with(PAYLOAD) + """
SELECT run_id, app_id, page_number, pos, ' ' || CAST(doc_id AS VARCHAR) AS recommendationid,
    chr(9) || ' ' || text || ' ' || chr(13) || chr(10) || 'end' || chr(13) || chr(10) || ' ' AS review,
    CASE WHEN doc_id % 11 = 0 THEN 'soon' ELSE CAST(1600000000 + doc_id * 37 AS VARCHAR) END AS timestamp_updated FROM placed"""

ORACLES["sanitize_payload"] = """
SELECT 'BIGINT' AS type_of_total, 'reply to ' || CAST(doc_id AS VARCHAR) AS developer_response, ' ' || CAST(doc_id AS VARCHAR) AS recommendationid,
    CASE WHEN doc_id % 4 = 0 THEN 'last_played,playtime_at_review,playtime_forever'
        ELSE 'last_played,playtime_at_review,playtime_forever,playtime_last_two_weeks' END AS author_fields,
    chr(9) || ' ' || text || ' ' || chr(13) || chr(10) || 'end' || chr(13) || chr(10) || ' ' AS review FROM documents"""

ORACLES["normalize_reviews"] = _with(PAYLOAD) + r"""
SELECT CAST(doc_id AS VARCHAR) AS recommendationid, run_id, app_id, lang AS language,
    regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '^\s+', '') || ' ' || chr(10) || 'end' AS review,
    doc_id % 2 = 0 AS voted_up, 1500000000 + doc_id AS timestamp_created,
    CASE WHEN doc_id % 11 = 0 THEN NULL ELSE 1600000000 + doc_id * 37 END AS timestamp_updated,
    strftime(make_timestamp((1500000000 + doc_id) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS created_at_iso,
    CASE WHEN doc_id % 11 = 0 THEN NULL
        ELSE strftime(make_timestamp((1600000000 + doc_id * 37) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS updated_at_iso,
    n_chars AS votes_up, CAST(0 AS BIGINT) AS votes_funny, CAST('0.' || CAST(doc_id AS VARCHAR) AS DOUBLE) AS weighted_vote_score,
    CAST(0 AS BIGINT) AS comment_count, doc_id % 3 = 0 AS steam_purchase, false AS received_for_free,
    false AS written_during_early_access, false AS primarily_steam_deck, doc_id * 3 AS playtime_forever,
    CASE WHEN doc_id % 4 = 0 THEN NULL ELSE doc_id % 60 END AS playtime_last_two_weeks, doc_id * 2 AS playtime_at_review,
    1700000000 + doc_id AS last_played, '2026-06-15T00:00:00+00:00' AS collected_at,
    run_id || ':' || app_id || ':' || lpad(CAST(page_number AS VARCHAR), 4, '0') AS source_page_key
FROM placed"""

ORACLES["raw_path_join"] = _with(PAYLOAD) + """
SELECT DISTINCT run_id, app_id, page_number,
    'app_' || app_id || '_page_' || lpad(CAST(page_number AS VARCHAR), 4, '0') || '.json' AS file_name, true AS found
FROM placed WHERE page_number % 3 <> 0"""

ORACLES["landed_page_reports"] = _with(PAYLOAD) + """,
landed AS (SELECT run_id, app_id, page_number, CAST(count(*) AS INTEGER) AS review_count, page_number % 4 = 3 AS unsuccessful,
    page_number % 10 = 9 AS limited FROM placed GROUP BY run_id, app_id, page_number),
chained AS (SELECT *, coalesce('c' || CAST(lag(page_number) OVER (PARTITION BY run_id, app_id ORDER BY page_number) AS VARCHAR), '*')
    AS cursor FROM landed)
SELECT run_id, app_id, page_number, review_count, cursor, 'c' || CAST(page_number AS VARCHAR) AS next_cursor,
    CASE WHEN unsuccessful OR limited THEN 'fetch_error' ELSE 'fetched' END AS status,
    CASE WHEN unsuccessful OR limited THEN 'fetch_error' END AS terminal_reason, limited AS retryable,
    CASE WHEN limited THEN 'HTTP 429' WHEN unsuccessful THEN 'page did not report success' END AS error_message,
    'https://reviews.example.org/list/' || app_id || '?json=1&filter=updated&language=english&purchase_type=all'
        || '&review_type=all&num_per_page=100&cursor=' || replace(cursor, '*', '%2A') AS request_url
FROM chained c WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.run_id = c.run_id AND l.app_id = c.app_id
    AND (l.unsuccessful OR l.limited) AND l.page_number < c.page_number)"""

ORACLES["response_bytes"] = "SELECT page_id, CAST(strlen(html) AS BIGINT) AS response_bytes FROM pages"

ORACLES["clean_text"] = r"""
SELECT doc_id, CASE WHEN doc_id % 20 = 0 THEN NULL ELSE nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '') END AS cleaned
FROM documents"""

ORACLES["clean_review_text"] = r"""
SELECT doc_id, CASE WHEN doc_id % 20 = 0 THEN '' ELSE regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '^\s+', '')
    || chr(10) || 'last' || chr(10) || chr(10) || ' line' END AS cleaned FROM documents"""

ORACLES["timestamp_iso"] = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE
    strftime(make_timestamp(((l_orderkey - 2000) * 123457 + l_linenumber) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS iso
FROM lineitem"""

ORACLES["lenient_casts"] = _with(PAGES) + """,
written AS (SELECT event_id, k, value FROM report)
SELECT event_id, CASE k % 6 WHEN 0 THEN k WHEN 4 THEN -k END AS int_or_none,
    CASE k % 6 WHEN 0 THEN k WHEN 4 THEN -k ELSE 0 END AS int_or_zero,
    CASE k % 6 WHEN 0 THEN CAST(k AS DOUBLE) WHEN 1 THEN value WHEN 4 THEN -CAST(k AS DOUBLE) END AS float_or_none FROM written"""

ORACLES["mask_url"] = """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN replace(url, '://', '://user:***@')
    WHEN 2 THEN replace(url, '://', '://***@') ELSE replace(url, '://', '@') END AS masked FROM pages"""

ORACLES["request_url"] = """
SELECT page_id, 'https://reviews.example.org/list/' || CAST(page_id AS VARCHAR)
    || '?json=1&filter=updated&language=english&purchase_type=all&review_type=all&num_per_page=100&cursor='
    || replace(url_encode(url), '%20', '+') AS request_url FROM pages"""

ORACLES["stream_load_tables"] = _with(PAYLOAD) + """,
landed AS (SELECT run_id, app_id, page_number, page_number % 4 = 3 OR page_number % 10 = 9 AS failed
    FROM placed GROUP BY run_id, app_id, page_number),
kept AS (SELECT * FROM landed c WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.run_id = c.run_id AND l.app_id = c.app_id
    AND l.failed AND l.page_number < c.page_number)),
good AS (SELECT p.doc_id FROM placed p JOIN kept k ON k.run_id = p.run_id AND k.app_id = p.app_id AND k.page_number = p.page_number
    WHERE NOT k.failed)
SELECT 'runs' AS what, count(DISTINCT run_id) AS rows_stored FROM kept
UNION ALL SELECT 'apps', count(DISTINCT app_id) FROM kept
UNION ALL SELECT 'pages', count(*) FROM kept
UNION ALL SELECT 'reviews', count(*) FROM good
UNION ALL SELECT 'review_changes', count(*) FROM good
UNION ALL SELECT 'pages without run_id', 0
UNION ALL SELECT 'pages without app_id', 0
UNION ALL SELECT 'reviews without run_id', 0
UNION ALL SELECT 'reviews without app_id', 0"""

# The reports of landed pages without the column that is not stored.
ORACLES["stream_pages_split"] = (
    "SELECT * EXCLUDE (retryable, review_count), CAST(review_count AS BIGINT) AS review_count FROM ("
    + ORACLES["landed_page_reports"] + ")"
)

# Pages of marked apps end where they catch up; 1600016650 is the mark that the stream starts from.
_STREAMED = PAYLOAD + """,
landed AS (
    SELECT run_id, app_id, page_number, page_number % 4 = 3 OR page_number % 10 = 9 AS failed, page_number % 10 = 9 AS limited,
        count(*) AS reviews, max(1600000000 + doc_id * 37) FILTER (WHERE doc_id % 11 <> 0) AS newest,
        min(1600000000 + doc_id * 37) FILTER (WHERE doc_id % 11 <> 0) AS oldest
    FROM placed GROUP BY run_id, app_id, page_number
),
judged AS (
    SELECT *, CASE WHEN failed THEN 'fetch_error'
        WHEN app_id LIKE '%1' AND coalesce(newest, 0) <= 1600016650 THEN 'caught_up_to_existing_reviews' END AS reason
    FROM landed
),
kept AS (
    SELECT * FROM judged j WHERE NOT EXISTS (SELECT 1 FROM judged l WHERE l.run_id = j.run_id AND l.app_id = j.app_id
        AND l.reason IS NOT NULL AND l.page_number < j.page_number)
)"""

ORACLES["stream_sync_state"] = _with(_STREAMED) + """,
progress AS (
    SELECT run_id, app_id, max(newest) AS newest, min(oldest) AS oldest, count(*) AS page_count, sum(reviews) AS reviews,
        coalesce(max(reason), 'unknown') AS reason
    FROM kept GROUP BY run_id, app_id
),
latest AS (SELECT * FROM progress QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY run_id DESC) = 1),
complete AS (
    SELECT app_id, max(newest) AS mark, max(run_id) AS run_id FROM progress
    WHERE reason = 'caught_up_to_existing_reviews' GROUP BY app_id
)
SELECT app_id, greatest(coalesce(c.mark, 0), CASE WHEN app_id LIKE '%1' THEN 1600016650 ELSE 0 END) AS complete_through_timestamp_updated,
    reason <> 'caught_up_to_existing_reviews' AS backlogged, l.run_id AS last_run_id, c.run_id AS last_successful_run_id,
    reason AS last_terminal_reason, newest AS last_seen_max_timestamp_updated, oldest AS last_seen_min_timestamp_updated,
    CAST(page_count AS BIGINT) AS last_page_count, CAST(reviews AS BIGINT) AS last_review_count
FROM latest l LEFT JOIN complete c USING (app_id)"""

ORACLES["stream_run_counters"] = _with(_STREAMED) + """
SELECT run_id, count(DISTINCT app_id) AS app_count, count(*) AS page_count,
    CAST(coalesce(sum(reviews) FILTER (WHERE NOT failed), 0) AS BIGINT) AS review_count,
    CAST(coalesce(sum(reviews) FILTER (WHERE NOT failed), 0) AS BIGINT) AS reviews_inserted, 0::BIGINT AS reviews_updated,
    0::BIGINT AS duplicates_skipped, count(*) FILTER (WHERE failed) AS fetch_errors, count(*) FILTER (WHERE limited) AS rate_limited_pages
FROM kept GROUP BY run_id"""

ORACLES["snapshot_import_repeated"] = ORACLES["snapshot_import"]

ORACLES["load_quarantine"] = _with(PAGES) + """,
faulty AS (
    SELECT event_id, run_id, CASE WHEN k % 13 = 0 THEN ' ' WHEN k % 17 <> 0 THEN app_id END AS app_id,
        CASE WHEN k % 19 <> 0 THEN page_number END AS page_number, CASE WHEN k % 23 <> 0 THEN status END AS status
    FROM report
)
SELECT *, concat_ws(', ', CASE WHEN coalesce(trim(app_id), '') = '' THEN 'app_id' END, CASE WHEN page_number IS NULL THEN 'page_number' END,
    CASE WHEN status IS NULL THEN 'status' END) AS missing
FROM faulty WHERE coalesce(trim(app_id), '') = '' OR page_number IS NULL OR status IS NULL"""

ORACLES["daily_cut"] = _with(PAGES, STATE) + """,
judged AS (
    SELECT r.*, r.status = 'fetched' AND s.complete_through_timestamp_updated > 0 AND r.review_count > 0
        AND coalesce(r.max_timestamp_updated, 0) <= s.complete_through_timestamp_updated AS reached
    FROM report r LEFT JOIN state s USING (app_id)
),
ends AS (SELECT run_id, app_id, min(page_number) AS page_number FROM judged WHERE reached GROUP BY run_id, app_id)
SELECT event_id, run_id, app_id, j.page_number, CASE WHEN reached THEN 'caught_up_to_existing_reviews' ELSE terminal_reason END AS terminal_reason
FROM judged j LEFT JOIN ends e USING (run_id, app_id) WHERE e.page_number IS NULL OR j.page_number <= e.page_number"""

# What is read back from a file, with the number of rows that the writer counted.
ORACLES["export_jsonl_file"] = f"SELECT *, count(*) OVER () AS review_count FROM ({ORACLES['export_reviews']})"
ORACLES["export_csv_file"] = (
    f"SELECT * REPLACE (nullif(review, '') AS review), count(*) OVER () AS review_count FROM ({ORACLES['export_reviews']})"
)

ORACLES["page_reports_file"] = _with(PAGES) + """
SELECT 'run-all' AS run_id, app_id, app_name, page_number, CAST(NULL AS VARCHAR) AS request_url, CAST(NULL AS VARCHAR) AS cursor,
    next_cursor, status, status_code, fetched_at, raw_json_path, response_bytes, review_count, total_reviews,
    CAST(NULL AS BIGINT) AS total_positive, CAST(NULL AS BIGINT) AS total_negative, max_timestamp_updated, min_timestamp_updated,
    attempt_count, CASE WHEN event_type = 'error' THEN '  failed ' || chr(9) || ' again ' END AS error_message, terminal_reason
FROM report"""

ORACLES["sync_state_skipped"] = _with(STATE) + """
SELECT app_id, coalesce(complete_through_timestamp_updated, 0) AS complete_through_timestamp_updated, backlogged,
    'filter=all is not chronological' AS skipped_reason FROM state"""
