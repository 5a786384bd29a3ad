"""Table contracts: columns, types, keys, defaults. Nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _table(text: str) -> T.StructType:
    pairs = (column.split() for column in text.replace("\n", " ").split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The column names and types below are the data contract of the landed pages and the stored tables.
TARGETS = _table("app_id string, app_name string, active string, notes string")

PAGE_REPORT = _table("""
    run_id string, app_id string, app_name string, page_number int, request_url string, cursor string,
    next_cursor string, status string, status_code int, fetched_at string, raw_json_path string,
    response_bytes bigint, review_count bigint, total_reviews bigint, total_positive bigint, total_negative bigint,
    max_timestamp_updated bigint, min_timestamp_updated bigint, attempt_count int, error_message string,
    terminal_reason string
""")

RUNS = _table("""
    run_id string, raw_dir string, targets_path string, loaded_at string, app_count bigint, page_count bigint,
    review_count bigint, reviews_inserted bigint, reviews_updated bigint, duplicates_skipped bigint,
    fetch_errors bigint, rate_limited_pages bigint
""")

APPS = _table("""
    app_id string, app_name string, active boolean, notes string, first_seen_run_id string, last_seen_run_id string
""")

PAGES = _table("""
    page_key string, run_id string, app_id string, page_number int, request_url string, cursor string,
    next_cursor string, status string, status_code int, fetched_at string, raw_json_path string,
    response_bytes bigint, review_count bigint, total_reviews bigint, total_positive bigint, total_negative bigint,
    max_timestamp_updated bigint, min_timestamp_updated bigint, attempt_count int, error_message string,
    terminal_reason string
""")

REVIEWS = _table("""
    recommendationid string, run_id string, app_id string, language string, review string, voted_up boolean,
    timestamp_created bigint, timestamp_updated bigint, created_at_iso string, updated_at_iso string,
    votes_up bigint, votes_funny bigint, weighted_vote_score double, comment_count bigint, steam_purchase boolean,
    received_for_free boolean, written_during_early_access boolean, primarily_steam_deck boolean,
    playtime_forever bigint, playtime_last_two_weeks bigint, playtime_at_review bigint, last_played bigint,
    collected_at string, source_page_key string
""")

REVIEW_CHANGES = _table("""
    run_id string, recommendationid string, app_id string, change_type string, previous_timestamp_updated bigint,
    new_timestamp_updated bigint, source_page_key string, changed_at string
""")

SYNC_STATE = _table("""
    app_id string, complete_through_timestamp_updated bigint, backlogged boolean, last_started_at string,
    last_completed_at string, last_run_id string, last_successful_run_id string, last_terminal_reason string,
    last_seen_max_timestamp_updated bigint, last_seen_min_timestamp_updated bigint, last_page_count bigint,
    last_review_count bigint, updated_at string
""")

# What a stream carries from load to load: how far each app's pages have come in a run, and pages that came before their turn.
PAGE_CHAINS = _table("""
    run_id string, app_id string, last_page int, next_cursor string, end_page int, terminal_reason string,
    max_seen bigint, min_seen bigint, page_count bigint, review_count bigint
""")

WAITING_PAGES = _table("""
    run_id string, app_id string, page_number int, file_name string, app_name string, status_code int, attempt_count int,
    fetched_at string, raw_json_path string, document string
""")

# Counts that the validation report is made of, by kind, run, app and label; `figure` names them in one column.
FIGURES = _table("""
    figure string, kind string, run_id string, app_id string, label string, n bigint, no_text bigint, no_language bigint
""")

TABLES = {
    "runs": RUNS,
    "apps": APPS,
    "pages": PAGES,
    "reviews": REVIEWS,
    "review_changes": REVIEW_CHANGES,
    "sync_state": SYNC_STATE,
    "page_chains": PAGE_CHAINS,
    "waiting_pages": WAITING_PAGES,
    "figures": FIGURES,
}

KEYS = {
    "runs": ["run_id"],
    "apps": ["app_id"],
    "pages": ["run_id", "app_id", "page_number"],
    "reviews": ["recommendationid"],
    "review_changes": ["run_id", "recommendationid"],
    "sync_state": ["app_id"],
    "page_chains": ["run_id", "app_id"],
    "waiting_pages": ["run_id", "app_id", "page_number"],
    "figures": ["figure"],
}

NOT_NULL = {
    "runs": ["run_id", "raw_dir", "loaded_at"],
    "apps": ["app_id"],
    "pages": ["page_key", "run_id", "app_id", "page_number", "status"],
    "reviews": ["recommendationid", "run_id", "app_id"],
    "review_changes": ["run_id", "recommendationid", "app_id", "change_type"],
    "sync_state": ["app_id"],
    "page_chains": [],
    "waiting_pages": [],
    "figures": [],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("pages", "run_id", "runs", "run_id"),
    ("pages", "app_id", "apps", "app_id"),
    ("reviews", "run_id", "runs", "run_id"),
    ("reviews", "app_id", "apps", "app_id"),
    ("reviews", "source_page_key", "pages", "page_key"),
    ("review_changes", "run_id", "runs", "run_id"),
    ("review_changes", "recommendationid", "reviews", "recommendationid"),
    ("review_changes", "app_id", "apps", "app_id"),
    ("review_changes", "source_page_key", "pages", "page_key"),
    ("sync_state", "app_id", "apps", "app_id"),
]

ENUMS = {("review_changes", "change_type"): ["inserted", "updated"]}

DEFAULTS = {
    "runs": {
        "app_count": 0, "page_count": 0, "review_count": 0, "reviews_inserted": 0, "reviews_updated": 0,
        "duplicates_skipped": 0, "fetch_errors": 0, "rate_limited_pages": 0,
    },
    "apps": {"active": True},
    "pages": {"response_bytes": 0, "review_count": 0, "attempt_count": 1},
    "reviews": {
        "voted_up": False, "votes_up": 0, "votes_funny": 0, "comment_count": 0, "steam_purchase": False,
        "received_for_free": False, "written_during_early_access": False, "primarily_steam_deck": False,
    },
    "review_changes": {},
    "sync_state": {
        "complete_through_timestamp_updated": 0, "backlogged": True, "last_page_count": 0, "last_review_count": 0,
    },
    "page_chains": {"page_count": 0, "review_count": 0},
    "waiting_pages": {},
    "figures": {},
}

# Column subsets of the older store, used by the snapshot import; the first column is the conflict key.
IMPORT_COLUMNS = {
    "runs": ["run_id", "raw_dir", "targets_path", "loaded_at", "app_count", "page_count", "review_count"],
    "apps": APPS.names,
    "pages": [c for c in PAGES.names if c not in ("max_timestamp_updated", "min_timestamp_updated")],
    "reviews": REVIEWS.names,
}

# Export order: the review columns with the app name after the app id.
EXPORT_COLUMNS = [*REVIEWS.names[:3], "app_name", *REVIEWS.names[3:]]

# Author fields that may be stored; every other author field is personal and never read.
SAFE_AUTHOR_FIELDS = ["playtime_forever", "playtime_last_two_weeks", "playtime_at_review", "last_played"]

REVIEW_FIELDS = [
    "recommendationid", "language", "review", "timestamp_created", "timestamp_updated", "voted_up", "votes_up",
    "votes_funny", "weighted_vote_score", "comment_count", "steam_purchase", "received_for_free",
    "written_during_early_access", "primarily_steam_deck",
]

# Values arrive as numbers or strings, so every leaf is read as text and cast leniently afterwards.
_TEXT = T.StringType()
AUTHOR = T.StructType([T.StructField(name, _TEXT) for name in SAFE_AUTHOR_FIELDS])
REVIEW_JSON = T.StructType(
    [T.StructField("recommendationid", _TEXT), T.StructField("author", AUTHOR)]
    + [T.StructField(name, _TEXT) for name in REVIEW_FIELDS[1:]]
)
QUERY_SUMMARY = T.StructType([
    T.StructField(name, _TEXT)
    for name in ("num_reviews", "review_score", "review_score_desc", "total_positive", "total_negative", "total_reviews")
])
PAYLOAD = T.StructType([
    T.StructField("success", _TEXT),
    T.StructField("cursor", _TEXT),
    T.StructField("query_summary", QUERY_SUMMARY),
    T.StructField("reviews", T.ArrayType(REVIEW_JSON)),
])

COMPLETE_REASONS = ["caught_up_to_existing_reviews", "empty_page", "missing_next_cursor"]
CHRONOLOGICAL_FILTERS = ["recent", "updated"]
REVIEW_FILTERS = ["all", "recent", "updated"]
RETRYABLE_STATUS_CODES = [429, 500, 502, 503, 504]
MAX_PAGE_SIZE = 100
