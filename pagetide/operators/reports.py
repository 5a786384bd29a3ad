"""Counts, distributions, summaries and the export projection.

Reports come in long form. A list of apps inside one row would gather them all in one task; one row per app does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.functions import clean_text
from pagetide.operators.normalize import conform
from pagetide.operators.quality import duplicate_keys
from pagetide.operators.skew import lookup_join
from pagetide.operators.sync import normalized_state
from pagetide.schemas import COMPLETE_REASONS, EXPORT_COLUMNS, REVIEWS


def run_scope(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows of one run; no run id, or a blank one, means all rows."""
    return df.filter(F.col("run_id") == run_id) if run_id else df


def row_count(df: DataFrame, run_id: str | None = None) -> DataFrame:
    return run_scope(df, run_id).agg(F.count("*").alias("row_count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    union = counts[0]
    for count in counts[1:]:
        union = union.unionByName(count)
    return union


def app_review_counts(reviews: DataFrame, apps: DataFrame, run_id: str | None = None) -> DataFrame:
    """Reviews per app with its name, largest first. Counting before the join leaves one row per app to join."""
    counted = run_scope(reviews, run_id).groupBy("app_id").agg(F.count("*").alias("review_count"))
    return (
        counted.join(apps.select("app_id", "app_name"), "app_id", "left")
        .select("app_id", "app_name", "review_count")
        .orderBy(F.desc("review_count"), "app_id")
    )


def recommendation() -> Column:
    return F.when(F.col("voted_up"), F.lit("recommended")).otherwise(F.lit("not_recommended"))


def recommendation_distribution(reviews: DataFrame, run_id: str | None = None) -> DataFrame:
    return (
        run_scope(reviews, run_id).groupBy(recommendation().alias("recommendation")).agg(F.count("*").alias("review_count"))
        .orderBy(F.desc("recommendation"))
    )


def page_status_counts(pages: DataFrame, run_id: str | None = None) -> DataFrame:
    return run_scope(pages, run_id).groupBy("status").agg(F.count("*").alias("page_count")).orderBy("status")


def change_counts(changes: DataFrame, run_id: str | None = None) -> DataFrame:
    return (
        run_scope(changes, run_id).groupBy("change_type").agg(F.count("*").alias("change_count")).orderBy("change_type")
    )


def _missing_text() -> Column:
    return F.count_if(F.col("review").isNull() | (F.col("review") == ""))


def _missing_language() -> Column:
    return F.count_if(F.col("language").isNull())


def quality_missing(reviews: DataFrame, run_id: str | None = None) -> DataFrame:
    return run_scope(reviews, run_id).agg(
        _missing_text().alias("missing_review_text"), _missing_language().alias("missing_language")
    )


def recent_reviews(reviews: DataFrame, count: int = 25) -> DataFrame:
    """The most recently updated reviews (missing times first, as in the export), ties by id. Spark keeps `count` rows per task and merges those."""
    return (
        reviews.select("app_id", "recommendationid", "updated_at_iso", "voted_up", "review", "timestamp_updated")
        .orderBy(F.desc_nulls_first("timestamp_updated"), "recommendationid")
        .limit(count)
    )


def export_reviews(reviews: DataFrame, apps: DataFrame) -> DataFrame:
    """The 25 export columns, by app, newest first (missing times first), then id.

    The sort is a range partitioning on all three columns, so a large app spreads over many files.
    """
    rows = lookup_join(conform(reviews, REVIEWS), apps.select("app_id", "app_name"), "app_id", "left")
    return rows.select(*EXPORT_COLUMNS).orderBy("app_id", F.desc_nulls_first("timestamp_updated"), "recommendationid")


def fetch_summary(reports: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pages, reviews and pages per condition in one pass, over all reports or per key."""
    return reports.groupBy(*(keys or [])).agg(
        F.count("*").alias("page_count"),
        F.coalesce(F.sum(F.coalesce("review_count", F.lit(0))), F.lit(0)).cast("bigint").alias("review_count"),
        F.count_if(F.col("status") == "fetched").alias("fetched_pages"),
        F.count_if(F.col("status") == "empty").alias("empty_pages"),
        F.count_if(F.col("status") == "fetch_error").alias("fetch_errors"),
        F.count_if(F.col("status_code") == 429).alias("rate_limited_pages"),
    )


def terminal_reasons(reports: DataFrame) -> DataFrame:
    return (
        reports.filter(F.col("terminal_reason").isNotNull() & (F.col("terminal_reason") != ""))
        .groupBy("terminal_reason").agg(F.count("*").alias("page_count")).orderBy("terminal_reason")
    )


def capped_apps(reports: DataFrame) -> DataFrame:
    capped = reports.filter(F.col("terminal_reason") == "page_cap_reached")
    return capped.select("app_id").distinct().orderBy("app_id")


def unique_apps(reports: DataFrame) -> DataFrame:
    cleaned = reports.select(clean_text(F.col("app_id")).alias("app_id"))
    return cleaned.filter(F.col("app_id").isNotNull()).distinct().orderBy("app_id")


def last_terminal(progress: DataFrame) -> DataFrame:
    return progress.select(
        "run_id", "app_id", "terminal_reason", F.col("terminal_reason").isin(COMPLETE_REASONS).alias("complete")
    )


def sync_state_counts(state: DataFrame) -> DataFrame:
    return normalized_state(state).agg(
        F.count("*").alias("state_count"),
        F.count_if("backlogged").alias("backlogged_count"),
        F.count_if(~F.col("backlogged")).alias("complete_count"),
    )


def sync_state_list(state: DataFrame) -> DataFrame:
    return normalized_state(state).select(
        "app_id", "complete_through_timestamp_updated", "backlogged", "last_terminal_reason", "last_run_id",
        "last_successful_run_id", "last_seen_max_timestamp_updated", "last_page_count", "last_review_count",
    ).orderBy(F.desc("backlogged"), "app_id")


def reviews_per_run_with_pages(reviews: DataFrame, pages: DataFrame) -> DataFrame:
    """What an inner join of reviews and pages on the run yields per run, without building its pairs.

    Each side is aggregated to one row per run first: the pairs of a run number reviews times pages, and the maxima over
    the pairs are the maxima over the sides.
    """
    left = reviews.groupBy("run_id").agg(F.count("*").alias("reviews"), F.max("votes_funny").alias("max_votes_funny"))
    right = pages.groupBy("run_id").agg(F.count("*").alias("pages"), F.max("total_reviews").alias("max_total_reviews"))
    return left.join(right, "run_id").select(
        "run_id", (F.col("reviews") * F.col("pages")).alias("joined_rows"), "max_votes_funny", "max_total_reviews"
    )


def _entry(section: str, name: Column | str, value: Column) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    return F.struct(
        F.lit(section).alias("section"), label.cast("string").alias("name"), value.cast("bigint").alias("value")
    )


def _entries(df: DataFrame, *entries: Column) -> DataFrame:
    return df.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


# Figures that are reported as 0, not left out, when there is nothing to count.
ALWAYS_REPORTED = [
    ("counts", "apps"), ("counts", "review_pages"), ("counts", "reviews"), ("counts", "review_changes"),
    ("counts", "sync_states"), ("quality", "missing_review_text"), ("quality", "missing_language"),
    ("quality", "duplicate_recommendationids"), ("sync_state", "state_count"), ("sync_state", "backlogged_count"),
    ("sync_state", "complete_count"),
]


def validation_report(
    reviews: DataFrame,
    apps: DataFrame,
    pages: DataFrame,
    changes: DataFrame,
    state: DataFrame,
    run_id: str | None = None,
) -> DataFrame:
    """All counts, quality figures and distributions as (section, name, label, value). Apps and states ignore the run.

    Every table is aggregated once, to few rows that each feed several figures; the figures are then summed up. Only the
    duplicate check reads the reviews a second time, and only their keys.
    """
    scoped = run_scope(reviews, run_id)
    return report_of(
        scoped.groupBy("app_id", recommendation().alias("flag")).agg(
            F.count("*").alias("n"), _missing_text().alias("no_text"), _missing_language().alias("no_language")
        ),
        duplicate_keys(scoped, ["recommendationid"]).agg(F.count("*").alias("n")),
        run_scope(pages, run_id).groupBy("status").agg(F.count("*").alias("n")),
        run_scope(changes, run_id).groupBy("change_type").agg(F.count("*").alias("n")),
        apps,
        state,
    )


def report_of(
    per_app_and_flag: DataFrame,
    duplicates: DataFrame,
    per_status: DataFrame,
    per_change: DataFrame,
    apps: DataFrame,
    state: DataFrame,
) -> DataFrame:
    """The report from its counts `n`: reviews per app and flag (with `no_text` and `no_language`), repeated keys, pages, changes."""
    n = F.col("n")
    parts = [
        _entries(
            per_app_and_flag,
            _entry("counts", "reviews", n),
            _entry("quality", "missing_review_text", F.col("no_text")),
            _entry("quality", "missing_language", F.col("no_language")),
            _entry("recommendation_distribution", F.col("flag"), n),
            _entry("app_review_counts", F.col("app_id"), n),
        ),
        _entries(duplicates, _entry("quality", "duplicate_recommendationids", n)),
        _entries(apps.agg(F.count("*").alias("n")), _entry("counts", "apps", n)),
        _entries(
            per_status,
            _entry("counts", "review_pages", n),
            _entry("page_status_counts", F.col("status"), n),
        ),
        _entries(
            per_change,
            _entry("counts", "review_changes", n),
            _entry("change_counts", F.col("change_type"), n),
        ),
        _entries(
            sync_state_counts(state),
            _entry("counts", "sync_states", F.col("state_count")),
            *(_entry("sync_state", name, F.col(name)) for name in ("state_count", "backlogged_count", "complete_count")),
        ),
        _entries(
            apps.sparkSession.range(1),
            *(_entry(section, name, F.lit(0)) for section, name in ALWAYS_REPORTED),
        ),
    ]
    figures = parts[0]
    for part in parts[1:]:
        figures = figures.unionByName(part)
    figures = figures.groupBy("section", "name").agg(F.sum("value").alias("value"))
    names = apps.select(
        F.lit("app_review_counts").alias("section"), F.col("app_id").alias("name"), F.col("app_name").alias("label")
    )
    return figures.join(names, ["section", "name"], "left").select("section", "name", "label", "value")


def load_summary(
    reports: DataFrame, outcomes: DataFrame, reviews_seen: DataFrame, run_ids: DataFrame | None = None
) -> DataFrame:
    """Per run: apps, pages, reviews seen, and merge outcomes. `run_ids` names runs that may have no pages.

    `outcomes` has (run_id, outcome, rows), `reviews_seen` has (run_id, reviews_seen), keyless reviews included.
    """
    pages = reports.groupBy("run_id").agg(
        F.countDistinct(clean_text(F.col("app_id"))).alias("apps_upserted"), F.count("*").alias("pages_upserted")
    )
    merged = outcomes.groupBy("run_id").agg(*(
        F.coalesce(F.sum(F.when(F.col("outcome") == outcome, F.col("rows"))), F.lit(0)).alias(name)
        for outcome, name in (
            ("inserted", "reviews_inserted"), ("updated", "reviews_updated"), ("unchanged", "duplicates_skipped")
        )
    ))
    if run_ids is not None:
        pages = pages.join(run_ids.select("run_id").distinct(), "run_id", "full_outer")
    joined = pages.join(reviews_seen, "run_id", "left").join(merged, "run_id", "left")
    counts = ["apps_upserted", "pages_upserted", "reviews_seen", "reviews_inserted", "reviews_updated", "duplicates_skipped"]
    return joined.select("run_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts))
