"""Completeness state per app: how far its updates are known without gaps.

The mark moves only when an app's pages ended for a complete reason. Otherwise the app is backlogged and keeps its mark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.functions import clean_text
from pagetide.operators.merges import overwrite_by_key
from pagetide.operators.normalize import conform
from pagetide.operators.scans import ordered_by, running_max
from pagetide.schemas import CHRONOLOGICAL_FILTERS, COMPLETE_REASONS, DEFAULTS, SYNC_STATE


def normalized_state(state: DataFrame) -> DataFrame:
    """Typed state rows with null counters and marks as 0."""
    defaults = {**DEFAULTS["sync_state"], "backlogged": False}
    return conform(state, SYNC_STATE, defaults)


def sync_states(state: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """All states, or one per requested app; an app without state starts at 0, backlogged."""
    known = normalized_state(state)
    if requested is None:
        return known
    wanted = requested.select("app_id").distinct()
    return conform(wanted.join(known, "app_id", "left"), SYNC_STATE, DEFAULTS["sync_state"])


def high_water_marks(state: DataFrame, requested: DataFrame) -> DataFrame:
    return sync_states(state, requested).select("app_id", F.col("complete_through_timestamp_updated").alias("high_water"))


def backlogged_apps(state: DataFrame) -> DataFrame:
    return state.filter("backlogged")


def app_progress(reports: DataFrame, order: list[str]) -> DataFrame:
    """Per run and app: pages, reviews, extremes, and the end reason of the last page (`unknown` when it has none)."""
    cleaned = reports.withColumn("app_id", clean_text(F.col("app_id"))).filter(F.col("app_id").isNotNull())
    last = F.max_by(F.struct(clean_text(F.col("terminal_reason")).alias("reason")), ordered_by(order))
    return cleaned.groupBy("run_id", "app_id").agg(
        F.max("max_timestamp_updated").alias("max_seen"),
        F.min("min_timestamp_updated").alias("min_seen"),
        F.count("*").alias("page_count"),
        F.sum(F.coalesce("review_count", F.lit(0))).alias("review_count"),
        F.coalesce(last["reason"], F.lit("unknown")).alias("terminal_reason"),
    ).withColumn("complete", F.col("terminal_reason").isin(COMPLETE_REASONS))


def _mark() -> Column:
    return F.when(F.col("complete"), F.coalesce("max_seen", F.lit(0)).cast("bigint"))


def _successful_run() -> Column:
    return F.when(F.col("complete"), F.col("run_id"))


def _state_columns(started_at: str | None, completed_at: str | None, updated_at: str | None) -> list[Column]:
    def text(value: str | None) -> Column:
        return F.lit(value).cast("string")

    columns = {
        "app_id": F.col("app_id"),
        "complete_through_timestamp_updated": F.greatest(F.coalesce("mark", F.lit(0)), F.coalesce("stored_mark", F.lit(0))),
        "backlogged": ~F.col("complete"),
        "last_started_at": text(started_at),
        "last_completed_at": text(completed_at),
        "last_run_id": F.col("run_id"),
        "last_successful_run_id": F.coalesce("successful_run", "stored_run"),
        "last_terminal_reason": F.col("terminal_reason"),
        "last_seen_max_timestamp_updated": F.col("max_seen"),
        "last_seen_min_timestamp_updated": F.col("min_seen"),
        "last_page_count": F.col("page_count"),
        "last_review_count": F.col("review_count"),
        "updated_at": text(updated_at),
    }
    return [columns[field.name].cast(field.dataType).alias(field.name) for field in SYNC_STATE]


def _with_stored(progress: DataFrame, state: DataFrame) -> DataFrame:
    stored = state.select(
        "app_id",
        F.col("complete_through_timestamp_updated").alias("stored_mark"),
        F.col("last_successful_run_id").alias("stored_run"),
    )
    return progress.join(stored, "app_id", "left")


def sync_history(state: DataFrame, progress: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """The state of every app after each of its runs, runs taken in run-id order.

    Run ids rise with time, so "last successful run so far" is a running maximum too.
    """
    history = running_max(
        progress, ["app_id"], ["run_id"], {"mark": _mark(), "successful_run": _successful_run()}, hot_rows
    )
    return _with_stored(history, state).select(*_state_columns(None, None, None))


@dataclass
class SyncUpdate:
    """`states` holds the rows that changed, `table` the whole new state."""

    states: DataFrame
    table: DataFrame
    skipped_reason: str | None = None


def advance_sync_state(
    state: DataFrame,
    progress: DataFrame,
    review_filter: str = "updated",
    started_at: str | None = None,
    completed_at: str | None = None,
    updated_at: str | None = None,
) -> SyncUpdate:
    """Move the state past one or more runs. Pages not ordered by time say nothing about completeness and are skipped."""
    current = normalized_state(state)
    if review_filter not in CHRONOLOGICAL_FILTERS:
        return SyncUpdate(current.limit(0), current, f"filter={review_filter} is not chronological")
    last = ["run_id", "complete", "terminal_reason", "max_seen", "min_seen", "page_count", "review_count"]
    latest = progress.groupBy("app_id").agg(
        F.max(_mark()).alias("mark"),
        F.max(_successful_run()).alias("successful_run"),
        F.max_by(F.struct(*last), F.col("run_id")).alias("last"),
    ).select("app_id", "mark", "successful_run", "last.*")
    states = _with_stored(latest, current).select(*_state_columns(started_at, completed_at, updated_at))
    return SyncUpdate(states, overwrite_by_key(current, states, ["app_id"]))


def summarize_update(update: SyncUpdate) -> DataFrame:
    """Long form (section, name, value) of what an update did; one row per app or reason instead of lists in a row."""
    states = update.states
    zero = F.lit(0).cast("bigint")

    def rows(df: DataFrame, section: str | Column, name: Column, value: Column) -> DataFrame:
        label = F.lit(section) if isinstance(section, str) else section
        return df.select(label.alias("section"), name.cast("string").alias("name"), value.cast("bigint").alias("value"))

    total = states.agg(F.count("*").alias("n"))
    reasons = states.groupBy("last_terminal_reason").agg(F.count("*").alias("n"))
    membership = F.when(F.col("backlogged"), F.lit("backlogged_apps")).otherwise(F.lit("complete_apps"))
    per_app = states.select(
        "app_id",
        F.explode(F.array(
            F.struct(membership.alias("section"), zero.alias("value")),
            F.struct(F.lit("watermarks").alias("section"), F.col("complete_through_timestamp_updated").alias("value")),
        )).alias("entry"),
    )
    return (
        rows(total, "states_updated", F.lit(None), F.col("n"))
        .unionByName(rows(reasons, "terminal_reasons", F.col("last_terminal_reason"), F.col("n")))
        .unionByName(rows(per_app, F.col("entry.section"), F.col("app_id"), F.col("entry.value")))
    )
