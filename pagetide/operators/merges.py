"""Merges of incoming rows into stored tables. Each returns the new table; the caller decides where to write it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.functions import clean_text
from pagetide.operators.fold import OUTCOME, PREVIOUS, fold_versions
from pagetide.operators.normalize import conform
from pagetide.operators.scans import ordered_by
from pagetide.operators.skew import lookup_join
from pagetide.schemas import APPS, DEFAULTS, KEYS, PAGES, REVIEW_CHANGES, REVIEWS, RUNS
from pagetide.session import materialise


def last_per_key(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """The last row of each key. The aggregation combines before the shuffle, so hot keys cost nothing extra."""
    rest = [c for c in columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), ordered_by(order)).alias("_row"))
        .select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))
        .select(*columns)
    )


def ranked_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both sides in one frame, `_rank` 0 for stored and 1 for incoming rows. Order columns of stored rows are null."""
    return incoming.withColumn("_rank", F.lit(1)).unionByName(
        existing.withColumn("_rank", F.lit(0)), allowMissingColumns=True
    )


def overwrite_by_key(existing: DataFrame | None, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace stored rows of the same key. Each side is read once and shuffled once."""
    if existing is None:
        return incoming
    columns = incoming.columns
    return last_per_key(ranked_union(existing.select(*columns), incoming), keys, ["_rank"], columns)


def merge_runs(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    return overwrite_by_key(existing, conform(incoming, RUNS, DEFAULTS["runs"]), KEYS["runs"])


def add_to_runs(existing: DataFrame, parts: DataFrame) -> DataFrame:
    """Runs of which one more part was loaded: counters add up, the rest is that of the latest part."""
    counters = list(DEFAULTS["runs"])
    before = existing.select("run_id", *(F.col(c).alias(f"_{c}") for c in counters))
    sums = conform(parts, RUNS, DEFAULTS["runs"]).join(before, "run_id", "left").withColumns({
        c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in counters
    })
    return overwrite_by_key(existing, sums.select(*RUNS.names), KEYS["runs"])


def seen_apps(reports: DataFrame, order: list[str], targets: DataFrame | None = None) -> DataFrame:
    """One row per app of the reports: names, flags and notes from the target list, else the page's app name.

    The page name is that of the app's first report in each run, even when it is null. Over several runs the last known
    name stands, as it would after loading the runs one by one.
    """
    named = reports.select(
        "run_id", clean_text(F.col("app_id")).alias("app_id"), clean_text(F.col("app_name")).alias("app_name"), *order
    ).filter(F.col("app_id").isNotNull())
    per_run = named.groupBy("run_id", "app_id").agg(
        F.min_by(F.struct("app_name"), ordered_by(order)).alias("first")
    )
    if targets is not None:
        wanted = last_per_key(
            targets.select("app_id", F.col("app_name").alias("target_name"), "active", "notes", "row_number"),
            ["app_id"], ["row_number"], ["app_id", "target_name", "active", "notes"],
        )
        per_run = per_run.join(wanted, "app_id", "left")
    else:
        per_run = per_run.withColumns({
            "target_name": F.lit(None).cast("string"),
            "active": F.lit(True),
            "notes": F.lit(None).cast("string"),
        })
    name = F.coalesce(clean_text(F.col("target_name")), F.col("first.app_name"))
    return per_run.groupBy("app_id").agg(
        F.max_by(name, F.when(name.isNotNull(), F.col("run_id"))).alias("app_name"),
        F.coalesce(F.max("active"), F.lit(True)).alias("active"),
        F.max(clean_text(F.col("notes"))).alias("notes"),
        F.min("run_id").alias("first_seen_run_id"),
        F.max("run_id").alias("last_seen_run_id"),
    )


def merge_apps(existing: DataFrame | None, seen: DataFrame) -> DataFrame:
    """New names and notes win unless null, the first run is kept, the last run is replaced."""
    incoming = seen.select(*APPS.names)
    if existing is None:
        return incoming
    old, new = existing.alias("old"), incoming.alias("new")

    def newer(column: str) -> Column:
        return F.coalesce(F.col(f"new.{column}"), F.col(f"old.{column}")).alias(column)

    return old.join(new, F.col("old.app_id") == F.col("new.app_id"), "full_outer").select(
        newer("app_id"),
        newer("app_name"),
        newer("active"),
        newer("notes"),
        F.coalesce("old.first_seen_run_id", "new.first_seen_run_id").alias("first_seen_run_id"),
        newer("last_seen_run_id"),
    )


def merge_pages(existing: DataFrame | None, incoming: DataFrame, order: list[str]) -> DataFrame:
    """The last row of a (run, app, page number) wins; the page key of a stored page stays."""
    keys = KEYS["pages"]
    if existing is None:
        return last_per_key(incoming, keys, order, PAGES.names)
    rest = [c for c in PAGES.names if c not in keys]
    rows = ranked_union(existing.select(*PAGES.names), incoming.select(*dict.fromkeys([*PAGES.names, *order])))
    merged = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), ordered_by(["_rank", *order])).alias("_row"),
        F.max(F.when(F.col("_rank") == 0, F.col("page_key"))).alias("_stored_key"),
    )
    return merged.select(*keys, "_stored_key", "_row.*").withColumn(
        "page_key", F.coalesce("_stored_key", "page_key")
    ).select(*PAGES.names)


def incoming_pages(existing: DataFrame | None, incoming: DataFrame, order: list[str]) -> DataFrame:
    """Only the merged rows of incoming pages, for appending to a table of which most pages stay untouched."""
    if existing is None:
        return merge_pages(None, incoming, order)
    stored = lookup_join(existing, incoming.select(*KEYS["pages"]).distinct(), KEYS["pages"], "left_semi", derived=True)
    return merge_pages(stored, incoming, order)


@dataclass
class ReviewMerge:
    """Lazy results of one review merge. `accepted` and `outcomes` come from the same fold."""

    existing: DataFrame | None
    folded: DataFrame
    order: list[str]
    changed_at: str | None

    def stored_once(self) -> ReviewMerge:
        """The same merge over a written copy of the fold, for jobs that use several of its results.

        Unchanged rows are only counted, so they are written without their contents.
        """
        counted = {"run_id", "recommendationid", OUTCOME}
        is_change = F.col(OUTCOME) != "unchanged"
        slim = self.folded.select(*(
            F.col(c) if c in counted else F.when(is_change, F.col(c)).alias(c) for c in self.folded.columns
        ))
        return ReviewMerge(self.existing, materialise(slim, "folded"), self.order, self.changed_at)

    @property
    def outcomes(self) -> DataFrame:
        """Rows per run and outcome, counting incoming rows, not keys."""
        return self.folded.groupBy("run_id", OUTCOME).agg(F.count("*").alias("rows"))

    @property
    def accepted(self) -> DataFrame:
        return self.folded.filter(F.col(OUTCOME) != "unchanged")

    @property
    def changed(self) -> DataFrame:
        """The new current version of every key that changed."""
        return last_per_key(self.accepted, KEYS["reviews"], self.order, REVIEWS.names)

    @property
    def current(self) -> DataFrame:
        """`changed` in the columns that figures are counted by."""
        narrow = [c for c in REVIEWS.names if c in ("recommendationid", "run_id", "app_id", "voted_up", "language", "review")]
        return last_per_key(self.accepted, KEYS["reviews"], self.order, narrow)

    @property
    def table(self) -> DataFrame:
        if self.existing is None:
            return self.changed
        rows = ranked_union(self.existing, self.accepted)
        return last_per_key(rows, KEYS["reviews"], ["_rank", *self.order], REVIEWS.names)

    @property
    def changes(self) -> DataFrame:
        """The last change of every (run, key)."""
        events = self.accepted.select(
            "run_id", "recommendationid", "app_id", F.col(OUTCOME).alias("change_type"), PREVIOUS,
            F.col("timestamp_updated").alias("new_timestamp_updated"), "source_page_key",
            F.lit(self.changed_at).cast("string").alias("changed_at"), *self.order,
        )
        order = [c for c in self.order if c != "run_id"]
        return last_per_key(events, KEYS["review_changes"], order, REVIEW_CHANGES.names)


def merge_reviews(
    existing: DataFrame | None,
    incoming: DataFrame,
    order: list[str],
    changed_at: str | None = None,
    hot_rows: int | None = None,
) -> ReviewMerge:
    """Fold incoming reviews into the stored ones; rows without a key are passed over.

    The stored side is probed with three columns and only for incoming keys, so a small load does not move a large table.
    """
    incoming = incoming.filter(F.col("recommendationid").isNotNull())
    stored = None
    if existing is not None:
        keys = incoming.select("recommendationid").distinct()
        stored = lookup_join(
            existing.select("recommendationid", "timestamp_updated", "review"), keys, "recommendationid", "left_semi",
            derived=True,
        )
    folded = fold_versions(incoming, "recommendationid", order, "timestamp_updated", "review", stored, hot_rows)
    return ReviewMerge(existing, folded, order, changed_at)


def merge_changes(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    return overwrite_by_key(existing, incoming, KEYS["review_changes"])


def import_snapshot(existing: DataFrame, snapshot: DataFrame, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """Overwrite only `columns`, matched by the first of them; other columns of stored rows survive.

    Of snapshot rows with one key the last by `order` counts, by all columns where there is none.
    """
    key = columns[0]
    listed = last_per_key(snapshot, [key], order or columns, columns).withColumn("_listed", F.lit(True))
    old, new = existing.alias("old"), listed.alias("new")
    matched = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    return matched.select(*(
        F.when(F.col("new._listed"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) if c in columns
        else F.col(f"old.{c}").alias(c)
        for c in existing.columns
    ))
