"""An app's pages of a run that arrive over several loads, in any order.

What a page means depends on the pages before it: its cursor is the next cursor of the page before, and pages behind the one that
ended the app are no part of the run. So a load takes pages in turn. A page whose predecessors have not all come waits, with its
document, in a table of its own, until they have, or until its run is closed, which is when pages still missing are known to stay
so. How far each app has come in a run is one row: last page, next cursor, end, and the figures that the state of the app and the
counters of the run are made of. All of it is written with the load itself, so a lost or repeated load changes nothing.

A page that arrives behind others that were taken already (landed again, or missing when its run was closed) is late: it gets the
cursor that the stored page before it names, and replaces a stored page of the same number; pages stored behind it stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetide.operators.merges import add_to_runs, last_per_key
from pagetide.operators.normalize import conform
from pagetide.operators.pages import CHAIN, finish_reports, measure_pages
from pagetide.operators.scans import previous_value
from pagetide.operators.skew import lookup_join
from pagetide.operators.sync import advance_sync_state
from pagetide.schemas import COMPLETE_REASONS, KEYS, PAGE_CHAINS, PAGE_REPORT, WAITING_PAGES
from pagetide.session import materialise

CARRIED = ["page_chains", "waiting_pages", "sync_state", "pages"]
_PAGE = KEYS["waiting_pages"]


@dataclass
class Arrivals:
    """What becomes of the pages of one load.

    `reports` are those of the pages taken, `documents` all at hand, `chains` the new rows of the apps concerned (`new` where
    the run had no page of the app before), `waiting` the changes of the waiting table: a row without a document takes one off.
    """

    reports: DataFrame
    documents: DataFrame
    chains: DataFrame
    waiting: DataFrame


def _before(chain: Column) -> Column:
    """What a chain's next page follows: the number and next cursor of the last one taken."""
    return F.struct(
        F.coalesce("last_page", F.lit(0)).alias("page_number"),
        F.when(chain, F.coalesce("carried_cursor", F.lit(""))).otherwise(F.lit("*")).alias("next_cursor"),
    )


def take_pages(
    landed: DataFrame, stored: dict[str, DataFrame], base_url: str, closing: bool = False, hot_rows: int | None = None, **rules
) -> Arrivals:
    """Takes the landed pages (WAITING_PAGES columns) and those of the same apps that waited for them, as far as it is their turn.

    With `closing`, the landed pages are waiting ones, and pages missing before them are passed over. `rules` are those of
    `finish_reports`.
    """
    documents = conform(landed, WAITING_PAGES).withColumn("_held", F.lit(closing))
    if not closing:
        held = stored["waiting_pages"].filter("document is not null").withColumn("_held", F.lit(True))
        held = lookup_join(held, documents.select(*CHAIN).distinct(), CHAIN, "left_semi", derived=True)
        held = lookup_join(held, documents.select(*_PAGE).distinct(), _PAGE, "left_anti", derived=True)
        documents = documents.unionByName(materialise(held, "held"))
    chains = lookup_join(stored["page_chains"], documents.select(*CHAIN).distinct(), CHAIN, "left_semi", derived=True)
    chains = materialise(chains, "chains")
    known = chains.select(*CHAIN, "last_page", F.col("next_cursor").alias("carried_cursor"), "end_page")
    measured = materialise(lookup_join(measure_pages(documents), known, CHAIN, "left"), "measured")

    past_end = F.coalesce(F.col("page_number") > F.col("end_page"), F.lit(False))
    late = F.coalesce(F.coalesce("page_number", F.lit(0)) <= F.col("last_page"), F.lit(False))
    open_pages = measured.filter(~past_end)
    own = F.struct(F.coalesce("page_number", F.lit(0)).alias("page_number"), "next_cursor")
    turn = open_pages.filter(~late).withColumn("_own", own)
    turn = previous_value(turn, CHAIN, ["page_number"], "_own", "_before", _before(F.col("last_page").isNotNull()), hot_rows)
    turn = materialise(turn.withColumn("cursor", F.coalesce("_before.next_cursor", F.lit(""))), "in-turn")
    gap = F.lit(False) if closing else F.coalesce(F.col("page_number") > F.col("_before.page_number") + 1, F.lit(False))
    gaps = materialise(turn.groupBy(*CHAIN).agg(F.min(F.when(gap, F.col("page_number"))).alias("gap")).filter("gap is not null"), "gaps")
    taken = lookup_join(turn, gaps, CHAIN, "left").filter(F.col("gap").isNull() | (F.coalesce("page_number", F.lit(0)) < F.col("gap")))
    columns = [*measured.columns, "cursor", "_again"]
    taken = taken.withColumn("_again", F.lit(False)).select(*columns)
    tardy = materialise(open_pages.filter(late), "late")
    if not tardy.isEmpty():
        taken = taken.unionByName(_late_pages(tardy, stored["pages"], hot_rows).select(*columns))

    made = finish_reports(taken, stored["sync_state"], base_url, **rules)
    reports = materialise(made, "page-reports")
    after = materialise(_advance(chains, reports), "chains-after")
    # A page waits on if its chain has a gap before it and no end.
    info = materialise(gaps.join(after.filter("end_page is not null").select(*CHAIN), CHAIN, "left_anti"), "open-gaps")
    marked = lookup_join(documents, info, CHAIN, "left")
    waits = F.coalesce(F.col("page_number") >= F.col("gap"), F.lit(False))
    waiting = marked.filter((waits & ~F.col("_held")) | (~waits & F.col("_held"))).withColumn(
        "document", F.when(waits, F.col("document"))
    )
    return Arrivals(reports, documents, after, waiting.select(*WAITING_PAGES.names))


def _late_pages(tardy: DataFrame, pages: DataFrame, hot_rows: int | None) -> DataFrame:
    """Late pages with the cursor that the stored page before each names; `_again` where the page is stored already."""
    chain = tardy.select(*CHAIN).distinct()
    stored = lookup_join(pages.select(*_PAGE, "next_cursor"), chain, CHAIN, "left_semi", derived=True)
    numbers = tardy.select(*_PAGE).distinct()
    again = lookup_join(stored.select(*_PAGE), numbers, _PAGE, "left_semi").withColumn("_again", F.lit(True))
    others = lookup_join(stored, numbers, _PAGE, "left_anti").withColumn("_late", F.lit(False))
    both = tardy.withColumn("_late", F.lit(True)).unionByName(others, allowMissingColumns=True)
    chained = previous_value(both, CHAIN, ["page_number"], "next_cursor", "cursor", F.lit("*"), hot_rows)
    chained = chained.filter("_late").drop("_late").withColumn("cursor", F.coalesce("cursor", F.lit("")))
    return lookup_join(chained, again, _PAGE, "left", derived=True).withColumn("_again", F.coalesce("_again", F.lit(False)))


def _advance(chains: DataFrame, reports: DataFrame) -> DataFrame:
    """The rows of the chains that the reports belong to, counters added up; `new` where there was none before."""
    first = ~F.col("_again")
    end = F.when(F.col("terminal_reason").isNotNull(), F.struct("page_number", "terminal_reason"))
    part = reports.groupBy(*CHAIN).agg(
        F.max(F.struct("page_number", "next_cursor")).alias("last"),
        F.min(end).alias("end"),
        F.max("max_timestamp_updated").alias("max_seen"),
        F.min("min_timestamp_updated").alias("min_seen"),
        F.count(F.when(first, F.lit(1))).alias("page_count"),
        F.sum(F.when(first, F.coalesce("review_count", F.lit(0))).otherwise(0)).alias("review_count"),
    )
    old = chains.select(*CHAIN, *(F.col(c).alias(f"old_{c}") for c in PAGE_CHAINS.names if c not in CHAIN))
    joined = part.join(old, CHAIN, "left")
    further = F.col("old_last_page").isNull() | (F.col("last.page_number") >= F.col("old_last_page"))
    sooner = F.col("old_end_page").isNull() | (F.col("end.page_number") < F.col("old_end_page"))
    return joined.select(
        *CHAIN,
        F.greatest("last.page_number", "old_last_page").alias("last_page"),
        F.when(further, F.col("last.next_cursor")).otherwise(F.col("old_next_cursor")).alias("next_cursor"),
        F.least("end.page_number", "old_end_page").alias("end_page"),
        F.when(F.col("end").isNotNull() & sooner, F.col("end.terminal_reason")).otherwise(F.col("old_terminal_reason")).alias("terminal_reason"),
        F.greatest("max_seen", "old_max_seen").alias("max_seen"),
        F.least("min_seen", "old_min_seen").alias("min_seen"),
        (F.col("page_count") + F.coalesce("old_page_count", F.lit(0))).alias("page_count"),
        (F.col("review_count") + F.coalesce("old_review_count", F.lit(0))).alias("review_count"),
        F.col("old_last_page").isNull().alias("new"),
    )


def page_reports(arrivals: Arrivals) -> DataFrame:
    return conform(arrivals.reports, PAGE_REPORT)


def add_runs(arrivals: Arrivals):
    """How the run rows of this load go into the stored ones: an app counts once, with its first page."""
    apps = arrivals.chains.groupBy("run_id").agg(F.count(F.when(F.col("new"), F.lit(1))).alias("_apps"))

    def fold(existing: DataFrame, parts: DataFrame) -> DataFrame:
        counted = parts.join(apps, "run_id", "left").withColumn("app_count", F.coalesce("_apps", F.lit(0))).drop("_apps")
        return add_to_runs(existing, counted)

    return fold


def advanced_state(arrivals: Arrivals, stored: dict[str, DataFrame], review_filter: str, at: str) -> DataFrame:
    """The state rows of the apps concerned, from all their runs so far. An app whose pages go on has no end reason yet."""
    apps = arrivals.chains.select("app_id").distinct()
    chains = lookup_join(stored["page_chains"], apps, "app_id", "left_semi", derived=True).withColumn("_rank", F.lit(0))
    fresh = arrivals.chains.select(*PAGE_CHAINS.names).withColumn("_rank", F.lit(1))
    latest = last_per_key(chains.unionByName(fresh), CHAIN, ["_rank"], PAGE_CHAINS.names)
    progress = latest.withColumn("terminal_reason", F.coalesce("terminal_reason", F.lit("unknown")))
    progress = progress.filter("app_id is not null").withColumn("complete", F.col("terminal_reason").isin(COMPLETE_REASONS))
    return advance_sync_state(stored["sync_state"], progress, review_filter, at, at, at).states
