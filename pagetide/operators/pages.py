"""From landed documents to page reports, and where an app's pages end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetide.functions import (
    caught_up,
    clean_text,
    int_or_none,
    page_status,
    raw_status,
    request_url,
    response_bytes,
    retryable,
    review_bounds,
    terminal_reason,
)
from pagetide.operators.normalize import parse_payload
from pagetide.operators.scans import previous_value
from pagetide.operators.skew import lookup_join
from pagetide.session import materialise

CHAIN = ["run_id", "app_id"]


def measure_pages(pages: DataFrame) -> DataFrame:
    """One narrow row per document: status, counts, extremes, next cursor. The document itself goes no further."""
    reviews = F.col("payload.reviews")
    newest, oldest = review_bounds(reviews)
    others = [c for c in pages.columns if c not in ("document", "payload")]
    return parse_payload(pages).select(
        *others,
        raw_status(F.col("payload.success"), F.col("status_code")).alias("raw_status"),
        retryable(F.col("status_code")).alias("retryable"),
        clean_text(F.col("payload.cursor")).alias("next_cursor"),
        F.coalesce(F.size(reviews), F.lit(0)).alias("review_count"),
        newest.alias("max_timestamp_updated"),
        oldest.alias("min_timestamp_updated"),
        *(int_or_none(F.col(f"payload.query_summary.{n}")).alias(n)
          for n in ("total_reviews", "total_positive", "total_negative")),
        response_bytes(F.col("document")).alias("response_bytes"),
    )


def cursor_chain(pages: DataFrame, order: list[str], hot_rows: int | None = None) -> DataFrame:
    """Adds `cursor`: the next cursor of the page before, `*` on the first page of an app in a run."""
    chained = previous_value(pages, CHAIN, order, "next_cursor", "cursor", F.lit("*"), hot_rows)
    return chained.withColumn("cursor", F.coalesce("cursor", F.lit("")))


def with_high_water(pages: DataFrame, state: DataFrame) -> DataFrame:
    marks = state.select("app_id", F.col("complete_through_timestamp_updated").alias("high_water"))
    return lookup_join(pages, marks, "app_id", "left").withColumn("high_water", F.coalesce("high_water", F.lit(0)))


def end_pages(pages: DataFrame, page_cap: int = 0, delta_stop: bool = True) -> DataFrame:
    """Adds `terminal_reason` and the final `status` to measured pages that have a cursor and a high-water mark."""
    reached = caught_up(F.col("high_water"), F.col("review_count"), F.col("max_timestamp_updated"))
    return pages.withColumn(
        "terminal_reason",
        terminal_reason(
            F.col("raw_status"), F.col("review_count"), F.col("next_cursor"), F.col("cursor"), F.col("page_number"),
            page_cap, reached if delta_stop else None,
        ),
    ).withColumn("status", page_status(F.col("raw_status"), F.col("review_count")))


def stop_at_first_end(pages: DataFrame) -> DataFrame:
    """Keep an app's pages up to the first one with an end reason.

    The first end is an aggregate (combined before its shuffle) that is joined back, so no app is gathered into a task.
    """
    ends = pages.groupBy(*CHAIN).agg(
        F.min(F.when(F.col("terminal_reason").isNotNull(), F.col("page_number"))).alias("_end")
    )
    kept = lookup_join(pages, ends, CHAIN, "left", derived=True)
    return kept.filter(F.col("_end").isNull() | (F.col("page_number") <= F.col("_end"))).drop("_end")


def cut_at_marks(reports: DataFrame, marks: DataFrame) -> DataFrame:
    """Page reports up to the first page of an app that lies at or below its mark, which is what ends the app.

    `marks` has app_id and high_water. Reports of other apps, and end reasons that come first, stay as they are.
    """
    marked = lookup_join(reports, marks.select("app_id", "high_water"), "app_id", "left")
    reached = (F.col("status") == "fetched") & caught_up(F.col("high_water"), F.col("review_count"), F.col("max_timestamp_updated"))
    ends = F.when(F.coalesce(reached, F.lit(False)), F.lit("caught_up_to_existing_reviews"))
    ended = marked.withColumn("terminal_reason", F.coalesce(ends, F.col("terminal_reason")))
    stops = marked.withColumn("_reached", ends.isNotNull()).filter("_reached").groupBy(*CHAIN).agg(F.min("page_number").alias("_end"))
    kept = lookup_join(ended, stops, CHAIN, "left", derived=True)
    return kept.filter(F.col("_end").isNull() | (F.col("page_number") <= F.col("_end"))).select(*reports.columns)


def delta_applies(review_filter: str, disabled: bool = False) -> bool:
    """Only pages ordered by update time may stop at the high-water mark."""
    return review_filter == "updated" and not disabled


def report_landed_pages(
    pages: DataFrame,
    state: DataFrame,
    base_url: str,
    review_filter: str = "updated",
    language: str = "english",
    page_size: int = 100,
    page_cap: int = 0,
    disable_delta_stop: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Page reports of landed documents, cut where each app ended.

    `pages` has run_id, app_id, app_name, page_number, status_code, attempt_count, fetched_at, raw_json_path, document.
    """
    chained = cursor_chain(materialise(measure_pages(pages), "pages"), ["page_number"], hot_rows)
    return finish_reports(chained, state, base_url, review_filter, language, page_size, page_cap, disable_delta_stop)


def finish_reports(
    chained: DataFrame,
    state: DataFrame,
    base_url: str,
    review_filter: str = "updated",
    language: str = "english",
    page_size: int = 100,
    page_cap: int = 0,
    disable_delta_stop: bool = False,
) -> DataFrame:
    """Page reports of measured pages that have their cursor."""
    ended = end_pages(with_high_water(chained, state), page_cap, delta_applies(review_filter, disable_delta_stop))
    url = request_url(base_url, F.col("app_id"), F.col("cursor"), review_filter, language, page_size=page_size)
    message = F.when(
        F.col("raw_status") == "fetch_error",
        F.when(F.col("status_code") != 200, F.concat(F.lit("HTTP "), F.col("status_code").cast("string"))).otherwise(
            F.lit("page did not report success")
        ),
    )
    reports = ended.withColumn("request_url", url).withColumn("error_message", message)
    return stop_at_first_end(materialise(reports, "reports"))
