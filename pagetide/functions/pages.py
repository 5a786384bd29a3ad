"""Page classification: status, end reason, extremes, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetide.functions.casts import int_or_none
from pagetide.schemas import RETRYABLE_STATUS_CODES


def page_key(run_id: Column, app_id: Column, page_number: Column) -> Column:
    """`run:app:page`, the page padded to four digits and never cut."""
    number = F.coalesce(page_number, F.lit(0))
    digits = number.cast("string")
    padded = F.when(number.between(0, 999), F.lpad(digits, 4, "0")).otherwise(digits)
    blank = F.lit("")
    return F.concat(F.coalesce(run_id, blank), F.lit(":"), F.coalesce(app_id, blank), F.lit(":"), padded)


def raw_status(success: Column, status_code: Column) -> Column:
    """`fetched` for a 200 page that reports success; anything else is an error."""
    flag = F.lower(success.cast("string"))
    succeeded = F.coalesce((flag == "true") | (flag.try_cast("bigint") == 1), F.lit(False))
    return F.when(succeeded & (F.coalesce(status_code, F.lit(0)) == 200), F.lit("fetched")).otherwise(
        F.lit("fetch_error")
    )


def page_status(status: Column, review_count: Column) -> Column:
    """A fetched page without reviews is `empty`; other states stay."""
    return F.when((status == "fetched") & (F.coalesce(review_count, F.lit(0)) == 0), F.lit("empty")).otherwise(status)


def retryable(status_code: Column) -> Column:
    return F.coalesce(status_code.isin(RETRYABLE_STATUS_CODES), F.lit(False))


def caught_up(high_water: Column, review_count: Column, page_max: Column) -> Column:
    zero = F.lit(0)
    mark = F.coalesce(high_water, zero)
    return (mark > 0) & (F.coalesce(review_count, zero) > 0) & (F.coalesce(page_max, zero) <= mark)


def terminal_reason(
    status: Column,
    review_count: Column,
    next_cursor: Column,
    previous_cursor: Column,
    page_number: Column,
    page_cap: int = 0,
    is_caught_up: Column | None = None,
) -> Column:
    """Why an app's pages end here, or null. `status` is the state before `page_status`; cap 0 means no cap.

    The first rule that holds wins, except that catching up beats all of them on a fetched page.
    """
    fetched = F.coalesce(status == "fetched", F.lit(False))
    reason = F.when(~fetched, F.lit("fetch_error")).when(
        F.coalesce(review_count, F.lit(0)) == 0, F.lit("empty_page")
    )
    if page_cap:
        reason = reason.when(page_number >= page_cap, F.lit("page_cap_reached"))
    reason = reason.when(F.coalesce(next_cursor, F.lit("")) == "", F.lit("missing_next_cursor")).when(
        next_cursor == previous_cursor, F.lit("cursor_not_advancing")
    )
    if is_caught_up is None:
        return reason
    return F.when(fetched & is_caught_up, F.lit("caught_up_to_existing_reviews")).otherwise(reason)


def review_bounds(reviews: Column, field: str = "timestamp_updated") -> tuple[Column, Column]:
    """Largest and smallest timestamp in a page's review array; unreadable values are passed over."""
    values = F.transform(reviews, lambda review: int_or_none(review[field]))
    return F.array_max(values), F.array_min(values)
