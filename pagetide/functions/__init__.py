"""Column functions. All are built from native expressions; none is a UDF."""

from pagetide.functions.casts import (
    float_or_none,
    int_or_none,
    int_or_zero,
    parse_bool,
    timestamp_iso,
    truthy,
)
from pagetide.functions.pages import (
    caught_up,
    page_key,
    page_status,
    raw_status,
    retryable,
    review_bounds,
    terminal_reason,
)
from pagetide.functions.text import clean_review_text, clean_text, mask_url, request_url, response_bytes

__all__ = [
    "caught_up", "clean_review_text", "clean_text", "float_or_none", "int_or_none", "int_or_zero", "mask_url",
    "page_key", "page_status", "parse_bool", "raw_status", "request_url", "response_bytes", "retryable",
    "review_bounds", "terminal_reason", "timestamp_iso", "truthy",
]
