"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetide.schemas import MAX_PAGE_SIZE, REVIEW_FILTERS

# White space as Unicode defines it, plus the four ASCII separators that Java leaves out: as a class and as characters.
_SPACE = r"[\s\x1c-\x1f]"
_SPACES = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000
]))


def clean_text(value: Column) -> Column:
    """Collapse white space, strip, and turn an empty result into null."""
    collapsed = F.regexp_replace(value, f"(?U){_SPACE}+", " ")
    return F.nullif(F.trim(collapsed), F.lit(""))


def clean_review_text(value: Column) -> Column:
    """Line ends become LF, outer white space goes, empty stays empty. No regular expression runs over the whole text."""
    lines = F.replace(F.replace(value, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.btrim(lines, F.lit(_SPACES))


def mask_url(url: Column) -> Column:
    """Hide the password of a URL, or all of the credentials when there is no password."""
    scheme = r"(?s)\A((?:(?!://).)*://)"
    with_password = scheme + r"([^:]*):.*@([^@]*)\z"
    user_only = scheme + r".*@([^@]*)\z"
    return (
        F.when(url.rlike(with_password), F.regexp_replace(url, with_password, "$1$2:***@$3"))
        .when(url.rlike(user_only), F.regexp_replace(url, user_only, "$1***@$2"))
        .otherwise(url)
    )


def _form_encoded(value: Column) -> Column:
    # The JVM encoder and the form encoding of the landed request URLs differ in these two characters.
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def request_url(
    base_url: str,
    app_id: Column,
    cursor: Column,
    review_filter: str = "updated",
    language: str = "english",
    purchase_type: str = "all",
    review_type: str = "all",
    page_size: int = 100,
) -> Column:
    """URL of one review page, for page reports and re-requests."""
    if review_filter not in REVIEW_FILTERS:
        raise ValueError(f"review_filter must be one of: {', '.join(REVIEW_FILTERS)}")
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be between 1 and {MAX_PAGE_SIZE}")
    parameters = {
        "json": F.lit("1"),
        "filter": F.lit(review_filter),
        "language": F.lit(language),
        "purchase_type": F.lit(purchase_type),
        "review_type": F.lit(review_type),
        "num_per_page": F.lit(str(page_size)),
        "cursor": cursor,
    }
    query = F.concat_ws("&", *(F.concat(F.lit(f"{name}="), _form_encoded(v)) for name, v in parameters.items()))
    return F.concat(F.lit(base_url.rstrip("/") + "/"), app_id, F.lit("?"), query)


def response_bytes(document: Column) -> Column:
    """UTF-8 size of a landed document; no document counts as 0."""
    return F.coalesce(F.octet_length(document), F.lit(0)).cast("bigint")
