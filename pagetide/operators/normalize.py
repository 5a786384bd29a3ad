"""From landed payloads to table rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetide.functions import (
    clean_review_text,
    clean_text,
    float_or_none,
    int_or_none,
    int_or_zero,
    page_key,
    timestamp_iso,
    truthy,
)
from pagetide.functions.casts import LAST_SECOND
from pagetide.schemas import DEFAULTS, PAGES, PAYLOAD, REVIEWS, SAFE_AUTHOR_FIELDS


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, Any] | None = None) -> DataFrame:
    """Bring any older or narrower frame to the table's columns and types, filling defaults; extra columns go."""
    defaults = defaults or {}
    present = {field.name: field.dataType for field in df.schema}

    def column(field: T.StructField) -> Column:
        default = F.lit(defaults.get(field.name)).cast(field.dataType)
        if field.name not in present:
            return default.alias(field.name)
        value = F.col(field.name)
        if present[field.name] != field.dataType:
            value = value.cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, default)
        return value.alias(field.name)

    return df.select(*(column(field) for field in schema))


def parse_payload(df: DataFrame, document: str = "document", strict: bool = False) -> DataFrame:
    """Adds `payload`. Only the contract's fields are parsed, so personal author fields never enter a row.

    An unreadable document gives an empty payload, or fails the job in strict mode, in the same pass over the documents.
    """
    parsed = df.withColumn("payload", F.from_json(document, PAYLOAD))
    if not strict:
        return parsed
    readable = F.col(document).rlike(r"^\s*\{\s*\}\s*$")
    for name in PAYLOAD.names:
        readable = readable | F.col(f"payload.{name}").isNotNull()
    message = F.concat(F.lit("raw page is not readable: "), F.substring(F.col(document), 1, 80))
    return parsed.withColumn("payload", F.when(readable, F.col("payload")).otherwise(F.raise_error(message)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once. A value named by several branches of a condition is computed in each of them."""
    return F.transform(F.array(value), use)[0]


def sanitize_document(document: Column) -> Column:
    """A raw page document whose authors keep only the fields that may be stored. All else stays, with its JSON type.

    An author that is no object goes; reviews that are no objects stay as they are. What is no JSON object gives null.
    """

    def fields_of(value: Column, path: str = "$") -> Column:
        return F.try_variant_get(value, path, "map<string,variant>")

    def without_author(review: Column) -> Column:
        def rebuilt(others: Column) -> Column:
            def with_safe(author: Column) -> Column:
                safe = F.to_variant_object(F.map_filter(author, lambda name, _: name.isin(SAFE_AUTHOR_FIELDS)))
                joined = F.map_concat(others, F.create_map(F.lit("author"), safe))
                return F.to_variant_object(F.when(author.isNull(), others).otherwise(joined))

            return F.when(others.isNull(), review).otherwise(_once(fields_of(review, "$.author"), with_safe))

        return _once(F.map_filter(fields_of(review), lambda name, _: name != "author"), rebuilt)

    def sanitized(page: Column) -> Column:
        def rebuilt(fields: Column) -> Column:
            def with_clean(reviews: Column) -> Column:
                rest = F.map_filter(fields, lambda name, _: name != "reviews")
                clean = F.to_variant_object(F.transform(reviews, without_author))
                whole = F.to_variant_object(F.map_concat(rest, F.create_map(F.lit("reviews"), clean)))
                return F.when(reviews.isNull(), page).otherwise(whole)

            return F.when(fields.isNotNull(), _once(F.try_variant_get(page, "$.reviews", "array<variant>"), with_clean))

        return _once(fields_of(page), rebuilt)

    return F.to_json(_once(F.try_parse_json(document), sanitized))


def explode_reviews(pages: DataFrame) -> DataFrame:
    """One row per review with its position in the page; pages without reviews give no row.

    An inner explode would have Spark ask for reviews before any join that brought the documents here, and so parse all
    documents for those of a few pages, and these twice.
    """
    others = [c for c in pages.columns if c != "payload"]
    return pages.select(*others, F.posexplode_outer("payload.reviews").alias("pos", "review")).filter("pos is not null")


def normalize_reviews(exploded: DataFrame, keep: list[str] | None = None, last: int = LAST_SECOND) -> DataFrame:
    """Exploded reviews as table rows plus the columns in `keep` (the load order).

    `exploded` has the page's run_id, app_id, page_number and fetched_at next to `review`. Times after `last` have no ISO text.
    """

    def field(name: str) -> Column:
        return F.col(f"review.{name}")

    def author(name: str) -> Column:
        return int_or_none(F.col(f"review.author.{name}"))

    created, updated = int_or_none(field("timestamp_created")), int_or_none(field("timestamp_updated"))
    app_id = clean_text(F.col("app_id"))
    columns = {
        "recommendationid": clean_text(field("recommendationid")),
        "run_id": F.col("run_id"),
        "app_id": app_id,
        "language": clean_text(field("language")),
        "review": clean_review_text(field("review")),
        "timestamp_created": created,
        "timestamp_updated": updated,
        "created_at_iso": timestamp_iso(created, last),
        "updated_at_iso": timestamp_iso(updated, last),
        "weighted_vote_score": float_or_none(field("weighted_vote_score")),
        "collected_at": clean_text(F.col("fetched_at")),
        "source_page_key": page_key(F.col("run_id"), app_id, F.col("page_number")),
    }
    for name in ("votes_up", "votes_funny", "comment_count"):
        columns[name] = int_or_zero(field(name))
    for name in (
        "voted_up", "steam_purchase", "received_for_free", "written_during_early_access", "primarily_steam_deck"
    ):
        columns[name] = truthy(field(name))
    for name in SAFE_AUTHOR_FIELDS:
        columns[name] = author(name)
    kept = [F.col(c) for c in keep or [] if c not in columns]
    return exploded.select(*(columns[name].alias(name) for name in REVIEWS.names), *kept)


def page_rows(reports: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Page reports as table rows: cleaned text, defaults, keys, plus the columns in `keep`."""
    text = [
        "app_id", "request_url", "cursor", "next_cursor", "status", "fetched_at", "raw_json_path", "error_message",
        "terminal_reason",
    ]
    cleaned = reports.withColumns({name: clean_text(F.col(name)) for name in text}).withColumns({
        "page_number": F.coalesce("page_number", F.lit(0)),
        "status": F.coalesce("status", F.lit("unknown")),
        "attempt_count": F.coalesce(F.nullif("attempt_count", F.lit(0)), F.lit(1)),
    })
    keyed = cleaned.withColumn("page_key", page_key(F.col("run_id"), F.col("app_id"), F.col("page_number")))
    kept = [c for c in keep or [] if c not in PAGES.names]
    filled = [
        F.coalesce(field.name, F.lit(DEFAULTS["pages"][field.name])).cast(field.dataType).alias(field.name)
        if field.name in DEFAULTS["pages"] else F.col(field.name).cast(field.dataType).alias(field.name)
        for field in PAGES
    ]
    return keyed.select(*filled, *kept)
