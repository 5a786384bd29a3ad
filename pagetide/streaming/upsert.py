"""Loads as a stream: each micro-batch is one load."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagetide.functions import page_status, raw_status
from pagetide.operators.figures import changed_figures
from pagetide.operators.merges import merge_reviews
from pagetide.operators.normalize import explode_reviews, normalize_reviews, parse_payload
from pagetide.plans.load import load_pages, utc_now
from pagetide.plans.store import CHANGES, StaleRead, Store
from pagetide.session import folder_bytes, materialise, scratch, sized_shuffle
from pagetide.sources.landing import read_landed_pages
from pagetide.streaming.chains import CARRIED, add_runs, advanced_state, page_reports, take_pages


PAGE_ORDER = ["run_id", "page_number", "pos"]


def landed_reviews(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """Reviews of landed pages as they arrive, in table form with their load order; failed pages give none."""
    pages = parse_payload(read_landed_pages(spark, path, streaming)).drop("document")
    success, code = F.col("payload.success"), F.col("status_code")
    read = page_status(raw_status(success, code), F.size("payload.reviews")).isin("fetched", "empty")
    return normalize_reviews(explode_reviews(pages.filter(read)), PAGE_ORDER)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a stream: Spark makes one for every new checkpoint and keeps it there over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def _sized_by(staged: DataFrame) -> AbstractContextManager[None]:
    """Shuffles sized by the files of a written copy."""
    folders = {file.rsplit("/", 1)[0] for file in staged.inputFiles()}
    return sized_shuffle(staged.sparkSession, folder_bytes(staged.sparkSession, folders))


def once(store: Store, checkpoint: str, load: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that loads a micro-batch exactly once: stream and batch number name the load."""

    def batch_load(batch: DataFrame, batch_id: int) -> None:
        token = f"{stream_id(store.spark, checkpoint)}-{batch_id}"
        if not store.has(token):
            with scratch(store.spark):
                staged = materialise(batch, "batch")
                with _sized_by(staged):
                    load(staged, token)
            store.compact_pending()

    return batch_load


def _start(rows: DataFrame, store: Store, checkpoint: str, load: Callable[[DataFrame, str], None]) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(once(store, checkpoint, load)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def merge_load(store: Store, order: list[str], hot_rows: int | None = None) -> Callable[[DataFrame, str], None]:
    """Merges a batch of normalized reviews, again if another load comes between."""

    def load(staged: DataFrame, token: str) -> None:
        while True:
            last = store.last_load()
            stored = store.read_all(["reviews", "review_changes", "figures"])
            merged = merge_reviews(stored["reviews"], staged, order, utc_now(), hot_rows).stored_once()
            written = {"reviews": merged.current, "review_changes": merged.changes}
            writes = {
                "reviews": (CHANGES, merged.changed),
                "review_changes": (CHANGES, merged.changes),
                "figures": (CHANGES, changed_figures(stored["figures"], stored, written)),
            }
            try:
                store.publish(writes, token, computed_from=last)
                return
            except StaleRead:
                continue

    return load


def stream_reviews(
    reviews: DataFrame, store: Store, checkpoint: str, order: list[str], hot_rows: int | None = None
) -> StreamingQuery:
    """Merge a stream of normalized reviews (with their load order) until the input present now is used up."""
    return _start(reviews, store, checkpoint, merge_load(store, order, hot_rows))


def page_load(
    store: Store, base_url: str, raw_dir: str, closing: bool = False, review_filter: str = "updated", hot_rows: int | None = None,
    **rules,
) -> Callable[[DataFrame, str], None]:
    """Loads a batch of landed pages into all tables, again if another load comes between."""

    def load(staged: DataFrame, token: str) -> None:
        name = F.coalesce("file_name", F.format_string("app_%s_page_%04d.json", "app_id", "page_number"))
        named = staged.withColumn("file_name", name).withColumn("raw_json_path", F.coalesce("raw_json_path", name))
        while True:
            last = store.last_load()
            stored = store.read_all(CARRIED)
            taken = take_pages(named, stored, base_url, closing, hot_rows, review_filter=review_filter, **rules)
            also = {
                "page_chains": (CHANGES, taken.chains),
                "waiting_pages": (CHANGES, taken.waiting),
                "sync_state": (CHANGES, advanced_state(taken, stored, review_filter, utc_now())),
            }
            files = taken.documents.select("run_id", "file_name", "document")
            try:
                load_pages(
                    store, page_reports(taken), files, ["run_id", "page_number"], raw_dir, hot_rows=hot_rows, token=token,
                    computed_from=last, also=also, fold_runs=add_runs(taken),
                )
                return
            except StaleRead:
                continue

    return load


def stream_pages(
    pages: DataFrame, store: Store, checkpoint: str, base_url: str, raw_dir: str, disable_delta_stop: bool = False,
    hot_rows: int | None = None, **rules,
) -> StreamingQuery:
    """Load a stream of landed pages into all tables until the input present now is used up.

    Each micro-batch is one load: its page reports are made from the documents and cut at the stored high-water marks, and runs,
    apps, pages, reviews, changes and the state of the apps become visible together. The pages of a run may be dealt over any
    number of batches, in any order: cursors, ends and counters go on where the last batch left them. Pages that wait for
    missing ones are taken by `close_runs`.
    """
    load = page_load(store, base_url, raw_dir, hot_rows=hot_rows, disable_delta_stop=disable_delta_stop, **rules)
    return _start(pages, store, checkpoint, load)


def close_runs(store: Store, base_url: str, raw_dir: str, run_id: str | None = None, hot_rows: int | None = None, **rules) -> None:
    """Take all pages (of one run) that still wait: those missing before them will not come."""
    held = store.read("waiting_pages").filter("document is not null")
    held = held if run_id is None else held.filter(F.col("run_id") == run_id)
    if not held.isEmpty():
        with scratch(store.spark):
            load = page_load(store, base_url, raw_dir, closing=True, hot_rows=hot_rows, **rules)
            staged = materialise(held, "held")
            with _sized_by(staged):
                load(staged, uuid.uuid4().hex)
        store.compact_pending()
